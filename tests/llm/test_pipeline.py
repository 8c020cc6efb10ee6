"""The pipeline's stages on one small table, each against what it must do."""

import random

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from claimtide.llm import decontamination, jaccard_join, personal_data, toxicity

from .frames import docs
from .test_jaccard import brute

SMALL = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "jaccard_join", "decontamination", "personal_data", "packing"]
    before = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, docs = {}, before
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), name)
        assert docs.columns == before.columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    all_rows = {r.doc_id: r for r in before.collect()}
    model = toxicity.learn(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.score_texts(before, model).collect()}
    assert set(kept["toxicity"]) == {d for d in all_rows if scores[d] < 0.5}
    assert len(kept["toxicity"]) > 0.9 * len(all_rows) * 0.9
    groups = brute([(d, r.text) for d, r in kept["toxicity"].items()], size=5, share=80)
    assert set(kept["jaccard_join"]) == {c for _, _, c in groups}
    items = [r.text.lower() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for doc, row in kept["jaccard_join"].items():
        if any(i in row.text.lower() for i in items):
            assert doc not in kept["decontamination"]
    leaks = {r.doc_id for r in decontamination.find_leaks(before, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert set(kept["decontamination"]) == set(kept["jaccard_join"]) - leaks
    assert set(kept["personal_data"]) == set(kept["decontamination"])
    for doc, row in kept["personal_data"].items():
        assert row.text == personal_data.masked_text(all_rows[doc].text, 0.5) and row.n_chars == len(row.text)
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for doc, row in kept["personal_data"].items():
        own = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        assert sum(p.length for p in own) == len(encode.encode(row.text, add_special_tokens=False).ids) + 1
    assert {p.doc_id for p in pieces} == set(kept["personal_data"])


def test_near_copies_by_five_words_and_four_fifths(spark):
    """All pairs by brute force, with pairs between the query's limits and the pipeline's."""
    rng = random.Random(6)
    rows = []
    for k in range(30):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((10 * k, " ".join(words)))
        for n in range(1, 4):
            changed = list(words)
            for j in range(3 + n % 3 if k % 2 else 4):
                changed[10 + 40 * j] = f"x{k}n{n}j{j}"
            rows.append((10 * k + n, " ".join(changed)))
    sets = {i: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    between = 0
    for i in sets:
        for j in sets:
            share = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if i < j and share >= 0.8:
                a, b = sorted((find(i), find(j)))
                root[b] = a
                between += share < 0.815
    kept = {r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs(spark, rows), "").collect()}
    assert between and kept == {find(i) for i in sets}
    assert len({r.doc_id for r in jaccard_join.keep_one(docs(spark, rows)).collect()}) > len(kept)
