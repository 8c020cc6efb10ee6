"""The classifiers: held-out labels for toxicity, a plain dictionary model for perplexity."""

import math
import threading
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from claimtide.llm import quality_lm, queries, toxicity
from claimtide.llm.words import WordHashes

from .frames import docs, edge_rows

SMALL, MIDDLE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def test_toxicity_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in queries.queries()["op8_toxicity"](spark, MIDDLE).collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    labels = [(r.toxic, rows[r.doc_id]) for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()
              if rows[r.doc_id].held_out]
    right = sum(t == r.predicted for t, r in labels) / len(labels)
    assert right > 0.93 and right > max(sum(t == k for t, _ in labels) for k in (0, 1)) / len(labels)


def test_toxicity_learns_beginnings_of_words():
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 5))
    clean = [" ".join(word() for _ in range(120)) for _ in range(200)]
    toxic = []
    for _ in range(120):
        words = [word() for _ in range(120)]
        for k in rng.choice(120, 6, replace=False):
            words[k] = "zorqu" + word()
        toxic.append(" ".join(words))
    model = toxicity.fit(clean[:150] + toxic[:80], [0] * 150 + [1] * 80)
    score = lambda texts: model.score(toxicity.Gains(model.ordinary, model.toxic)(texts))
    assert (score(clean[150:]) < 0.5).mean() > 0.95 and (score(toxic[80:]) >= 0.5).mean() > 0.95


@pytest.mark.parametrize("first, last, space", [
    (0x430, 0x44F, " "), (0x3B1, 0x3C9, " "), (0x628, 0x63A, " "), (0x4E00, 0x55FF, ""), (0x3042, 0x3093, ""),
    (0xE01, 0xE2E, ""),
])
def test_toxicity_in_other_scripts(first, last, space):
    """A word that toxic texts have six times tells them from clean ones."""
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in range(first, last + 1)]
    bad = "".join(rng.choice(letters, 6, replace=False))
    word = lambda: "".join(rng.choice(letters, 5))
    clean = [space.join(word() for _ in range(100)) for _ in range(200)]
    toxic = [space.join(bad if k % 16 == 8 else word() for k in range(100)) for _ in range(120)]
    model = toxicity.fit(clean[:150] + toxic[:80], [0] * 150 + [1] * 80)
    score = lambda texts: model.score(toxicity.Gains(model.ordinary, model.toxic)(texts))
    assert (score(clean[150:]) < 0.5).mean() > 0.9 and (score(toxic[80:]) >= 0.5).mean() > 0.9
    for text in (clean[0], toxic[0], toxic[0].replace(" ", "") * 5):
        plain, at = toxicity.plain(text).encode(), 0
        for window in toxicity.windows(text):
            body = window.removesuffix(toxicity.TAIL)
            body.decode()
            at = plain.find(body, max(0, at - 16)) + len(body)
        assert at == len(plain)


def test_toxicity_never_learns_from_held_out_rows(spark):
    rows = [(k, f"text {k} " + ("venom " * 5 if k % 3 == 0 else "calm ") * 4) for k in range(120)]
    true = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k, _ in rows], "doc_id long, quality int, toxic int")
    turned = spark.createDataFrame(
        [(k, 1, int((k % 3 == 0) != toxicity.held_out(k))) for k, _ in rows], "doc_id long, quality int, toxic int")
    assert toxicity.learn(docs(spark, rows), true) == toxicity.learn(docs(spark, rows), turned)


def test_toxicity_edges(spark):
    none = spark.createDataFrame([(1, None, None), (None, 1, 1), (2, 0, 7)], "doc_id long, quality int, toxic int")
    for labels in (none, none.limit(0)):
        model = toxicity.learn(docs(spark, edge_rows()), labels)
        rows = toxicity.score_texts(docs(spark, edge_rows()), model).collect()
        assert len(rows) == len(edge_rows()) and len({r.score for r in rows}) == 1
    assert toxicity.score_texts(docs(spark, []), model).collect() == []
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(1, 11)], "doc_id long, quality int, toxic int")
    frame = docs(spark, edge_rows())
    model = toxicity.learn(frame, labels)
    kept = toxicity.drop_toxic(frame, model)
    assert kept.columns == frame.columns
    scores = sorted(str(r.doc_id) for r in toxicity.score_texts(frame, model).collect() if r.score < 0.5)
    assert sorted(str(r.doc_id) for r in kept.collect()) == scores


def plain_perplexities(rows, trusted):
    """Interpolated modified Kneser-Ney over the same slots and folds, with dictionaries."""
    hashes = WordHashes()
    seqs = {i: quality_lm.slots_of(t or "", hashes).tolist() for i, t, _ in rows}
    folds = {i: quality_lm.fold_of(t or "") for i, t, _ in rows}
    models = []
    for fold in (0, 1):
        pairs = Counter()
        for i in trusted:
            if i in seqs and folds[i] == fold:
                pairs.update(zip([0, *seqs[i]], seqs[i]))
        total, kinds, then = Counter(), defaultdict(Counter), Counter()
        for (a, b), n in pairs.items():
            total[a] += n
            kinds[a][min(n, 3)] += 1
            then[b] += 1
        d = quality_lm.discounts(*(sum(n == k for n in pairs.values()) for k in (1, 2, 3, 4)))
        u = quality_lm.discounts(*(sum(n == k for n in then.values()) for k in (1, 2, 3, 4)))
        mass = sum(then.values())

        def single(b, then=then, u=u, mass=mass):
            if not mass:
                return 1 / (quality_lm.SLOTS - 1)
            rest = sum(u[min(n, 3)] for n in then.values()) / mass
            return max(then[b] - u[min(then[b], 3)], 0) / mass + rest / (quality_lm.SLOTS - 1)

        def both(a, b, pairs=pairs, total=total, kinds=kinds, d=d, single=single):
            if not total[a]:
                return single(b)
            left = sum(d[k] * n for k, n in kinds[a].items()) / total[a]
            return max(pairs[a, b] - d[min(pairs[a, b], 3)], 0) / total[a] + left * single(b)

        models.append(both)
    out = {}
    for i, seq in seqs.items():
        log = sum(math.log(models[1 - folds[i]](a, b)) for a, b in zip([0, *seq], seq))
        out[i] = math.exp(-log / len(seq)) if seq else None
    return out


def test_perplexity_equals_plain_model(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 200")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in frame.collect()]
    trusted = {r.doc_id for r in labels.where("quality = 1").collect()}
    want = plain_perplexities(rows, trusted)
    got = {r.doc_id: r for r in quality_lm.perplexities(frame.repartition(5), labels).collect()}
    assert got.keys() == want.keys()
    for i, p in want.items():
        assert got[i].perplexity == pytest.approx(p, rel=1e-4)


def test_quality_keeps_trusted_and_drops_junk(spark):
    rows = {r.doc_id: r for r in queries.queries()["op10_quality_lm"](spark, MIDDLE).collect()}
    frame = spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
    assert len(rows) == len(frame)
    by_lang = defaultdict(list)
    trusted = {r.doc_id for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").where("quality = 1").collect()}
    for i in trusted:
        by_lang[rows[i].lang].append(rows[i].perplexity)
    for lang, values in by_lang.items():
        at = next(r.threshold for r in rows.values() if r.lang == lang)
        assert abs(np.mean(np.array(values) <= at) - quality_lm.QUANTILE) < 0.01
    junk = [rows[r.doc_id].keep for r in frame if "%%%" in r.text or "!!" in r.text]
    assert np.mean(junk) < 0.1


def test_quality_edges(spark):
    frame = docs(spark, edge_rows())
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (7, 0, 0), (7, 1, 0), (None, 1, 1), (9, None, None)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_lm.judge(frame.repartition(3), labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in edge_rows())
    assert all((r.perplexity is None) == (r.n_words == 0) and r.keep in (True, False) for r in rows)
    assert not any(r.keep for r in rows if not r.n_words)
    assert all(r.keep for r in quality_lm.judge(frame, labels.limit(0)).collect() if r.n_words)
    assert quality_lm.judge(docs(spark, []), labels).collect() == []


def test_perplexity_keeps_words_apart(spark):
    """More words than 16 bits have: an unknown word has no trusted word's counts."""
    rows = [(k, " ".join(f"w{j}" for j in range(400 * k, 400 * k + 400)) + f" end{k % 2}") for k in range(200)]
    rows += [(1000, " ".join(f"w{j}" for j in range(300))), (1001, " ".join(f"junk{j}" for j in range(3000)))]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(200)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.perplexity for r in quality_lm.perplexities(docs(spark, rows), labels).collect()}
    hashes = WordHashes()
    slots = {int(x) for _, t in rows for x in quality_lm.slots_of(t, hashes)}
    assert len(slots) == len({w for _, t in rows for w in t.split()})
    assert got[1001] > 1 << 16  # each unknown word has only the uniform part


def plain_words(rng, count):
    return " ".join(f"{x:x}" for x in rng.integers(0, 1 << 48, count))


def test_perplexity_stores_no_pairs_of_untrusted_text(spark):
    """All that is stored while documents are scored is the model and the result, whatever else the corpus holds."""
    rng = np.random.default_rng(8)
    rows = [(k, plain_words(rng, 2000)) for k in range(300)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(3)], "doc_id long, quality int, toxic int")
    root = Path(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:"))
    stored, ended = [], threading.Event()

    def size():
        return sum(f.stat().st_size for f in root.rglob("*.parquet") if f.exists())

    def watch():
        while not ended.wait(0.02):
            try:
                stored.append(size())
            except FileNotFoundError:
                pass

    frame = docs(spark, rows).repartition(4).cache()
    frame.count()
    before, watcher = size(), threading.Thread(target=watch)
    watcher.start()
    try:
        got = quality_lm.perplexities(frame, labels).collect()
    finally:
        ended.set()
        watcher.join()
    assert len(got) == len(rows) and all(r.n_words == 2000 for r in got)
    assert max(stored) - before < 1 << 20  # 600,000 pairs, of which trusted text has 6,000
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("quality_")]


def test_perplexity_is_the_same_in_rounds(spark, monkeypatch):
    """Rounds part the documents only: the same sums to the last bit, and the same for equal texts."""
    rng = np.random.default_rng(9)
    word = lambda: f"w{int(rng.zipf(1.3)) % 5000}"
    texts = [" ".join(word() for _ in range(int(n))) for n in rng.integers(0, 200, 60)]
    rows = [(k, texts[k % 60]) for k in range(120)] + [(3, texts[3]), (None, texts[4]), (500, None)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    frame = docs(spark, rows).repartition(3)
    score = lambda: sorted(((str(r.doc_id), r.n_words, r.perplexity) for r in quality_lm.perplexities(frame, labels).collect()),
                           key=str)
    one = score()
    monkeypatch.setattr(quality_lm, "ROUND_BYTES", 8 << 10)
    assert score() == one and len(one) == len(rows)
    of = {i: p for i, _, p in one}
    assert all(of[str(k)] == of[str(k + 60)] for k in range(60))


def test_perplexity_where_trusted_documents_are_too_many_to_send(spark, monkeypatch):
    rows = [(k, f"a b c d{k % 7} a b e{k % 5}") for k in range(40)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int")
    score = lambda: {r.doc_id: r.perplexity for r in quality_lm.perplexities(docs(spark, rows), labels).collect()}
    sent = score()
    monkeypatch.setattr(quality_lm, "MOST_SENT", 0)
    assert score() == sent
