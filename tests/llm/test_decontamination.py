"""Decontamination against a search for every item in every text."""

import random
from types import SimpleNamespace

import numpy as np
import pytest

from claimtide.llm import decontamination, queries
from claimtide.llm.words import WordHashes, runs

from .frames import docs, edge_rows

SMALL = "/root/testdata/sf0.01"


def test_verbatim_items_are_found(spark):
    texts = {r.doc_id: r.text.lower() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = {r.item_id: r.text.lower() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in texts.items() for i, q in items.items() if q in t}
    got = {(r.doc_id, r.item_id) for r in queries.queries()["op9_decontamination"](spark, SMALL).collect()}
    assert want and want <= got
    for doc, item in got - want:  # with changes, most of the item's words are still there in order
        share = np.mean([" ".join(p) in " ".join(texts[doc].split()) for p in zip(items[item].split(), items[item].split()[1:])])
        assert share > 0.7


def test_block_max_wand_equals_all_scores(monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 4)
    rng = np.random.default_rng(7)
    for _ in range(60):
        items, terms = int(rng.integers(1, 90)), int(rng.integers(1, 30))
        weight = np.where(rng.random((terms, items)) < 0.4, rng.random((terms, items)) * 0.3, 0)
        weight[:, 0] += 0.01
        rows = [(t, i, weight[t, i]) for t in range(terms) for i in np.flatnonzero(weight[t])]
        first = np.searchsorted([r[0] for r in rows], np.arange(terms + 1))
        index = decontamination.Index(32, np.arange(terms, dtype=np.uint64), first, np.array([r[1] for r in rows]),
                                      np.array([r[2] for r in rows]))
        own = np.unique(rng.integers(0, terms, int(rng.integers(1, terms + 1))))
        scores = weight[own].sum(axis=0)
        want = [(i, s) for i, s in enumerate(scores) if s >= decontamination.THRESHOLD - 1e-9]
        got = index.search(own.tolist())
        assert [i for i, _ in got] == [i for i, _ in want]
        assert np.allclose([s for _, s in got], [s for _, s in want])


@pytest.fixture
def made(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(words, k=n))) for k, n in enumerate([5, 12, 16, 17, 40, 64, 65, 300])]
    frame = spark.createDataFrame([(k, t, "x") for k, t in items] + [(50, None, "x"), (51, "", "x"), (None, "a b c d e", "x"), (52, "one", "x")],
                                  "item_id long, text string, term string")
    rows, want = [], set()
    for k, text in items:
        for place in (0, 7, 30, 63, 64, 65, 200):  # across the borders of passages
            doc = len(rows)
            rows.append((doc, " ".join([*rng.choices(words, k=place), text.upper() if place == 7 else text, *rng.choices(words, k=100)])))
            want.add((doc, k))
        changed = text.split()
        if len(changed) >= 40:
            changed[3] = "changed"
            rows.append((len(rows), " ".join(changed)))
            want.add((len(rows) - 1, k))
        rows.append((len(rows), " ".join(rng.sample(text.split(), len(text.split())))))  # the words in another order
        rows.append((len(rows), " ".join(text.split()[:len(text.split()) // 2])))  # half an item
    return rows, frame, want


@pytest.mark.parametrize("shard", [20_000, 3])
def test_items_at_all_places(spark, made, shard, monkeypatch):
    monkeypatch.setattr(decontamination.shards, "__defaults__", (shard,))
    rows, items, want = made
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs(spark, rows), items).collect()}
    assert got == want
    frame = docs(spark, [*rows, *((None if i is None else i + 1000, t) for i, t in edge_rows())])
    kept = decontamination.drop_leaked(frame, items)
    assert kept.columns == frame.columns
    leaked = {d for d, _ in want} | {1004}  # whose text is the item of one word
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        [str(d) for d, _ in rows if d not in leaked] + [str(None if i is None else i + 1000) for i, _ in edge_rows() if i != 4])


def test_edges(spark, made):
    rows, items, _ = made
    assert [(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs(spark, edge_rows()), items).collect()] == [(4, 52)]
    assert decontamination.find_leaks(docs(spark, rows), items.limit(0)).collect() == []
    assert decontamination.find_leaks(docs(spark, []), items).collect() == []


def test_items_of_one_word(spark):
    """They are found where they are the whole text, whatever else the index holds."""
    rows = [(1, "Paris."), (2, "paris"), (3, "paris is a town"), (4, ""), (5, None), (6, "London"), (2, "paris")]
    items = [(10, "Paris"), (11, "paris?"), (12, "!"), (13, "")]
    for more in ([], [(14, "what is the capital of france answer paris is the capital")]):
        frame = spark.createDataFrame(items + more, "item_id long, text string")
        got = sorted((r.doc_id, r.item_id) for r in decontamination.find_leaks(docs(spark, rows), frame).collect())
        assert got == [(1, 10), (1, 11), (2, 10), (2, 10), (2, 11), (2, 11)]
        kept = [r.doc_id for r in decontamination.drop_leaked(docs(spark, rows), frame).collect()]
        assert sorted(kept) == [3, 4, 5, 6]


def test_scores_are_relative_to_the_item():
    texts = {1: "alpha beta gamma delta epsilon zeta", 2: "alpha beta gamma delta other words"}
    hashes, rows = WordHashes(), []
    for item, text in texts.items():
        own = decontamination.words(text)
        rows += [SimpleNamespace(item_id=item, n_words=len(own), term=int(t), n=1) for t in runs(hashes.of(own), 2).view(np.int64)]
    for r in rows:
        r.df = sum(x.term == r.term for x in rows)
    shard = decontamination.Shard(texts, rows, 2, 6.0)
    assert [(i, round(s, 6)) for i, s, _, _ in shard.leaks(f"x y {texts[1]} z", hashes)] == [(1, 1.0)]
