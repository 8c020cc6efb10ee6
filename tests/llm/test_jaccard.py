"""The Jaccard join against all pairs."""

import random
import re

import pytest

from claimtide.llm import jaccard_join, queries

from .duck import assert_same_as_duckdb
from .frames import docs, edge_rows

SMALL = "/root/testdata/sf0.01"


def sets_of(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, size=4, share=85):
    """(doc_id, set size, component) of each row, by comparing all pairs that share a shingle."""
    sets, root, holders = [sets_of(t, size) for _, t in rows], list(range(len(rows))), {}

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k, own in enumerate(sets):
        near = {j for s in own for j in holders.setdefault(s, [])}
        for j in near:
            if find(j) != find(k):
                both = len(own & sets[j])
                if 100 * both >= share * (len(own) + len(sets[j]) - both):
                    root[find(k)] = find(j)
        for s in own:
            holders[s].append(k)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(k)] = min(doc, least.get(find(k), doc))
    return sorted(((doc, len(sets[k]), least.get(find(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)), key=str)


def brute_links(rows, size=4, share=85):
    """(doc_id, number of links) of each row."""
    sets, links, holders = [sets_of(t, size) for _, t in rows], [0] * len(rows), {}
    for k, own in enumerate(sets):
        for j in {j for s in own for j in holders.setdefault(s, [])}:
            both = len(own & sets[j])
            if 100 * both >= share * (len(own) + len(sets[j]) - both):
                links[k] += 1
                links[j] += 1
        for s in own:
            holders[s].append(k)
    return sorted(((doc, n) for (doc, _), n in zip(rows, links)), key=str)


def links(frame):
    return sorted(((r.doc_id, r.n_links) for r in frame.collect()), key=str)


def joined(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join_documents(frame).collect()), key=str)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    frame = queries.queries()["op7_jaccard_join"](spark, SMALL)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=str)
    assert got == brute(rows)
    assert links(frame) == brute_links(rows)
    assert len({c for _, _, c in got}) < len(rows)


def copies(rng, words, changes):
    """A text with so many of its words changed."""
    words = list(words)
    for k in rng.sample(range(len(words)), changes):
        words[k] = f"c{rng.randrange(10**9)}"
    return " ".join(words)


def made_rows():
    """Chains of copies about the threshold, one large group, a passage that many texts share."""
    rng = random.Random(5)
    rows, fresh = [], lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    for _ in range(12):
        words = fresh(rng.choice([3, 4, 9, 40, 200]))
        for step in range(6):  # each a copy of the one before
            rows.append(" ".join(words))
            words = copies(rng, words, min(len(words), rng.randrange(0, 1 + len(words) // 45))).split()
    large = fresh(120)
    rows += [copies(rng, large, k % 6) for k in range(200)]
    passage = fresh(60)
    rows += [" ".join(fresh(rng.randrange(5, 40)) + passage + fresh(rng.randrange(5, 40))) for _ in range(150)]
    rows += [" ".join(passage)] * 3
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("common, tile, best", [(64, 2048, 3), (4, 16, 1), (10**6, 2048, 3)])
def test_hot_groups_and_chains(spark, monkeypatch, common, tile, best):
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "BEST", best)
    rows = made_rows()
    assert joined(docs(spark, rows)) == brute(rows)


@pytest.mark.parametrize("sets, size, few", [(512, 4 << 20, 64), (16, 4 << 20, 0), (512, 20_000, 10**9)])
def test_every_link_is_counted(spark, monkeypatch, sets, size, few):
    """Also those within a group, which finding the groups needn't look at; over blocks of any size."""
    monkeypatch.setattr(jaccard_join, "LINK_SETS", sets)
    monkeypatch.setattr(jaccard_join, "LINK_BYTES", size)
    monkeypatch.setattr(jaccard_join, "FEW_PAIRS", few)
    monkeypatch.setattr(jaccard_join, "COLUMNS", 100)
    rows = [*made_rows(), *edge_rows()]
    want = brute_links(rows)
    assert links(jaccard_join.join_documents(docs(spark, rows))) == want
    assert max(n for _, n in want) > 100


def test_edges(spark):
    rows = [*edge_rows(), (11, "A b C d"), (12, "a  B\tc\nd"), (13, "a b c d e"), (14, "two words"), (14, "something else entirely, for once"),
            (None, "NO id AT all")]
    got, want = joined(docs(spark, rows)), brute(rows)
    assert got == want
    assert joined(docs(spark, [])) == []


def test_bounds():
    import numpy as np
    rng = np.random.default_rng(2)
    for _ in range(200):
        size = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[:int(rng.integers(0, len(a) + 1))], rng.integers(0, 2**63, int(rng.integers(0, 40))).astype(np.uint64)]))
        if not len(b):
            continue
        x, y = jaccard_join.bitmap(a), jaccard_join.bitmap(b)
        words = min(len(x), len(y))
        apart = int(np.bitwise_count(jaccard_join.folded(x, words) ^ jaccard_join.folded(y, words)).sum())
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))
        if jaccard_join.linked(a, b):
            last = np.sort(rng.choice(a, len(a) // 3, replace=False))
            assert jaccard_join.may_link(apart, len(a) + len(b))
            assert set(jaccard_join.prefix(a, last).tolist()) & set(jaccard_join.prefix(b, last).tolist())


def test_one_row_of_each_group_stays(spark):
    rows = [*made_rows(), *edge_rows()]
    frame = docs(spark, rows)
    kept = jaccard_join.keep_one(frame)
    assert kept.columns == frame.columns
    want, groups = brute(rows), set()
    for doc, size, component in want:
        if size and component is not None:
            groups.add(component)
    out = [r.doc_id for r in kept.collect() if sets_of(r.text)]
    assert sorted(d for d in out if d is not None) == sorted(groups)
    blank = sum(1 for _, t in rows if not sets_of(t))
    assert sum(1 for r in kept.collect() if not sets_of(r.text)) == blank
    assert out.count(None) == 1


def test_whole_table_equals_sql(spark):
    name = "op7_jaccard_join"
    assert_same_as_duckdb(queries.queries()[name](spark, "/root/testdata/sf0.01"), queries.oracle_sql()[name], "/root/testdata/sf0.01")
