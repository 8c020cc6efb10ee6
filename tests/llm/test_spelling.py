"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from claimtide.llm import queries, spelling
from .frames import docs, edge_rows

FOLDER = "/root/testdata/sf0.001"


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near_words(words):
    """word -> the near ones, by what is left of a word without one letter."""
    holes = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[w[:k], w[k + 1:]].add(w)
    near = defaultdict(set)
    for own in holes.values():
        for w in own:
            near[w] |= own - {w}
    for w in words:
        for k in range(len(w)):
            short = w[:k] + w[k + 1:]
            if short in words:
                near[w].add(short)
                near[short].add(w)
    return near


def wanted(rows):
    words = words_of(rows)
    near, form = near_words(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def found(frame):
    rows = frame.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = wanted(rows)
    assert found(queries.queries()["op13_spelling_variants"](spark, FOLDER)) == want
    assert any(v[0] for v in want.values()) and any(v[3] > 1 for v in want.values())


def test_chains_ties_and_edges(spark):
    long = "A" * 50_000
    rows = [(k, "Commander " * 300) for k in range(9)] + [(k, "comander commandr " * 20) for k in range(9)] + [
        (50, "comandr comandr philosphr philosphr"), (60, "philosopher " * 900), (61, "philosophr " * 40), (51, "zzzzzzy zzzzzzy zzzzzzx zzzzzzx " + "zzzzzza zzzzzzb " * 40), (52, f"{long} {long} {long}b {long}b"),
        (53, "ÀÉÎÕÜßÿ×÷ " * 3 + "àéîõüßÿ×÷ " * 3), (54, "naïvetéānaïvetéınaïveté"), (None, "nobodys nobodys nobodys"),
        (55, "ab" * 40 + " " + "ba" * 40), (55, "ab" * 40 + " " + "ba" * 40)] + edge_rows()
    frame = docs(spark, rows)
    want = wanted(rows)
    got = found(spelling.group_variants(frame))
    assert got == want
    assert any(form not in (None, root) for form, root, *_ in want.values())
    assert found(spelling.group_variants(frame.limit(0))) == {}
    assert found(spelling.group_variants(docs(spark, [(1, None), (2, "")]))) == {}


def test_signatures_lose_no_near_pair():
    rng = np.random.default_rng(2)
    for _ in range(400):
        length = int(rng.integers(7, 14))
        word = rng.choice(np.frombuffer(b"abcde\xe9", np.uint8), length)
        at = int(rng.integers(0, length))
        letter = rng.choice(np.frombuffer(b"abcdef", np.uint8))
        others = [np.delete(word, at), np.insert(word, at, letter), np.concatenate([word[:at], [letter], word[at + 1:]]).astype(np.uint8)]
        own = set(spelling.signatures(word[None])[0].tolist())
        for other in others:
            assert own & set(spelling.signatures(other[None].astype(np.uint8))[0].tolist())
