"""Filter effects against simulated removals."""

from collections import defaultdict
from fractions import Fraction
from itertools import permutations
from math import comb

from claimtide.llm import filter_audit, queries
from .duck import assert_same_as_duckdb
from .frames import docs, edge_rows

FOLDER = "/root/testdata/sf0.01"
SPACE = " \t\n\x0b\f\r"


def failing(text, repeated):
    words = [w for w in "".join(" " if c in SPACE else c for c in text).split(" ") if w]
    return {
        "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text), "E": repeated,
    }


def simulated(rows, labels):
    """(part, order, step) -> the seven counts, document by document; rows (doc_id, text, lang)."""
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = defaultdict(list)
    for i, text, lang in rows:
        fails = failing(text or "", i is not None and i > first[text or ""])
        good = any(k == i and q == 1 for k, q, _ in labels if k is not None)
        toxic = any(k == i and t == 1 for k, _, t in labels if k is not None)
        parts[lang or ""].append((fails, good, toxic))
    out, total = {}, defaultdict(int)
    for part, own in parts.items():
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                total[part, f] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(d[0][f] for d in own) - len(gone),
                    sum(d[0][f] and sum(d[0].values()) == 1 for d in own), sum(d[1] for d in gone), sum(d[2] for d in gone))
    return {key: (*value, total[key[0], key[1][key[2] - 1]]) for key, value in out.items()}


def found(frame):
    rows = frame.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(out) == len(rows)
    return out


def test_edge_rows_equal_simulation(spark):
    long = " ".join(f"w{k}" for k in range(120))
    rows = [(i, t, "en") for i, t in edge_rows()] + [
        (20, long, None), (21, long, ""), (22, long, "de"), (22, long, "de"), (19, long + " $", "de"), (23, long.upper(), "en"),
        (24, "a " * 200, "fr"), (25, "B\x1c" * 200, "fr"), (26, "É" * 30, "fr"), (27, "x\x0by\x85z", "fr")]
    labels = [(20, 1, 0), (22, 1, 1), (22, 0, 0), (24, None, 1), (None, 1, 1), (99, 1, 1), (25, 1, None), (25, 1, None)]
    frame = docs(spark, [(i, t) for i, t, _ in rows]).drop("lang")
    by_row = spark.createDataFrame([(i, t, lang, "m", 1, 2) for i, t, lang in rows], "doc_id long, text string, lang string, mask string, n int, good int")
    marks = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    assert frame.count() == len(rows)
    assert found(filter_audit.audit(by_row, marks)) == simulated(rows, labels)
    assert found(filter_audit.audit(by_row.limit(0), marks)) == {}
    assert found(filter_audit.audit(by_row, marks.limit(0))) == simulated(rows, [])


def test_weights_are_shapley_weights():
    for n in (2, 3, 5):
        for f, weights in enumerate(filter_audit.shapley_weights(n)):
            for s, weight in enumerate(weights):
                size = s.bit_count()
                want = Fraction(1, n * comb(n - 1, size - 1)) if s >> f & 1 else -Fraction(1, n * comb(n - 1, size))
                # The empty coalition removes nothing, so its weight is free.
                assert weight == want or s == 0


def test_whole_table(spark):
    name = "op12_filter_audit"
    assert_same_as_duckdb(queries.queries()[name](spark, FOLDER), queries.oracle_sql()[name], FOLDER)
