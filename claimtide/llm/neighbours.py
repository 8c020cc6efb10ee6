"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors of length one are projected on Gaussian directions and cut into cells of one width;
TABLES such hashes of FUNCTIONS directions each are kept. A query looks into its own cell and
into neighbouring ones, in the order in which they are likely to hold its neighbours: by the
sum of squared distances to the borders that lie between. All vectors found are reranked by
their exact cosine.

Equal vectors are one class with its smallest ids, so a common vector costs as much as a rare
one. A cell's vectors and queries are dealt over tiles of a bounded size; a tile compares
its two blocks by one matrix product and keeps each query's best, so what is shuffled back
doesn't grow with the cells. Queries that find too few vectors are compared with all of them.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import Batches, arrow, chosen, stored

TABLES, FUNCTIONS, WIDTH, PROBES, SEED = 4, 6, 2.0, 60, 5
FLIPS = 4  # borders that a probe crosses at most
TILE_ROWS, TILE_QUERIES = 8192, 2048
_CLASS = "cls long, ids array<long>, is_query boolean, vec binary"


def _valid(batches: Batches) -> Batches:
    """Ids and vectors as doubles, without those that take no part."""
    for batch in batches:
        ids, vecs = [], []
        for vec_id, vec in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            if vec_id is None or not vec or None in vec:
                continue
            values = np.array(vec, "<f8")
            if np.isfinite(values).all() and values.any():
                ids.append(vec_id)
                vecs.append(values.tobytes())
        yield arrow(vec_id=pa.array(ids, pa.int64()), vec=pa.array(vecs, pa.binary()))


def _combined(keep: int, every: int):
    """One row for each different vector of a batch, with its smallest ids."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            for vec_id, vec in zip(batch.column("vec_id").to_pylist(), batch.column("vec").to_pylist()):
                held.setdefault(vec, []).append(vec_id)
            yield arrow(vec=pa.array(list(held), pa.binary()),
                        ids=pa.array([sorted(i)[:keep] for i in held.values()], pa.list_(pa.int64())),
                        is_query=[any(k % every == 0 for k in i) for i in held.values()])

    return run


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; large and small values are scaled first, so squares stay finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _hash(table: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, table, size])
    return rng.standard_normal((size, FUNCTIONS)), rng.random(FUNCTIONS) * WIDTH


def places(vectors: np.ndarray, table: int) -> np.ndarray:
    """Unit vectors along a table's directions, in widths of cells."""
    directions, shift = _hash(table, vectors.shape[1])
    return (vectors @ directions + shift) / WIDTH


def probes(place: np.ndarray, count: int = PROBES) -> np.ndarray:
    """The cells to look into, the likeliest first."""
    steps = np.array([s for s in product((0, -1, 1), repeat=len(place)) if np.count_nonzero(s) <= FLIPS])
    cell = np.floor(place)
    inside = place - cell
    cost = np.where(steps < 0, inside ** 2, np.where(steps > 0, (1 - inside) ** 2, 0)).sum(axis=1)
    return (cell + steps[np.argsort(cost, kind="stable")[:count]]).astype(np.int64)


def _cells(of_queries: bool):
    """A row for each cell that a class lies in, or that its query probes."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, raw = batch.column("cls").to_pylist(), batch.column("vec").to_pylist()
            for size in sorted({len(v) for v in raw}):
                own = [k for k, v in enumerate(raw) if len(v) == size]
                vectors = unit(np.frombuffer(b"".join(raw[k] for k in own), "<f8").reshape(len(own), -1))
                for table in range(TABLES):
                    spots = places(vectors, table)
                    found = [probes(s) for s in spots] if of_queries else np.floor(spots).astype(np.int64)[:, None]
                    cells = [f"{size}:{table}:{','.join(map(str, c))}" for cs in found for c in cs.tolist()]
                    rows = [k for k, cs in zip(own, found) for _ in range(len(cs))]
                    yield arrow(cell=cells, cls=pa.array([ids[k] for k in rows], pa.int64()),
                                vec=pa.array([raw[k] for k in rows], pa.binary()))

    return run


def _tile(keep: int):
    """Each query's best classes of a tile."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        query, cls, score = [], [], []
        if rows.num_rows and queries.num_rows:
            base, asked = (np.stack([np.frombuffer(v, "<f8") for v in t.column("vec").to_pylist()]) for t in (rows, queries))
            ids, names = np.array(rows.column("cls")), np.array(queries.column("cls"))
            base, asked = unit(base), unit(asked)
            near = asked @ base.T
            most = min(2 * keep, len(ids))
            for k, line in enumerate(near):
                best = np.argpartition(-line, most - 1)[:most]
                exact = np.einsum("ij,j->i", base[best], asked[k])
                order = np.lexsort((ids[best], -exact))[:keep]
                query += [int(names[k])] * len(order)
                cls += ids[best][order].tolist()
                score += exact[order].tolist()
        return pa.table({"query": pa.array(query, pa.int64()), "cls": pa.array(cls, pa.int64()),
                         "score": pa.array(score, pa.float64())})

    return run


def _compared(rows: DataFrame, queries: DataFrame, keep: int) -> DataFrame:
    """(query, cls, score) of rows and queries that share a cell, tile by tile.

    Cells with more than a tile's rows or queries are listed with the number of blocks that each
    side needs; there are at most as many as rows and queries divided by a tile's.
    """
    counted = rows.select("cell", F.lit(1).alias("r"), F.lit(0).alias("q")).unionByName(
        queries.select("cell", F.lit(0).alias("r"), F.lit(1).alias("q"))).groupBy("cell").agg(
        F.sum("r").alias("r"), F.sum("q").alias("q"))
    large = F.broadcast(counted.where((F.col("r") > TILE_ROWS) | (F.col("q") > TILE_QUERIES)).select(
        "cell", F.ceil(F.col("r") / TILE_ROWS).alias("nr"), F.ceil(F.col("q") / TILE_QUERIES).alias("nq")))

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        own_block = F.pmod(F.xxhash64("cls"), F.greatest(F.coalesce(own, F.lit(1)), F.lit(1)))
        others = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.coalesce(other, F.lit(1)), F.lit(1)) - 1))
        return frame.join(large, "cell", "left").withColumn("own", own_block).withColumn("other", others)

    left = dealt(rows, "nr", "nq").select("cell", F.col("own").alias("rb"), F.col("other").alias("qb"), "cls", "vec")
    right = dealt(queries, "nq", "nr").select("cell", F.col("other").alias("rb"), F.col("own").alias("qb"), "cls", "vec")
    return left.groupBy("cell", "rb", "qb").cogroup(right.groupBy("cell", "rb", "qb")).applyInArrow(
        _tile(keep), "query long, cls long, score double")


def _best(found: DataFrame, classes: DataFrame, keep: int) -> DataFrame:
    """Each query class's best ids, best first: (query, best: array of (score, id))."""
    one = found.groupBy("query", "cls").agg(F.max("score").alias("score"))
    ids = one.join(classes.select("cls", "ids"), "cls").select("query", "score", F.explode("ids").alias("id"))
    # A query has at most tables x probes x blocks x keep rows here.
    listed = ids.groupBy("query").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "id")).alias("all"))
    return listed.select("query", F.slice(F.array_sort("all"), 1, keep).alias("best"))


def nearest(frame: DataFrame, every: int, count: int) -> DataFrame:
    """For each row of (vec_id, embedding) whose vec_id is divisible by `every`, its `count`
    nearest other rows found: query_id, rank (from 1), vec_id, score (cosine), ties to the
    smaller vec_id; all others, if there are fewer.

    Rows take no part whose id or vector is null, or whose vector is empty, zero or has null or
    non-finite components. Of rows that share an id, one counts: that with the smallest vector
    as bytes. Vectors of different lengths are never near. Other columns are ignored.
    """
    keep = count + 1
    rows = chosen(frame, vec_id="long", embedding="array<double>").mapInArrow(
        _valid, "vec_id long, vec binary").groupBy("vec_id").agg(F.min("vec").alias("vec"))
    smallest = F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep)
    classes = stored(rows.mapInArrow(_combined(keep, every), "vec binary, ids array<long>, is_query boolean").groupBy("vec").agg(
        smallest.alias("ids"), F.max("is_query").alias("is_query")).select(F.col("ids")[0].alias("cls"), "ids", "is_query", "vec"),
        "classes")
    asked = classes.where("is_query")
    cells = "cell string, cls long, vec binary"
    found = stored(_compared(classes.mapInArrow(_cells(False), cells), asked.mapInArrow(_cells(True), cells), keep), "found")
    best = _best(found, classes, keep)
    short = stored(asked.join(best.where(F.size("best") >= keep), F.col("cls") == F.col("query"), "left_anti"), "short")
    if not short.isEmpty():  # these are compared with all vectors of their length
        size = F.concat(F.lit("all:"), F.octet_length("vec")).alias("cell")
        all_found = _compared(classes.select(size, "cls", "vec"), short.select(size, "cls", "vec"), keep)
        best = _best(found.unionByName(all_found), classes, keep)
    queries = chosen(frame, vec_id="long", embedding="array<double>").where(F.col("vec_id") % every == 0).mapInArrow(
        _valid, "vec_id long, vec binary").groupBy("vec_id").agg(F.min("vec").alias("vec"))
    named = queries.join(classes.select("cls", "vec"), "vec").select(F.col("vec_id").alias("query_id"), "cls")
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, count)
    return named.join(best, F.col("cls") == F.col("query")).select("query_id", F.posexplode(others).alias("k", "b")).select(
        "query_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("b")["id"].alias("vec_id"), (-F.col("b")["far"]).alias("score"))
