"""Near copies of embeddings by PCA-ordered tiled comparison.

Vectors of length one are turned onto the principal axes of their second moments, so that the
leading coordinates hold most of a cosine. A pair's cosine is summed over the leading
coordinates first; what the others can add is at most the product of the two suffix norms, and
a pair is left as soon as that cannot reach the threshold.

Equal vectors are one class with a number of copies. Classes are dealt over blocks of bounded
bytes by a tree of medians along the leading axes; a block is one row. Two blocks whose boxes
lie too far apart are never compared, all others meet in a tile, whose task adds up links per
class and keeps one edge per class at most: no task ever returns its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import Batches, arrow, chosen, stored
from claimtide.llm.jaccard_join import components
from claimtide.llm.neighbours import unit

BLOCK_BYTES = 8 << 20  # of the vectors of a block
STRIP = 2048  # rows of either block that a tile compares at once
LEAD = 16  # axes along which blocks are cut and boxed
STEPS = (16, 32)  # coordinates after which a pair may be left
SAMPLE = 16_384  # classes that the tree's medians are taken from; it only balances the blocks
HOT_SHARE = 1 / 1024  # a class with more of all rows than this finds its rows by a broadcast
SLACK = 1e-9  # by which bounds are widened against rounding


def _vectors(batches: Batches) -> Batches:
    """Ids and vectors as doubles; null for vectors that take no part."""
    for batch in batches:
        column = batch.column("embedding")
        size = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
        flat = np.asarray(pc.fill_null(column.flatten(), math.nan), "<f8")
        end = np.cumsum(size)
        found = []
        for first, last in zip((end - size).tolist(), end.tolist()):
            row = flat[first:last]
            found.append(row.tobytes() if np.isfinite(row).all() and row.any() else None)
        yield arrow(vec_id=batch.column("vec_id"), vec=pa.array(found, pa.binary()))


def _by_size(raw: list[bytes]):
    """(size, places, unit vectors) for each length among the vectors."""
    for size in sorted({len(v) for v in raw}):
        own = [k for k, v in enumerate(raw) if len(v) == size]
        yield size, own, unit(np.frombuffer(b"".join(raw[k] for k in own), "<f8").reshape(len(own), -1))


def _moments(batches: Batches) -> Batches:
    """A task's sums of products, one row for each length and coordinate."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, _, rows in _by_size(batch.column("vec").to_pylist()):
            total[size] = total.get(size, 0) + rows.T @ rows
    for size, sums in total.items():
        yield arrow(size=np.full(len(sums), size), i=np.arange(len(sums)), line=[line.tobytes() for line in sums])


def _added(rows: pa.Table) -> pa.Table:
    lines = np.stack([np.frombuffer(v, "<f8") for v in rows.column("line").to_pylist()])
    return pa.table({"size": rows.column("size")[:1], "i": rows.column("i")[:1], "line": [lines.sum(axis=0).tobytes()]})


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each length of vectors (in bytes) its axes as columns, the one with most of the
    squared lengths first, over all classes."""
    kinds = "size long, i long, line binary"
    sums = classes.select("vec").mapInArrow(_moments, kinds).groupBy("size", "i").applyInArrow(_added, kinds).toArrow()
    lines: dict[int, dict[int, bytes]] = {}
    for size, i, line in zip(*(sums.column(c).to_pylist() for c in ("size", "i", "line"))):
        lines.setdefault(size, {})[i] = line
    axes = {}
    for size, own in lines.items():
        matrix = np.stack([np.frombuffer(own[i], "<f8") for i in range(len(own))])
        axes[size] = np.linalg.eigh(matrix + matrix.T)[1][:, ::-1].copy()
    return axes


def median_tree(points: np.ndarray, leaves: int, first: int = 0):
    """Halves the points along the axis where they spread most, until there are as many leaves:
    (axis, cut, lower, upper), or a leaf's number."""
    if leaves <= 1 or len(points) < 2:
        return first
    axis = int(np.argmax(np.ptp(points, axis=0)))
    cut = float(np.median(points[:, axis]))
    under = points[:, axis] < cut
    half = leaves // 2
    return axis, cut, median_tree(points[under], half, first), median_tree(points[~under], half, first + half)


def leaf_of(tree, points: np.ndarray) -> np.ndarray:
    found = np.zeros(len(points), np.int64)
    open_ = [(tree, np.arange(len(points)))]
    while open_:
        node, at = open_.pop()
        if isinstance(node, tuple):
            under = points[at, node[0]] < node[1]
            open_ += [(node[2], at[under]), (node[3], at[~under])]
        else:
            found[at] = node
    return found


def _turned(axes, leading: int | None, make):
    """Applies `make(batch, places, size, coordinates)` to the vectors of each length."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for size, own, rows in _by_size(batch.column("vec").to_pylist()):
                yield make(batch, own, size, rows @ axes.value[size][:, :leading])

    return run


def _trees(classes: DataFrame, axes) -> dict[int, object]:
    """A tree of medians for each length, from a bounded sample of the classes."""
    counts = {r.size: r.n for r in classes.groupBy(F.octet_length("vec").alias("size")).agg(F.count("*").alias("n")).collect()}
    step = 1 + sum(counts.values()) // SAMPLE
    sampled = classes.where(F.pmod(F.xxhash64("cls"), F.lit(step)) == 0).select("vec").mapInArrow(
        _turned(axes, LEAD, lambda batch, own, size, rows: arrow(size=np.full(len(own), size), lead=[r.tobytes() for r in rows])),
        "size long, lead binary").toArrow()
    raw: dict[int, list[bytes]] = {}
    for size, lead in zip(*(sampled.column(c).to_pylist() for c in ("size", "lead"))):
        raw.setdefault(size, []).append(lead)
    trees = {}
    for size, n in counts.items():
        points = np.array([np.frombuffer(v, "<f8") for v in sorted(raw.get(size, []))])
        wanted = min(n * size / BLOCK_BYTES, len(points) / 16)
        trees[size] = median_tree(points, 1 << max(0, math.ceil(math.log2(max(wanted, 1)))))
    return trees


def _blocks(classes: DataFrame) -> tuple[DataFrame, int]:
    """(block, size, low, high, ids, copies, vecs): a row for each block, numbered from 0; and their
    number. low and high are the box along the leading axes."""
    context = classes.sparkSession.sparkContext
    axes = context.broadcast(principal_axes(classes))
    trees = context.broadcast(_trees(classes, axes))
    leaf = _turned(axes, LEAD, lambda batch, own, size, rows: arrow(
        size=np.full(len(own), size), leaf=leaf_of(trees.value[size], rows)))
    counted = classes.select("vec").mapInArrow(leaf, "size long, leaf long").groupBy("size", "leaf").agg(F.count("*").alias("n"))
    base, parts, total = {}, {}, 0
    for r in sorted(counted.collect()):  # at most SAMPLE / 16 leaves, and one for each length
        base[r.size, r.leaf], parts[r.size, r.leaf] = total, 1 + int(r.n * r.size / BLOCK_BYTES / 1.5)
        total += parts[r.size, r.leaf]

    def placed(batch: pa.RecordBatch, own: list[int], size: int, rows: np.ndarray) -> pa.RecordBatch:
        deal = np.asarray(batch.column("deal"))[own]
        leaves = leaf_of(trees.value[size], rows[:, :LEAD])
        # A leaf that no class was counted in can only come from rounding at a median.
        block = [base.get((size, k), 0) + int(d) % parts.get((size, k), 1) for k, d in zip(leaves.tolist(), deal.tolist())]
        take = pa.array(own, pa.int64())
        return arrow(block=pa.array(block, pa.int64()), cls=batch.column("cls").take(take), copies=batch.column("copies").take(take),
                     vec=[r.tobytes() for r in rows])

    rows = classes.select("cls", "copies", "vec", F.pmod(F.xxhash64("cls"), F.lit(1 << 30)).alias("deal")).mapInArrow(
        _turned(axes, None, placed), "block long, cls long, copies long, vec binary")
    kinds = "block long, size long, low array<double>, high array<double>, ids binary, copies binary, vecs binary"
    return stored(rows.groupBy("block").applyInArrow(_packed, kinds), "blocks"), total


def _packed(rows: pa.Table) -> pa.Table:
    """A block's classes as one row, in order of the leading coordinate."""
    raw = rows.column("vec").to_pylist()
    size = max(map(len, raw))
    vecs = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    ids, copies = (np.asarray(rows.column(c)) for c in ("cls", "copies"))
    order = np.lexsort((ids, vecs[:, 0]))
    low, high = vecs[:, :LEAD].min(axis=0), vecs[:, :LEAD].max(axis=0)
    return pa.table({
        "block": rows.column("block")[:1], "size": pa.array([size], pa.int64()), "low": pa.array([low.tolist()], pa.list_(pa.float64())),
        "high": pa.array([high.tolist()], pa.list_(pa.float64())), "ids": [ids[order].tobytes()], "copies": [copies[order].tobytes()],
        "vecs": [vecs[order].tobytes()],
    })


def _far(threshold: float) -> float:
    """The squared distance beyond which unit vectors can't have the cosine."""
    return 2 - 2 * threshold + SLACK


def joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the groups of linked places in `label`, where each place names a place of its group."""
    while len(a):
        one, two = label[a], label[b]
        apart = one != two
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(one, two)[apart], np.minimum(one, two)[apart])
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label[:] = further


def linked_places(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The places of pairs of unit vectors whose cosine reaches the threshold, leading
    coordinates first."""
    steps = [s for s in STEPS if s < left.shape[1]] + [left.shape[1]]
    rest = lambda rows, s: np.sqrt(np.einsum("ij,ij->i", rows[:, s:], rows[:, s:]))
    near = left[:, :steps[0]] @ right[:, :steps[0]].T
    open_ = near + np.outer(rest(left, steps[0]), rest(right, steps[0])) >= threshold - SLACK
    if 8 * np.count_nonzero(open_) > open_.size:  # most are near: the other coordinates at once
        near += left[:, steps[0]:] @ right[:, steps[0]:].T
        return np.nonzero(near >= threshold)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    every_a, every_b = np.nonzero(open_)
    ends = [rest(side, s) for s in steps for side in (left, right)]
    for k in range(0, len(every_a), 1 << 16):
        a, b = every_a[k:k + (1 << 16)], every_b[k:k + (1 << 16)]
        sums = near[a, b]
        for at, (first, last) in enumerate(zip(steps, steps[1:]), 1):
            sums = sums + np.einsum("ij,ij->i", left[a, first:last], right[b, first:last])
            bound = sums + ends[2 * at][a] * ends[2 * at + 1][b] >= threshold - SLACK
            a, b, sums = a[bound], b[bound], sums[bound]
        reached = sums >= threshold
        found.append((a[reached], b[reached]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _tile(threshold: float):
    """Of a tile's one or two blocks: (a, null, links counted with copies) per linked class, and
    edges (a, b, 0) that join the classes which links join."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        ids, copies = (np.concatenate([np.frombuffer(v, np.int64) for v in rows.column(c).to_pylist()]) for c in ("ids", "copies"))
        size = rows.column("size")[0].as_py()
        sides = [np.frombuffer(v, "<f8").reshape(-1, size // 8) for v in rows.column("vecs").to_pylist()]
        left, right, base = sides[0], sides[-1], len(sides[0]) if len(sides) > 1 else 0
        links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for p in range(0, len(left), STRIP):
            one = left[p:p + STRIP]
            for q in range(0 if base else p, len(right), STRIP):
                two = right[q:q + STRIP]
                gap = np.maximum(0, np.maximum(one[:, :LEAD].min(0) - two[:, :LEAD].max(0), two[:, :LEAD].min(0) - one[:, :LEAD].max(0)))
                if gap @ gap > _far(threshold):
                    continue
                a, b = linked_places(one, two, threshold)
                if not base and p == q:
                    a, b = a[a < b], b[a < b]
                a, b = a + p, b + q + base
                # Whole numbers: weights of bincount would be doubles.
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                joined(label, a, b)
        counted, edge = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(label)))
        return pa.table({
            "a": pa.array(np.concatenate([ids[counted], ids[edge]])),
            "b": pa.array([None] * len(counted) + ids[label[edge]].tolist(), pa.int64()),
            "n": pa.array(np.concatenate([links[counted], np.zeros(len(edge), np.int64)])),
        })

    return run


def _compared(classes: DataFrame, threshold: float) -> DataFrame:
    """What all tiles found."""
    blocks, total = _blocks(classes)
    boxes = blocks.select("block", "size", "low", "high")
    other = boxes.toDF("other", "size2", "low2", "high2")
    gap = F.aggregate(F.arrays_zip("low", "high", "low2", "high2"), F.lit(0.0), lambda s, z: s + F.pow(F.greatest(
        F.lit(0.0), z["low"] - z["high2"], z["low2"] - z["high"]), F.lit(2.0)))
    numbered = boxes.withColumn("other", F.explode(F.sequence("block", F.lit(max(total - 1, 0)).cast("long"))))
    near = numbered.join(other, "other").where((F.col("size") == F.col("size2")) & (gap <= _far(threshold)))
    tiles = near.select(F.col("block").alias("i"), F.col("other").alias("j"), F.explode(F.array_distinct(
        F.array("block", "other"))).alias("block"))
    dealt = blocks.select("block", "size", "ids", "copies", "vecs").join(tiles, "block")
    return stored(dealt.groupBy("i", "j").applyInArrow(_tile(threshold), "a long, b long, n long"), "tiles")


def group_vectors(frame: DataFrame, threshold: float = 0.9) -> DataFrame:
    """For each id of (vec_id, embedding): vec_id, n_links (other ids whose vectors have a cosine
    of the threshold or more), component_id (the smallest id reached by links, its own
    included) and kept (whether that is its own).

    Vectors that are null, empty or zero or hold null or non-finite components link with
    nothing, and vectors of different lengths never do. Rows without an id are left out. Of rows
    that share an id one counts: that with the smallest valid vector as bytes. Equal vectors
    link like any others. Other columns are ignored; an empty table gives an empty result.
    The threshold has to be positive.
    """
    given = chosen(frame, vec_id="long", embedding="array<double>").where("vec_id IS NOT NULL")
    rows = stored(given.mapInArrow(_vectors, "vec_id long, vec binary").groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn(
        "key", F.unhex(F.sha2("vec", 256))), "vectors")
    valid = rows.where("vec IS NOT NULL")
    classes = stored(valid.groupBy("key").agg(F.min("vec_id").alias("cls"), F.count("*").alias("copies"), F.first("vec").alias("vec")), "classes")
    found = _compared(classes, threshold)
    links = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("links"))
    groups = components(found.where("b IS NOT NULL").select("a", "b"))
    judged = stored(
        classes.select("key", "cls", "copies").join(links, F.col("cls") == F.col("a"), "left").join(groups, F.col("cls") == F.col("uid"), "left").select(
            "key", "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("grp", "cls").alias("component_id")), "judged")
    # At most 1 / HOT_SHARE classes are hot; their rows stay where they are.
    least = classes.agg((F.sum("copies") * HOT_SHARE).alias("least")).scalar()
    is_hot = F.col("copies") > least
    hot = judged.where(is_hot).select("key", F.col("n_links").alias("hot_links"), F.col("component_id").alias("hot_id"))
    near = rows.select("vec_id", "key").join(F.broadcast(hot), "key", "left")
    rest = near.where("hot_id IS NULL AND key IS NOT NULL").select("vec_id", "key").join(judged.where(~is_hot).select(
        "key", "n_links", "component_id"), "key").select("vec_id", "n_links", "component_id")
    own = near.where("hot_id IS NOT NULL OR key IS NULL").select(
        "vec_id", F.coalesce("hot_links", F.lit(0)).alias("n_links"), F.coalesce("hot_id", "vec_id").alias("component_id"))
    return own.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
