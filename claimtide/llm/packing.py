"""Packing documents into sequences along a Hilbert curve.

A document's byte pairs are hashed into a vector, the vector is projected to four dimensions, and
the cell it falls in gives its place on a Hilbert curve. The documents are range-sorted by
that place, so neighbours in the order have like content; each partition is tokenized where
it lies, and the gapless stream of ids is cut every `length` ids.

Only the totals of the partitions, one number each, meet on the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import Batches, arrow, documents, running_base, small_batches, stored
from claimtide.llm.tokens import END_ID, encoder

LENGTH = 4096
SLOTS, DIMENSIONS, BITS, SEED = 256, 4, 10, 20
TIE_BITS = 20
SAMPLED = 16
MOST_PIECES = 120_000  # of the tokenizer that a worker remembers


def hashed_vectors(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of SLOTS square-rooted, unit-length counts of hashed byte pairs for each text;
    `data` has the texts' bytes one after the other, `ends` where each ends."""
    out = np.zeros((len(ends), SLOTS))
    if len(data) >= 2:
        pairs = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
        slot = (pairs * np.uint16(40503) >> np.uint16(8)).astype(np.uint8)
        begin = 0
        for k, end in enumerate(ends.tolist()):
            if end - begin >= 2:
                out[k] = np.bincount(slot[begin:end - 1], minlength=SLOTS)
            begin = end
    out = np.sqrt(out)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def cells(vectors: np.ndarray) -> np.ndarray:
    """The projected vectors on a grid of 2**BITS steps a side."""
    direction = np.random.default_rng(SEED).standard_normal((SLOTS, DIMENSIONS))
    direction -= direction.mean(axis=0)  # counts are never negative: what all texts share goes
    spot = 0.5 + (vectors @ direction) / 4
    return np.clip(spot * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def hilbert_keys(grid: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each grid cell (one row each), by Skilling's way of
    undoing the rotations from the coarsest bit to the finest."""
    axes = grid.T.astype(np.int64).copy()
    dims = len(axes)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for k in range(dims):
            high = (axes[k] & bit) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[k]) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            axes[k] ^= swap
        bit >>= 1
    for k in range(1, dims):
        axes[k] ^= axes[k - 1]
    flip = np.zeros_like(axes[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where((axes[dims - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    axes ^= flip
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for k in range(dims):
            key = key << 1 | (axes[k] >> level & 1)
    return key


def curve_keys(texts: pa.Array) -> np.ndarray:
    raw = texts.cast(pa.large_binary())
    if not len(raw):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    held = raw.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held else np.zeros(0, np.uint8)
    return hilbert_keys(cells(hashed_vectors(data, offsets[1:] - offsets[0])))


def _spots(borders: list[int]):
    """A function of texts and hashes of their ids: the place on the curve, with the hash in the
    lowest bits because copies share a place, and the part of the curve between borders."""

    @F.arrow_udf("struct<spot: long, part: int>")
    def spots(texts: pa.Array, ties: pa.Array) -> pa.Array:
        spot = curve_keys(texts) << TIE_BITS | np.asarray(ties) & (1 << TIE_BITS) - 1
        part = np.searchsorted(borders, spot, "right").astype(np.int32)
        return pa.StructArray.from_arrays([pa.array(spot), pa.array(part)], ["spot", "part"])

    return spots(F.col("text"), F.xxhash64("doc_id"))


def _borders(frame: DataFrame, parts: int) -> list[int]:
    """Borders that cut the curve into parts of about equal length of text, from one row in
    SAMPLED, picked by a hash. They only balance the partitions; every row is packed whatever
    they are."""
    sample = frame.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(SAMPLED)) == 0)
    weight = (F.octet_length("text") / 1024 + 1).cast("int")
    spots = sample.select(_spots([]).alias("s"), weight.alias("weight")).select(
        F.explode(F.array_repeat("s.spot", F.col("weight"))).alias("spot"))
    shares = [k / parts for k in range(1, parts)]
    return sorted(spots.agg(F.percentile_approx("spot", shares, 20 * parts).alias("b")).first().b or [])


def _tokenize(path: str, end: int):
    def run(batches: Batches) -> Batches:
        number, place, coder = TaskContext.get().partitionId(), 0, encoder(path, MOST_PIECES)
        for batch in batches:
            for part in small_batches(batch, "text", 2 << 20):
                flat, sizes = coder.encode_ended(part.column("text").to_pylist(), end)
                flat = flat.astype(coder.dtype, copy=False)
                ends = np.cumsum(sizes)
                ids = [flat[e - n:e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist())]
                yield arrow(
                    part=np.full(len(sizes), number), doc_id=part.column("doc_id"),
                    place=place + ends - sizes, n_tokens=sizes,
                    width=np.full(len(sizes), coder.dtype().itemsize, np.int32),
                    ids=pa.array(ids, pa.binary()),
                )
                place += int(ends[-1])

    return run


def _cut(base: dict[int, int], length: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in small_batches(batch, "ids", 8 << 20):
                rows = []
                for number, doc, place, total, width, raw in zip(*(part.column(c).to_pylist() for c in (
                        "part", "doc_id", "place", "n_tokens", "width", "ids"))):
                    at, start = base[number] + place, 0
                    while start < total:
                        offset = at % length
                        size = min(length - offset, total - start)
                        piece = np.frombuffer(raw, f"<u{width}", size, start * width).astype("<u4").tobytes()
                        rows.append((doc, start, size, total, at // length, offset, piece))
                        at, start = at + size, start + size
                doc, start, size, total, sequence, offset, piece = zip(*rows)
                yield arrow(
                    doc_id=pa.array(doc, pa.int64()), start=pa.array(start, pa.int64()),
                    length=pa.array(size, pa.int64()), doc_tokens=pa.array(total, pa.int64()),
                    sequence_id=pa.array(sequence, pa.int64()), offset=pa.array(offset, pa.int64()),
                    ids=pa.array(piece, pa.binary()),
                )

    return run


def pack(frame: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END_ID) -> DataFrame:
    """Documents (doc_id, text) as pieces of sequences of `length` ids.

    Columns: doc_id, start, length, doc_tokens, sequence_id, offset, ids. `ids` holds the
    piece's ids as unsigned 32-bit little-endian integers. All sequences are full but the last.

    A null or empty text is just the end id. Rows that share a doc_id are packed each for
    itself; a null doc_id stays null. Ties on the curve go by a hash of doc_id, then by doc_id
    and a hash of the text. An empty table gives no pieces; other columns are ignored.
    """
    docs = documents(frame)
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    borders = _borders(docs, parts) if parts > 1 else []
    placed = docs.withColumn("s", _spots(borders)).select("doc_id", "text", F.col("s.spot").alias("spot"), F.col("s.part").alias("part"))
    ordered = placed.repartitionById(parts, F.col("part")).sortWithinPartitions("spot", "doc_id", F.xxhash64("text"))
    tokens = stored(ordered.mapInArrow(
        _tokenize(tokenizer, end),
        "part long, doc_id long, place long, n_tokens long, width int, ids binary",
    ), "packing")
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # one row a partition
    return tokens.mapInArrow(
        _cut(running_base((r.part, r.n) for r in totals), length),
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )

