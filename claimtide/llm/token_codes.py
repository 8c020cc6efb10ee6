"""Token ids as directly addressable codes.

An id is cut into chunks of `chunk_bits`. The lowest chunks of all ids form level 0; a bitmap
says which ids go on, and only those have a chunk in level 1, and so on. A rank directory
(ones before each block of 512 bits) finds where an id goes on, so any id is read by itself,
without decoding its neighbours.

Documents are range-sorted by doc_id. Each partition writes segments of about half a million ids:
records of a Parquet table, which any store that Spark reads can hold.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import Batches, arrow, documents, running_base, scratch_folder, small_batches, written
from claimtide.llm.tokens import END_ID, encoder

CHUNK_BITS = 8
SEGMENT_IDS = 1 << 19
GATHERED = 6 << 20
BLOCK = 512  # bits of a bitmap for each entry of the rank directory
_FILE = "part long, place long, n_tokens long, payload binary"
_MAGIC = b"DAC1"
_HEAD = struct.Struct("<4sBBQ")  # magic, chunk bits, levels, ids
_LEVEL = struct.Struct("<Q")  # chunks of a level


def _directory(bits: np.ndarray) -> np.ndarray:
    """Ones before each block."""
    blocks = -(-len(bits) // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:len(bits)] = bits
    ones = padded.reshape(blocks, BLOCK).sum(axis=1, dtype=np.uint32) if blocks else np.zeros(0, np.uint32)
    return (np.cumsum(ones) - ones).astype("<u4")


def encode_ids(ids: np.ndarray, chunk_bits: int = CHUNK_BITS) -> bytes:
    """The ids' levels: for each, its chunks (a byte or two each), bitmap and directory."""
    kind = "<u1" if chunk_bits <= 8 else "<u2"
    left, parts, levels = ids.astype(np.uint32, copy=False), [], 0
    while levels == 0 or len(left):
        more = left >> np.uint32(chunk_bits)
        bits = more > 0
        chunks = (left & np.uint32((1 << chunk_bits) - 1)).astype(kind)
        parts += [_LEVEL.pack(len(left)), chunks.tobytes(), np.packbits(bits, bitorder="little").tobytes(),
                  _directory(bits).tobytes()]
        left, levels = more[bits], levels + 1
    return b"".join([_HEAD.pack(_MAGIC, chunk_bits, levels, len(ids)), *parts])


class Codes:
    """Reads encoded ids, any one by itself or all of them."""

    def __init__(self, raw: bytes) -> None:
        magic, self.chunk_bits, levels, self.size = _HEAD.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        kind, at, self.levels = ("<u1" if self.chunk_bits <= 8 else "<u2"), _HEAD.size, []
        for _ in range(levels):
            (n,) = _LEVEL.unpack_from(raw, at)
            at += _LEVEL.size
            read = []
            for form, count in ((kind, n), ("<u1", -(-n // 8)), ("<u4", -(-n // BLOCK))):
                read.append(np.frombuffer(raw, form, count, at))
                at += read[-1].nbytes
            self.levels.append(tuple(read))
        self.end = at

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, k: int) -> int:
        """One id: a chunk from each level, found by rank."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        value, shift = 0, 0
        for chunks, bitmap, directory in self.levels:
            value |= int(chunks[k]) << shift
            byte, bit = divmod(k, 8)
            if not bitmap[byte] >> bit & 1:
                return value
            block = k // BLOCK
            before = bitmap[block * BLOCK // 8:byte]
            k = int(directory[block]) + int(np.bitwise_count(before).sum()) + int(bitmap[byte] & ((1 << bit) - 1)).bit_count()
            shift += self.chunk_bits
        raise ValueError("the last level goes on")

    def all(self) -> np.ndarray:
        """Every id, from the deepest level up."""
        above = np.zeros(0, np.uint32)
        for chunks, bitmap, _ in reversed(self.levels):
            goes_on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
            values = chunks.astype(np.uint32)
            values[goes_on] |= above << np.uint32(self.chunk_bits)
            above = values
        return above


def segment(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray, chunk_bits: int = CHUNK_BITS) -> bytes:
    """A segment: its documents' ids and sizes, then the codes."""
    known = np.array([d is not None for d in doc_ids], "<u1")
    table = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join([struct.pack("<Q", len(doc_ids)), known.tobytes(), table.tobytes(),
                     sizes.astype("<i8").tobytes(), encode_ids(ids, chunk_bits)])


def read_segment(raw: bytes) -> tuple[list[int | None], np.ndarray, Codes]:
    (n,) = struct.unpack_from("<Q", raw)
    known = np.frombuffer(raw, "<u1", n, 8)
    table = np.frombuffer(raw, "<i8", n, 8 + n)
    sizes = np.frombuffer(raw, "<i8", n, 8 + 9 * n)
    return [int(d) if k else None for d, k in zip(table, known)], sizes, Codes(raw[8 + 17 * n:])


def _gathered(batches: Batches) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of about GATHERED characters: small batches would cost the encoder more."""
    ids: list[int | None] = []
    texts: list[str] = []
    held = 0
    for batch in batches:
        for part in small_batches(batch, "text", 2 << 20):
            ids += part.column("doc_id").to_pylist()
            new = part.column("text").to_pylist()
            texts += new
            held += sum(map(len, new))
            if held >= GATHERED:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _write(path: str, end: int, chunk_bits: int):
    def run(batches: Batches) -> Batches:
        number, coder = TaskContext.get().partitionId(), encoder(path)
        docs, sizes, flats, held, place = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, sizes, flats, held, place
            raw = segment(docs, np.concatenate(sizes), np.concatenate(flats), chunk_bits)
            made = arrow(part=[number], place=[place], n_tokens=[held], payload=pa.array([raw], pa.binary()))
            docs, sizes, flats, held, place = [], [], [], 0, place + held
            return made

        for ids, texts in _gathered(batches):
            flat, size = coder.encode_ended(texts, end)
            docs += ids
            sizes.append(size)
            flats.append(flat)
            held += len(flat)
            if held >= SEGMENT_IDS:
                yield flush()
        if docs:
            yield flush()

    return run


def write_codes(frame: DataFrame, path: str, tokenizer: str, end: int = END_ID,
                chunk_bits: int = CHUNK_BITS) -> None:
    """Tokenizes documents (doc_id, text) and writes them to `path` in ascending doc_id order.

    Rows without a doc_id come first; rows that share one go by a hash of their text. A null
    or empty text is just the end id; other columns are ignored. An empty table writes a
    table without segments. The files' rows: part (place of the partition in the order),
    place (ids before the segment in its partition), n_tokens, payload (see `segment`).
    """
    tie = F.xxhash64("text")
    docs = documents(frame).repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    written(docs.mapInArrow(_write(tokenizer, end, chunk_bits), _FILE), "snappy").parquet(path)


def _read(base: dict[int, int]):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for number, place, raw in zip(*(batch.column(c).to_pylist() for c in ("part", "place", "payload"))):
                docs, sizes, codes = read_segment(raw)
                ids, ends = codes.all().astype("<u4", copy=False), np.cumsum(sizes)
                yield arrow(
                    doc_id=pa.array(docs, pa.int64()), start=base[number] + place + ends - sizes, n_tokens=sizes,
                    ids_crc32=[zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends.tolist(), sizes.tolist())],
                )

    return run


def read_codes(spark, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of its ids as unsigned 32-bit little-endian integers)."""
    files = spark.read.schema(_FILE).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # one row a partition
    return files.mapInArrow(_read(running_base((r.part, r.n) for r in totals)),
                            "doc_id long, start long, n_tokens long, ids_crc32 long")


def codes_folder(spark) -> str:
    return scratch_folder(spark, "codes")
