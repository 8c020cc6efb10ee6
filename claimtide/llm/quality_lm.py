"""Quality by the perplexity of a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney bigram model. A word is its 64-bit hash, and
pairs are counted by the hashes of both words, so neither words nor pairs are merged.

Only trusted text is counted: its tasks deal distinct pairs with their counts evenly over shards,
by a hash of both words. What the model needs per word is dealt by word: each shard sends its
words with what it has counted of them, and gets the sums over all shards back. Only sums over
all words go through the driver.

A pair that trusted text lacks has the logarithm of its first word's share for unseen words plus
that of its second word's own probability; a word that it lacks has the same value everywhere. So
the model is a table of gains over that: by 64-bit key a gain for a word, for a pair beyond its
words, and for a word that ends a text (where nothing is first to another). A text's
log-probability is a constant a word plus the gains of its keys.

Documents are scored in rounds, by a hash of the row. In a round each block of documents sends the
shards its keys, the shards look them up and return sums per document. What a round has
sent is removed before the next one, so it is a fraction of the corpus; the model, a table
bucketed by shard, is not shuffled. Gains are whole numbers of 2^-24: equal texts have equal
sums, whatever the order.

Trusted text is split in two folds by a hash of the text, and a document is scored with the
counts of the other fold, so none is judged by counts it is part of. A document is kept if
its perplexity is at most a quantile of the trusted documents of its language.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimtide.llm.common import Batches, arrow, chosen, scratch_folder, small_batches, stored, written
from claimtide.llm.words import WordHashes, mixed
from claimtide.session import remove_folder

SLOTS = 1 << 32  # words that the uniform part of the model allows for, more than a corpus has
QUANTILE = 0.98
ROUNDS = 8  # at most; fewer where a round would have less text than this
ROUND_BYTES = 32 << 20
MOST_DOCS = 10_000  # of a block
MOST_SENT = 1 << 23  # trusted documents that every executor is told; with more, the texts are shuffled to them
LEAST_SHARDS = 64
SCALE = 1 << 24  # a gain of 1 as a whole number
_END = np.uint64(0x5BD1E995)  # tells the key of a text's last word from that of the word; leaves its shard
_PAIRS = "shard int, words binary, pairs binary, counts binary"
_SUMS = "slice int, shard int, words binary, stats binary, seen array<double>"
_ANSWER = "shard int, slice int, words binary, stats binary, sums array<double>"
_MODEL = "shard int, keys binary, gains binary"
_ASKED = "shard int, block long, docs binary, sizes binary, keys binary, ids binary, known binary, langs array<string>"
_PARTIAL = "block long, docs binary, sizes binary, sums binary, ids binary, known binary, langs array<string>"
_STAT_ROWS = 5  # of a word in each fold: total, N1, N2, N3+ as first word, continuations as second
_SUM_ROWS = 10 + _STAT_ROWS  # the last ones are those of the place before the first word


def slots_of(text: str, hashes: WordHashes) -> np.ndarray:
    """The words of a text (as they are, between white space) as hashes from 1 on; 0 stands for
    what is before the first word."""
    return np.maximum(hashes.of(text.encode().split()), np.uint64(1))


def fold_of(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) & 1


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(first) + second)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()),
          "array<string>": pa.list_(pa.string())}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.table({name: pa.array(column, _KINDS[kind]) for (name, kind), column in zip(fields, columns)})


def _pack(values: np.ndarray, kind: str) -> bytes:
    """Numbers byte by byte, low bytes first: what is the same in many packs better."""
    values = np.ascontiguousarray(values.astype(kind)).reshape(-1)
    return zstandard.compress(values.view("u1").reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), "u1").reshape(size, -1).T).view(kind).reshape(-1)


def _pack_pairs(first: np.ndarray, second: np.ndarray) -> bytes:
    """Pairs of places, sorted by the first ones, of which the steps are kept."""
    return _pack(np.concatenate([np.diff(first, prepend=0), second]), "<u4")


def _unpack_pairs(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, second = _unpack(raw, "<u4").astype(np.int64).reshape(2, -1)
    return np.cumsum(steps), second


def _dealt(shard: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of entries by shard, and where in it each shard's begin and end."""
    shard = shard.astype(np.uint16)
    return np.argsort(shard, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=1 << bits))])


def _trusted_pairs(bits: int, most_chars: int = 12 << 20):
    """The distinct pairs of trusted texts and their counts in both folds, a row per shard."""
    def run(batches: Batches) -> Batches:
        hashes, held, size = WordHashes(), [], 0
        for batch in batches:
            for part in small_batches(batch, "text", most_chars):
                if held and size + part.nbytes > most_chars:
                    yield _paired(held, hashes, bits)
                    held, size = [], 0
                held += part.column("text").to_pylist()
                size += part.nbytes
        if held:
            yield _paired(held, hashes, bits)

    return run


def _paired(texts: list[str], hashes: WordHashes, bits: int) -> pa.RecordBatch:
    cut = [slots_of(t, hashes) for t in texts]
    n = np.array([len(c) for c in cut], np.int64)
    fold = np.repeat(np.array([fold_of(t) for t in texts], np.int64), n)
    vocabulary, second = np.unique(np.concatenate([np.zeros(1, np.uint64), *cut]), return_inverse=True)
    second = second[1:].astype(np.int64)
    first = _firsts(second, n)
    size = len(vocabulary)
    pairs, place = np.unique(first * size + second, return_inverse=True)
    counts = np.stack([np.bincount(place[fold == f], minlength=len(pairs)) for f in (0, 1)])
    first, second = pairs // size, pairs % size
    order, bounds = _dealt(pair_key(vocabulary[first], vocabulary[second]) >> np.uint64(64 - bits), bits)
    rows: list[tuple] = []
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        own = order[bounds[k]:bounds[k + 1]]
        words, at = np.unique(np.concatenate([first[own], second[own]]), return_inverse=True)
        rows.append((k, _pack(vocabulary[words], "<u8"), _pack_pairs(*at.reshape(2, -1)), _pack(counts[:, own], "<u4")))
    return _batch(rows, _PAIRS)


def _firsts(seconds: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What stands before each word of texts of `n` words; 0 before a text's first one."""
    firsts = np.concatenate([seconds[:0], np.zeros(min(1, len(seconds)), seconds.dtype), seconds[:-1]])
    firsts[(np.cumsum(n) - n)[n > 0]] = 0
    return firsts


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    table = _table(rows, schema)
    return arrow(**{c: table.column(c).combine_chunks() for c in table.column_names})


def _counted(table: pa.Table) -> pa.Table:
    """A shard's distinct pairs and their counts in both folds."""
    rows = [(_unpack(w, "<u8"), _unpack_pairs(p), _unpack(c, "<u4").reshape(2, -1)) for w, p, c in zip(
        *(table.column(c).to_pylist() for c in ("words", "pairs", "counts")))]
    words = np.unique(np.concatenate([w for w, _, _ in rows]))
    size, pairs = len(words), []
    for own, (first, second), _ in rows:
        at = np.searchsorted(words, own)
        pairs.append(at[first] * size + at[second])
    distinct, place = np.unique(np.concatenate(pairs), return_inverse=True)
    counts = [np.bincount(place, np.concatenate([c[f] for _, _, c in rows]), len(distinct)) for f in (0, 1)]
    return _table([(table.column("shard")[0].as_py(), _pack(words, "<u8"), _pack_pairs(distinct // size, distinct % size),
                    _pack(np.stack(counts), "<u4"))], _PAIRS)


def _shards(table: pa.Table | pa.RecordBatch) -> Iterator[tuple]:
    """(shard, words, first places, second places, counts) of counted shards."""
    for shard, words, pairs, counts in zip(*(table.column(c).to_pylist() for c in ("shard", "words", "pairs", "counts"))):
        yield shard, _unpack(words, "<u8"), *_unpack_pairs(pairs), _unpack(counts, "<u4").astype(np.int64).reshape(2, -1)


def _summaries(bits: int):
    """A shard's words and what it has counted of them, a row for each slice of the words; the
    first row has the numbers of pairs seen one to four times in each fold."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for shard, words, first, second, counts in _shards(batch):
                stats, seen, rows, size = [], [], [], len(words)
                for count in counts:
                    stats += [np.bincount(first, count, size), *(np.bincount(first[count == k], minlength=size) for k in (1, 2)),
                              np.bincount(first[count > 2], minlength=size), np.bincount(second[count > 0], minlength=size)]
                    seen += [float((count == k).sum()) for k in (1, 2, 3, 4)]
                table = np.stack(stats)
                bounds = np.searchsorted(words >> np.uint64(64 - bits), np.arange((1 << bits) + 1))
                for k in np.flatnonzero(np.diff(bounds)).tolist():
                    own = slice(bounds[k], bounds[k + 1])
                    rows.append((k, shard, _pack(words[own], "<u8"), _pack(table[:, own], "<u8"), [0.0] * 8 if rows else seen))
                yield _batch(rows, _SUMS)

    return run


def _stats(raw: bytes) -> np.ndarray:
    return _unpack(raw, "<u8").astype(np.int64).reshape(2 * _STAT_ROWS, -1)


def _added(table: pa.Table) -> pa.Table:
    """Sums of a slice's words over all shards: for each shard those of its words, in order, and for
    the shard of the slice's number the words and their sums. The row of shard -1 has for each
    fold the sums over the slice that the model needs."""
    slice_ = table.column("slice")[0].as_py()
    rows = [(shard, _unpack(words, "<u8"), stats, seen) for shard, words, stats, seen in zip(
        *(table.column(c).to_pylist() for c in ("shard", "words", "stats", "seen")))]
    words = np.unique(np.concatenate([r[1] for r in rows]))
    total, spans = np.zeros((2 * _STAT_ROWS, len(words)), np.int64), []
    for _, own, stats, _ in rows:
        spans.append(np.searchsorted(words, own))
        total[:, spans[-1]] += _stats(stats)  # a shard has a word once
    seen = np.sum([r[3] for r in rows], axis=0).reshape(2, 4)
    sums = []
    for fold in (0, 1):
        own = total[fold * _STAT_ROWS:(fold + 1) * _STAT_ROWS]
        then = own[4]
        sums += [*seen[fold], *(float((then == k).sum()) for k in (1, 2, 3, 4)), float((then > 2).sum()), float(then.sum()),
                 *own[:, words == 0].sum(axis=1).astype(float)]
    out = [(shard, slice_, None, _pack(total[:, span], "<u8"), None) for (shard, *_), span in zip(rows, spans)]
    return _table([*out, (slice_, slice_, _pack(words, "<u8"), _pack(total, "<u8"), None), (-1, slice_, None, None, sums)], _ANSWER)


def discounts(n1: float, n2: float, n3: float, n4: float) -> np.ndarray:
    """The modified discounts for counts of 0, 1, 2 and 3 or more, from how many counts of 1 to
    4 there are; where these are too few, halves of the counts."""
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        out[1] = 1 - 2 * y * n2 / n1
        if n3:
            out[2] = 2 - 3 * y * n3 / n2
            out[3] = 3 - 4 * y * n4 / n3 if n4 else out[3]
    return np.clip(out, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])



class Model:
    """What one fold's scores need besides the pair counts, for some words; `sums` are over all
    words."""

    def __init__(self, stats: np.ndarray, sums: np.ndarray) -> None:
        d = self.discount = discounts(*sums[:4])
        u = discounts(*sums[4:8])
        mass = max(sums[9], 1.0)
        rest = (u[1] * sums[4] + u[2] * sums[5] + u[3] * sums[8]) / mass if sums[9] else 1.0
        total, n1, n2, n3, then = stats.astype(float)
        self.total = np.maximum(total, 1)
        self.left = np.where(total > 0, (d[1] * n1 + d[2] * n2 + d[3] * n3) / self.total, 1.0)
        self.unknown = np.log(rest / (SLOTS - 1))
        self.single = np.maximum(then - u[np.minimum(then, 3).astype(int)], 0) / mass + rest / (SLOTS - 1)

    def words(self) -> np.ndarray:
        """Gains of the words over an unknown one."""
        return np.log(self.left) + np.log(self.single) - self.unknown

    def pairs(self, first: np.ndarray, second: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Gains of pairs over their words alone."""
        seen = np.maximum(count - self.discount[np.minimum(count, 3)], 0) / self.total[first]
        return np.log1p(seen / (self.left[first] * self.single[second]))


def _models(stats: np.ndarray, sums: np.ndarray) -> list[Model]:
    return [Model(stats[f * _STAT_ROWS:(f + 1) * _STAT_ROWS], sums[f]) for f in (0, 1)]


def _constants(sums: np.ndarray) -> np.ndarray:
    """For each fold the logarithm that an unknown word has, and what the place before the first word adds."""
    models = _models(sums[:, 10:].reshape(2 * _STAT_ROWS, 1), sums)
    return np.array([(m.unknown, float(np.log(m.left[0]))) for m in models])


def _gains(totals: np.ndarray):
    """A shard's keys, sorted, and their gains in both folds, from its counted pairs and answers."""
    def run(counted: pa.Table, answers: pa.Table) -> pa.Table:
        keys, gains = [np.zeros(0, np.uint64)], [np.zeros((2, 0))]
        known = sorted(zip(*(answers.column(c).to_pylist() for c in ("slice", "words", "stats"))), key=lambda r: r[0])
        for _, words, first, second, counts in _shards(counted):
            models = _models(np.concatenate([_stats(raw) for _, of, raw in known if of is None], axis=1), totals)
            keys.append(pair_key(words[first], words[second]))
            gains.append(np.stack([m.pairs(first, second, c) for m, c in zip(models, counts)]))
        for _, of, raw in known:
            if of is not None:
                words, models = _unpack(of, "<u8"), _models(_stats(raw), totals)
                keys += [words, words ^ _END]
                gains += [np.stack([m.words() for m in models]), np.stack([-np.log(m.left) for m in models])]
        distinct, at = np.unique(np.concatenate(keys), return_index=True)
        shard = (answers if answers.num_rows else counted).column("shard")[0].as_py()
        return _table([(shard, _pack(distinct, "<u8"), _pack(np.rint(np.concatenate(gains, axis=1)[:, at] * SCALE), "<i4"))], _MODEL)

    return run


def _asked(bits: int):
    """The keys of each block's documents, a row per shard, and a row with what is known of the documents."""
    def run(batches: Batches) -> Batches:
        hashes, block = WordHashes(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in small_batches(batch, "text", 8 << 20):
                for at in range(0, part.num_rows, MOST_DOCS):
                    yield _keyed(part.slice(at, MOST_DOCS), block, hashes, bits)
                    block += 1

    return run


def _keyed(part: pa.RecordBatch, block: int, hashes: WordHashes, bits: int) -> pa.RecordBatch:
    """A document is twice its place in the block, plus its fold; a shard has runs of a document's keys."""
    texts = part.column("text").to_pylist()
    cut = [slots_of(t, hashes) for t in texts]
    n = np.array([len(c) for c in cut], np.int64)
    own = np.array([2 * k + fold_of(t) for k, t in enumerate(texts)], np.uint16)
    words = np.concatenate([np.zeros(0, np.uint64), *cut])
    keys = np.concatenate([pair_key(_firsts(words, n), words), words, words[np.cumsum(n)[n > 0] - 1] ^ _END])
    docs = np.concatenate([np.repeat(own, n)] * 2 + [own[n > 0]])
    order, bounds = _dealt(keys >> np.uint64(64 - bits), bits)
    keys, docs = keys[order], docs[order]
    rows: list[tuple] = []
    for k in np.flatnonzero(np.diff(bounds)).tolist():
        of = docs[bounds[k]:bounds[k + 1]]
        new = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
        rows.append((k, block, of[new].astype("<u2").tobytes(), np.diff(np.append(new, len(of))).astype("<u4").tobytes(),
                     keys[bounds[k]:bounds[k + 1]].astype("<u8").tobytes(), None, None, None))
    ids = part.column("doc_id").to_pylist()
    rows.append((block % (1 << bits), block, own.astype("<u2").tobytes(), n.astype("<u4").tobytes(), None,
                 np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is not None for i in ids], "<u1").tobytes(),
                 part.column("lang").to_pylist()))
    return _batch(rows, _ASKED)


def _answered(model: pa.Table, asked: pa.Table) -> pa.Table:
    """Sums of a shard's gains for the documents of each block, in order; what is known of documents goes through."""
    keys, gains = np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
    if model.num_rows:
        keys = _unpack(model.column("keys")[0].as_py(), "<u8")
        gains = _unpack(model.column("gains")[0].as_py(), "<i4").astype(np.int64).reshape(2, -1)
    out: list[tuple] = []
    for block, docs, sizes, wanted, *known in zip(*(asked.column(c).to_pylist() for c in (
            "block", "docs", "sizes", "keys", "ids", "known", "langs"))):
        if wanted is None:
            out.append((block, docs, sizes, None, *known))
        elif len(keys):
            of, size, wanted = np.frombuffer(docs, "<u2"), np.frombuffer(sizes, "<u4").astype(np.int64), np.frombuffer(wanted, "<u8")
            order = np.argsort(wanted)
            at = np.minimum(np.searchsorted(keys, wanted[order]), len(keys) - 1)
            hit = keys[at] == wanted[order]
            order, at = order[hit], at[hit]
            gain = np.zeros(len(wanted), np.int64)
            gain[order] = gains[1 - (np.repeat(of, size)[order] & 1), at]
            sums = np.zeros((int(of.max()) >> 1) + 1, np.int64)
            np.add.at(sums, of >> 1, np.add.reduceat(gain, np.cumsum(size) - size))
            out.append((block, None, None, _pack(sums, "<i8"), None, None, None))
    return _table(out, _PARTIAL)


def _summed(constants: np.ndarray):
    """A block's documents with their log-probabilities."""
    def run(rows: pa.Table) -> pa.Table:
        about = [r for r in rows.drop_columns(["sums"]).to_pylist() if r["ids"] is not None]
        if len(about) != 1:
            raise ValueError("a block without its documents")
        one = about[0]
        n = np.frombuffer(one["sizes"], "<u4").astype(np.int64)
        total = np.zeros(len(n), np.int64)
        for raw in rows.column("sums").to_pylist():
            if raw is not None:
                sums = _unpack(raw, "<i8")
                total[:len(sums)] += sums
        unknown, start = constants[1 - (np.frombuffer(one["docs"], "<u2") & 1).astype(int)].T
        with np.errstate(divide="ignore", invalid="ignore"):
            perplexity = np.exp(-(total / SCALE + start + n * unknown) / n)
        return pa.table({
            "doc_id": pa.array(np.frombuffer(one["ids"], "<i8"), mask=np.frombuffer(one["known"], "<u1") == 0),
            "lang": pa.array(one["langs"], pa.string()), "n_words": pa.array(n),
            "perplexity": pa.array(perplexity, mask=n == 0),
        })

    return run


def _trusted(labels: DataFrame) -> DataFrame:
    known = chosen(labels, doc_id="long", quality="int").dropna().groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return known.where("quality = 1").select("doc_id")


def _shard_bits(spark: SparkSession) -> int:
    """Shards follow the session's shuffle partitions, so that a shard fits a task."""
    wanted = max(LEAST_SHARDS, min(4096, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return (wanted - 1).bit_length()


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, what a write has shuffled is removed when the write ends, not when the driver next
    collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _dealt_table(frame: DataFrame, bits: int, name: str) -> DataFrame:
    """The frame as a table that reads shard by shard without a shuffle."""
    written(frame).bucketBy(1 << bits, "shard").saveAsTable(name)
    return frame.sparkSession.table(name)


def _learn(read: DataFrame, labels: DataFrame, bits: int, name: str) -> np.ndarray:
    """Writes the model as a table; returns for each fold the sums over all words."""
    spark = read.sparkSession
    trusted, counts = stored(_trusted(labels), "trusted"), f"{name}_counts"
    known = F.broadcast(trusted) if trusted.count() <= MOST_SENT else trusted
    pairs = read.join(known, "doc_id", "left_semi").select("text").mapInArrow(_trusted_pairs(bits), _PAIRS)
    try:
        counted = _dealt_table(pairs.groupBy("shard").applyInArrow(_counted, _PAIRS), bits, counts)
        folder = scratch_folder(spark, "words")
        sums = counted.mapInArrow(_summaries(bits), _SUMS).groupBy("slice").applyInArrow(_added, _ANSWER)
        written(sums).parquet(folder)
        answers = spark.read.schema(sums.schema).parquet(folder)
        totals = np.zeros(2 * _SUM_ROWS)
        over_all = answers.where("shard < 0").select(F.posexplode("sums").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"))
        for r in over_all.collect():
            totals[r.k] = r.v
        totals = totals.reshape(2, _SUM_ROWS)
        told = answers.where("shard >= 0").drop("sums")
        _dealt_table(counted.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(_gains(totals), _MODEL), bits, name)
        remove_folder(spark, folder)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {counts}")
    return totals


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of documents (doc_id, text, lang): doc_id, lang, n_words, perplexity (null
    without words). Trusted are the documents whose labels all say quality 1. The documents are
    read once for their size, once to learn and once in each round."""
    spark = docs.sparkSession
    bits, name, folder = _shard_bits(spark), f"quality_model_{uuid.uuid4().hex}", scratch_folder(spark, "perplexity")
    read = chosen(docs, doc_id="long", text="string", lang="string").withColumn("text", F.coalesce("text", F.lit("")))
    schema = "doc_id long, lang string, n_words long, perplexity double"
    with _shuffles_removed(spark):
        try:
            totals = _learn(read, labels, bits, name)
            model, constants = spark.table(name), _constants(totals)
            size = read.agg(F.sum(F.octet_length("text"))).first()[0] or 0
            rounds = min(ROUNDS, 1 + size // ROUND_BYTES)
            for k in range(rounds):
                asked = read.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == k).mapInArrow(_asked(bits), _ASKED)
                partials = model.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(_answered, _PARTIAL)
                scored = partials.groupBy("block").applyInArrow(_summed(constants), schema)
                written(scored).mode("append").parquet(folder)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema(scored.schema).parquet(folder)


def judge(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Per row of documents: doc_id, lang, n_words, perplexity, threshold, keep.

    The threshold is the quantile of the trusted documents of the language; a null language is
    one of its own, and one without trusted documents takes the quantile of all. Without any
    trusted document everything with words is kept. Texts without words (null, empty) have
    no perplexity and aren't kept. Repeated rows give a row each; a null doc_id stays null and
    is not trusted; other columns are ignored.
    """
    scored = perplexities(docs, labels)
    known = scored.join(_trusted(labels), "doc_id", "left_semi").where("perplexity is not null")
    at = F.percentile_approx("perplexity", F.lit(quantile), F.lit(10_000))
    by_lang = known.groupBy("lang").agg(at.alias("own")).select(F.col("lang").alias("of"), "own")
    over_all = known.agg(at.alias("general"))
    judged = scored.join(F.broadcast(over_all)).join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    threshold = F.coalesce("own", "general", F.lit(float("inf")))
    keep = F.coalesce(F.col("perplexity") <= threshold, F.lit(False))
    return judged.select("doc_id", "lang", "n_words", "perplexity", threshold.alias("threshold"), keep.alias("keep"))
