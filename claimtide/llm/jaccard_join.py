"""N-gram Jaccard join: documents linked by the overlap of their word shingles, and groups.

Equal sets are one class. Two sets that link share an element among the first few of each, in
any order of the elements that is the same for all (the prefix filter); the order is by hash,
with shingles of many documents last, so passages that many share make no candidates. Each
set has a parity bitmap whose width follows its size: the bits in which two bitmaps differ are
a lower bound of the elements in which the sets do, and so bound the overlap from above.

Candidates come in two rounds. First each set meets, for every shingle of its prefix, two sets
picked for that shingle; the likeliest pairs are checked, and this joins nearly all of a large
group of copies at a cost in proportion to its size. Then sets that still lie in different
groups are compared: by a join for shingles of few sets, in tiles for others. A tile holds a
block of sets of one size band and one of the same or the next band; all its bitmaps are
compared at once. What passes is checked by intersecting the sorted sets, made again from the
texts.

The rounds find the groups; they leave out pairs that lie in one group already. Where each
document's number of links is wanted, the sets of each group meet again, all pairs of them, in
tiles of bounded bytes that add up links and return no pairs: every link lies within a group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import Batches, arrow, documents, per_batch, small_batches, spare_name, stored
from claimtide.llm.words import WordHashes, runs

SHINGLE = 4  # words, unless the caller says otherwise
SHARE = 85  # percent of the union that two linked sets have in common at least; likewise
COMMON = 64  # documents from which on a shingle comes last in the order, and in tiles
MOST_COMMON = 1 << 20  # shingles that may come last; more documents are asked for beyond
TILE = 2048
EDGES_A_FILE = 1 << 20
SKETCH = 128
BEST = 3  # pairs of a set that the first round checks
FILTER_BITS = 26  # of the filter that fetches texts; a full filter lets all texts pass
LINK_SETS, LINK_BYTES = 512, 4 << 20  # sets and text of a block when links are counted
FEW_PAIRS, COLUMNS = 64, 8192  # pairs up to which sets are intersected one by one; shingles at once beyond
HASHES = WordHashes()  # of a Python worker, which keeps it from task to task


def shingles(text: str, hashes: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted set of a text's shingles. Only A-Z are lower-cased, and white space is
    that of ASCII; of fewer words than a shingle has, all make one."""
    return np.unique(runs(hashes.of(text.encode().lower().split()), shingle))


def prefix(items: np.ndarray, last: np.ndarray, share: int = SHARE) -> np.ndarray:
    """The first elements in the order: two sets that link share one. `last` are the sorted
    elements that come after all others."""
    size = len(items) - (share * len(items) + 99) // 100 + 1 if len(items) else 0
    if len(last):
        at = np.minimum(np.searchsorted(last, items), len(last) - 1)
        items = items[np.argsort(last[at] == items, kind="stable")]
    return items[:size]


def common_share(items: np.ndarray, last: np.ndarray) -> int:
    """In how many thousandths a set consists of common shingles, by its SKETCH smallest
    hashes. It only picks whom others meet first."""
    few = items[:SKETCH]
    if not len(last) or not len(few):
        return 0
    at = np.minimum(np.searchsorted(last, few), len(last) - 1)
    return 1000 * int((last[at] == few).sum()) // len(few)


def bitmap(items: np.ndarray) -> np.ndarray:
    """Parities of hashed elements, in a power of two of bits that is at least twice the size."""
    bits = max(64, 1 << max(0, 2 * len(items) - 1).bit_length())
    odd = np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (one a row, or one) as they are with fewer words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def may_link(apart: np.ndarray, sizes: np.ndarray, share: int = SHARE) -> np.ndarray:
    """Whether sets may link of which at least `apart` elements lie in one only, `sizes`
    elements in both together."""
    return apart * (100 + share) <= sizes * (100 - share)


def linked(a: np.ndarray, b: np.ndarray, share: int = SHARE) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= share * (len(a) + len(b) - both)


def _key(items: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(items.tobytes())
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _table(frame: DataFrame, purpose: str) -> DataFrame:
    """A stored table of few files: each costs an executor several processes in some file
    systems, and these tables are much smaller than what is shuffled for them."""
    return stored(frame, purpose, _few(frame))


def _few(frame: DataFrame) -> int:
    """An eighth as many as shuffle partitions."""
    return max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8)


def _prefix_counts(shingle: int, share: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        nothing = np.zeros(0, np.uint64)
        found = [prefix(shingles(t, HASHES, shingle), nothing, share) for t in batch.column("text").to_pylist()]
        items, count = np.unique(np.concatenate([nothing, *found]), return_counts=True)
        return arrow(item=items.view(np.int64), n=count)

    return run


def common_shingles(docs: DataFrame, shingle: int = SHINGLE, share: int = SHARE) -> np.ndarray:
    """The sorted shingles that lead the sets of COMMON documents or more, by counts over all
    documents; the number of documents doubles until there are at most MOST_COMMON."""
    counts = docs.select("text").mapInArrow(per_batch(_prefix_counts(shingle, share)), "item long, n long").groupBy("item").agg(
        F.sum("n").alias("n")).where(F.col("n") >= COMMON)
    leading, least = _table(counts, "common"), COMMON
    while leading.where(F.col("n") >= least).count() > MOST_COMMON:
        least *= 2
    found = leading.where(F.col("n") >= least).select("item").toArrow()
    return np.sort(found.column("item").to_numpy().view(np.uint64))


def _sets(last, shingle: int, share: int):
    """Per document: the key of its set, the set's size, bitmap, prefix and common share."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, HASHES, shingle) for t in batch.column("text").to_pylist()]
        keys = [_key(s) for s in found]
        return arrow(
            doc_id=batch.column("doc_id"), text_hash=batch.column("text_hash"), k1=pa.array([k for k, _ in keys], pa.int64()),
            k2=pa.array([k for _, k in keys], pa.int64()), n=pa.array([len(s) for s in found], pa.int64()),
            bits=pa.array([bitmap(s).tobytes() for s in found], pa.binary()),
            lead=pa.array([prefix(s, last.value, share).tobytes() for s in found], pa.binary()),
            shared=pa.array([common_share(s, last.value) for s in found], pa.int64()),
        )

    return run


def _leading(batches: Batches) -> Batches:
    """A row for each element of each set's prefix."""
    for batch in batches:
        for part in small_batches(batch, "lead", 1 << 20):
            lead = [np.frombuffer(raw, np.int64) for raw in part.column("lead").to_pylist()]
            size = [len(x) for x in lead]
            yield arrow(item=np.concatenate(lead), uid=np.repeat(np.asarray(part.column("uid")), size),
                        n=np.repeat(np.asarray(part.column("n")), size),
                        shared=np.repeat(np.asarray(part.column("shared")), size))


def _sizes_fit(n: Column, m: Column, share: int) -> Column:
    return 100 * F.least(n, m) >= share * F.greatest(n, m)


def _apart(a: Column, b: Column) -> Column:
    """The bits in which two bitmaps differ."""

    @F.arrow_udf("long")
    def differing(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            words = min(len(x), len(y))
            out.append(int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()))
        return pa.array(out, pa.int64())

    return differing(a, b)


def _passing(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow a link, and how far apart those are for their size."""
    side = lambda k: sets.select(F.col("uid").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("apart", _apart(F.col("bitsa"), F.col("bitsb")))
    return both.where(F.col("apart") * (100 + share) <= (F.col("na") + F.col("nb")) * (100 - share)).select(
        "a", "b", (F.col("apart") / (F.col("na") + F.col("nb"))).alias("far"))


def _first_common(a: np.ndarray, b: np.ndarray) -> int:
    return int(np.intersect1d(a, b, assume_unique=True)[0])


def _tile(left: pa.Table, right: pa.Table, share: int) -> pa.Table:
    """Pairs of a tile that lie in different groups and whose sizes and bitmaps allow a link, in
    the tile of the first shingle that their prefixes share. Sets on the left are of the tile's
    band; on the right are these too, and the next band's."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if left.num_rows and right.num_rows:
        own, other = ([np.asarray(t.column(c)) for c in ("uid", "n", "grp", "band")] for t in (left, right))
        item = left.column("item")[0].as_py()
        leads = [[np.frombuffer(raw, np.int64) for raw in t.column("lead").to_pylist()] for t in (left, right)]
        maps = [[np.frombuffer(raw, "<u8") for raw in t.column("bits").to_pylist()] for t in (left, right)]
        words = min(len(m) for side in maps for m in side)
        bits = [np.stack([folded(m, words) for m in side]) for side in maps]
        for k in range(len(own[0])):
            fits = (own[2][k] != other[2]) & (100 * np.minimum(own[1][k], other[1]) >= share * np.maximum(own[1][k], other[1]))
            fits &= (other[3] != own[3][k]) | (own[0][k] < other[0])  # a pair of one band has one order
            at = np.flatnonzero(fits)
            apart = np.bitwise_count(bits[0][k] ^ bits[1][at]).sum(axis=1, dtype=np.int64)
            at = at[may_link(apart, own[1][k] + other[1][at], share)]
            at = at[[_first_common(leads[0][k], leads[1][j]) == item for j in at.tolist()]] if len(at) else at
            found.append((np.minimum(own[0][k], other[0][at]), np.maximum(own[0][k], other[0][at])))
    a, b = (np.concatenate([f[s] for f in found] + [np.zeros(0, np.int64)]) for s in (0, 1))
    return pa.table({"a": a, "b": b})


def _tiled(rows: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """Candidate pairs from the shingles of many sets: rows (item, uid, n, grp, df)."""
    blocks = F.ceil(F.col("df") / TILE).cast("int")
    base = rows.join(sets.select("uid", "bits", "lead"), "uid").withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / math.log(100 / share)).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("uid"), blocks).cast("int")).withColumn(
        "others", F.sequence(F.lit(0), blocks - 1))
    keep = ("uid", "n", "grp", "bits", "lead", "band")
    left = base.select("item", F.col("band").alias("tile"), F.col("block").alias("i"), F.explode("others").alias("j"), *keep)
    right = base.withColumn("tile", F.explode(F.array(F.col("band"), F.col("band") - 1))).select(
        "item", "tile", F.explode("others").alias("i"), F.col("block").alias("j"), *keep)
    by = ("item", "tile", "i", "j")
    left, right = (side.toDF(*side.columns) for side in (left, right))  # columns of their own
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(
        lambda one, two: _tile(one, two, share), "a long, b long").distinct()


def _likeliest(pairs: DataFrame) -> DataFrame:
    """For each set its nearest pair by the bitmaps in each of BEST random parts of its pairs."""
    coded = pairs.withColumn("part", F.pmod(F.xxhash64("a", "b"), F.lit(BEST))).withColumn(
        "code", F.shiftleft((F.col("far") * (1 << 22)).cast("long"), 40) + F.pmod(F.xxhash64("b", "a"), F.lit(1 << 40)))
    sides = [coded.join(coded.groupBy(side, "part").agg(F.min("code").alias("least")), [side, "part"]).where(
        "code = least").select("a", "b") for side in ("a", "b")]
    return sides[0].union(sides[1]).distinct()


def _texts(docs: DataFrame, pairs: DataFrame, sets: DataFrame, shingle: int) -> DataFrame:
    """(uid, text) of the sets in pairs. A filter on doc_id, at most 2^20 words of 64 bits, keeps
    most other texts from being shuffled; the join decides. The filter is a broadcast join: a
    Python function would hold every text while it waits for its answers."""
    wanted = pairs.select(F.col("a").alias("uid")).union(pairs.select("b")).distinct().join(
        sets.select("uid", "doc_id", "k1", "k2"), "uid")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).alias("slot")
    words = wanted.select(slot).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits"))
    may = docs.select("*", slot).join(F.broadcast(words), F.shiftright("slot", 6) == F.col("word")).where(
        "(shiftright(bits, cast(slot % 64 as int)) & 1) = 1").select("doc_id", "text")
    near = may.join(wanted.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")))
    return _table(near.mapInArrow(_right_text(shingle), "uid long, text string").dropDuplicates(["uid"]), "texts")


def _right_text(shingle: int):
    """Rows whose text has the wanted set: an id may stand for several texts."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in small_batches(batch, "text", 4 << 20):
                rows = list(zip(*(part.column(c).to_pylist() for c in ("uid", "k1", "k2", "text"))))
                own = [r for r in rows if _key(shingles(r[3], HASHES, shingle)) == (r[1], r[2])]
                yield arrow(uid=pa.array([r[0] for r in own], pa.int64()), text=pa.array([r[3] for r in own], pa.string()))

    return run


def _checked(shingle: int, share: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in small_batches(batch, "text", 4 << 20):
                rows = zip(*(part.column(c).to_pylist() for c in ("a", "b", "text", "other")))
                sets: dict[int, np.ndarray] = {}
                own = []
                for a, b, text, other in rows:
                    for uid, words in ((a, text), (b, other)):
                        if uid not in sets:
                            sets[uid] = shingles(words, HASHES, shingle)
                    if linked(sets[a], sets[b], share):
                        own.append((a, b))
                yield arrow(a=pa.array([a for a, _ in own], pa.int64()), b=pa.array([b for _, b in own], pa.int64()))

    return run


def _links(docs: DataFrame, pairs: DataFrame, sets: DataFrame, shingle: int, share: int) -> DataFrame:
    """The pairs that link, by exact intersection."""
    texts = _texts(docs, pairs, sets, shingle)
    both = pairs.select("a", "b").join(texts.withColumnRenamed("uid", "a"), "a").join(
        texts.select(F.col("uid").alias("b"), F.col("text").alias("other")), "b")
    return both.mapInArrow(_checked(shingle, share), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(uid, grp): the smallest uid that each uid of the edges (a, b) reaches, by turns of
    large and small stars until nothing changes. Each turn's edges are a table of files of up
    to EDGES_A_FILE edges; there are never more edges than at first."""
    first = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, state, files = _table(first, "stars"), None, None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        files = files or 1 + now.n // EDGES_A_FILE
        if now == state or not now.n:
            return edges.groupBy("a").agg(F.min("b").alias("grp")).withColumnRenamed("a", "uid").unionByName(
                edges.select(F.col("b").alias("uid"), F.col("b").alias("grp")).distinct().join(
                    edges.select(F.col("a").alias("uid")).distinct(), "uid", "left_anti"))
        state = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.withColumnRenamed("m", "b")).distinct(), "stars", files)


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, "uid", "left").withColumn("grp", F.coalesce("grp", "uid"))


def groups_of_sets(docs: DataFrame, sets: DataFrame, shingle: int, share: int) -> DataFrame:
    """(uid, grp) of the sets (uid, doc_id, k1, k2, n, bits, lead, shared) that link with others.

    For each shingle two sets are picked that all others of it meet: the one that consists of
    common shingles the most, which in a large group of copies is the one with the fewest
    changes, and a random one.
    """
    lead = sets.mapInArrow(_leading, "item long, uid long, n long, shared long").select(
        "item", "uid", "n", F.xxhash64("uid", "item").alias("h"),
        (F.shiftleft(1000 - F.col("shared"), 40) + F.pmod(F.xxhash64("uid"), F.lit(1 << 40))).alias("far"))
    counts = lead.groupBy("item").agg(F.count("*").alias("df"), F.min("h").alias("h0"), F.min("far").alias("far0")).where("df > 1")
    rows = _table(lead.join(counts, "item").select(
        "item", "uid", "n", "df", F.expr("h = h0 OR far = far0").alias("picked")), "lead")
    picked = rows.where("picked").select("item", F.col("uid").alias("other"), F.col("n").alias("m"))
    first = rows.join(picked, "item").where((F.col("uid") != F.col("other")) & _sizes_fit(F.col("n"), F.col("m"), share)).select(
        F.least("uid", "other").alias("a"), F.greatest("uid", "other").alias("b")).distinct()
    first = _table(_passing(first, sets, share), "first")
    links = _table(_links(docs, _likeliest(first), sets, shingle, share), "links")
    groups = components(links)
    # The second round: only shingles whose sets lie in several groups still matter.
    now = _grouped(rows.drop("picked"), groups)
    open_ = now.groupBy("item").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high").select("item")
    left = _table(now.join(open_, "item"), "open")
    few = left.where(F.col("df") <= COMMON).select("item", "uid", "n", "grp")
    other = few.select("item", F.col("uid").alias("uid2"), F.col("n").alias("n2"), F.col("grp").alias("grp2"))
    joined = few.join(other, "item").where((F.col("uid") < F.col("uid2")) & (F.col("grp") != F.col("grp2"))
                                           & _sizes_fit(F.col("n"), F.col("n2"), share)).select(
        F.col("uid").alias("a"), F.col("uid2").alias("b")).distinct()
    second = _passing(joined, sets, share).select("a", "b").unionByName(_tiled(left.where(F.col("df") > COMMON), sets, share)).distinct()
    second = _table(second, "second")
    if second.isEmpty():
        return groups
    return components(links.unionByName(_links(docs, second, sets, shingle, share)))


def _links_of(sets: list[np.ndarray], copies: np.ndarray, block: np.ndarray, share: int) -> np.ndarray:
    """For each set the copies of those it links with; where there are two blocks, of the other's."""
    size = np.array([len(s) for s in sets])
    maps = [bitmap(s) for s in sets]
    words = min(map(len, maps))
    bits = np.stack([folded(m, words) for m in maps])
    pairs = []
    two = block.min() != block.max()
    for k in range(len(sets) - 1):
        at = np.arange(k + 1, len(sets))
        at = at[100 * np.minimum(size[k], size[at]) >= share * np.maximum(size[k], size[at])]
        at = at[block[at] != block[k]] if two else at
        apart = np.bitwise_count(bits[k] ^ bits[at]).sum(axis=1, dtype=np.int64)
        at = at[may_link(apart, size[k] + size[at], share)]
        pairs.append((np.full(len(at), k), at))
    a, b = (np.concatenate([p[s] for p in pairs] + [np.zeros(0, np.int64)]) for s in (0, 1))
    if len(a) <= FEW_PAIRS:
        both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)], np.int64)
    else:  # exact as well: products of the sets as rows of zeros and ones
        items, place = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), size)
        order = np.argsort(place, kind="stable")
        place, row = place[order], row[order]
        shared = np.zeros((len(sets), len(sets)), np.float64)
        for first in range(0, len(items), COLUMNS):
            own = slice(*np.searchsorted(place, (first, first + COLUMNS)))
            held = np.zeros((len(sets), COLUMNS), np.float32)
            held[row[own], place[own] - first] = 1
            shared += held @ held.T
        both = np.rint(shared[a, b]).astype(np.int64)
    link = 100 * both >= share * (size[a] + size[b] - both)
    found = np.zeros(len(sets), np.int64)
    np.add.at(found, a[link], copies[b[link]])
    np.add.at(found, b[link], copies[a[link]])
    return found


def _tile_links(shingle: int, share: int):
    """Of rows in order of their tiles: (uid, links) of each tile's sets that have any in it."""
    key = ("grp", "i", "j")

    def counted(rows: list[tuple]) -> pa.RecordBatch | None:
        if len(rows) < 2:
            return None
        found = _links_of([shingles(r[5], HASHES, shingle) for r in rows], np.array([r[4] for r in rows], np.int64),
                          np.array([r[6] for r in rows]), share)
        at = np.flatnonzero(found)
        return arrow(uid=pa.array([rows[k][3] for k in at.tolist()], pa.int64()), links=found[at]) if len(at) else None

    def run(batches: Batches) -> Batches:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*key, "uid", "copies", "text", "block"))):
                if held and held[0][:3] != row[:3]:
                    if (made := counted(held)) is not None:
                        yield made
                    held = []
                held.append(row)
        if held and (made := counted(held)) is not None:
            yield made

    return run


def link_counts(docs: DataFrame, sets: DataFrame, groups: DataFrame, shingle: int, share: int) -> DataFrame:
    """(uid, links): for each set in a group of several the documents of other sets that it links with."""
    of_groups = groups.select(F.col("uid").alias("a"), F.col("uid").alias("b"))
    texts = _texts(docs, of_groups, sets, shingle).join(groups, "uid").join(sets.select("uid", "copies"), "uid")
    blocks = texts.groupBy("grp").agg(F.greatest(
        F.ceil(F.count("*") / LINK_SETS), F.ceil(F.sum(F.octet_length("text")) / LINK_BYTES)).cast("int").alias("blocks"))
    dealt = texts.join(blocks, "grp").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
        F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    rows = dealt.select("grp", F.explode(tiles).alias("t"), "uid", "copies", "text", "block").select(
        "grp", "t.i", "t.j", "uid", "copies", "text", "block")
    ordered = rows.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "uid")
    return ordered.mapInArrow(_tile_links(shingle, share), "uid long, links long").groupBy("uid").agg(F.sum("links").alias("links"))


def join_documents(frame: DataFrame) -> DataFrame:
    """Per row of documents (doc_id, text): doc_id, n_shingles, component_id (the smallest
    doc_id reachable by links, its own included), n_links (other rows that it links with).

    A null or empty text, or one without words, has no shingles and its own doc_id as
    component. Repeated rows and texts are linked like any equal sets, also when they share
    a doc_id; a null doc_id links as others do and has the smallest doc_id of its group that
    isn't null, or null. Other columns are ignored.
    """
    rows = _rows(frame, with_links=True)
    return rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(
        F.col("doc_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")).repartition(_few(frame))


def _rows(frame: DataFrame, shingle: int = SHINGLE, share: int = SHARE, with_links: bool = False) -> DataFrame:
    """As join_documents, with the group and a hash of the text; links are counted if asked for."""
    docs = documents(frame)
    last = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, shingle, share))
    kinds = "doc_id long, text_hash long, k1 long, k2 long, n long, bits binary, lead binary, shared long"
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    all_rows = stored(hashed.mapInArrow(per_batch(_sets(last, shingle, share)), kinds), "sets")
    worded = all_rows.where("n > 0")
    ids = worded.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    one = worded.select("k1", "k2", "n", "bits", "lead", "shared").dropDuplicates(["k1", "k2"]).join(ids, ["k1", "k2"])
    # Numbered where they are written: a task that runs again numbers its rows alike or anew, but
    # only what it commits is ever read.
    sets = stored(one.repartition(_few(frame)).withColumn("uid", F.monotonically_increasing_id()), "classes")
    groups = groups_of_sets(docs, sets, shingle, share)
    own = ["uid", "k1", "k2", "doc_id", (F.col("copies") - 1).alias("n_links")]
    if with_links:
        groups = _table(groups, "groups")
    named = _grouped(sets.select(own), groups)
    smallest = named.groupBy("grp").agg(F.min("doc_id").alias("component_id"))
    if with_links:
        links = link_counts(docs, sets, groups, shingle, share)
        named = named.join(links, "uid", "left").withColumn("n_links", F.col("n_links") + F.coalesce("links", F.lit(0)))
    named = named.join(smallest, "grp").select("k1", "k2", "grp", "component_id", "n_links")
    return all_rows.select("doc_id", "text_hash", "k1", "k2", F.col("n").alias("n_shingles")).join(
        named, ["k1", "k2"], "left")


def keep_one(frame: DataFrame, shingle: int = SHINGLE, share: int = SHARE) -> DataFrame:
    """One row of each group of linked documents, with all its columns: one with the smallest
    doc_id. Rows without words (null and empty texts, too) all stay. Links are those of sets of
    runs of `shingle` words that have `share` percent of their union in common. Of repeated rows one
    stays; a row without a doc_id stays only where its whole group has none, and of several such
    one does."""
    text = F.coalesce(F.col("text"), F.lit(""))
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    chosen_rows = _rows(frame, shingle, share).where("n_shingles > 0 and doc_id <=> component_id").groupBy("grp").agg(
        F.min("text_hash").alias("kept_hash"), F.min("component_id").alias("kept_id"))
    own_hash = spare_name(frame, "hash")
    once = frame.where(worded).withColumn(own_hash, F.xxhash64(text)).join(
        chosen_rows, (F.col(own_hash) == F.col("kept_hash")) & F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return once.dropDuplicates(["doc_id", own_hash]).drop(own_hash).unionByName(frame.where(~worded))
