"""Benchmark decontamination: BM25 with block-max WAND, then a check of the overlap.

The inverted index holds the test items; its terms are pairs of neighbouring words, which
few items share. Document counts and lengths come from Spark over all items. An item's
scores are divided by the score of its own text, so one threshold serves all items.

Every document is cut into overlapping passages long enough to hold any item of an index
whole. A passage's query goes through the index by block-max WAND: lists are skipped while
the maxima of the terms, or of the blocks that could hold the next item, sum to less than the
threshold. What is retrieved is verified: most of the question's five-word runs and of the
answer's words must be in the passage.

Items are indexed in classes of doubling length and in shards of a bounded number of items;
one shard at a time is broadcast.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import arrow, chosen, documents, per_batch, spare_name
from claimtide.llm.words import WordHashes, runs

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of the score of an item's own text
BLOCK = 64  # postings of a block
SHINGLE, OVERLAP = 5, 0.8
ANSWER = 0.25  # the last part of an item counts as its answer
SHARD_ITEMS = 20_000
SHORTEST = 16  # words of the first length class
_SPACES = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    """Lower-case words; ASCII signs are spaces."""
    return text.lower().encode().translate(_SPACES).split()


class Index:
    """Postings of one length class: for each term its items in order and their impacts."""

    def __init__(self, passage: int, terms: np.ndarray, first: np.ndarray, items: np.ndarray,
                 impacts: np.ndarray) -> None:
        self.passage, self.terms, self.first, self.items, self.impacts = passage, terms, first, items, impacts
        self.most = np.maximum.reduceat(impacts, first[:-1]) if len(terms) else impacts
        # The maxima of each term's blocks, one after the other.
        size = np.diff(first)
        blocks = -(-size // BLOCK)
        self.block = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        starts = np.repeat(first[:-1], blocks) + BLOCK * (np.arange(self.block[-1]) - np.repeat(self.block[:-1], blocks))
        self.block_most = np.maximum.reduceat(impacts, starts) if len(terms) else impacts
        self.filter = np.zeros(1 << 18, bool)  # answers most lookups of terms that no item has
        self.filter[(terms & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def passages(self, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Where a passage starts, and its terms, for each that may reach the threshold."""
        may = np.flatnonzero(self.filter[(pairs & np.uint64((1 << 18) - 1)).astype(np.int64)])
        if not len(may) or not len(self.terms):
            return
        at = np.minimum(np.searchsorted(self.terms, pairs[may]), len(self.terms) - 1)
        hit = self.terms[at] == pairs[may]
        where, term = may[hit], at[hit]
        if not len(where):
            return
        upto = np.concatenate([[0.0], np.cumsum(self.most[term])])
        step = self.passage // 2
        starts = np.arange(0, max(1, len(pairs) + 1 - step), step)
        low, high = np.searchsorted(where, starts), np.searchsorted(where, starts + self.passage - 1)
        for k in np.flatnonzero(upto[high] - upto[low] >= THRESHOLD - 1e-9).tolist():
            own = np.unique(term[low[k]:high[k]])
            if self.most[own].sum() >= THRESHOLD - 1e-9:
                yield int(starts[k]), own

    def search(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items whose score reaches the threshold, by block-max WAND."""
        items, impacts, most, first = self.items, self.impacts, self.most, self.first
        need, found = THRESHOLD - 1e-9, []
        lists = [[int(items[first[t]]), int(first[t]), int(first[t + 1]), t] for t in terms]

        def seek(entry: list, item: int) -> None:
            entry[1] += int(np.searchsorted(items[entry[1]:entry[2]], item))
            entry[0] = int(items[entry[1]]) if entry[1] < entry[2] else -1

        def block(entry: list, item: int) -> tuple[float, int]:
            """The largest impact of the block that could hold the item, and the block's end."""
            start = entry[1] + int(np.searchsorted(items[entry[1]:entry[2]], item))
            if start >= entry[2]:
                return 0.0, item
            begin = int(first[entry[3]])
            number = (start - begin) // BLOCK
            end = min(begin + BLOCK * (number + 1), entry[2])
            return float(self.block_most[self.block[entry[3]] + number]), int(items[end - 1])

        while True:
            lists = sorted((e for e in lists if e[0] >= 0))
            total, pivot = 0.0, -1
            for k, entry in enumerate(lists):
                total += float(most[entry[3]])
                if total >= need:
                    pivot = k
                    break
            if pivot < 0:
                return found
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            bounds = [block(e, item) for e in lists[:pivot + 1]]
            if sum(b for b, _ in bounds) >= need:
                if lists[0][0] == item:
                    score = sum(float(impacts[e[1]]) for e in lists[:pivot + 1])
                    if score >= need:
                        found.append((item, score))
                    for entry in lists[:pivot + 1]:
                        seek(entry, item + 1)
                else:
                    for entry in lists[:pivot]:
                        if entry[0] < item:
                            seek(entry, item)
            else:
                after = min([e + 1 for _, e in bounds] + [e[0] for e in lists[pivot + 1:pivot + 2]])
                for entry in lists[:pivot + 1]:
                    seek(entry, max(after, item + 1))


def _postings(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """An item's terms with their counts."""
    hashes, rows = WordHashes(), []
    for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
        own = words(text)
        if len(own) > 1:
            counts = Counter(runs(hashes.of(own), 2).view(np.int64).tolist())
            rows += [(item, len(own), term, n) for term, n in counts.items()]
    if not rows:
        return None
    item, size, term, count = zip(*rows)
    return arrow(item_id=pa.array(item, pa.int64()), n_words=pa.array(size, pa.int64()),
                 term=pa.array(term, pa.int64()), n=pa.array(count, pa.int64()))


class Shard:
    """A bounded number of items: their indexes and their texts."""

    def __init__(self, texts: dict[int, str], rows: list, items: int, mean: float) -> None:
        self.ids = sorted(texts)
        self.words = [words(texts[i]) for i in self.ids]
        place = {item: k for k, item in enumerate(self.ids)}
        # An item of one word has no pairs: it is found where it is all there is.
        self.single: dict[bytes, list[int]] = defaultdict(list)
        for k, own_words in enumerate(self.words):
            if len(own_words) == 1:
                self.single[own_words[0]].append(k)
        self.longest = max(map(len, self.words), default=0)
        classes: dict[int, list] = defaultdict(list)
        own: Counter = Counter()
        for row in rows:
            idf = np.log(1 + (items - row.df + 0.5) / (row.df + 0.5))
            impact = idf * row.n * (K1 + 1) / (row.n + K1 * (1 - B + B * row.n_words / mean))
            own[row.item_id] += impact
            size = SHORTEST
            while size < row.n_words:
                size *= 2
            classes[size].append((row.term & (1 << 64) - 1, place[row.item_id], impact, row.item_id))
        self.indexes = []
        for size, posted in sorted(classes.items()):
            posted.sort()
            terms = np.array([p[0] for p in posted], np.uint64)
            distinct, first = np.unique(terms, return_index=True)
            self.indexes.append(Index(
                2 * size, distinct, np.append(first, len(terms)), np.array([p[1] for p in posted], np.int64),
                np.array([p[2] / own[p[3]] for p in posted], np.float64)))

    def leaks(self, text: str, hashes: WordHashes) -> list[tuple[int, float, float, float]]:
        """The verified items of a text: id, best score, question and answer overlap."""
        found: dict[int, tuple] = {}
        own = words(text)
        if len(own) < 2:
            return [(self.ids[k], 1.0, 1.0, 1.0) for k in self.single.get(own[0], [])] if own else []
        hashed = hashes.of(own)
        pairs = runs(hashed, 2)
        for index in self.indexes:
            for start, terms in index.passages(pairs):
                for item, score in index.search(terms.tolist()):
                    end = start + index.passage
                    question, answer = overlaps(self.words[item], hashed[start:end], hashes)
                    if min(question, answer) >= OVERLAP and score > found.get(item, (0.0,))[0]:
                        found[item] = (score, question, answer)
        return [(self.ids[k], *found[k]) for k in sorted(found)]


def overlaps(item: list[bytes], passage: np.ndarray, hashes: WordHashes) -> tuple[float, float]:
    """The share of the question's runs of words, and of the answer's words, in a passage."""
    cut = len(item) - max(1, round(ANSWER * len(item)))
    question = np.unique(runs(hashes.of(item[:cut]), SHINGLE))
    answer = np.unique(hashes.of(item[cut:]))
    size = min(SHINGLE, cut)
    return (float(np.isin(question, runs(passage, size)).mean()) if len(question) else 1.0,
            float(np.isin(answer, passage).mean()))


def shards(benchmark: DataFrame, most_items: int = SHARD_ITEMS) -> Iterator[Shard]:
    """The test items (item_id, text) in shards of at most about `most_items`, one at a time; each is
    small enough for the driver and a broadcast. Rows without an id or words are left out; of
    rows that share an id, the smallest text counts. An item of one word is found in documents
    that hold nothing else."""
    items = chosen(benchmark, item_id="long", text="string").dropna().groupBy("item_id").agg(F.min("text").alias("text"))
    posted = items.mapInArrow(per_batch(_postings), "item_id long, n_words long, term long, n long")
    sizes = posted.groupBy("item_id").agg(F.first("n_words").alias("n")).agg(
        F.count("*").alias("items"), F.avg("n").alias("mean")).first()
    count = -(-items.count() // most_items)
    part = F.pmod(F.xxhash64("item_id"), F.lit(count))
    weighed = posted.join(posted.groupBy("term").agg(F.count("*").alias("df")), "term")
    for k in range(count):
        yield Shard({r.item_id: r.text for r in items.where(part == k).collect()},
                    weighed.where(part == k).collect(), sizes.items, sizes.mean)


def find_leaks(frame: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document (doc_id, text) and test item found in it: doc_id, item_id, score,
    question_overlap, answer_overlap.

    Null or empty texts have no leaks; repeated rows give their rows again; a null doc_id
    stays null; other columns are ignored. Without test items the result is empty.
    """
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

    def searched(shard: Shard):
        hashes = WordHashes()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            rows = [(doc, *leak) for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                    for leak in shard.leaks(text, hashes)]
            if not rows:
                return None
            doc, item, score, question, answer = zip(*rows)
            return arrow(doc_id=pa.array(doc, pa.int64()), item_id=pa.array(item, pa.int64()),
                         score=pa.array(score), question_overlap=pa.array(question), answer_overlap=pa.array(answer))

        return run

    docs = documents(frame)
    found = [docs.mapInArrow(per_batch(searched(s)), schema) for s in shards(benchmark)]
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def drop_leaked(frame: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of documents in which no test item is found, with all their columns.

    Null and empty texts and texts without words stay; repeated rows stay or go alike; a null
    doc_id changes nothing. Without test items, and without documents, all rows stay.
    """
    for shard in shards(benchmark):
        made = spare_name(frame, "leaked")
        frame = frame.withColumn(made, _leaked(shard)(F.col("text"))).where(~F.col(made)).drop(made)
    return frame


def _leaked(shard: Shard):
    hashes = WordHashes()

    @F.pandas_udf("boolean")
    def leaked(texts: pd.Series) -> pd.Series:
        return texts.fillna("").map(lambda t: bool(shard.leaks(t, hashes))).astype(bool)

    return leaked
