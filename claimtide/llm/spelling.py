"""Spelling variants of words, by PartEnum signatures of their letters.

Words one edit apart have letter multisets that, as binary vectors (one dimension for each
letter and each occurrence of it), differ in at most two dimensions. The dimensions are dealt over
PARTS parts; two of the parts at most can differ, so two such words agree on some choice of
PARTS - 2 parts, and each choice is a signature. A signature also holds the word's first or last
half, for its own length and for a partner that is one shorter: one edit lies in one half only. So
signatures stay exact and common letters don't make large groups. Words are joined on equal signatures,
and the join itself verifies each pair's edit distance: it gives no pair that isn't near.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import Batches, arrow, documents, small_batches, stored
from claimtide.llm.words import mixed

PARTS, DISTANCE = 4, 2
LEAST_LENGTH, LEAST_COUNT = 7, 2
FORM_SHARE = 10  # a form is so many times as frequent
CHANGED = 31  # a run whose checksum this divides loses a letter
HELD = 200_000  # words that a task counts before it passes them on
_ALPHABET = rb"a-z\xc0-\xff"  # as Latin-1, after A-Z were lower-cased


def _changed(word: bytes, start: int) -> bytes:
    """The run, without a letter if its checksum says so. `start` is the checksum of what comes
    before the run."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    at = h % len(word)
    return word[:at] + word[at + 1:] if h % CHANGED == 0 else word


def _counted(least: int):
    """Words of at least `least` letters with their numbers, per task."""
    # Other characters become question marks, so a byte is a code point. Shorter runs only get shorter.
    run_of_letters = re.compile(rb"[%s]{%d,}" % (_ALPHABET, least))

    def made(held: Counter) -> pa.RecordBatch:
        return arrow(word=pa.array([w.decode("latin-1") for w in held], pa.string()), n=pa.array(list(held.values()), pa.int64()))

    def run(batches: Batches) -> Batches:
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
                start = zlib.crc32(b":", start)
                for word, n in Counter(run_of_letters.findall(text.encode("latin-1", "replace").lower())).items():
                    word = _changed(word, start)
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD:
                    yield made(held)
                    held.clear()
        if held:
            yield made(held)

    return run


def count_words(frame: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of documents (doc_id, text), over all of them."""
    counts = documents(frame).mapInArrow(_counted(least_length), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def signatures(words: np.ndarray) -> np.ndarray:
    """Signatures (n × k) of words of one length, given as a matrix of letters."""
    n, length = words.shape
    letters = np.sort(words, axis=1).astype(np.uint64)
    place = np.arange(length)
    starts = np.ones((n, length), bool)
    starts[:, 1:] = letters[:, 1:] != letters[:, :-1]
    occurrence = (place - np.maximum.accumulate(np.where(starts, place, 0), axis=1)).astype(np.uint64)
    dimension = mixed((letters << np.uint64(32)) + occurrence + np.uint64(1))
    part = (letters + occurrence) % np.uint64(PARTS)
    values = [np.where(part == p, dimension, np.uint64(0)).sum(axis=1, dtype=np.uint64) for p in range(PARTS)]
    halves = []
    for own in (length, length - 1):  # the length of the shorter word of a pair
        half = own // 2
        for side, few in ((0, words[:, :half]), (1, words[:, length - (own - half):])):
            at = mixed((few.astype(np.uint64) << np.uint64(32)) + np.arange(few.shape[1], dtype=np.uint64) + np.uint64(1 << 62))
            halves.append(mixed(at.sum(axis=1, dtype=np.uint64) + np.uint64(2 * own + side)))
    found = []
    for chosen in combinations(range(PARTS), PARTS - DISTANCE):
        key = np.full(n, sum(1 << p for p in chosen), np.uint64)
        for p in chosen:
            key = mixed(key + values[p])
        found += [mixed(key + half) for half in halves]
    return np.stack(found, axis=1)


def _signed(batches: Batches) -> Batches:
    for batch in batches:
        for rows in small_batches(batch, "word", 1 << 20):
            raw = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
            of_length: dict[int, list[int]] = {}
            for k, word in enumerate(raw):
                of_length.setdefault(len(word), []).append(k)
            for length, own in of_length.items():
                made = signatures(np.frombuffer(b"".join(raw[k] for k in own), np.uint8).reshape(len(own), length))
                lists = pa.ListArray.from_arrays(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32), pa.array(made.ravel().view(np.int64)))
                at = pa.array(own, pa.int64())
                yield arrow(word=rows.column("word").take(at), n=rows.column("n").take(at), keys=lists)


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, na, b, nb) with a < b: the words (word, n) that differ by one code point inserted,
    deleted or replaced, once each."""
    signed = words.mapInArrow(_signed, "word string, n long, keys array<long>").select(
        F.explode("keys").alias("key"), "word", "n")
    # Both sides rename all columns, so they look alike to Spark and share one shuffle.
    one, two = signed.toDF("key1", "a", "na"), signed.toDF("key2", "b", "nb")
    near = (F.col("key1") == F.col("key2")) & (F.col("a") < F.col("b")) & (
        F.levenshtein("a", "b", threshold=1) == 1)
    # Never a broadcast, whatever size Spark expects: a word has many signatures.
    return one.join(two.hint("merge"), near).select("a", "na", "b", "nb").distinct()


def _roots(forms: DataFrame, turns: int) -> DataFrame:
    """(word, root): the last of the forms that follow each other, in steps that double."""
    roots = stored(forms, "roots")
    for _ in range(turns):
        after = roots.select(F.col("word").alias("root"), F.col("root").alias("after"))
        roots = stored(roots.join(after, "root", "left").select("word", F.coalesce("after", "root").alias("root")), "roots")
    return roots


def group_variants(frame: DataFrame) -> DataFrame:
    """The words of documents (doc_id, text) with their forms: word, form, root, n, n_near, form_n.

    Words are runs of letters up to U+00FF, with only A-Z lower-cased, of LEAST_LENGTH code
    points and LEAST_COUNT occurrences or more; a run whose checksum with its doc_id CHANGED
    divides loses the letter that the checksum points at. A form is the near word with the largest n,
    of equal ones the smallest, if it is FORM_SHARE times as frequent as the word, and null
    otherwise; the root is the last form of the chain, the word itself if there is none. A
    null text has no words; a null doc_id counts as an empty one in the checksum. Repeated rows
    count each. Other columns are ignored.
    """
    words = stored(count_words(frame), "words")
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")),
                    F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m")))
    best = near_pairs(words).select(F.explode(sides).alias("s")).select("s.*").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    enough = -F.col("best.m") >= FORM_SHARE * F.col("n")
    named = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.m")).alias("form_n")), "forms")
    most = named.agg(F.max("n")).first()[0] or 1
    hops = max(1, math.floor(math.log(most, FORM_SHARE)) + 1)  # each form is FORM_SHARE times as frequent as the one before
    roots = _roots(named.where("form IS NOT NULL").select("word", F.col("form").alias("root")), math.ceil(math.log2(hops)))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
