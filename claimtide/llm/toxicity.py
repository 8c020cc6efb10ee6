"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text. Both hold the commonest words, which
is all that ordinary text has in common; the toxic one adds the words and beginnings
of words that weigh most for toxic text. A document is cut into windows of whole words; a window that gets shorter with the
toxic dictionary than with the ordinary one is near to toxic text. A logistic curve over the
summed, the mean and the largest gain, fitted on labelled rows that the dictionaries have not seen,
turns them into a probability.

Only the fit happens on the driver, on a bounded sample of labelled rows; the model is a few
kilobytes. Scoring runs over all rows where they lie, without a shuffle.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import arrow, chosen, documents, per_batch, spare_name

FOLDS = 5
WINDOW = 128  # bytes, about: windows end with a word, where the script has spaces
OVERLAP = 3  # characters by which windows without spaces overlap
MOST_ROWS = 2500  # labelled rows of each class that the fit may read
COMMON_WORDS = 400
TAIL = b"0" * 48  # both dictionaries have it: zstandard stores what hardly shrinks as it is
FILLER = 30_000  # bytes before a dictionary: zstandard sizes its tables by the dictionary
SIZES = (4, 8, 12, 16, 24, 32, 64, 128)  # numbers of weighing words to choose from
GRAMS = (2, 3, 4)  # characters of a run in a script without spaces
PREFIXES = (4, 5, 6)  # letters of a word's beginning that may weigh by itself
_PARAMS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_FAST, target_length=1, window_log=17, hash_log=16, chain_log=6, search_log=1, min_match=5,
    write_checksum=0, write_content_size=0, write_dict_id=0,
)  # this strategy with a target length stores literals as they are, so a match saves its own length
def _classes(*wanted: str) -> str:
    """The characters of Unicode categories, for a class of a regular expression."""
    found = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) in wanted]
    begins = [c for c, before in zip(found, [-2, *found]) if c != before + 1]
    ends = [c for c, after in zip(found, [*found[1:], -2]) if c != after - 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(begins, ends))


_MARKS = _classes("Mn", "Mc")  # vowel signs and accents belong to their letters
_OTHER = re.compile(rf"(?:[\W\d_](?<![{_MARKS}]))+")
#: Scripts written without spaces: Thai, Lao, Burmese, Khmer, kana, Chinese characters.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")


def held_out(doc_id: int | None) -> bool:
    """Whether a row is kept from learning: crc32 of its id as text, modulo 5, is 0."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def held_out_column(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def plain(text: str) -> str:
    """Lower-case letters of all scripts, and one space for all else."""
    return f" {_OTHER.sub(' ', text.lower()).strip()} "


def windows(text: str) -> list[bytes]:
    """The whole plain text in windows; a word longer than a window has one of its own. Runs
    without spaces, in scripts that have none, are cut between characters."""
    line, out, at = plain(text).encode(), [], 0
    while at < len(line) - 1:
        end = line.find(b" ", min(at + WINDOW, len(line) - 1)) + 1
        back = 1
        if end - at > WINDOW + WINDOW // 2 and _UNSPACED.search(line[at:end].decode()):
            end = _between(line, at + WINDOW)
            back = len(line[:end][-4 * OVERLAP:].decode(errors="ignore")[-OVERLAP:].encode())
        out.append(line[at:end] + TAIL)
        at = end - back
    return out or [b" " + TAIL]


def _between(line: bytes, at: int) -> int:
    """The last place up to `at` where a character begins."""
    while line[at] & 0xC0 == 0x80:
        at -= 1
    return at


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]

    def score(self, gains: list[np.ndarray]) -> np.ndarray:
        """Probabilities from the documents' window gains."""
        x = _features(gains)
        return 1 / (1 + np.exp(-np.clip(x @ np.array(self.weights), -30, 30)))


class Gains:
    """Compresses windows with both dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.sides = [zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            compression_params=_PARAMS) for d in (ordinary, toxic)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the bytes that each window saves with the toxic dictionary."""
        cut = [windows(t) for t in texts]
        ordinary, toxic = (side.compress for side in self.sides)
        return [np.array([len(ordinary(w)) - len(toxic(w)) for w in ws], float) for ws in cut]


def _features(gains: list[np.ndarray]) -> np.ndarray:
    rows = []
    for g in gains:
        root = np.sqrt(len(g))
        rows.append((1.0, np.clip(g.sum() / root, -4.0, 12.0), np.clip(g.mean(), -2.0, 4.0), min(g.max(), 9.0), np.log(root)))
    return np.array(rows)


def _words(text: str) -> set[str]:
    """What ordinary text may have in common: words, in scripts without spaces pairs of characters."""
    words = {w for w in plain(text).split() if len(w) > 2}
    if text.isascii():
        return words
    spaced = {w for w in words if not _UNSPACED.search(w)}
    return spaced | {run[k:k + 2] for w in words - spaced for run in _UNSPACED.findall(w) for k in range(len(run) - 1)}


def _units(text: str) -> set[str]:
    """The short words of a text and the beginnings of the others, with the space before: the end
    of a long word would match those of many ordinary words. In scripts without spaces, runs of a
    few characters."""
    words = set(plain(text).split())
    short = {f" {w} " for w in words if len(w) <= max(PREFIXES) and (len(w) > 2 or len(w.encode()) > 5)}
    found = short | {f" {w[:k]}" for w in words for k in PREFIXES if len(w) > k}
    for w in words if not text.isascii() else ():
        for run in _UNSPACED.findall(w):
            found |= {run[k:k + n] for n in GRAMS for k in range(len(run) - n + 1)}
    return found


def _dictionaries(common: list[str], toxic: list[str]) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary. What they share ends both, at equal distances, and
    digits, which plain text has none of, stand in for the toxic words in the ordinary one: a
    window without any of these words compresses alike with either."""
    shared, own = f" {' '.join(reversed(common))} ".encode(), "".join(f"{u:<9}" for u in reversed(toxic)).encode()
    filler = b"0" * FILLER
    return filler + b"0" * len(own) + shared, filler + own + shared


def _weighing(texts: list[str], labels: np.ndarray) -> tuple[list[str], list[str]]:
    """The commonest words of ordinary text, and what weighs for toxic text, weightiest first.

    The weight is the G statistic of document counts, so a unit must be both frequent and
    one-sided to lead. A unit that has or is the beginning of a weightier one adds nothing.
    """
    words, counts = Counter(), [Counter(), Counter()]
    for text, label in zip(texts, labels):
        units = _units(text)
        counts[label].update(units)
        if not label:
            words.update(_words(text))
    sizes = np.array([max(1, int((labels == k).sum())) for k in (0, 1)], float)
    common = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:COMMON_WORDS]]
    found = list(counts[1])
    seen = np.array([[counts[0][u] for u in found], [counts[1][u] for u in found]], float).reshape(2, -1).T
    meant = seen.sum(axis=1, keepdims=True) * sizes / sizes.sum()
    cells = [(seen, meant), (sizes - seen, sizes - meant)]
    with np.errstate(divide="ignore", invalid="ignore"):
        g = sum(np.where(x > 0, x * np.log(x / m), 0.0).sum(axis=1) for x, m in cells)
    g = np.where(seen[:, 1] / sizes[1] > seen[:, 0] / sizes[0], g, 0.0)
    toxic: list[str] = []
    for k in sorted(np.flatnonzero(g > 0), key=lambda k: (-round(g[k], 6), -len(found[k]), found[k])):
        unit = found[k].rstrip()
        if not any(unit.startswith(t.rstrip()) or t.startswith(unit) or unit[0] != " " and (unit in t or t in unit) for t in toxic):
            toxic.append(found[k])
            if len(toxic) == max(SIZES):
                break
    return common, toxic


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton steps of a ridged logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def _apart(texts: list[str]) -> list[int]:
    """The places of texts that are no copies, also near ones, of earlier texts: at most a
    quarter of the smallest hashes of their five-word runs were seen before. Copies of one text
    would else pass its words off as typical of its label."""
    seen: set[int] = set()
    kept = []
    for k, text in enumerate(texts):
        words = plain(text).split()
        runs = {zlib.crc32(" ".join(words[i:i + 5]).encode()) for i in range(max(1, len(words) - 4))}
        least = sorted(runs)[:16]
        if 4 * sum(h in seen for h in least) <= len(least):
            kept.append(k)
        seen.update(least)
    return kept


def fit(texts: list[str], labels: list[int]) -> Model:
    """A model from labelled texts. Copies and near copies count once. The number of weighing words is
    the one with the smallest loss on the half that chose no words; with fewer than two
    texts of a class the score is the same for all documents."""
    first = {t: int(y) for t, y in zip(texts, labels)}
    texts = [list(first)[k] for k in _apart(list(first))]
    y = np.array([first[t] for t in texts], int)
    half = np.array([zlib.crc32(t.encode()) % 2 for t in texts], int)
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        p = np.clip((y.sum() + 1) / (len(y) + 2), 0.01, 0.99)
        return Model(b" ", b" ", (float(np.log(p / (1 - p))), 0.0, 0.0, 0.0, 0.0))
    losses, held = dict.fromkeys(SIZES, 0.0), {}
    for side in (0, 1):
        own, other = half == side, half != side
        common, toxic = _weighing([t for t, o in zip(texts, own) if o], y[own])
        rest = [t for t, o in zip(texts, other) if o]
        for size in SIZES:
            x, truth = _features(Gains(*_dictionaries(common, toxic[:size]))(rest)) if rest else np.zeros((0, 5)), y[other]
            w = _logistic(x, truth)
            losses[size] += _loss(1 / (1 + np.exp(-np.clip(x @ w, -30, 30))), truth) if len(truth) else 0.0
            held.setdefault(size, []).append((x, truth))
    size = min(SIZES, key=lambda s: (round(losses[s], 6), s))
    x, truth = (np.concatenate(parts) for parts in zip(*held[size]))
    common, toxic = _weighing(texts, y)
    return Model(*_dictionaries(common, toxic[:size]), tuple(_logistic(x, truth).tolist()))


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """A model from the labelled rows that aren't held out, at most `most_rows` of each class:
    those with the smallest hashes of their ids. Labels that are null or other than 0 and 1,
    and ids with both labels, are left out."""
    known = chosen(labels, doc_id="long", toxic="int").where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out_column(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    known = known.where("toxic = other").drop("other")
    by_hash = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = [known.where(F.col("toxic") == k).orderBy(*by_hash).limit(most_rows) for k in (0, 1)]
    rows = documents(docs).join(F.broadcast(sample[0].unionByName(sample[1])), "doc_id").select(
        "text", "toxic").dropDuplicates().orderBy("text", "toxic").collect()
    return fit([r.text for r in rows], [r.toxic for r in rows])


def score_texts(frame: DataFrame, model: Model) -> DataFrame:
    """Per row of documents (doc_id, text): doc_id, held_out, score (0 to 1), predicted.

    A null or empty text scores as a text without any gain; repeated rows give a row each; a
    null doc_id is not held out; other columns are ignored.
    """

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("doc_id")
        score = model.score(Gains(model.ordinary, model.toxic)(batch.column("text").to_pylist()))
        return arrow(doc_id=ids, held_out=[held_out(i) for i in ids.to_pylist()], score=score,
                     predicted=(score >= 0.5).astype(np.int32))

    return documents(frame).mapInArrow(per_batch(scored), "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(frame: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with all their columns.

    A null text scores as an empty one; repeated rows stay or go alike; ids, and whether they are
    null, play no part. An empty table stays empty.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(Gains(model.ordinary, model.toxic)(texts.fillna("").tolist())))

    made = spare_name(frame, "toxic")
    return frame.withColumn(made, score(F.col("text"))).where(F.col(made) < threshold).drop(made)
