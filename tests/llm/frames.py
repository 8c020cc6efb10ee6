"""Rows that every operator on documents must take."""

from __future__ import annotations

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, uid long, grp string, n string, "
           "ids string, part string, h int, `odd name` string")


def docs(spark, rows):
    """Documents from (doc_id, text) with further columns whose names clash with inner ones."""
    full = [(i, t, "en", None, None if t is None else len(t), 7, "g", "n", "i", "p", 1, "o") for i, t in rows]
    return spark.createDataFrame(full, COLUMNS)


def edge_rows():
    long = " ".join(f"word{k % 977} of{k % 13}" for k in range(60_000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "two words"), (6, long), (7, "same text here, twice"),
            (7, "same text here, twice"), (8, "same text here, twice"), (None, "no id at all"),
            (None, None), (9, "naïve Ünïcödé — “quotes” \U0001f600 ​ ſ K"), (10, "\x00\x01 control \x85 chars\x1c here")]
