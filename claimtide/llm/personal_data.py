"""Personal data in texts: patterns propose, checksums confirm, nearby words adjust.

Email addresses, IP addresses, payment cards (Luhn), phone numbers and bank accounts (IBAN,
mod 97). All patterns run in time linear in the text, also on long runs of digits or letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import documents, per_batch, spare_name

KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ A-Z0-9])")
_IBAN_REST = re.compile(r"(?: ?[A-Z0-9]){11,30}")
#: Characters of an account by country, as registered.
IBAN_LENGTHS = {country: int(length) for length, countries in (line.split(":") for line in """15:NO
16:BE
18:DK FI FK FO GL NL SD
19:MK SI
20:AT BA EE KZ LT LU MN XK
21:CH HR LI LV
22:BG BH CR DE GB GE IE ME RS VA
23:AE GI IL IQ OM SO TL
24:AD CZ ES MD PK RO SA SE SK TN VG
25:LY PT ST
26:IS TR
27:BI DJ FR GR IT MC MR SM
28:AL AZ BY CY DO GT HU LB NI PL SV
29:BR EG PS QA UA
30:JO KW MU YE
31:MT SC
32:LC
33:RU""".splitlines()) for country in countries.split()}

#: How sure a confirmed span is by itself, and the words near it that make it surer or less.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
NEAR = 48  # code points on either side
STEP = 0.3
WORDS = {
    "email": ("mail contact kontakt correo courriel write", "example noreply"),
    "ip": ("ip address adresse host server login from", "version release section chapter"),
    "card": ("card credit visa payment karte carte tarjeta", "order tracking serial isbn"),
    "phone": ("phone call tel mobile fax telefon appel llama", "version score equation"),
    "iban": ("iban bank account konto compte cuenta", "serial product"),
}
_WORDS = {kind: tuple(re.compile(rf"(?i)\b(?:{'|'.join(words.split())})", re.ASCII) for words in pair)
          for kind, pair in WORDS.items()}


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @, back over the local part and on over the domain."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each start, the account of its country's length, or else the longest that ends with a
    group of characters and that mod 97 confirms. What follows an account may look like a part
    of it. The work for a start is bounded."""
    start = _IBAN_START.search(text)
    while start:
        at = start.end()
        rest = _IBAN_REST.match(text, at)
        found = []
        for end in range(at + 11, rest.end() + 1) if rest else ():
            after = text[end:end + 1]
            if text[end - 1] != " " and not (after.isascii() and after.isalnum()):
                account = text[start.start():end].replace(" ", "")
                if len(account) >= 15:
                    found.append((len(account) != IBAN_LENGTHS.get(start[0][:2]), -len(account), end, account))
        for _, _, end, account in sorted(found):
            if mod97(account):
                yield start.start(), end
                at = end
                break
        start = _IBAN_START.search(text, at)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def confirmed(text: str) -> Iterator[tuple[str, int, int]]:
    """The spans that their check confirms, leftmost and non-overlapping for each kind."""
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for start, end in _ibans(text):
        yield "iban", start, end


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's own score, a step up or down for the words near the span."""
    near = f"{text[max(0, start - NEAR):start]} {text[end:end + NEAR]}"
    better, worse = _WORDS[kind]
    value = SCORES[kind] + STEP * bool(better.search(near)) - STEP * bool(worse.search(near))
    return round(min(1.0, max(0.0, value)), 2)


def scan(text: str) -> list[tuple[int, int, int, str, float]]:
    """(start, order of the kind, end, kind, score), in order."""
    return sorted((start, KINDS.index(kind), end, kind, score(text, kind, start, end))
                  for kind, start, end in confirmed(text))


SPAN = "array<struct<kind: string, start: long, end: long, score: double>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _scanned(batch: pa.RecordBatch) -> pa.RecordBatch:
    spans = [[{"kind": kind, "start": start, "end": end, "score": value} for start, _, end, kind, value in scan(text)]
             for text in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPAN)], ["doc_id", "spans"])


def find_personal_data(frame: DataFrame) -> DataFrame:
    """Per row of documents (doc_id, text): doc_id and spans, an array of (kind, start, end,
    score) ordered by start and kind, in code points of the text, ends exclusive.

    A null or empty text has no spans; repeated rows give a row each; a null doc_id stays
    null; other columns are ignored.
    """
    return documents(frame).mapInArrow(per_batch(_scanned), f"doc_id long, spans {SPAN}")


def masked_text(text: str, least: float) -> str:
    """The text with [KIND] in place of what scores at least `least`; where spans overlap,
    they are one, named after the first."""
    parts, last = [], 0
    for start, _, end, kind, value in scan(text):
        if value < least:
            continue
        if start >= last:
            parts += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*parts, text[last:]]) if parts else text


def mask_personal_data(frame: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents, all columns and rows, with personal data masked in `text` and n_chars
    (if there is such a column) counted anew. A null text stays null."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None else masked_text(t, least))

    made = spare_name(frame, "masked")
    out = frame.withColumn(made, mask(F.col("text")))
    columns = []
    for name, kind in frame.dtypes:
        if name == "text":
            columns.append(F.col(made).alias(name))
        elif name == "n_chars":
            columns.append(F.length(made).cast(kind).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return out.select(*columns)
