"""Secret scan and personal data against plain regular expressions, and their own methods."""

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import re
import time
import tracemalloc
import urllib.parse
import zlib

import pytest
import zstandard

from claimtide.llm import personal_data, queries, secret_scan

from .frames import docs, edge_rows

SMALL = "/root/testdata/sf0.001"


def base_secrets(text):
    found = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def base_personal(text):
    found = [(m.start(), 0, m.end(), "email")
             for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return sorted(found)


def joined(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in spans)


@pytest.mark.parametrize("query, brute", [("op2_secret_scan", base_secrets), ("op3_personal_data", base_personal)])
def test_base_spans_equal_plain_expressions(spark, query, brute):
    rows = queries.queries()[query](spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for row in rows:
        spans = brute(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(joined(spans).encode()).hexdigest()
        assert set(filter(None, joined(spans).split(","))) <= set(row.spans.split(","))
        if query == "op3_personal_data":  # the score of each span, in their order
            assert [float(v) for v in filter(None, row.scores.split(","))] == [f[4] for f in personal_data.scan(texts[row.doc_id])]
        for kind in {s[3] for s in spans}:
            assert row[f"n_{kind}"] == sum(s[3] == kind for s in spans)


HARD = ["a@b.c@d.e@f", "x@@y.z", "a@b", ".@a.b", "a@b.c.", "me@x.y me@x.y.", "1.2.3.4.5.6.7.8", "256.1.1.1", "1.2.3",
        "01.002.0003.4", "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111111111111111 4111111111111111", "+1 (234) 567-8901",
        "+1+2 345 678 9012", "+12", "5", "password: \"abcdefgh\"", "PassWord==abcdefgh", "token = x token = abcdefghi", "api_key:abcdefgh-",
        "apikey='A'", "secretsecret: tokentoken", "AKIA" + "A" * 12, "AKIAKIAKIAKIAKIAKIA", "0" * 31, "f" * 32 + "g" + "0" * 40,
        "paſſword: abcdefgh", "toKen: abcdefgh"]


@pytest.mark.parametrize("text", HARD)
def test_hard_cases(text):
    assert [f[:4] for f in secret_scan.scan(text) if not f[4]] == base_secrets(text)
    assert [f[:4] for f in personal_data.scan(text) if f[3] != "iban"] == base_personal(text)


SECRET = 'password = "hunter2hunter2"'


def in_context(encoded):
    return f"äöü before {encoded} after"


@pytest.mark.parametrize("layers, encoded", [
    ("url", urllib.parse.quote(SECRET, safe="")),
    ("unicode", "".join(f"\\u{ord(c):04x}" for c in SECRET)),
    ("base64", base64.b64encode(SECRET.encode()).decode()),
    ("base64.compressed", base64.b64encode(gzip.compress(SECRET.encode())).decode()),
    ("base64.compressed", base64.urlsafe_b64encode(zlib.compress(SECRET.encode())).decode()),
    ("base64.base64", base64.b64encode(base64.b64encode(SECRET.encode())).decode()),
    ("base64.compressed.base64", base64.b64encode(gzip.compress(base64.b64encode(SECRET.encode()))).decode()),
])
def test_layers_are_unwrapped_and_mapped(layers, encoded):
    text = in_context(encoded)
    found = [f for f in secret_scan.scan(text) if f[4] == layers]
    assert len(found) == 1, secret_scan.scan(text)
    start, _, end, kind, _ = found[0]
    assert kind == "assign" and text.index(encoded) <= start < end <= text.index(encoded) + len(encoded)
    if layers in ("url", "unicode"):  # escapes are mapped character by character
        assert start == text.index(encoded)


def wrapped(raw, width=76, end="\n"):
    encoded = base64.b64encode(raw).decode()
    return end.join(encoded[k:k + width] for k in range(0, len(encoded), width))


LONG = b"x " * 24 + SECRET.encode() + b" y" * 90  # the secret lies over the end of the first line


@pytest.mark.parametrize("end", ["\n", "\r\n", "\\n", "\\r\\n", "\n  ", "\n> "])
@pytest.mark.parametrize("width", [60, 64, 76])
def test_base64_over_line_ends(end, width):
    for raw, layers in ((LONG, "base64"), (gzip.compress(bytes(range(32, 127)) * 3 + LONG), "base64.compressed")):
        encoded = wrapped(raw, width, end)
        for after in ("", "\nword", "\n\nMore words here.", " after"):
            text = f"before {encoded}{after}"
            spans = {(f[0], f[2]) for f in secret_scan.scan(text) if f[4] == layers and f[3] == "assign"}
            assert spans == {(7, 7 + len(encoded))}, (end, width, layers, after)


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress])
def test_all_members_of_compressed_payloads(pack):
    encoded = base64.b64encode(pack(b"nothing here\n") + pack(b"nor here ") + pack(SECRET.encode())).decode()
    assert [f[4] for f in secret_scan.scan(in_context(encoded))] == ["base64.compressed"]
    twice = base64.b64encode(gzip.compress(pack(b"a") + pack(SECRET.encode()))).decode()
    assert [f[4] for f in secret_scan.scan(in_context(twice))] == ["base64.compressed.compressed"]


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress])
def test_large_layers_are_scanned_in_parts(monkeypatch, pack):
    """Secrets before, at and after the borders of parts, in characters of one to three bytes."""
    monkeypatch.setattr(secret_scan, "PART", 5000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 500)
    inside = "".join(f'key{k} é€ token="value{k:08}" ' + "über " * (k % 17) for k in range(900))
    wanted = set(re.findall("value[0-9]{8}", inside))
    parts = list(secret_scan._texts(secret_scan._inflated(pack(inside.encode()))[1]))
    assert max(len(p.encode()) for p in parts) <= 5000 and len(parts) > 10
    assert {v for p in parts for v in re.findall("value[0-9]{8}", p)} == wanted
    found = secret_scan.scan(base64.b64encode(pack(inside.encode())).decode())
    assert [f[3:] for f in found] == [("assign", "base64.compressed")]


def test_a_bomb_is_scanned_in_bounded_memory():
    bomb = b" ".join([b"0 " * (100 << 20), SECRET.encode()])
    encoded = base64.b64encode(gzip.compress(bomb, 1)).decode()
    del bomb
    tracemalloc.start()
    found = secret_scan.scan(encoded)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[3:] for f in found] == [("assign", "base64.compressed")] and peak < 160 << 20


def test_equal_payloads_keep_a_span_each():
    encoded = base64.b64encode(SECRET.encode()).decode()
    found = [f for f in secret_scan.scan(f"{encoded} and {encoded}") if f[4]]
    assert len(found) == 2


def test_escapes_in_an_assignment():
    text = "password%3D%22abcdefghi%22 100% \\u"
    assert [(f[3], text[f[0]:f[2]]) for f in secret_scan.scan(text)] == [("assign", "password%3D%22abcdefghi")]


def test_checks_and_context():
    assert personal_data.luhn("4111111111111111") and not personal_data.luhn("4111111111111112")
    text = "bank account GB82 WEST 1234 5698 7654 32 now"
    found = [f for f in personal_data.scan(text) if f[3] == "iban"]
    assert [text[f[0]:f[2]] for f in found] == ["GB82 WEST 1234 5698 7654 32"]
    assert not [f for f in personal_data.scan(text.replace("82 W", "83 W")) if f[3] == "iban"]
    assert personal_data.scan("release version 1.2.3.4")[0][4] < personal_data.scan("x 1.2.3.4")[0][4] \
        < personal_data.scan("server address 1.2.3.4")[0][4]


def test_masking_keeps_rows_and_columns(spark):
    rows = [(1, "mail me@x.org or +1 (234) 567-8901"), (2, None), (3, ""), (None, "none")]
    before = docs(spark, rows)
    after = personal_data.mask_personal_data(before)
    assert after.columns == before.columns
    out = {r.doc_id: r for r in after.collect()}
    assert out[1].text == "mail [EMAIL] or [PHONE]" and out[1].n_chars == len(out[1].text)
    assert out[2].text is None and out[3].text == "" and out[None].text == "none"


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 100_000, "+1" + " (" * 200_000, "%41" * 100_000, "1-" * 200_000):
        secret_scan.scan(text)
        personal_data.scan(text)
    assert time.perf_counter() - start < 60


def test_edges(spark):
    for find in (secret_scan.find_secrets, personal_data.find_personal_data):
        rows = find(docs(spark, edge_rows())).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in edge_rows())
        assert find(docs(spark, [])).collect() == []
        assert all(r.spans == [] for r in rows if r.doc_id in (1, 2, 3, 4))
    json.dumps([list(r.spans) for r in rows])


@pytest.mark.parametrize("text, account", [
    ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89 3704 0044 0532 0130 00"),
    ("DE89370400440532013000 EUR 250", "DE89370400440532013000"),
    ("pay GB82 WEST 1234 5698 7654 32 2024 10 REF 7", "GB82 WEST 1234 5698 7654 32"),
    ("ORDER NR12 34 5678 9012 DE89 3704 0044 0532 0130 00 BIC", "DE89 3704 0044 0532 0130 00"),
    ("NO93 8601 1117 947 OSLO", "NO93 8601 1117 947"),
])
def test_accounts_before_words_and_numbers(text, account):
    at = text.index(account)
    assert [s for s in personal_data.confirmed(text) if s[0] == "iban"] == [("iban", at, at + len(account))]
    assert account not in personal_data.masked_text(text, 0.5)


def test_account_starts_take_linear_time():
    began = time.perf_counter()
    list(personal_data.confirmed("AA11 " * 100_000))
    assert time.perf_counter() - began < 30
