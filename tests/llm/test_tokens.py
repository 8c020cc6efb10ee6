"""Packing and token codes against the tokenizers library, text by text."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimtide.llm import packing, queries, token_codes
from claimtide.llm.tokens import Encoder

from .frames import docs, edge_rows

SMALL = "/root/testdata/sf0.001"
WORDS, BYTES = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TRICKY = ["", " ", "  two  spaces \n\n\tand\ttabs ", "it's we'll THEY'VE 'sic 12345 3.14 ½²", "a<|endoftext|>b <|startoftext|>",
          "hello <|endoftext|> world", "<|ENDOFTEXT|> <|startoftext|><|endoftext|>", "<|endoftext", "日本<|endoftext|>語",
          "İstanbul ΣΊΣΥΦΟΣ ß ﬁ Å Å", "日本語 \U0001f600 emoji ‍ zwj", "\x00\x1c\x85   ", "x" * 5000, "é" * 300 + " naïve œuvre Œ",
          "don't can't I'M YOU'RE", "| || ||| \n|\n", "…—–‘q’ “w”", "a\r\nb\rc", "퟿￿", "ªº µ × ÷"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_encoder_equals_the_library(path):
    encode, coder = library(path), Encoder(path, most_pieces=20)
    for texts in (TRICKY, TRICKY[::-1] + TRICKY, [], ["one"]):
        flat, sizes = coder.encode_ended(texts)
        assert flat.tolist() == [i for t in texts for i in [*encode(t), 2]]
        assert sizes.tolist() == [len(encode(t)) + 1 for t in texts]


def check_pieces(pieces, texts, length):
    """Every id in exactly one piece, sequences gapless, all but the last full."""
    encode, by_doc, by_sequence = library(WORDS), defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    want = sorted((str(i), crc([*encode(t or ""), 2])) for i, t in texts)
    got = []
    for doc, own in by_doc.items():
        own.sort(key=lambda p: (p.sequence_id, p.offset))
        at, ids = 0, b""
        for p in own:
            assert p.start == at and p.length > 0
            at, ids = at + p.length, ids + bytes(p.ids)
            if at == p.doc_tokens:
                got.append((str(doc), zlib.crc32(ids)))
                at, ids = 0, b""
        assert at == 0
    assert sorted(got) == want
    sizes = []
    for _, own in sorted(by_sequence.items()):
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist()
        sizes.append(sum(p.length for p in own))
    assert sizes[:-1] == [length] * (len(sizes) - 1) and 0 < sizes[-1] <= length


def test_packing_whole_table(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    check_pieces(packing.pack(frame, WORDS).collect(), [(r.doc_id, r.text) for r in frame.collect()], 4096)
    rows = queries.queries()["op4_curve_packing"](spark, SMALL).collect()
    encode, texts = library(WORDS), {r.doc_id: r.text for r in frame.collect()}
    for row in rows:
        ids = [*encode(texts[row.doc_id]), 2]
        assert row.doc_tokens == len(ids) and row.ids_crc32 == crc(ids[row.start:row.start + row.length])


def test_packing_edges(spark):
    frame = docs(spark, edge_rows())
    pieces = packing.pack(frame.repartition(3), WORDS, length=64).collect()
    twice = [p for p in pieces if p.doc_id not in (7, None)]  # ids that several rows share can't be told apart
    assert {p.doc_id for p in twice} == {i for i, _ in edge_rows()} - {7, None}
    total = sum(len(library(WORDS)(t or "")) + 1 for _, t in edge_rows())
    assert sum(p.length for p in pieces) == total
    assert max(p.sequence_id for p in pieces) == (total - 1) // 64
    check_pieces(packing.pack(docs(spark, [r for r in edge_rows() if r[0] not in (7, None)]), WORDS, length=64).collect(),
                 [r for r in edge_rows() if r[0] not in (7, None)], 64)
    assert packing.pack(docs(spark, []), WORDS).collect() == []


def test_curve_is_a_walk_through_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = packing.hilbert_keys(grid, bits=3)
    assert sorted(keys.tolist()) == list(range(512))
    walk = grid[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_copies_lie_together(spark):
    rows = [(k, "alpha beta gamma " * 30 if k % 3 else f"text {k} " + "zzz qqq " * (k % 7 + 5)) for k in range(90)]
    pieces = packing.pack(docs(spark, rows), WORDS, length=1 << 30).collect()
    order = [p.doc_id for p in sorted(pieces, key=lambda p: p.offset)]
    places = [k for k, d in enumerate(order) if d % 3]
    assert places == list(range(places[0], places[0] + 60))


def test_codes_whole_table(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    encode, start = library(BYTES), 0
    rows = {r.doc_id: r for r in queries.queries()["op6_token_codes"](spark, SMALL).collect()}
    for doc in frame.orderBy("doc_id").collect():
        ids, row = [*encode(doc.text), 2], rows.pop(doc.doc_id)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    assert not rows


@pytest.mark.parametrize("bits", [3, 8, 11])
def test_random_access(bits):
    rng = np.random.default_rng(3)
    for ids in ([], [0], [2**31], rng.integers(0, 50_257, 3000), rng.integers(0, 2, 1500), np.full(600, 2**bits)):
        ids = np.array(ids, np.uint32)
        codes = token_codes.Codes(token_codes.encode_ids(ids, bits))
        assert codes.all().tolist() == ids.tolist() == [codes[k] for k in range(len(codes))]
    with pytest.raises(IndexError):
        codes[600]


def test_codes_edges(spark, tmp_path):
    encode, path = library(BYTES), str(tmp_path / "codes")
    token_codes.write_codes(docs(spark, edge_rows()).repartition(5), path, BYTES)
    rows = token_codes.read_codes(spark, path).collect()
    assert sorted((str(r.doc_id), r.ids_crc32) for r in rows) == sorted((str(i), crc([*encode(t or ""), 2])) for i, t in edge_rows())
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    token_codes.write_codes(docs(spark, []), path + "2", BYTES)
    assert token_codes.read_codes(spark, path + "2").collect() == []
