"""Secrets in texts, also under layers of encoding.

Each text starts a worklist. A layer is scanned, then unwrapped: URL and Unicode escapes are
undone over the whole layer, runs of base64 (also those that are wrapped over lines) become layers
of their own, and compressed bytes are inflated, all members and frames of them. New layers join
the list until nothing unwraps any more. A layer that equals one of those it lies in is left
out, so a payload that inflates to itself ends there. Every find is mapped back to the code
points of the original text that it came from.

Compressed bytes are inflated as a stream. A layer beyond PART bytes is scanned in parts that
overlap by OVERLAP, so that memory stays bounded whatever a payload inflates to; only a find or a
payload in it that is longer than the overlap can be cut at a part's border.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import io
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimtide.llm.common import documents, per_batch

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # a greedy run that is shorter has no other start inside
_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(
    r"\\u[dD][89abAB][0-9a-fA-F]{2}\\u[dD][c-fC-F][0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U00[01][0-9a-fA-F]{5}"
    r"|\\u\{[0-9a-fA-F]{1,5}\}|\\x[0-9a-fA-F]{2}"
)
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# What a wrapped run goes on after: a line's end, as it is or escaped, and an indent or quote mark.
_WRAP = re.compile(r"(?:\r\n|\n|\r|\\r\\n|\\n)[\x20\t>]*([A-Za-z0-9+/_-]+={0,2})")
_UNPRINTED = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f�]")
PART, OVERLAP, HEAD = 16 << 20, 1 << 20, 1 << 16  # bytes

Spans = Callable[[int, int], tuple[int, int]]
Find = tuple[int, int, int, str, str]  # start, order of the kind, end, kind, layers


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """The base kinds in one text, leftmost and non-overlapping for each kind."""
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 8:
            yield "assign", m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _rewritten(text: str, escapes: re.Pattern, undo: Callable[[str], list[tuple[str, int]]],
               outer: Spans) -> tuple[str, Spans] | None:
    """The text without its escapes, and where its parts come from.

    `undo` gives an escape's characters, each with the length of its source.
    """
    parts: list[str] = []
    begins: list[int] = []  # of a part in the new text
    sources: list[tuple[int, int, bool]] = []  # start, end, verbatim

    def put(part: str, start: int, end: int, verbatim: bool) -> None:
        nonlocal size
        if part:
            begins.append(size)
            sources.append((start, end, verbatim))
            parts.append(part)
            size += len(part)

    size = last = 0
    for m in escapes.finditer(text):
        put(text[last:m.start()], last, m.start(), True)
        at = m.start()
        for char, length in undo(m[0]):
            put(char, at, at + length, False)
            at += length
        last = m.end()
    if not last:
        return None
    put(text[last:], last, len(text), True)

    def spans(start: int, end: int) -> tuple[int, int]:
        k, j = bisect_right(begins, start) - 1, bisect_right(begins, end - 1) - 1
        first = sources[k][0] + (start - begins[k]) * sources[k][2]
        upto = sources[j][0] + end - begins[j] if sources[j][2] else sources[j][1]
        return outer(first, upto)

    return "".join(parts), spans


def _url(escape: str) -> list[tuple[str, int]]:
    raw = bytes.fromhex(escape.replace("%", ""))
    try:
        return [(c, 3 * len(c.encode())) for c in raw.decode()]
    except UnicodeDecodeError:
        return [(chr(b), 3) for b in raw]


def _unicode(escape: str) -> list[tuple[str, int]]:
    if len(escape) == 12 and escape[6] == "\\":
        raw = bytes.fromhex(escape[2:6] + escape[8:12])
        return [(raw.decode("utf-16-be"), 12)]
    return [(chr(int(escape.strip("\\uUx{}"), 16)), len(escape))]


def _readable(raw: bytes) -> str | None:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return None if not text or _UNPRINTED.search(text) else text


_BROKEN = (zlib.error, zstandard.ZstdError, OSError, EOFError, lzma.LZMAError, ValueError)


def _members(make: Callable, magic: bytes, chunks: Iterator[bytes]) -> Iterator[bytes]:
    """What all members of a compressed stream hold, in parts of bounded size; up to where it breaks."""
    member, data = make(), b""
    while True:
        data = data or next(chunks, b"")
        try:
            out = member.decompress(data, PART)
        except _BROKEN:
            return
        if out:
            yield out
        if member.eof:
            data = member.unused_data
            while len(data) < len(magic) and (more := next(chunks, b"")):
                data += more
            if not data or not data.startswith(magic):
                return
            member = make()
            continue
        left = getattr(member, "unconsumed_tail", b"")
        if not (out or left or data):
            return
        data = left


class _Stream(io.RawIOBase):
    """Chunks as a file."""

    def __init__(self, chunks: Iterator[bytes]) -> None:
        self.chunks, self.held = chunks, b""

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        self.held = self.held or next(self.chunks, b"")
        size = min(len(into), len(self.held))
        into[:size], self.held = self.held[:size], self.held[size:]
        return size


def _frames(chunks: Iterator[bytes]) -> Iterator[bytes]:
    reader = zstandard.ZstdDecompressor().stream_reader(_Stream(chunks), read_across_frames=True)
    while True:
        try:
            out = reader.read(PART)
        except _BROKEN:
            return
        if not out:
            return
        yield out


def _inflater(head: bytes) -> Callable[[Iterator[bytes]], Iterator[bytes]] | None:
    """What inflates bytes that begin so, or None if nothing does."""
    made = None
    if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and len(head) > 2 and (head[0] << 8 | head[1]) % 31 == 0:
        made = lambda chunks: _members(lambda: zlib.decompressobj(47), b"\x1f\x8b", chunks)
    elif head[:4] == b"\x28\xb5\x2f\xfd":
        made = _frames
    elif head[:3] == b"BZh":
        made = lambda chunks: _members(bz2.BZ2Decompressor, b"BZh", chunks)
    elif head[:6] == b"\xfd7zXZ\x00":
        made = lambda chunks: _members(lzma.LZMADecompressor, b"\xfd7zXZ\x00", chunks)
    return made


def _inflated(raw: bytes) -> tuple[int, Iterator[bytes]]:
    """How often bytes were compressed, and what they hold in the end."""
    times, chunks, first, heads = 0, iter(()), raw, set()
    while first[:HEAD] not in heads and (inflate := _inflater(first[:HEAD])) is not None:
        heads.add(first[:HEAD])
        inner = inflate(chain([first], chunks))
        if (begin := next(inner, None)) is None:
            break  # a mere likeness, or empty
        times, chunks, first = times + 1, inner, begin
    return times, chain([first], chunks)


def _is_compressed(raw: bytes) -> bool:
    inflate = _inflater(raw[:HEAD])
    return inflate is not None and next(inflate(iter([raw])), None) is not None


def _texts(chunks: Iterator[bytes]) -> Iterator[str]:
    """The readable parts of a layer: one, unless it is beyond PART bytes."""
    held, ended, final = b"", False, False
    while not final:
        while len(held) <= PART and not ended:
            more = next(chunks, None)
            ended = more is None
            held += more or b""
        final = len(held) <= PART
        upto = len(held) if final else PART
        # A part ends before a character's first byte; that character is in the next part.
        while not final and held[upto] & 0xC0 == 0x80 and upto > PART - 4:
            upto -= 1
        if (text := _readable(held[:upto])) is not None:
            yield text
        begin = max(0, upto - OVERLAP)
        while begin < upto and held[begin] & 0xC0 == 0x80:
            begin += 1
        held = held[begin:]


def _unbased(run: str) -> list[tuple[bytes, int, int]]:
    """The bytes of a base64 run; if they mean nothing, those of its parts between / - _."""

    def plain(part: str) -> bytes | None:
        body = part.rstrip("=").replace("-", "+").replace("_", "/")
        try:
            return base64.b64decode(body + "=" * (-len(body) % 4))
        except (binascii.Error, ValueError):
            return None

    def means(raw: bytes | None) -> bool:
        return raw is not None and (_readable(raw) is not None or _is_compressed(raw))

    if means(raw := plain(run)):
        return [(raw, 0, len(run))]
    return [(raw, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+]{16,}={0,2}", run)
            if m[0] != run and means(raw := plain(m[0]))]


def _payloads(text: str) -> Iterator[tuple[bytes, int, int]]:
    """The bytes of the base64 runs of a text and where they stand: lines of one length and a last
    one that is no longer belong together, if they mean something together."""
    at = 0
    while m := _BASE64.search(text, at):
        lines, upto, size = [m[0]], [m.end()], m.end() - m.start()
        # A run is wrapped where each of its lines is full: a shorter one is the last.
        while len(lines[-1]) == size and not lines[-1].endswith("=") and (more := _WRAP.match(text, upto[-1])):
            if len(more[1]) > size:
                break
            lines.append(more[1])
            upto.append(more.end())
        at = m.end()
        for count in (len(lines), len(lines) - 1):  # what follows a full last line may be a word
            if count > 1 and (made := _unbased("".join(lines[:count]))) and made[0][1:] == (0, sum(map(len, lines[:count]))):
                yield made[0][0], m.start(), upto[count - 1]
                at = upto[count - 1]
                break
        else:
            for raw, start, end in _unbased(m[0]):
                yield raw, m.start() + start, m.start() + end


def unwrapped(text: str, outer: Spans) -> Iterator[tuple[str, str, Spans]]:
    """The layers right under a text: the encoding's name, the text, where it comes from."""
    for name, mark, escapes, undo in (("url", "%", _URL, _url), ("unicode", "\\", _UNICODE, _unicode)):
        if mark in text and (made := _rewritten(text, escapes, undo, outer)):
            yield name, *made
    for raw, start, end in _payloads(text):
        place = outer(start, end)
        times, chunks = _inflated(raw)
        for inside in _texts(chunks):
            yield "base64" + ".compressed" * times, inside, lambda start, end, place=place: place


def scan(text: str) -> list[Find]:
    """All finds of a text, in order; `layers` is empty for those in the text itself."""
    found: set[Find] = {(start, KINDS.index(kind), end, kind, "") for kind, start, end in matches(text)}
    plain = {(f[0], f[2], f[3]) for f in found}
    # Layers are unwrapped one at a time: of a large one only the part at hand is held.
    work = [(unwrapped(text, lambda a, b: (a, b)), "", frozenset([hash(text)]))]
    while work:
        inside, path, above = work[-1]
        made = next(inside, None)
        if made is None:
            work.pop()
            continue
        name, inner, spans = made
        if hash(inner) in above:
            continue
        layers = f"{path}.{name}" if path else name
        for kind, start, end in matches(inner):
            start, end = spans(start, end)
            if (start, end, kind) not in plain:
                found.add((start, KINDS.index(kind), end, kind, layers))
        work.append((unwrapped(inner, spans), layers, above | {hash(inner)}))
    return sorted(found)


SPAN = "array<struct<kind: string, start: long, end: long, layers: string>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("layers", pa.string())]))


def _scanned(batch: pa.RecordBatch) -> pa.RecordBatch:
    spans = [[{"kind": kind, "start": start, "end": end, "layers": layers} for start, _, end, kind, layers in scan(text)]
             for text in batch.column("text").to_pylist()]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, _SPAN)], ["doc_id", "spans"])


def find_secrets(frame: DataFrame) -> DataFrame:
    """Per row of documents (doc_id, text): doc_id and spans, an array of (kind, start, end,
    layers) ordered by start and kind, in code points of the text, ends exclusive.

    `layers` names what had to be undone, outermost first; it is empty for the base spans. A
    find under a layer has the span of its encoded form. A null or empty text has no spans;
    repeated rows give a row each; a null doc_id stays null; other columns are ignored.
    """
    return documents(frame).mapInArrow(per_batch(_scanned), f"doc_id long, spans {SPAN}")


def is_base(span: Column) -> Column:
    return span["layers"] == F.lit("")
