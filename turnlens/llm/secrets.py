"""Secret scan that unwraps encoded layers until nothing is left to decode.

A worklist starts with the text itself. Every layer is scanned, and everything in it that can be
decoded becomes a new layer: percent escapes, character escapes, base64 runs, and compressed
bytes inside those. A layer remembers for each of its characters from which place of the text it
comes, so what is found in it is reported there. A layer seen before at the same place is not
taken again; that ends cycles, such as an archive that holds itself.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty

#: The kinds and their patterns, in the order of the contract. Fixed values.
KINDS = ("assign", "access", "hex")
KEYWORDS = r"password|passwd|secret|token|api_?key"
ASSIGN = re.compile(r"(?:" + KEYWORDS + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
#: A run of the class is found whole, so the shortest length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
SHORTEST_VALUE = 6

URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
BASE64_PART = re.compile(r"[A-Za-z0-9]{16,}={0,2}")
#: Control characters that no text layer holds.
UNPRINTABLE = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")


@dataclass(frozen=True)
class Unwrapping:
    """``most_bytes`` bounds one decompressed layer; a larger one is reported as kind ``oversized``."""

    most_bytes: int = 1 << 26


class Layer:
    """Text with the places it comes from; ``starts`` is None for the text itself.

    ``opaque`` layers show nothing of what they come from; in others most characters are
    the text's own.
    """

    __slots__ = ("text", "starts", "ends", "path", "opaque")

    def __init__(self, text: str, starts=None, ends=None, path: tuple[str, ...] = (), opaque: bool = False):
        self.text, self.starts, self.ends, self.path, self.opaque = text, starts, ends, path, opaque

    def place(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start]), int(self.ends[end - 1])

    def key(self) -> tuple:
        """Text and place; the way it was decoded does not matter."""
        where = xxhash.xxh3_128_digest(self.starts.tobytes() + self.ends.tobytes()) if self.starts is not None else b""
        return xxhash.xxh3_128_digest(self.text.encode("utf-8", "surrogatepass")), where


def matches(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of everything in one layer."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= SHORTEST_VALUE:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield 1, m.start(), m.end()
    for m in HEX.finditer(text):
        yield 2, m.start(), m.end()


def substituted(layer: Layer, parts: list[tuple[int, int, str, list[tuple[int, int]]]], name: str) -> Layer:
    """The layer with parts (start, end, text, place of each character in the layer) put in."""
    n = len(layer.text)
    own_starts = layer.starts if layer.starts is not None else np.arange(n)
    own_ends = layer.ends if layer.ends is not None else np.arange(1, n + 1)
    texts, starts, ends, at = [], [], [], 0
    for start, end, text, places in parts:
        texts += [layer.text[at:start], text]
        starts += [own_starts[at:start], np.array([own_starts[a] for a, _ in places], np.int64)]
        ends += [own_ends[at:start], np.array([own_ends[b - 1] for _, b in places], np.int64)]
        at = end
    texts.append(layer.text[at:])
    starts.append(own_starts[at:])
    ends.append(own_ends[at:])
    return Layer("".join(texts), np.concatenate(starts), np.concatenate(ends), (*layer.path, name), layer.opaque)


def utf8_places(raw: bytes, width: int, start: int) -> tuple[str, list[tuple[int, int]]]:
    """Characters of bytes that take ``width`` places each; what is no UTF-8 is read byte by byte."""
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        text = raw.decode("latin-1")
        return text, [(start + i * width, start + (i + 1) * width) for i in range(len(raw))]
    places, at = [], start
    for char in text:
        size = width * len(char.encode("utf-8"))
        places.append((at, at + size))
        at += size
    return text, places


def from_url(layer: Layer, most: int) -> Iterator[Layer]:
    parts = []
    for m in URL_RUN.finditer(layer.text):
        raw = bytes.fromhex(m.group().replace("%", ""))
        yield from from_bytes(layer, raw, m.start(), m.end(), ("url",), most)
        parts.append((m.start(), m.end(), *utf8_places(raw, 3, m.start())))
    if parts:
        yield substituted(layer, parts, "url")


def from_escapes(layer: Layer) -> Iterator[Layer]:
    parts = []
    for m in ESCAPE.finditer(layer.text):
        code = int(m.group(m.lastindex), 10 if m.lastindex == 6 else 16)
        char = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd"
        parts.append((m.start(), m.end(), char, [(m.start(), m.end())]))
    if parts:
        yield substituted(layer, parts, "unicode")


def inflated(raw: bytes) -> tuple[str, object] | None:
    """Name and decompressor of bytes that start like a compressed stream."""
    if raw[:2] == b"\x1f\x8b":
        return "gzip", zlib.decompressobj(31)
    if len(raw) > 2 and raw[0] == 0x78 and (raw[0] * 256 + raw[1]) % 31 == 0:
        return "zlib", zlib.decompressobj()
    if raw[:3] == b"BZh":
        return "bzip2", bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return "xz", lzma.LZMADecompressor()
    return None


class Oversized(Exception):
    """A decompressed layer is larger than allowed; the argument is the way to it."""


def unpacked(raw: bytes, path: tuple[str, ...], most: int, seen: set) -> tuple[bytes, tuple[str, ...]]:
    """Bytes out of all their compressed layers; an archive that is met again ends it."""
    while (found := inflated(raw)) is not None:
        digest = xxhash.xxh3_128_digest(raw)
        if digest in seen:
            return b"", path
        seen.add(digest)
        name, stream = found
        try:
            out = stream.decompress(raw, most + 1)
        except (zlib.error, OSError, lzma.LZMAError, EOFError):
            return raw, path
        path = (*path, name)
        if len(out) > most:
            raise Oversized(path)
        raw = out
    return raw, path


def printable(raw: bytes) -> str | None:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if not text or UNPRINTABLE.search(text) else text


def from_bytes(layer: Layer, raw: bytes, start: int, end: int, path: tuple[str, ...], most: int) -> Iterator[Layer]:
    """The text inside compressed bytes; all of it comes from the whole run."""
    out, full = unpacked(raw, (*layer.path, *path), most, set())
    if len(full) == len(layer.path) + len(path):
        return
    if text := printable(out):
        a, b = layer.place(start, end)
        yield Layer(text, np.full(len(text), a), np.full(len(text), b), full, True)


def decoded(run: str) -> bytes | None:
    digits = run.rstrip("=").translate({45: 43, 95: 47})
    if len(digits) % 4 == 1:
        return None
    try:
        return base64.b64decode(digits + "=" * (-len(digits) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def from_base64(layer: Layer, most: int) -> Iterator[Layer]:
    for m in BASE64_RUN.finditer(layer.text):
        runs = [(m.start(), m.end())]
        made = list(_base64_layers(layer, *runs[0], most))
        if not made:  # a path or a name before it: its parts
            runs = [(m.start() + p.start(), m.start() + p.end()) for p in BASE64_PART.finditer(m.group())]
            made = [x for a, b in runs if (a, b) != (m.start(), m.end()) for x in _base64_layers(layer, a, b, most)]
        yield from made


def _base64_layers(layer: Layer, start: int, end: int, most: int) -> Iterator[Layer]:
    raw = decoded(layer.text[start:end])
    if raw is None:
        return
    if inflated(raw) is not None:
        yield from from_bytes(layer, raw, start, end, ("base64",), most)
        return
    if (text := printable(raw)) is None:
        return
    ends = np.cumsum(np.fromiter((len(c.encode("utf-8")) for c in text), np.int64, len(text)))
    begins = np.append(0, ends[:-1])
    first, last = start + begins * 4 // 3, np.minimum(start + -(-ends * 4 // 3), end)
    if layer.starts is not None:
        first, last = layer.starts[first], layer.ends[last - 1]
    yield Layer(text, first, last, (*layer.path, "base64"), True)


def secrets_in(text: str, how: Unwrapping = Unwrapping()) -> list[tuple[str, str, int, int]]:
    """(kind, layers, start, end) of a text's secrets; ``layers`` is empty for what stands there openly."""
    found: dict[tuple[int, str, int, int], None] = {}
    work, seen = deque([Layer(text)]), set()
    while work:
        layer = work.popleft()
        path = "+".join(layer.path)
        for kind, start, end in matches(layer.text):
            a, b = layer.place(start, end)
            # What no escape stands in was found in the layer before.
            if not path or layer.opaque or b - a != end - start:
                found[kind, path, a, b] = None
        try:
            children = list(_children(layer, how))
        except Oversized as too_large:
            a, b = layer.place(0, len(layer.text))
            found[len(KINDS), "+".join(too_large.args[0]), a, b] = None
            children = []
        for child in children:
            key = child.key()
            if key not in seen:
                seen.add(key)
                work.append(child)
    names = (*KINDS, "oversized")
    ordered = sorted(found, key=lambda x: (x[2], x[0], x[1], x[3]))
    return [(names[kind], path, a, b) for kind, path, a, b in ordered]


def _children(layer: Layer, how: Unwrapping) -> Iterator[Layer]:
    if "%" in layer.text:
        yield from from_url(layer, how.most_bytes)
    if "\\" in layer.text or "&#" in layer.text:
        yield from from_escapes(layer)
    yield from from_base64(layer, how.most_bytes)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("layers", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPANS_SQL = "array<struct<kind:string,layers:string,start:bigint,end:bigint>>"


def scan_secrets(docs: DataFrame, text_col: str = "text", how: Unwrapping = Unwrapping()) -> DataFrame:
    """``docs`` with ``secrets``: kind, layers, start and end (code points, end exclusive) of each secret.

    ``layers`` names the decoding steps, joined by +, and is empty for what stands openly in the
    text; places are always those of the whole text. Null and empty texts have no secrets. Very
    long texts are read whole. Repeated rows have the same secrets each, and equal spans of
    different kinds or layers are listed each. An empty table gives an empty result. A column of
    ``docs`` named secrets is replaced, all others are returned.
    """

    @F.arrow_udf(SPANS_SQL)
    def scan(texts: pa.Array) -> pa.Array:
        rows = [
            [dict(zip(("kind", "layers", "start", "end"), x)) for x in secrets_in(text.as_py(), how)] for text in texts
        ]
        return pa.array(rows, SPANS)

    others = [F.col(f"`{c}`") for c in docs.columns if c != "secrets"]
    return docs.select(*others, scan(text_or_empty(text_col)).alias("secrets"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas; decoded ones name their layers after the kind."""

    def one(x: Column) -> Column:
        kind = F.when(x["layers"] == "", x["kind"]).otherwise(F.concat(x["kind"], F.lit("@"), x["layers"]))
        return F.concat_ws(":", kind, x["start"].cast("string"), x["end"].cast("string"))

    return F.array_join(F.transform(spans, one), ",")
