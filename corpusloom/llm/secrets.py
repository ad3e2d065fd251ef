"""Secret scans: a worklist that unwraps nested encodings until nothing new appears."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_RUN = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#x[0-9A-Fa-f]{1,6};|&#[0-9]{1,7};)+")
UNICODE_ONE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
MOST_UNPACKED = 64 << 20


def matches(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of every secret written openly in one text.

    Leftmost, not overlapping within a kind; a match that is too short is passed over whole.
    """
    found = []
    low = text.lower() if text.isascii() else re.sub("[A-Z]+", lambda m: m.group().lower(), text)
    if any(h in low for h in ASSIGN_HINTS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return found


@dataclass
class Layer:
    """A decoded text and the span of the original text that each of its characters came from."""

    text: str
    start: list[int]
    end: list[int]


def _printable(raw: bytes) -> str | None:
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return None
    odd = sum(1 for ch in text if not (ch.isprintable() or ch in "\r\n\t"))
    return text if text and not odd else None


def _inflate(raw: bytes) -> bytes | None:
    """Contents of one gzip, zlib, bzip2 or xz stream, or None. Over ``MOST_UNPACKED`` bytes count as none."""
    try:
        if raw[:2] == b"\x1f\x8b":
            maker = zlib.decompressobj(31)
        elif len(raw) > 2 and raw[0] == 0x78 and (raw[0] << 8 | raw[1]) % 31 == 0:
            maker = zlib.decompressobj(15)
        elif raw[:3] == b"BZh":
            maker = bz2.BZ2Decompressor()
        elif raw[:6] == b"\xfd7zXZ\x00":
            maker = lzma.LZMADecompressor(memlimit=256 << 20)
        else:
            return None
        out = maker.decompress(raw, MOST_UNPACKED + 1)
        return out if maker.eof and len(out) <= MOST_UNPACKED else None
    except (zlib.error, OSError, lzma.LZMAError, ValueError, EOFError):
        return None


def _packed(raw: bytes) -> str | None:
    """Text in a chain of compressed streams, one within the other."""
    seen = set()
    while (inner := _inflate(raw)) is not None:
        if inner in seen:
            return None
        seen.add(inner)
        raw = inner
    return _printable(raw) if seen else None


def _utf8(raw: bytes) -> list[tuple[str, int, int]]:
    """Characters of raw bytes with the bytes they took; bytes that are not UTF-8 become one U+FFFD each."""
    out, at = [], 0
    while at < len(raw):
        first = raw[at]
        size = 1 if first < 0x80 else 2 if 0xC2 <= first < 0xE0 else 3 if 0xE0 <= first < 0xF0 else 4 if 0xF0 <= first < 0xF5 else 1
        try:
            out.append((raw[at : at + size].decode("utf-8"), at, at + size))
            at += size
        except UnicodeDecodeError:
            out.append(("�", at, at + 1))
            at += 1
    return out


def _replaced(layer: Layer, runs: list[tuple[int, int, list[tuple[str, int, int]]]]) -> Layer:
    """The layer with each run (start, end, decoded characters and where each stood) put in."""
    text, start, end, at = [], [], [], 0
    for low, high, inner in [*runs, (len(layer.text), len(layer.text), [])]:
        text.append(layer.text[at:low])
        start += layer.start[at:low]
        end += layer.end[at:low]
        for ch, a, b in inner:
            text.append(ch)
            start += [layer.start[a]] * len(ch)
            end += [layer.end[b - 1]] * len(ch)
        at = high
    return Layer("".join(text), start, end)


def _url(layer: Layer) -> Layer | None:
    runs = []
    for m in URL_RUN.finditer(layer.text):
        raw = bytes.fromhex(m.group().replace("%", ""))
        runs.append((m.start(), m.end(), [(c, m.start() + 3 * a, m.start() + 3 * b) for c, a, b in _utf8(raw)]))
    return _replaced(layer, runs) if runs else None


def _unicode(layer: Layer) -> Layer | None:
    runs = []
    for m in UNICODE_RUN.finditer(layer.text):
        inner: list[tuple[str, int, int]] = []
        for one in UNICODE_ONE.finditer(layer.text, m.start(), m.end()):
            digits = one.group(1) or one.group(2) or one.group(3)
            code = int(digits, 16) if digits else int(one.group(4))
            if inner and 0xDC00 <= code < 0xE000 and 0xD800 <= ord(inner[-1][0]) < 0xDC00:
                whole = 0x10000 + ((ord(inner[-1][0]) - 0xD800) << 10) + code - 0xDC00
                inner[-1] = (chr(whole), inner[-1][1], one.end())
            else:
                inner.append((chr(code) if code < 0x110000 else "�", one.start(), one.end()))
        runs.append((m.start(), m.end(), [("�" if 0xD800 <= ord(c) < 0xE000 else c, a, b) for c, a, b in inner]))
    return _replaced(layer, runs) if runs else None


def _base64(layer: Layer) -> list[Layer]:
    """A layer for each run that decodes to printable text or to compressed text."""
    found = []
    for m in BASE64_RUN.finditer(layer.text):
        run = m.group().rstrip("=").replace("-", "+").replace("_", "/")
        run = run[: len(run) - (len(run) % 4 == 1)]
        try:
            raw = base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        text = _packed(raw)
        if text is not None:  # a compressed character came from the whole run
            found.append(Layer(text, [layer.start[m.start()]] * len(text), [layer.end[m.end() - 1]] * len(text)))
            continue
        text = _printable(raw)
        if text is None:
            continue
        start, end, at = [], [], 0
        for ch in text:
            size = len(ch.encode("utf-8"))
            start.append(layer.start[m.start() + at * 4 // 3])
            end.append(layer.end[min(m.end(), m.start() + -(-(at + size) * 4 // 3)) - 1])
            at += size
        found.append(Layer(text, start, end))
    return found


def _could_hide(text: str) -> bool:
    return "%" in text or "\\" in text or "&#" in text or BASE64_RUN.search(text) is not None


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(open secrets, all secrets) of one text as sorted (start, end, kind) in code points of that text.

    Every layer is scanned, then unwrapped in all ways into new layers, until no layer is new. Layers are
    known by their text and place, so encodings that lead back to a seen layer end there. A secret in a layer is
    reported where its characters came from in the original text.
    """
    text = text or ""
    base = sorted(matches(text))
    if not _could_hide(text):
        return base, base
    found, seen = set(base), set()
    work = [Layer(text, list(range(len(text))), list(range(1, len(text) + 1)))]
    while work:
        layer = work.pop()
        place = (layer.start[0], layer.end[-1]) if layer.text else (0, 0)
        mark = (hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest(), place)
        if mark in seen:
            continue
        seen.add(mark)
        if len(seen) > 1:
            found.update((min(layer.start[a:b]), max(layer.end[a:b]), k) for a, b, k in matches(layer.text))
        if _could_hide(layer.text):
            work += [new for new in (_url(layer), _unicode(layer)) if new is not None]
            work += _base64(layer)
    return base, sorted(found)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def secret_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, base, spans): open secrets and all secrets of every whole text, as arrays of (start, stop, kind).

    One pass, no shuffle. Null and empty texts have none; null keys and repeated rows come back as given.
    ``start`` and ``stop`` count code points; ``kind`` is a place in ``KINDS``.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.int32())]))

    def rows_of(spans):
        return [{"start": a, "stop": b, "kind": k} for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1]))]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for value in batch.column(1):
                a, b = scan(value.as_py())
                base.append(rows_of(a))
                every.append(rows_of(b))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(every, span)], names=["key", "base", "spans"]
            )

    kind = docs.schema[key].dataType.simpleString()
    shape = "array<struct<start: bigint, stop: bigint, kind: int>>"
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(search, f"key {kind}, base {shape}, spans {shape}")
