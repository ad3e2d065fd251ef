"""Fill-in-the-middle rewriting over texts stored as seekable compressed frames.

A text is a row of frames: independently compressed pieces, each with the number of units (lines) that end before
it and within it. Where a cut falls is known from these numbers; only the one or two frames that hold a cut are
unpacked and divided, all others move as they are. Digests unpack one frame at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.scratch import keep, new_folder

FRAME_BYTES = 1 << 18
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: The parts of the text (0 prefix, 1 middle, 2 suffix) behind their marks, in the order of each form.
LAYOUT = {PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}

_FRAME = pa.struct([("before", pa.int64()), ("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])
_FRAMES = "array<struct<before: bigint, units: bigint, chars: bigint, data: binary>>"
_BATCH_BYTES = 1 << 23


def _chars(raw: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80))


def cut_frames(raw: bytes, size: int = FRAME_BYTES) -> Iterator[bytes]:
    """UTF-8 bytes in pieces of at most ``size`` (four or more), never within a character."""
    start = 0
    while start < len(raw):
        end = min(start + size, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        yield raw[start:end]
        start = end


def _batches(rows: Iterator[tuple[tuple, int]], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows with their size in bytes to batches of about ``_BATCH_BYTES``."""

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*held), types)], names=names)

    held, total = [], 0
    for row, size in rows:
        held.append(row)
        total += size + 64
        if total >= _BATCH_BYTES:
            yield batch()
            held, total = [], 0
    if held:
        yield batch()


def framed(rows: DataFrame, key: str, text: str, size: int = FRAME_BYTES) -> DataFrame:
    """(key, n, marked, frames): every text as compressed frames, its number of lines, and whether a mark stands in it.

    No shuffle. Null texts count as empty and have no frames. A row is never larger than the text it came from.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3).compress

        def stored(batch: pa.RecordBatch):
            for name, marked, value in zip(*batch.columns):
                raw, frames, lines = value.as_py() or b"", [], 0
                for piece in cut_frames(raw, size):
                    ends = piece.count(b"\n")
                    frames.append({"before": lines, "units": ends, "chars": _chars(piece), "data": pack(piece)})
                    lines += ends
                n = lines + (raw[-1:] not in (b"", b"\n"))
                yield (name.as_py(), n, marked.as_py(), frames), sum(len(f["data"]) for f in frames)

        for batch in batches:
            yield from _batches(stored(batch), ["key", "n", "marked", "frames"], [batch.schema.field(0).type, pa.int64(), pa.bool_(), pa.list_(_FRAME)])

    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = reduce(Column.__or__, [F.contains(value, F.lit(m)) for m in MARKS])
    parts = rows.select(F.col(key).alias("key"), marked.alias("marked"), value.cast("binary").alias("raw"))
    return parts.mapInArrow(store, f"key {rows.schema[key].dataType.simpleString()}, n bigint, marked boolean, frames {_FRAMES}")


def drawn(key: Column, n: Column, marked: Column, seed: int, rate: int = 100, spm: int = 50) -> list[Column]:
    """(form, first, second): form and cut units from the SHA-256 of ``<seed>:<key>``; ``rate`` and ``spm`` in hundredths.

    Null keys count as the empty text. ``n`` is the number of units, ``marked`` says that the text holds a mark and stays plain.
    """
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h1, h2, h3, h4 = [F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    form = F.when((n == 0) | marked | (h3 % 100 >= rate), PLAIN).when(h4 % 100 < spm, SPM).otherwise(PSM)
    a, b = h1 % (n + 1), h2 % (n + 1)
    return [form.alias("form"), F.least(a, b).alias("first"), F.greatest(a, b).alias("second")]


def _line_end(raw: bytes, nth: int) -> int:
    """Bytes up to and with the ``nth`` line end (from 1)."""
    return int(np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)[nth - 1]) + 1


def divided(frames: list[dict], first: int, second: int) -> tuple[list[list[bytes]], list[int]]:
    """(prefix, middle, suffix) as lists of compressed frames, and their lengths in characters."""
    parts, chars = [[], [], []], [0, 0, 0]
    for f in frames:
        before, after = f["before"], f["before"] + f["units"]
        inside = [cut for cut in (first, second) if before < cut <= after]
        if not inside:
            part = (before >= first) + (before >= second)
            parts[part].append(f["data"])
            chars[part] += f["chars"]
            continue
        raw = zstandard.decompress(f["data"])
        # A cut before this frame lies at its start, one behind it at its end.
        ends = [_line_end(raw, cut - before) if cut in inside else 0 if cut <= before else len(raw) for cut in (first, second)]
        for part, piece in enumerate((raw[: ends[0]], raw[ends[0] : ends[1]], raw[ends[1] :])):
            if piece:
                parts[part].append(zstandard.compress(piece, 3))
                chars[part] += _chars(piece)
    return parts, chars


def transformed(frames: DataFrame, seed: int, rate: int = 100, spm: int = 50) -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output): ``output`` is the rewritten text as compressed frames.

    Takes what ``framed`` gives; row by row, no shuffle. Only frames with a cut are unpacked. A plain text keeps its frames,
    and its two lengths are null. Repeated keys have the same draws.
    """

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = {m: zstandard.compress(m.encode(), 3) for m in MARKS}

        def rewritten(batch: pa.RecordBatch):
            for name, n, form, first, second, listed in zip(*batch.columns):
                listed, form = listed.as_py(), form.as_py()
                if form == PLAIN:
                    lengths, output = (None, None), [f["data"] for f in listed]
                else:
                    parts, chars = divided(listed, first.as_py(), second.as_py())
                    lengths, output = chars[:2], [x for mark, part in LAYOUT[form] for x in (marks[mark], *parts[part])]
                yield (name.as_py(), n.as_py(), form, *lengths, output), sum(map(len, output))

        for batch in batches:
            types = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
            yield from _batches(rewritten(batch), ["key", "n", "form", "prefix_chars", "middle_chars", "output"], types)

    ready = frames.select("key", "n", *drawn(F.col("key"), F.col("n"), F.col("marked"), seed, rate, spm), "frames")
    kind = frames.schema["key"].dataType.simpleString()
    return ready.mapInArrow(rewrite, f"key {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>")


def rebuilt(output: list[bytes], form: str) -> list[bytes]:
    """Frames of the text from the frames of its rewritten form, read in order until the next mark due; a mark may lie across frames."""
    if form == PLAIN:
        return output
    parts: dict[int, list[bytes]] = {0: [], 1: [], 2: []}
    due = [(m.encode(), part) for m, part in LAYOUT[form]]
    part, held = None, b""

    def add(raw: bytes, frame: bytes | None = None) -> None:
        if raw:
            parts[part].append(frame if frame is not None else zstandard.compress(raw, 3))

    for frame in output:
        raw = fresh = zstandard.decompress(frame)
        raw, held = held + raw, b""
        while due and (at := raw.find(due[0][0])) >= 0:
            if part is not None:
                add(raw[:at])
            raw, part = raw[at + len(due[0][0]) :], due.pop(0)[1]
        if due:
            mark = due[0][0]
            keep_back = next((k for k in range(min(len(mark) - 1, len(raw)), 0, -1) if mark.startswith(raw[-k:])), 0)
            raw, held = raw[: len(raw) - keep_back], raw[len(raw) - keep_back :]
        if part is not None:
            add(raw, frame if raw == fresh else None)
    if held:
        add(held)
    return parts[0] + parts[1] + parts[2]


def restored(output: str, form: str) -> Column:
    """Frames of the original text, from the rewritten frames and the form alone; null where one of them is."""

    @F.pandas_udf("array<binary>")
    def rebuild(output: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([None if o is None or f is None else rebuilt(list(o), f) for o, f in zip(output, form)], dtype=object)

    return rebuild(output, form)


def sha256_of(frames) -> str | None:
    if frames is None:
        return None
    sha = hashlib.sha256()
    for frame in frames:
        sha.update(zstandard.decompress(frame))
    return sha.hexdigest()


def digest(frames: str | Column) -> Column:
    """Hex SHA-256 of the text in an array of frames, one frame unpacked at a time; null for a null array."""

    @F.pandas_udf("string")
    def hexed(column: pd.Series) -> pd.Series:
        return column.map(sha256_of)

    return hexed(frames)


def stored(rows: DataFrame, key: str, text: str, size: int = FRAME_BYTES) -> DataFrame:
    """Runs a job. ``framed`` written to the checkpoint folder and read back."""
    return keep(framed(rows, key, text, size), new_folder(rows.sparkSession, "frames"))
