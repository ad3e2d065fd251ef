"""Byte-level BPE with a given table of ranks: every distinct pre-token of the corpus is encoded once.

Texts are cut into blocks. A block holds its distinct pre-tokens and, position by position, the place of its texts' pre-tokens
among them. The distinct pre-tokens go through one global shuffle by groups of their hash, meet their ids, return to their block and are
laid out by position. Decoding looks every id up in the table of token bytes.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.bytepairs import merge_pairs
from corpusloom.llm.scratch import fresh, keep, new_folder, pieces as slices

BLOCK_CHARS = 12_000_000  # a block ends with the text that reaches this many characters
MAX_TOKENS = 1_000_000  # of a table of ranks; above that it isn't sent to the tasks
MOST_GROUPS = 4096  # of words; each is encoded by one task
ROWS_OUT = 256
LONG_TEXT = 1 << 23  # a text from this length on is matched piece by piece


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id from a file of base64 tokens and ids. Raises above ``MAX_TOKENS`` lines."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, number = line.split()
                ranks[base64.b64decode(token)] = int(number)
            if len(ranks) > MAX_TOKENS:
                raise ValueError(f"{path} has more than {MAX_TOKENS} tokens")
    return ranks


def word_ids(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token. One that is a token itself is that token; else the lowest-ranked neighbours join first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = merge_pairs([word[i : i + 1] for i in range(len(word))], lambda a, b: ranks.get(a + b))
    return [ranks[p] for p in parts]


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, all first bytes before all second bytes and so on."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 3)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_lists(parts: list[bytes]) -> bytes:
    """Byte strings as their lengths and then themselves."""
    lengths = np.fromiter(map(len, parts), "<u4", len(parts))
    return zstandard.compress(len(parts).to_bytes(8, "little") + lengths.tobytes() + b"".join(parts), 3)


def _unpack_lists(packed: bytes) -> tuple[np.ndarray, bytes]:
    """(lengths, all bytes)."""
    raw = zstandard.decompress(packed)
    n = int.from_bytes(raw[:8], "little")
    return np.frombuffer(raw, "<u4", n, 8).astype(np.int64), raw[8 + 4 * n :]


def _split(lengths: np.ndarray, raw: bytes) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def blocks_of(rows: DataFrame, key: str, text: str, pattern: str, groups: int) -> DataFrame:
    """(block, keys, counts, words, places): the texts of a block by key and number of pre-tokens, its distinct pre-tokens
    packed by group (CRC-32 modulo ``groups``) and sorted within, and packed the place of each pre-token of its texts among them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = regex.compile(pattern)
        keys: list = []
        counts: list[int] = []
        first: dict[str, int] = {}
        order, size = array("I"), 0
        shape = None

        def block() -> pa.RecordBatch:
            raw = [word.encode("utf-8") for word in first]
            group = np.fromiter((zlib.crc32(w) % groups for w in raw), np.int64, len(raw))
            ranked = sorted(range(len(raw)), key=lambda i: (group[i], raw[i]))
            place = np.empty(len(raw), np.uint32)
            place[ranked] = np.arange(len(raw), dtype=np.uint32)
            packed, ends = [], np.cumsum(np.bincount(group, minlength=groups)).tolist()
            for a, b in zip([0, *ends], ends):
                packed.append(_pack_lists([raw[i] for i in ranked[a:b]]) if a < b else None)
            del raw, ranked, group
            places = _pack(place[np.frombuffer(order, np.uint32)] if order else np.empty(0, np.uint32))
            columns = [pa.array([keys], pa.list_(shape)), pa.array([counts], pa.list_(pa.int32())), pa.array([packed], pa.list_(pa.binary())), pa.array([places], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["keys", "counts", "words", "places"])

        for batch in slices(batches):
            shape = batch.schema.field(0).type
            for name, value in zip(batch.column(0), batch.column(1)):
                value = value.as_py() or ""
                found = pieces.findall(value) if len(value) < LONG_TEXT else (m.group() for m in pieces.finditer(value))
                before = len(order)
                order.extend([first.setdefault(word, len(first)) for word in found] if len(value) < LONG_TEXT else (first.setdefault(word, len(first)) for word in found))
                keys.append(name.as_py())
                counts.append(len(order) - before)
                size += len(value)
                if size >= BLOCK_CHARS:
                    yield block()
                    keys, counts, first, order, size = [], [], {}, array("I"), 0
        if keys:
            yield block()

    kind = rows.schema[key].dataType.simpleString()
    parts = rows.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    made = parts.mapInArrow(cut, f"keys array<{kind}>, counts array<int>, words array<binary>, places binary")
    return made.select(F.monotonically_increasing_id().alias("block"), "*")


def _bucketed(rows: DataFrame, folder: str, by: str, buckets: int) -> DataFrame:
    """Runs a job. ``rows`` written to ``folder`` in buckets, so that a join on ``by`` finds them dealt out already.

    Spark takes buckets through a table name only; the name goes again at once, the files stay.
    """
    spark, name = rows.sparkSession, f"blocks_{uuid.uuid4().hex}"
    rows.write.format("parquet").option("compression", "zstd").option("path", folder).bucketBy(buckets, by).saveAsTable(name)
    kept = spark.table(name)
    assert kept.columns == rows.columns  # resolves the table while it has a name
    spark.sql(f"DROP TABLE {name}")
    return kept


def _laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the packed ids of their words, to one row per text: the words' ids by position."""
    for batch in batches:
        for keys, counts, places, packed in zip(*batch.columns):
            order = _unpack(places.as_py())
            lists = [_unpack_lists(p) for p in packed.as_py() or ()]
            lengths = np.concatenate([n for n, _ in lists] or [np.empty(0, np.int64)]) // 4
            flat = np.frombuffer(b"".join(raw for _, raw in lists), "<i4")
            del lists
            starts = np.cumsum(lengths) - lengths
            stops = np.concatenate([[0], np.cumsum(counts.values.to_numpy(zero_copy_only=False))])
            for a in range(0, len(stops) - 1, ROWS_OUT):
                b = min(a + ROWS_OUT, len(stops) - 1)
                part = order[stops[a] : stops[b]]
                ends = np.concatenate([[0], np.cumsum(lengths[part])])
                values = flat[np.repeat(starts[part] - ends[:-1], lengths[part]) + np.arange(ends[-1])]
                out = pa.ListArray.from_arrays(pa.array(ends[stops[a : b + 1] - stops[a]], pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys.values.slice(a, b - a), out], names=["key", "ids"])


def encoded(rows: DataFrame, key: str, text: str, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """Runs a job. (key, ids): the token ids of every whole text, each match of ``pattern`` encoded by itself.

    One row per row: null and empty texts have no ids, null and repeated keys come back as given, and other columns play
    no part. Blocks are written to the checkpoint folder, dealt out by block. A word is shuffled once per block that
    holds it, however often it stands there, in a list with the other words of its group; a group is in one task, which encodes each
    of its words once. The only things gathered are the words of one block, no larger than its texts: ``BLOCK_CHARS`` or one longer text.
    """
    spark = rows.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = min(4 * buckets, MOST_GROUPS)
    blocks = _bucketed(blocks_of(rows, key, text, pattern, groups), new_folder(spark, "blocks"), "block", buckets)
    sent = spark.sparkContext.broadcast(ranks)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        at = None
        for batch in slices(batches):
            packed = []
            for group, words in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if group != at:
                    known, at = {}, group
                ids = []
                for word in _split(*_unpack_lists(words)):
                    got = known.get(word)
                    if got is None:
                        got = known[word] = np.asarray(word_ids(word, sent.value), "<i4").tobytes()
                    ids.append(got)
                packed.append(_pack_lists(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["block", "group", "ids"])

    words = blocks.select("block", F.posexplode("words").alias("group", "words")).filter(F.col("words").isNotNull())
    known = words.repartition("group").sortWithinPartitions("group").mapInArrow(encode, "block bigint, group int, ids binary")
    back = known.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("group", "ids"))).alias("w"))
    whole = blocks.drop("words").join(back, "block", "left").select("keys", "counts", "places", F.col("w.ids").alias("ids"))
    return whole.mapInArrow(_laid_out, f"key {rows.schema[key].dataType.simpleString()}, ids array<int>")


def token_bytes(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The table of token bytes: (token_id, bytes). At most ``MAX_TOKENS`` rows."""
    rows = pa.table({"token_id": pa.array(ranks.values(), pa.int32()), "bytes": pa.array(ranks.keys(), pa.binary())})
    return spark.createDataFrame(rows, "token_id int, bytes binary")


def decoded(rows: DataFrame, ids: str, tokens: DataFrame, out: str = "decoded") -> DataFrame:
    """``rows`` and in the binary column ``out`` the bytes of their token ids (``tokens``: token_id, bytes).

    A join on the side of the ids: the table of tokens, of at most ``MAX_TOKENS`` rows (else an error), goes to every task sorted by id, and
    ids take their bytes from it by place. No shuffle. Null ids give null, no ids no bytes, and a row
    with an id that the table doesn't have (or a null one) gives null. Raises if ``out`` is a column already.
    """
    if fresh(rows.columns, out) != out:
        raise ValueError(f"there is a column {out} already")
    listed = tokens.select("token_id", "bytes").filter("token_id IS NOT NULL AND bytes IS NOT NULL").limit(MAX_TOKENS + 1).collect()
    if len(listed) > MAX_TOKENS:
        raise ValueError(f"more than {MAX_TOKENS} tokens")
    table: list[bytes | None] = [None] * (1 + max((r["token_id"] for r in listed), default=-1))
    for r in listed:
        table[r["token_id"]] = bytes(r["bytes"])
    sent = rows.sparkSession.sparkContext.broadcast(table)
    at = rows.columns.index(ids)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _looked_up(batches, pa.array(sent.value, pa.large_binary()), at, out)

    return rows.mapInArrow(look_up, T.StructType([*rows.schema.fields, T.StructField(out, T.BinaryType())]))


def _looked_up(batches: Iterator[pa.RecordBatch], table: pa.LargeBinaryArray, at: int, out: str) -> Iterator[pa.RecordBatch]:
    """The batches, ``ROWS_OUT`` rows at a time, with the bytes of the ids in column ``at``: neither this worker nor Spark holds the bytes of a whole batch."""
    for batch in slices(batches, ROWS_OUT):
        texts = []
        for value in batch.column(at):
            text = None
            if value.is_valid:
                numbers = value.values
                known = not numbers.null_count and (not len(numbers) or (0 <= pa.compute.min(numbers).as_py() and pa.compute.max(numbers).as_py() < len(table)))
                got = table.take(numbers) if known and len(numbers) else None
                if got is not None and not got.null_count:
                    text = _joined(got)
                elif known and not len(numbers):
                    text = b""
            texts.append(text)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, out])


def _joined(tokens: pa.LargeBinaryArray) -> bytes:
    """All tokens in one: they lie one behind the other already."""
    _, offsets, data = tokens.buffers()
    ends = np.frombuffer(offsets, np.int64)
    return data.slice(ends[tokens.offset], ends[tokens.offset + len(tokens)] - ends[tokens.offset]).to_pybytes()
