"""WARC archives through Spark's own writers, and capture indexes merged into one global order."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.scratch import fresh, keep, new_folder

# The format's line ends, version and profile, and the alphabet of base32.
CRLF = "\r\n"
END = CRLF + CRLF
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
STATUS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits (5 hex digits) make 4 letters."""
    digest = F.sha1(payload)
    letters = []
    for part in range(8):
        bits = F.conv(F.substring(digest, 5 * part + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(bits, 15 - 5 * n).bitwiseAND(31) + 1, F.lit(1)) for n in range(4)]
    return F.concat(*letters)


def with_revisits(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """Runs a job. ``pages`` with ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``; no other column goes.

    Of pages with equal payloads (null counts as empty) the one with the largest key is the response and the others revisit it.
    Rows that repeat the largest key are responses too, as are pages all of whose copies have null keys; a null key
    beside others revisits. Equality is that of digest and length. Only digests and keys are grouped, with partial maxima, and the
    table of repeated digests is written before it is joined, so a payload that a third of all pages share is split.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    dealt = pages.withColumn("payload_bytes", F.octet_length(body).cast("bigint")).withColumn("payload_digest", base32_sha1(body))
    sums = dealt.groupBy("payload_digest", "payload_bytes").agg(F.max(key).alias("last"), F.count(F.lit(1)).alias("n"))
    repeated = sums.filter("n > 1 AND last IS NOT NULL").select("payload_digest", "payload_bytes", "last")
    repeated = keep(repeated, new_folder(pages.sparkSession, "digests"))
    last = fresh(dealt.columns, "last")
    joined = dealt.join(repeated.withColumnRenamed("last", last), ["payload_digest", "payload_bytes"], "left")
    copy = F.col(last).isNotNull() & ~F.col(key).eqNullSafe(F.col(last))
    return joined.withColumn("record_type", F.when(copy, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(copy, F.col(last))
    ).drop(last)


def write_archives(pages: DataFrame, folder: str, key: str, url: str, payload: str, start: str = "2024-01-01 00:00:00", records_per_file: int = 2000) -> None:
    """Runs a job. One WARC record per row of ``pages`` (which has the columns of ``with_revisits``), a file per partition.

    A record is one line of Spark's text writer whose line separator is the two line ends that close a record, so archives go
    to any file system that Spark reaches. Responses hold an HTTP head and the payload; revisits hold the head alone, and carry the
    payload's length in a field of their own. Pages have no capture time: it is ``start`` plus the key in seconds.
    Line ends in a URL are percent-encoded; a null URL leaves its field out.
    """
    ident = F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(key).cast("string"), F.lit("none")), F.lit(">"))
    seconds = F.pmod(F.coalesce(F.col(key).cast("bigint"), F.lit(0)), F.lit(3_000_000_000))
    when = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(start)) + seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.coalesce(F.col(payload), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit(STATUS)).otherwise(F.concat(F.lit(STATUS), body))
    target = F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A")
    fields = F.concat_ws(
        CRLF,
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), ident),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Date: "), when),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:x-page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    pages.select(F.concat(fields, F.lit(END), block).alias("record")).write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(folder)


FIELD = re.compile(rb"([A-Za-z-]+): ?([^\r]*)\r\n")
CAPTURE = "page_id bigint, url string, url_key string, captured string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, file string, offset bigint, length bigint, intact boolean"


def url_key(url: str | None) -> str:
    """Sortable form: host labels reversed, then path and query in lower case; '' without a host."""
    host, _, rest = (url or "").partition("://")[2].partition("/")
    return f"{','.join(reversed(host.lower().split('.')))})/{rest.lower()}" if host else ""


def _number(raw: bytes | None) -> int | None:
    digits = (raw or b"").rpartition(b":")[2].rstrip(b">")
    return int(digits) if digits.lstrip(b"-").isdigit() else None


def records(content: bytes) -> Iterator[tuple[dict[bytes, bytes], int, int, memoryview]]:
    """(fields, offset, length, block) of each record of one archive, by the declared block lengths."""
    at, view = 0, memoryview(content)
    while at < len(content):
        head = content.index(b"\r\n\r\n", at)
        fields = dict(FIELD.findall(content[at : head + 2]))
        begin = head + 4
        stop = begin + int(fields[b"Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where its length says")
        yield fields, at, stop + 4 - at, view[begin:stop]
        at = stop + 4


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of the archives in ``folder``, with its file, offset and length; ``intact`` if its payload fits its digest."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in CAPTURE.split(", ")]
        types = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
        schema = pa.schema([(c.split(" ")[0], types[c.split(" ")[1]]) for c in CAPTURE.split(", ")])
        for batch in batches:
            for n in range(batch.num_rows):
                path, content = batch.column(0)[n].as_py(), batch.column(1)[n].as_py()
                rows = []
                for fields, offset, length, block in records(content):
                    kind = fields[b"WARC-Type"].decode()
                    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
                    payload = block[len(STATUS) :]
                    sound = kind != "response" or base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest
                    url = fields.get(b"WARC-Target-URI")
                    url = None if url is None else url.decode("utf-8", "replace")
                    rows.append((
                        _number(fields[b"WARC-Record-ID"]), url, url_key(url), fields[b"WARC-Date"].decode(),
                        len(payload) if kind == "response" else int(fields[b"X-Payload-Length"]), digest, kind,
                        _number(fields.get(b"WARC-Refers-To")), path, offset, length, sound,
                    ))
                rows.sort(key=lambda r: (r[2], r[3], -1 if r[0] is None else r[0]))
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(parse, CAPTURE)


class LoserTree:
    """Merges sorted runs: the winner leaves, and its run's next entry plays the losers on its way up."""

    def __init__(self, runs: list[Iterator]):
        self.runs, k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.losers = [-1] * k
        self.k, self.winner = k, -1
        for run in range(k):
            self._play(run)

    def _beats(self, a: int, b: int) -> bool:
        if b < 0 or a < 0:
            return a < 0  # a run that has not entered yet wins, so that building fills every node
        x, y = self.heads[a], self.heads[b]
        return y is None if x is None or y is None else x[0] < y[0] or (x[0] == y[0] and a < b)

    def _play(self, run: int) -> None:
        node = (run + self.k) // 2
        while node > 0:
            if self._beats(self.losers[node], run):
                self.losers[node], run = run, self.losers[node]
            node //= 2
        self.winner = run

    def __iter__(self) -> Iterator:
        while self.winner >= 0 and (head := self.heads[self.winner]) is not None:
            yield head[1]
            self.heads[self.winner] = next(self.runs[self.winner], None)
            self._play(self.winner)


def histories(runs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Runs a job for the range bounds. All captures in global order of url_key, time and page_id.

    ``runs`` come locally sorted, one run per archive (``captures``). Ranges of (url_key, captured, page_id) are sampled, every range gets
    its stretch of each run, still sorted, and merges the stretches through a loser tree. Pages of a hot URL spread
    over ranges by time and id, so a range stays as small as the others. Null page ids come first.
    """
    order = ["url_key", "captured", "page_id"]
    dealt = runs.repartitionByRange(partitions, *order) if partitions else runs.repartitionByRange(*order)
    stretches = dealt.sortWithinPartitions("file", *order)
    names = runs.columns
    url_at, time_at, page_at = (names.index(c) for c in order)
    run_at = names.index("file")

    def entries(parts: list[pa.RecordBatch]) -> Iterator:
        for part in parts:
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                yield (row[url_at], row[time_at], -(1 << 63) if row[page_at] is None else row[page_at]), row

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.RecordBatch]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            runs_here = np.array(batch.column(run_at).to_pylist(), dtype=object)
            begin = np.flatnonzero(np.r_[True, runs_here[1:] != runs_here[:-1]])
            for low, high in zip(begin, [*begin[1:], len(runs_here)], strict=True):
                held.setdefault(runs_here[low], []).append(batch.slice(low, high - low))
        out = []
        schema = next(iter(held.values()))[0].schema if held else None
        for row in LoserTree([entries(parts) for _, parts in sorted(held.items())]):
            out.append(row)
            if len(out) == 4096:
                yield _batch(out, schema)
                out = []
        if out:
            yield _batch(out, schema)

    return stretches.mapInArrow(merge, stretches.schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
