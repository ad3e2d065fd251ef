"""Stateful streams, the sink that takes a batch once, text-level spans and the early stop."""

import json
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import spans as P
from corpusloom.operators import vocabulary as V
from corpusloom.sources import readers, writers
from corpusloom.streaming import chunks as K
from corpusloom.streaming import metrics as T


def source(spark, place, schema, rows):
    """A stream that takes one row at a time in the given order."""
    place.mkdir()
    for i, row in enumerate(rows):
        file = place / f"{i:03d}.json"
        file.write_text(json.dumps(row))
        os.utime(file, (1.7e9 + i, 1.7e9 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(place))


def drained(spark, stream, place):
    running = stream.writeStream.format("memory").queryName("s" + re.sub(r"\W", "_", place.name)).option("checkpointLocation", str(place / "state")).trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.table("s" + re.sub(r"\W", "_", place.name)).collect()


FRAGMENT = "request_id bigint, seq bigint, call_index bigint, id string, name string, arguments string"


def fragment(request, seq, index=None, id=None, name=None, arguments=None, **more):
    return {"request_id": request, "seq": seq, "call_index": index, "id": id, "name": name, "arguments": arguments, **more}


def test_call_fragments_repeat_come_late_and_out_of_order(spark, tmp_path):
    sent = [
        fragment(1, 1, 0, arguments='{"a"'), fragment(1, 0, 0, "c0", "f"), fragment(1, 0, 0, "c0", "f"), fragment(1, 3, 1, "c1", "g", "{}"),
        fragment(2, 0, None, "x", "h", "1"), fragment(1, 2, 0, arguments=": 1}"), fragment(1, 3, 1, "again", "g", "{}"), fragment(1, 4), fragment(1, 5, 0, arguments="late"),
        fragment(2, 1, None, "y", "k", "2"), fragment(2, 2, 1, arguments="3"), fragment(1, 0, 0, "c0", "f"), fragment(2, 3), fragment(3, 0, 0, "open", "never", "ended"),
    ]
    rows = drained(spark, K.stream_call_fragments(source(spark, tmp_path / "in", FRAGMENT, sent)), tmp_path)
    got = sorted(tuple(r) for r in rows)
    assert got == [(1, 0, "c0", "f", '{"a": 1}'), (1, 1, "c1", "g", "{}"), (2, 0, "x", "h", "1"), (2, 1, "y", "k", "23")]
    unique = {(f["request_id"], f["seq"]): f for f in sent if f["request_id"] == 1 and f["seq"] < 4 and f["id"] != "again"}
    batch = K.join_call_fragments(spark.createDataFrame([tuple(f.values()) for f in unique.values()], FRAGMENT)).collect()
    assert sorted(tuple(r) for r in batch) == got[:2]


def test_silent_requests_end(spark, tmp_path):
    sent = [fragment(1, 0, 0, "a", "f", "{", at="2024-01-01 00:00:00"), fragment(1, 2, 0, None, None, "lost", at="2024-01-01 00:00:01")]
    sent += [fragment(2, 0, 0, "b", "g", "{}", at="2024-01-02 00:00:00"), fragment(2, 1, at="2024-01-02 00:00:00"), fragment(3, 0, 0, "c", "h", "", at="2024-01-03 00:00:00")]
    stream = source(spark, tmp_path / "in", FRAGMENT + ", at timestamp", sent).withWatermark("at", "1 second")
    rows = drained(spark, K.stream_call_fragments(stream, "at", 60_000), tmp_path)
    assert sorted(tuple(r) for r in rows) == [(1, 0, "a", "f", "{"), (2, 0, "b", "g", "{}")]


def test_characters_cut_anywhere(spark, tmp_path):
    dice = random.Random(6)
    raw = {1: "é你🙂a\n".encode() * 3, 2: b"ok\xff\xe4\xbd", 3: b""}
    pieces = []
    for request, whole in raw.items():
        at = seq = 0
        while at < len(whole):
            size = dice.randint(0, 3)
            pieces.append({"request_id": request, "seq": seq, "piece": whole[at : at + size].hex()})
            at, seq = at + size, seq + 1
        pieces.append({"request_id": request, "seq": seq, "piece": None})
    pieces += [pieces[0], pieces[3]]
    dice.shuffle(pieces)
    hexed = source(spark, tmp_path / "in", "request_id bigint, seq bigint, piece string", pieces)
    rows = drained(spark, K.stream_characters(hexed.withColumn("piece", F.unhex("piece"))), tmp_path)
    for request, whole in raw.items():
        mine = sorted((r.seq, r.text, r.shown) for r in rows if r.request_id == request)
        assert "".join(t for _, t, _ in mine) == whole.decode("utf-8", "replace")
        assert [n for _, _, n in mine] == [sum(len(t) for _, t, _ in mine[: i + 1]) for i in range(len(mine))]
        assert not request == 1 or all("�" not in t for _, t, _ in mine)


def test_last_step_of_a_run_that_nobody_announced(spark, tmp_path):
    def step(run, n, value, at):
        return {"run": run, "step": n, "value": value, "at": f"2024-01-0{at} 00:00:00"}

    sent = [step("a", 1, 0.1, 1), step("a", 2, 0.2, 1), step("a", 3, 0.3, 1), step("a", 5, None, 1), step("a", 4, 0.4, 1), step("b", 4, 4.0, 1), step("c", 1, 1.0, 4), step("z", None, None, 5)]
    stream = source(spark, tmp_path / "in", "run string, step bigint, value double, at timestamp", sent).withWatermark("at", "1 second")
    rows = drained(spark, T.every_kth_and_last(stream, 2, ["value"], "at"), tmp_path)
    assert sorted((r.run, r.step) for r in rows) == [("a", 2), ("a", 4), ("a", 5), ("b", 4), ("c", 1)]
    assert {r.step: r.value for r in rows if r.run == "a"} == {2: 0.2, 4: 0.4, 5: None}


def test_a_batch_again_adds_nothing(spark, tmp_path):
    log = str(tmp_path / "log")
    rows = spark.createDataFrame([("r", 1, "m", 0.5), ("r", 2, "m", 0.25)], "run string, step int, metric string, value double")
    sink, other = writers.metric_sink(log, "one"), writers.metric_sink(log, "two")
    sink(rows, 0)
    sink(rows, 0)
    sink(rows.limit(1), 1)
    other(rows, 0)
    rows.write.parquet(f"{log}/rows/query=one/batch=2")  # a batch that broke off before its commit
    assert writers.read_metrics(spark, log).count() == 5
    sink(rows, 2)
    assert writers.read_metrics(spark, log).count() == 7


def test_files_behind_the_last_line_are_not_opened(spark, tmp_path):
    tmp_path = tmp_path / "a folder"
    tmp_path.mkdir()
    for i in range(9):
        (tmp_path / f"{i}.jsonl").write_text("".join(json.dumps({"text": f"{i}-{k}"}) + "\n" for k in range(3)))

    def read(n):
        files = [f.rsplit("/", 1)[1] for f in readers.leading_files(spark, str(tmp_path), n)]
        good, bad = readers.read_tolerant(spark, str(tmp_path), "text", first_lines=n)
        assert bad.count() == 0
        return files, [r.text for r in good.collect()]

    assert read(2) == (["0.jsonl"], ["0-0", "0-1"])
    files, texts = read(4)
    assert files == ["0.jsonl", "1.jsonl", "2.jsonl"] and sorted(texts) == ["0-0", "0-1", "0-2", "1-0"]
    assert len(read(100)[1]) == 27 and len(read(100)[0]) == 9
    (tmp_path / "empty").mkdir()
    assert readers.read_tolerant(spark, str(tmp_path / "empty"), "text", first_lines=5)[0].count() == 0


def test_intermediate_tables_can_be_removed(spark):
    from corpusloom.session import remove_intermediate, settled

    remove_intermediate(spark)
    kept = settled(spark.range(3))
    (file, *_) = kept.inputFiles()
    assert os.path.exists(file.removeprefix("file://")) and remove_intermediate(spark) == 1
    assert not os.path.exists(file.removeprefix("file://")) and remove_intermediate(spark) == 0


def test_spans_of_the_text_and_of_the_tokens(spark):
    a, e = P.OPENER, P.CLOSER
    texts = [f"x{a}réply{e}y{a}two", f"{a}{e}", "none", "", a, f"{a}one{a}inner{e}out{e}", f"🙂{a}日本{e}{a}z{e}", None, f"{a[:-1]} no{e}"]

    def want(text):
        if text is None:
            return None
        raw, at, out = text.encode(), 0, []
        while (at := raw.find(a.encode(), at)) >= 0:
            start = at + len(a)
            stop = raw.find(e.encode(), start)
            at = len(raw) if stop < 0 else stop + len(e)
            out.append((start, at))
        return out

    encoder = V.Encoder(*V.base_vocabulary(spark))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    coded = df.select("i", "t", P.text_spans(F.col("t")).alias("spans"), encoder.encode(F.col("t")).alias("ids"))
    rows = coded.select("*", P.spans_to_mask(P.token_ends(F.col("ids"), encoder), F.col("spans")).alias("mask"), P.token_ends(F.col("ids"), encoder).alias("ends")).collect()
    for r in rows:
        spans = want(texts[r.i])
        assert (None if r.spans is None else [tuple(s) for s in r.spans]) == spans
        if spans is not None:
            starts = [0, *r.ends[:-1]] if r.ends else []
            assert list(r.mask) == [int(any(s <= x and y <= t for s, t in spans)) for x, y in zip(starts, r.ends)]
            assert not r.ends or r.ends[-1] == len(texts[r.i].encode())


@pytest.mark.parametrize("name", ["stream_fragments", "hold_bytes", "stream_metrics"])
def test_these_queries_are_streams(spark, monkeypatch, name):
    from corpusloom.plans import stream_queries as S

    seen = []
    real = S._drain
    monkeypatch.setattr(S, "_drain", lambda s: seen.append(s.isStreaming) or real(s))
    assert getattr(S, name)(spark, "/root/testdata/sf0.001").count() and seen == [True]


@pytest.mark.parametrize("name", ["stream_deltas", "stream_fragments", "hold_bytes"])
def test_streams_of_tables_in_several_files(spark, tmp_path, name):
    from corpusloom.plans.catalogue import ORACLES, QUERIES
    from tests.compare import compare

    place = tmp_path / "conversations.parquet"
    rows = [(i, turn, ("user", "assistant")[turn % 2], f"Wörter {i} von {turn}") for i in range(12) for turn in range(4)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3).write.parquet(str(place))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{place}/*.parquet')")
    assert compare(spark, con, name, str(tmp_path), QUERIES[name], ORACLES[name]) is None
