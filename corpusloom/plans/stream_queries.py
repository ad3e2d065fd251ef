"""Streaming queries. Each reads the given tables as a stream, runs until everything has been
taken in and returns what the stream wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans import sqltext as S
from corpusloom.plans.derived import RESPONSE, RESPONSES_SQL, TOOL_ARGS, TOOL_NAME, responses
from corpusloom.plans.registry import query, table
from corpusloom.session import new_place
from corpusloom.sources.writers import metric_sink, read_metrics
from corpusloom.streaming import chunks as K
from corpusloom.streaming.metrics import every_kth_and_last, to_metric_log


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's files as a stream, be it one file or a folder of them; a stream takes a single file only as a glob."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _drain(stream: DataFrame) -> DataFrame:
    """Run the stream over everything there is into Parquet files in the shared folder."""
    spark = stream.sparkSession
    folder = new_place(spark, "stream")
    running = (
        stream.writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


_REQUEST = "conv_id * 1000 + turn"


def chunked(rows: DataFrame, size: int = 12) -> DataFrame:
    """(request_id, text) to (request_id, seq, chunk) pieces, a null chunk at the end."""
    n = F.ceil(F.length("text") / size).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.struct(
            i.cast("bigint").alias("seq"),
            F.when(i < n, F.substring("text", i * size + 1, F.lit(size))).alias("chunk"),
        ),
    )
    return rows.select("request_id", F.inline(pieces))


_SPLIT = f"""r AS ({RESPONSES_SQL}), s AS (SELECT {_REQUEST} AS request_id, {S.before_first("response", "</think>")} AS reasoning,
 CASE WHEN instr(response, '</think>') > 0 THEN ltrim({S.after_first("response", "</think>")}, chr(10)) ELSE '' END AS content,
 conv_id % 5 = 0 AS called FROM r)"""


@query(f"""WITH {_SPLIT} SELECT request_id, md5(reasoning) AS reasoning_md5, md5(content) AS content_md5,
 CASE WHEN called THEN 'tool_calls' ELSE 'stop' END AS finish_reason FROM s""")
def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses put together from chunks and split; the grouped form, in batch."""
    rows = responses(spark, sf_dir).selectExpr(f"{_REQUEST} AS request_id", "response AS text")
    return K.split_responses(chunked(rows)).select(
        "request_id", F.md5("reasoning").alias("reasoning_md5"), F.md5("content").alias("content_md5"), "finish_reason"
    )


@query(f"""WITH {_SPLIT} SELECT request_id, md5(reasoning) AS reasoning_md5, md5(content) AS content_md5,
 CASE WHEN called THEN 1 ELSE 0 END AS n_calls,
 CASE WHEN called THEN 'tool_calls' ELSE 'stop' END AS finish_reason FROM s""")
def stream_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deltas from the stateful stream, joined again per request."""
    rows = _stream(spark, sf_dir, "conversations").filter("role = 'assistant'").selectExpr(
        f"{_REQUEST} AS request_id", f"{RESPONSE} AS text"
    )
    deltas = _drain(K.stream_deltas(chunked(rows)))

    def joined(kind: str):
        parts = F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("part", "text"))))
        return F.md5(F.array_join(F.transform(parts, lambda p: p["text"]), ""))

    return deltas.groupBy("request_id").agg(
        joined("reasoning").alias("reasoning_md5"),
        joined("content").alias("content_md5"),
        F.sum(F.coalesce(F.size("calls"), F.lit(0))).cast("int").alias("n_calls"),
        F.max("finish_reason").alias("finish_reason"),
    )


@query(f"""WITH r AS ({RESPONSES_SQL}) SELECT {_REQUEST} AS request_id, CAST(turn % 2 AS BIGINT) AS call_index, 'call_' || turn AS id, tool AS name, args AS arguments FROM r""")
def stream_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tool calls put together from fragments: id and name come first, arguments in pieces; a fragment of nulls ends a request."""
    rows = _stream(spark, sf_dir, "conversations").filter("role = 'assistant'").selectExpr(
        f"{_REQUEST} AS request_id", "CAST(turn % 2 AS BIGINT) AS call_index", "turn", f"{TOOL_NAME} AS tool", f"{TOOL_ARGS} AS args"
    )
    last = F.floor(F.length("args") / 4).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), last + 1),
        lambda i: F.struct(
            i.cast("bigint").alias("seq"),
            F.when(i <= last, F.col("call_index")).alias("call_index"),
            F.when(i == 0, F.concat(F.lit("call_"), F.col("turn"))).alias("id"),
            F.when(i == 0, F.col("tool")).alias("name"),
            F.when(i <= last, F.substring("args", i * 4 + 1, F.lit(4))).alias("arguments"),
        ),
    )
    return _drain(K.stream_call_fragments(rows.select("request_id", F.inline(pieces))))


@query("""WITH e AS (SELECT user_id AS run, event_id AS step, value FROM events
 QUALIFY event_id % 25 = 0 OR event_id = max(event_id) OVER (PARTITION BY user_id))
SELECT run, step, 'value' AS metric, value FROM e UNION ALL SELECT run, step, 'double', value * 2 FROM e""")
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at every 25th step and at the last of each run, found when the watermark passes the run."""
    shape = [F.col("user_id").alias("run"), F.col("event_id").alias("step"), "value", (F.col("value") * 2).alias("double"), F.col("ts").cast("timestamp").alias("at")]
    steps = _stream(spark, sf_dir, "events").select(*shape)
    # A later source that has no steps moves the watermark on, as the next day's runs would.
    later = _stream(spark, sf_dir, "region").select(
        F.lit(-1).cast("bigint").alias("run"), F.lit(None).cast("bigint").alias("step"), F.lit(0.0).alias("value"), F.lit(0.0).alias("double"),
        F.lit("2100-01-01").cast("timestamp").alias("at"),
    )
    timed = steps.unionByName(later).withWatermark("at", "1 hour")
    return _drain(to_metric_log(every_kth_and_last(timed, 25, ["value", "double"], "at"), ["value", "double"]))


@query("""SELECT user_id AS run, event_id AS step, 'value' AS metric, value FROM events WHERE event_id % 10 = 0 AND value IS NOT NULL""")
def metric_log_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth value through the sink that takes each batch once; every batch is offered twice."""
    folder = new_place(spark, "stream")
    steps = _stream(spark, sf_dir, "events").filter("event_id % 10 = 0").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), "value")
    sink = metric_sink(f"{folder}/log", "values")

    def twice(rows: DataFrame, batch: int) -> None:
        sink(rows, batch)
        sink(rows, batch)

    running = to_metric_log(steps, ["value"]).writeStream.foreachBatch(twice).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return read_metrics(spark, f"{folder}/log").select("run", "step", "metric", "value")


@query("""WITH t AS (SELECT *, 10 + turn * 3 AS size, octet_length(encode(text)) AS n FROM conversations),
c AS (SELECT *, unnest(range(1, n // size + 2)) AS cut FROM t),
s AS (SELECT conv_id, turn, cut, list_max(list_filter(range(0, length(text) + 1), lambda k: octet_length(encode(left(text, k))) <= cut * size)) AS shown FROM c)
SELECT conv_id, turn, cut, CAST(shown AS INT) AS shown FROM s""")
def hold_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that arrive as a stream of byte chunks cut anywhere: how many characters can be shown after each."""
    size = F.col("turn") * 3 + 10
    raw = F.encode("text", "UTF-8")
    texts = _stream(spark, sf_dir, "conversations").selectExpr(f"{_REQUEST} AS request_id", "turn", "text")
    pieces = texts.select(
        "request_id", size.alias("size"), raw.alias("raw"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.length(raw) / size))).alias("seq")
    )
    cut = F.substring("raw", (F.col("seq") * F.col("size") + 1).cast("int"), F.col("size").cast("int"))
    shown = _drain(K.stream_characters(pieces.select("request_id", "seq", cut.alias("piece"))))
    return shown.select(
        F.floor(F.col("request_id") / 1000).alias("conv_id"), (F.col("request_id") % 1000).alias("turn"), (F.col("seq") + 1).alias("cut"), F.col("shown").cast("int").alias("shown")
    )
