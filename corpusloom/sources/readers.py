"""JSONL readers, the corpus registry and the long-to-nested conversation reader."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import fixed
from corpusloom.functions.bind import keep_if

MESSAGE = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("role", "content", "reasoning_content", "tools", "tool_calls")]
)
PLAIN_MESSAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("role", "content")])

SCHEMAS = {
    "text": T.StructType([T.StructField("text", T.StringType())]),
    "conversation": T.StructType([T.StructField("conversations", T.ArrayType(MESSAGE))]),
    "preference": T.StructType(
        [T.StructField(n, T.ArrayType(PLAIN_MESSAGE)) for n in ("chosen", "rejected")]
    ),
    "agent": T.StructType(
        [
            T.StructField("conversations", T.ArrayType(MESSAGE)),
            T.StructField("gt", T.ArrayType(T.StringType())),
        ]
    ),
}


_ASIDE = "\U000f7a31\U000f7a32"  # private characters


def read_inferred(spark: SparkSession, path: str) -> DataFrame:
    """JSONL with the schema taken from the data (one extra pass over the files)."""
    return spark.read.json(path)


def read_declared(spark: SparkSession, path: str, kind: str = "conversation") -> DataFrame:
    """JSONL with a declared nested schema; missing fields become null, no inference pass."""
    return spark.read.schema(SCHEMAS[kind]).json(path)


def read_strict(spark: SparkSession, path: str, kind: str = "agent") -> DataFrame:
    """JSONL where any bad line fails the job."""
    return spark.read.schema(SCHEMAS[kind]).option("mode", "FAILFAST").json(path)


def leading_files(spark: SparkSession, path: str, lines: int) -> list[str]:
    """Runs jobs. The first files of ``path`` (in order of their names) that hold ``lines`` lines, or all if there are fewer.

    Files are counted in groups of 1, 2, 4, … under a limit, which ends every task after as many lines as are still wanted: nothing behind
    the group with the last line is opened, and of that group little more than is needed.
    """
    files = sorted(unquote(file) for file in spark.read.text(path).inputFiles())
    taken, group = 0, 1
    while taken < len(files) and lines > 0:
        lines -= spark.read.text(files[taken : taken + group]).limit(lines).count()
        taken, group = taken + group, 2 * group
    return files[: max(taken, 1)] or [path]


def read_tolerant(
    spark: SparkSession, path: str, kind: str = "conversation", first_lines: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """JSONL with bad bytes ignored and bad lines set aside.

    Returns (good rows, bad lines). ``first_lines`` stops after that many lines in file order, bad ones included; files
    behind them are not opened (see ``leading_files``, which runs jobs).
    """
    lines = spark.read.text(path if first_lines is None else leading_files(spark, path, first_lines))
    if first_lines is not None:
        # Splits are not scheduled in file order, so a bare limit could take other lines. Sorting
        # on the position keeps only ``first_lines`` rows per task (a top-n, not a full sort).
        place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
        lines = (
            lines.select("value", place[0].alias("_file"), place[1].alias("_block"))
            .withColumn("_row", F.monotonically_increasing_id())
            .orderBy("_file", "_block", "_row")
            .limit(first_lines)
        )
    value = F.col("value")
    # A replacement character that was in the file steps aside while bad bytes become that character.
    guarded = F.replace(value, F.lit("\ufffd"), F.lit(_ASIDE))
    repaired = F.replace(F.make_valid_utf8(guarded), F.lit("\ufffd"), F.lit(""))
    clean = F.when(F.is_valid_utf8(value), value).otherwise(F.replace(repaired, F.lit(_ASIDE), F.lit("\ufffd")))
    schema = T.StructType(list(SCHEMAS[kind].fields) + [T.StructField("_bad", T.StringType())])
    row = F.from_json(clean, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})

    def broken(r: Column) -> Column:
        return r.isNull() | r["_bad"].isNotNull()

    good_rows = lines.select(keep_if(row, lambda r: ~broken(r))).drop("_bad")
    bad_lines = lines.filter(broken(row)).select(value.alias("line"))
    return good_rows, bad_lines


def registry(spark: SparkSession) -> DataFrame:
    """The named corpora: file name, stage and row format."""
    return spark.createDataFrame(fixed.CORPORA, "file string, stage string, format string")


def register_views(spark: SparkSession, folder: str, files: list[str] | None = None) -> list[str]:
    """Register each corpus under ``folder`` as a temp view named after its file."""
    views = []
    for file, _, kind in fixed.CORPORA:
        if files is not None and file not in files:
            continue
        view = file.removesuffix(".jsonl")
        read_declared(spark, f"{folder}/{file}", kind).createOrReplaceTempView(view)
        views.append(view)
    return views


def nest_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text"
) -> DataFrame:
    """Long form (one row per turn) to one row per conversation with a message array.

    The array is the output row itself, so this is the one place where a conversation is
    gathered; operators that only need per-conversation numbers aggregate the long form.
    """
    nulls = [F.lit(None).cast("string").alias(n) for n in ("reasoning_content", "tools", "tool_calls")]
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(content).alias("content"))
    ordered = F.sort_array(F.collect_list(item))
    return turns.groupBy(conv).agg(ordered.alias("_turns")).select(
        conv,
        F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"), *nulls)).alias(
            "conversations"
        ),
    )


SCAN_PARTITIONS = "spark.corpusloom.scanPartitions"


def spread(scan: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Spread a scan over ``partitions`` tasks before heavy per-row work; nothing happens without that number.

    One file with one row group is one task, whatever its text costs to process. The caller knows whether its
    input is like that, and says so here or in the session setting ``SCAN_PARTITIONS``. With ``keys`` the rows are
    spread by them.
    """
    partitions = partitions or int(scan.sparkSession.conf.get(SCAN_PARTITIONS, "0"))
    return scan.repartition(partitions, *keys) if partitions else scan
