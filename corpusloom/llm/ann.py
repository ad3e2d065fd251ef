"""Nearest neighbours by inner product: inverted lists scanned in column blocks with early abandoning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.scratch import draw, keep, new_folder

COLUMNS = 16  # rotated dimensions looked at before each test


class Lists:
    """Inverted lists and a rotation, fitted on a bounded sample.

    Vectors x become (x, sqrt(M^2 - |x|^2)) with M the largest norm of all vectors, queries (q, 0): the nearest by
    distance is then the one with the largest inner product. A random rotation spreads the distance evenly over
    the dimensions, so that a few of them estimate it.
    """

    def __init__(self, sample: np.ndarray, largest: float, lists: int, seed: int = 0):
        dice = np.random.Generator(np.random.PCG64(seed))
        self.largest, size = largest, sample.shape[1] + 1
        self.rotation = np.linalg.qr(dice.standard_normal((size, size)))[0]
        points = self.rows(sample)
        lists = min(lists, len(points))
        self.centres = points[dice.choice(len(points), lists, replace=False)].copy()
        for _ in range(10):
            near = self.nearest(points, 1)[:, 0]
            sums = np.zeros_like(self.centres)
            np.add.at(sums, near, points)
            count = np.bincount(near, minlength=lists)
            self.centres[count > 0] = sums[count > 0] / count[count > 0, None]

    def rows(self, x: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(0.0, self.largest**2 - (x * x).sum(axis=1)))
        return np.c_[x, extra] @ self.rotation

    def queries(self, q: np.ndarray) -> np.ndarray:
        return np.c_[q, np.zeros(len(q))] @ self.rotation

    def nearest(self, points: np.ndarray, n: int) -> np.ndarray:
        far = (self.centres**2).sum(axis=1) - 2 * points @ self.centres.T
        return np.argsort(far, axis=1, kind="stable")[:, :n]


def exact_scores(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added up dimension by dimension: the same for a row wherever it stands."""
    out = np.zeros(len(rows))
    for k in range(rows.shape[1]):
        out += rows[:, k] * q[k]
    return out


def adaptive_scan(columns: np.ndarray, q: np.ndarray, wanted: int, slack: float = 2.1, seed_rows: int = 64) -> np.ndarray:
    """Places of the rows of one list that may be among the ``wanted`` nearest.

    ``columns`` holds the rotated vectors dimension by dimension. The first rows are measured in full and give a
    distance to beat. The others are measured ``COLUMNS`` dimensions at a time; a row goes as soon as its distance so far,
    scaled to all dimensions, exceeds the one to beat by more than the sampling error allows: with d of D dimensions,
    sqrt(part x D / d) > (1 + slack / sqrt(d)) x best. ``slack`` is the number of deviations.
    """
    size, total = columns.shape
    first = min(total, max(seed_rows, 2 * wanted))
    head = ((columns[:, :first] - q[:, None]) ** 2).sum(axis=0)
    if total <= first:
        return np.arange(total)
    best = np.partition(head, wanted - 1)[wanted - 1] if first >= wanted else np.inf
    alive, part = np.arange(first, total), np.zeros(total - first)
    for low in range(0, size, COLUMNS):
        high = min(size, low + COLUMNS)
        block = columns[low:high] if len(alive) == total - first else columns[low:high, alive]
        block = block[:, first:] if block.shape[1] == total else block
        part = part + ((block - q[low:high, None]) ** 2).sum(axis=0)
        allowed = best * (high / size) * (1 + slack / np.sqrt(high)) ** 2 if high < size else best * (1 + 1e-9)
        stay = part <= allowed
        alive, part = alive[stay], part[stay]
        if not len(alive):
            break
    return np.r_[np.flatnonzero(head <= best * (1 + 1e-9)), alive]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the vectors that take part, as arrays of double; null, empty, zero and not wholly finite ones don't."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), v.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    return rows.filter((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull())).filter(finite & F.exists("v", lambda x: x != 0))


def nearest_by_product(
    vectors: DataFrame, key: str, vector: str, queries, k: int = 20, lists: int = 64, probes: int = 48,
    sample: int = 16_384, block: int = 4096,
) -> DataFrame:
    """Runs jobs. (query_id, rank, vec_id, score): the ``k`` rows with the largest inner product found for each query.

    ``queries`` is a condition on the column ``id``: which rows ask. Every usable row is indexed. Lists are fitted on at most
    ``sample`` rows, those with the smallest md5 draws of their keys; ``lists`` bounds the centres sent to the tasks. A query scans its ``probes``
    nearest lists, each in column blocks (``adaptive_scan``); survivors are scored exactly on the original vectors.
    A list is cut into blocks of about ``block`` rows that meet blocks of about ``block`` queries, so no task gets more.

    Equal vectors are one candidate with their ``k`` + 1 smallest ids, which is all that any query can use of them; equal queries
    are searched once. Vectors of another length than the most frequent one (ties: the longer) take no part. No usable vectors or no
    queries: no rows. Rows that repeat an id are one row per different vector.
    """
    spark = vectors.sparkSession
    valid = usable(vectors, key, vector)
    lengths = valid.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    shape = "query_id bigint, rank int, vec_id bigint, score double"
    if lengths is None:
        return spark.createDataFrame([], shape)
    size = lengths["n"]
    valid = valid.filter(F.size("v") == size)
    ranked = valid.distinct().withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id")))
    grouped = ranked.filter(F.col("n") <= k + 1).groupBy("v").agg(F.min("id").alias("c"), F.array_sort(F.collect_list("id")).alias("ids"))
    classes = keep(grouped, new_folder(spark, "vectors"))
    # A query's vector has a name of its own: ids may repeat with other vectors.
    asking = valid.filter(queries).select(F.col("id").alias("query_id"), F.xxhash64("v").alias("c"), "v").distinct()
    asking = keep(asking, new_folder(spark, "queries"))
    norms = classes.select(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("n"))
    largest = norms.agg(F.max("n")).first()[0]
    drawn = classes.select("v", draw(F.col("c")).alias("d"), "c").orderBy("d", "c").limit(sample)
    index = Lists(np.array([r["v"] for r in drawn.select("v").toLocalIterator()], np.float64), largest, lists)
    probes = min(probes, len(index.centres))

    def matrix(column: pa.Array) -> np.ndarray:
        return np.asarray(pa.concat_arrays(column.chunks) .flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(), dtype=np.float64).reshape(-1, size)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = index.nearest(index.rows(matrix(batch.column(2))), 1)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near, pa.int32())], names=["c", "ids", "v", "list"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                near = index.nearest(index.queries(matrix(part.column(1))), probes)
                again = pa.array(np.repeat(np.arange(part.num_rows), probes))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(again), part.column(1).take(again), pa.array(near.ravel(), pa.int32())], names=["c", "v", "list"]
                )

    filed = keep(classes.select("c", "ids", "v").mapInArrow(file, "c bigint, ids array<bigint>, v array<double>, list int"), new_folder(spark, "lists"))
    once = asking.select("c", "v").dropDuplicates(["c"])
    probing = once.mapInArrow(probe, "c bigint, v array<double>, list int")
    rows_in = filed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("rbs"))
    asks_in = probing.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("qbs"))
    cuts = keep(rows_in.join(asks_in, "list"), new_folder(spark, "cuts"))  # at most ``lists`` rows
    r = filed.join(F.broadcast(cuts), "list").select(
        "list", F.pmod(F.xxhash64("c"), F.col("rbs")).alias("rb"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("qbs").cast("bigint") - 1)).alias("qb"),
        F.lit(False).alias("asks"), "c", "ids", "v",
    )
    q = probing.join(F.broadcast(cuts), "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rbs").cast("bigint") - 1)).alias("rb"), F.pmod(F.xxhash64("c"), F.col("qbs")).alias("qb"),
        F.lit(True).alias("asks"), "c", F.array().cast("array<bigint>").alias("ids"), "v",
    )
    found_schema = pa.schema([("q", pa.int64()), ("c", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def scan(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, own = table.column("ids").combine_chunks(), table.column("c").to_numpy()
        v = matrix(table.column("v"))
        rows, order = np.flatnonzero(~asks), np.flatnonzero(asks)
        if not len(rows) or not len(order):
            return found_schema.empty_table()
        turned = np.ascontiguousarray(index.rows(v[rows]).T)
        turned_q = index.queries(v[order])
        out_q, out_r, out_s = [], [], []
        for n, at in enumerate(order):
            some = adaptive_scan(turned, turned_q[n], k + 1)
            score = exact_scores(v[rows[some]], v[at])
            best = np.lexsort((own[rows[some]], -score))[: k + 1]
            out_q.append(np.full(len(best), own[at]))
            out_r.append(rows[some[best]])
            out_s.append(score[best])
        picked = np.concatenate(out_r)
        columns = [pa.array(np.concatenate(out_q)), pa.array(own[picked]), ids.take(pa.array(picked)), pa.array(np.concatenate(out_s))]
        return pa.Table.from_arrays(columns, schema=found_schema)

    met = r.unionByName(q).groupBy("list", "rb", "qb").applyInArrow(scan, "q bigint, c bigint, ids array<bigint>, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    top = met.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n", "c")
    each = asking.select("query_id", F.col("c").alias("q")).distinct().join(top, "q").select("query_id", "score", F.explode("ids").alias("vec_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ordered = each.filter("vec_id <> query_id").withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
    return ordered.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
