"""Corpus tables: exact duplicates, licences, quality filters, overlap with benchmarks, profiles."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.bind import let
from corpusloom.functions.text import ngrams, strip, words
from corpusloom.session import settled


def drop_exact_copies(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Runs jobs. Keep the row with the smallest key of each distinct (stripped) text; null texts stay.

    Texts never travel. (hash, key) pairs are reduced to the smallest key of each repeated hash, with
    partial minimums first, so a text copied a billion times reaches its reducer as one row per map
    task. Those are written out (see ``settled``) before they meet the pairs again, so that the join can
    split a hot hash. The keys of the later copies, written too, become an anti-join filter.
    """
    hashed = rows.select(key, F.sha2(strip(F.col(text)), 256).alias("_h"))
    repeated = hashed.groupBy("_h").agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = settled(repeated.select("_h", "_first"))
    later = hashed.join(repeated, "_h").filter(F.col(key) != F.col("_first")).select(key)
    return rows.join(settled(later), key, "left_anti")


def licensed(rows: DataFrame, licences: DataFrame, allowed: list[str], source: str = "source") -> DataFrame:
    """Rows whose source has one of the allowed licences; ``licences`` is (source, licence)."""
    permitted = licences.filter(F.col("licence").isin(allowed)).select(source)
    return rows.join(permitted, source, "left_semi")


def clean(
    rows: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    min_chars: int = 1,
    max_chars: int | None = None,
    langs: list[str] | None = None,
    quality: int | None = None,
    toxic: int | None = None,
) -> DataFrame:
    """Length, language and label conditions in one pass; labels are joined only if asked for."""
    size = F.length(text)
    kept = rows.filter(size >= min_chars)
    if max_chars is not None:
        kept = kept.filter(size <= max_chars)
    if langs is not None:
        kept = kept.filter(F.col(lang).isin(langs))
    if quality is not None or toxic is not None:
        wanted = labels
        if quality is not None:
            wanted = wanted.filter(F.col("quality") == quality)
        if toxic is not None:
            wanted = wanted.filter(F.col("toxic") == toxic)
        kept = kept.join(wanted.select(key), key, "left_semi")
    return kept


def word_windows(text: Column, n: int) -> Column:
    """Distinct n-word windows of a text; a shorter text is its own single window, one without words has none."""

    def windows(w: Column) -> Column:
        whole = F.when(F.size(w) > 0, F.array(F.array_join(w, " "))).otherwise(F.array().cast("array<string>"))
        return F.when(F.size(w) < n, whole).otherwise(F.array_distinct(ngrams(w, n)))

    return let(words(text), windows)


def window_hashes(text: Column, n: int) -> Column:
    """Distinct 64-bit hashes of the windows of ``word_windows``, without building their strings."""

    def hashes(w: Column) -> Column:
        whole = F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
        runs = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) < n, whole).otherwise(F.array_distinct(runs))

    return let(words(text), hashes)


def overlapping(rows: DataFrame, benchmark: DataFrame, key: str, text: str, item_text: str, n: int = 8) -> DataFrame:
    """Runs jobs. Keys of rows that share an n-word window with any benchmark item.

    Rows offer the hashes of their windows; a semi-join to the benchmark's, written out first so that a
    hash many rows share can be split, leaves few rows. Only those build their windows and are
    compared word by word. Texts without words have no window.
    """
    bench = settled(benchmark.select(F.explode(window_hashes(F.col(item_text), n)).alias("hash")).distinct())
    seen = rows.select(key, F.explode(window_hashes(F.col(text), n)).alias("hash"))
    likely = settled(seen.join(bench, "hash", "left_semi").select(key).distinct())
    items = settled(benchmark.select(F.explode(word_windows(F.col(item_text), n)).alias("window")).distinct())
    exact = rows.select(key, text).join(likely, key, "left_semi").select(key, F.explode(word_windows(F.col(text), n)).alias("window"))
    return exact.join(items, "window", "left_semi").select(key).distinct()


def without_overlap(rows: DataFrame, benchmark: DataFrame, key: str, text: str, item_text: str, n: int = 8) -> DataFrame:
    """Rows that share no n-word window with the benchmark.

    The keys found are written out first (see ``settled``), so texts only move when there are
    too many of them to broadcast.
    """
    return rows.join(settled(overlapping(rows, benchmark, key, text, item_text, n)), key, "left_anti")


def length_profile(rows: DataFrame, text: str, by: str, limit: int, bin_width: int = 500) -> DataFrame:
    """Per group: rows, mean, median and 90th percentile length, share cut and share padded at ``limit``.

    Lengths are counted first. Percentiles then come from a running sum over (group, length)
    counts, which has at most one row per distinct length.
    """
    counts = rows.groupBy(by, F.length(text).cast("bigint").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(by).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    whole = counts.groupBy(by).agg(F.sum("c").alias("total"))
    running = counts.withColumn("upto", F.sum("c").over(upto)).join(whole, by)

    def at(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * F.lit(q)), F.col("n")))

    return running.groupBy(by).agg(
        F.sum("c").alias("n_rows"),
        (F.sum(F.col("n") * F.col("c")) / F.sum("c")).alias("mean_chars"),
        at(0.5).alias("p50"),
        at(0.9).alias("p90"),
        F.max("n").alias("max_chars"),
        (F.sum(F.when(F.col("n") > limit, F.col("c")).otherwise(0)) / F.sum("c")).alias("share_truncated"),
        (F.sum(F.when(F.col("n") < limit, F.col("c")).otherwise(0)) / F.sum("c")).alias("share_padded"),
    )


def length_sketches(rows: DataFrame, text: str, by: list[str], k: int = 4096) -> DataFrame:
    """(…by, n_rows, sketch): a KLL sketch of the text lengths of each group, to be kept as a table and merged later.

    A sketch holds about ``k`` lengths at most. Up to that many it is exact; beyond, the rank of a quantile is off by about 1.7 / k^0.9
    of the rows (0.1 % at 4,096) with 99 % confidence. Null texts have no length and aren't counted.
    """
    size = F.length(text).cast("bigint")
    return rows.groupBy(*by).agg(F.count(size).alias("n_rows"), F.kll_sketch_agg_bigint(size, k).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str], k: int = 4096) -> DataFrame:
    """The sketches of coarser groups from those of finer ones, without the rows: (…by, n_rows, sketch)."""
    filled = sketches.filter("n_rows > 0")
    return filled.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.kll_merge_agg_bigint("sketch", k).alias("sketch"))


def sketched_profile(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """The named quantiles of every sketch, in place of it."""
    rest = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*rest, *[F.kll_sketch_get_quantile_bigint("sketch", F.lit(q)).alias(name) for name, q in quantiles.items()])


def length_counts(rows: DataFrame, text: str, by: list[str]) -> DataFrame:
    """(…by, size, n_rows): how many texts of each length a group has, to be kept as a table and merged later; the length of a null text is null."""
    return rows.groupBy(*by, F.length(text).cast("bigint").alias("size")).agg(F.count(F.lit(1)).alias("n_rows"))


def merged_counts(counts: DataFrame, by: list[str]) -> DataFrame:
    """The length counts of coarser groups from those of finer ones, without the rows."""
    return counts.groupBy(*by, "size").agg(F.sum("n_rows").alias("n_rows"))


def counted_profile(counts: DataFrame, by: list[str], quantiles: dict[str, str]) -> DataFrame:
    """(…by, n_rows, …quantiles) from length counts: exact, the smallest length that the given share (a decimal, as text) of the texts doesn't exceed.

    Null texts are rows without a length. A group has one row per distinct length here, however many texts it has.
    """
    known = F.when(F.col("size").isNull(), 0).otherwise(F.col("n_rows"))
    upto = Window.partitionBy(*by).orderBy(F.asc_nulls_first("size")).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.select(*by, "size", "n_rows", F.sum(known).over(upto).alias("upto"), F.sum(known).over(Window.partitionBy(*by)).alias("known"))

    def at(share: str) -> Column:
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("known") * F.lit(Decimal(share))), F.col("size")))

    return running.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *[at(share).alias(name) for name, share in quantiles.items()])


def length_histogram(rows: DataFrame, text: str, by: str, bin_width: int = 500) -> DataFrame:
    return rows.groupBy(by, F.floor(F.length(text) / F.lit(bin_width)).cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def compression(rows: DataFrame, text: str, n_tokens: Column, by: str | None = None) -> DataFrame:
    """Characters per token: the mean of the ratios of the single texts."""
    rated = rows.withColumn("_t", n_tokens).filter(F.col("_t") > 0)
    grouped = rated.groupBy(by) if by else rated.groupBy()
    return grouped.agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.length(text) / F.col("_t")).alias("chars_per_token")
    )


def perplexity(nll: Column) -> Column:
    """Aggregate: exponential of the mean negative log-likelihood per token."""
    return F.exp(F.avg(nll))


def bits_per_byte(nll: Column, text_bytes: Column) -> Column:
    """Aggregate: summed negative log-likelihood in bits over the text's bytes."""
    return F.sum(nll) / (F.log(F.lit(2.0)) * F.sum(text_bytes))
