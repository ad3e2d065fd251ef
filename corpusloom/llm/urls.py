"""URL filtering by the likelihood ratio of two character models, under explicit rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.scratch import fresh, keep, new_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHAPE = r"(?s)^.*?://([^/?#]*)([^?#]*)"
START = "\x02"
ALPHABET = 128.0  # the chance of a character never seen is one in so many


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), SHAPE, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), SHAPE, 2)


def best_rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """Struct (size, rule, verdict) of the longest of the rules (verdict, host, path) that fit, or null."""
    fits = []
    for verdict, h, p in rules:
        hit = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        fits.append(F.when(hit, F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array_compact(F.array(*fits)))


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """Every character of every URL with the ``order`` characters before it, as one string of order + 1."""
    padded = F.concat(F.lit(START * order), F.col("text"))
    at = F.explode(F.sequence(F.lit(1), F.length("text")))
    return urls.filter(F.length("text") > 0).withColumn("at", at).withColumn("gram", F.substring(padded, F.col("at"), F.lit(order + 1))).drop("at")


def likelihoods(grams: DataFrame, order: int) -> DataFrame:
    """(gram, lean): log of block over allow likelihood of each gram's last character after its context.

    ``grams`` has the counts ``allow`` and ``block`` of every distinct gram. Per class the model is of variable order: each order mixes
    its own frequencies with the next shorter order's estimate, the latter weighted by the number of different characters seen
    after the context (Witten-Bell). A context never seen leaves the shorter estimate as it is.
    """
    model = grams.select("gram").withColumn("p_allow", F.lit(1 / ALPHABET)).withColumn("p_block", F.lit(1 / ALPHABET))
    for k in range(order + 1):
        tail = F.expr(f"right(gram, {k + 1})")
        counts = grams.groupBy(tail.alias("tail")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        context = counts.groupBy(F.expr(f"left(tail, {k})").alias("context")).agg(
            F.sum("allow").alias("n_allow"), F.sum("block").alias("n_block"),
            F.count_if(F.col("allow") > 0).alias("u_allow"), F.count_if(F.col("block") > 0).alias("u_block"),
        )
        model = model.withColumn("tail", tail).withColumn("context", F.expr(f"left(right(gram, {k + 1}), {k})"))
        model = model.join(counts, "tail").join(context, "context")
        for side in ("allow", "block"):
            below = F.col(f"n_{side}") + F.col(f"u_{side}")
            mixed = (F.col(side) + F.col(f"u_{side}") * F.col(f"p_{side}")) / below
            model = model.withColumn(f"p_{side}", F.when(below > 0, mixed).otherwise(F.col(f"p_{side}")))
        model = model.select("gram", "p_allow", "p_block")
    return model.select("gram", F.log(F.col("p_block") / F.col("p_allow")).alias("lean"))


def threshold(held: DataFrame, bins: int = 200, reach: float = 10.0) -> float:
    """Runs a job. The score that tells the labels of ``held`` (score, label) apart best, by balanced accuracy; 0 if one is missing.

    Counted in bins of 1 / ``bins`` between -``reach`` and ``reach``, so what reaches the driver is bounded. Of equally good cuts the middle one is taken.
    """
    place = F.floor(F.greatest(F.least("score", F.lit(reach)), F.lit(-reach)) * bins).cast("int")
    counts = held.groupBy(place.alias("at")).agg(F.count_if(F.col("label") == "allow").alias("a"), F.count_if(F.col("label") == "block").alias("b")).orderBy("at").collect()
    a_all, b_all = sum(r["a"] for r in counts), sum(r["b"] for r in counts)
    if not a_all or not b_all:
        return 0.0
    best, cuts, a, b = -1.0, [], 0, 0
    for r in counts:  # block from this bin on
        good = a / a_all + (b_all - b) / b_all
        if good > best + 1e-12:
            best, cuts = good, []
        if good > best - 1e-12:
            cuts.append(r["at"] / bins)
        a, b = a + r["a"], b + r["b"]
    return cuts[len(cuts) // 2]


def judged(pages: DataFrame, url: str, rules: list[tuple[str, str, str]], order: int = 4) -> DataFrame:
    """Runs jobs. (all columns of ``pages``, host, path, rule, verdict, score): rules first, the likelihood ratio for the rest.

    The URLs that a rule judges are the labelled ones: two character models are counted from all of them but a fifth, which
    calibrates the threshold. ``score`` is the log-likelihood ratio of block over allow per character; at the threshold or above it
    means block. A null or empty URL scores 0. Each different URL is looked at once, weighted by its pages. Without labels of either
    kind every score is 0 or leans one way and the threshold is 0: then only a positive score blocks. Columns of ``pages`` named like the new ones
    are replaced.
    """
    spark = pages.sparkSession
    new = ["host", "path", "rule", "verdict", "score"]
    rest = [c for c in pages.columns if c.lower() not in new]
    text = F.coalesce(F.col(url), F.lit(""))
    seen = pages.groupBy(text.alias("text")).agg(F.count(F.lit(1)).alias("pages"))
    named = seen.withColumn("host", host(F.col("text"))).withColumn("path", path(F.col("text")))
    named = named.withColumn("fit", best_rule(rules, F.col("host"), F.col("path"))).select("text", "pages", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("label"))
    named = keep(named.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(5)) == 0), new_folder(spark, "urls"))
    learnt = F.when(F.col("held"), F.lit(0)).otherwise(F.col("pages"))
    counted = _grams(named.withColumn("a", F.when(F.col("label") == "allow", learnt).otherwise(0)).withColumn("b", F.when(F.col("label") == "block", learnt).otherwise(0)), order)
    grams = keep(counted.groupBy("gram").agg(F.sum("a").alias("allow"), F.sum("b").alias("block")), new_folder(spark, "grams"))
    model = keep(likelihoods(grams, order), new_folder(spark, "model"))
    scores = _grams(named.select("text"), order).join(model, "gram").groupBy("text").agg((F.round(F.sum("lean") / F.length("text"), 9)).alias("score"))
    scored = named.join(scores, "text", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    scored = keep(scored.drop("pages"), new_folder(spark, "scored"))
    cut = threshold(scored.filter("held AND label IS NOT NULL").select("score", "label"))
    above = (F.col("score") >= cut) & (F.col("score") > 0) if cut == 0 else F.col("score") >= cut
    said = F.coalesce("label", F.when(above, F.lit("block")).otherwise(F.lit("allow")))
    mark = fresh(rest, "text_judged")
    verdicts = scored.select(F.col("text").alias(mark), "host", "path", "rule", said.alias("verdict"), "score")
    return pages.select(*rest).join(verdicts, text == F.col(mark)).drop(mark)
