"""Clashing column names, repeated ids, and shards and scores worked out by hand."""

import math
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import ann, catalogue, lines, sharding, toxicity, urls

FOLDER = "/root/testdata/sf0.001"


def shard_of(key, weights, seed=0):
    text = ("\0null" if key is None else str(key)).encode()
    best = None
    for shard, weight in enumerate(weights):
        if weight > 0:
            h = 42
            for part in (seed.to_bytes(4, "little", signed=True), shard.to_bytes(4, "little", signed=True), text):
                h = xxhash.xxh64_intdigest(part, h)
            cost = -math.log(((h >> 11) + 0.5) / (1 << 53)) / weight
            best = min(best or (cost, shard), (cost, shard))
    return best[1]


def test_the_winning_shard_worked_out_by_hand(spark):
    keys = [*range(300), None, None, 5, -1]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id bigint")
    for weights in ([1.0] * 16, [1.0] * 17, [3.0, 0.0, 1.0], [0.5]):
        got = Counter((r.doc_id, r.shard) for r in sharding.sharded(rows, "doc_id", weights, 3).collect())
        assert got == Counter((k, shard_of(k, weights, 3)) for k in keys)


def test_shards_of_odd_documents(spark, tmp_path):
    texts = [None, "", "é", "same", "same", "long " * 50_000]
    rows = [(i if i != 2 else None, t, "en", "s", 0) for i, t in enumerate(texts)] + [(1, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalogue.QUERIES["op5_rendezvous_shards"](spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.size, r.shard, r.grown_shard) for r in got) == Counter(
        (k, len((t or "").encode()) + 1, shard_of(k, [1.0] * 16), shard_of(k, [1.0] * 17)) for k, t, *_ in rows
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_scores_worked_out_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id", "text", "toxic", ~catalogue.held_out())
    got = {r.doc_id: r.score for r in catalogue.QUERIES["op10_counterfactual_toxicity"](spark, FOLDER).collect()}
    for r in docs.collect():
        found = {t for w in toxicity.WORD.findall((r.text or "").lower()) for t in toxicity.traits(w)}
        z = model.bias + sum(w for t, w in model.weights.items() if t in found)
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-z))) < 1e-9


CLASH = ("_key", "_y", "_d", "k", "t", "toxic", "_text", "text_judged", "_line_key", "line_key", "line_dropped", "copy", "repeats", "_order", "order_drawn", "score")


def clashing(rows):
    return rows.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASH if c not in rows.columns])


def test_toxicity_with_clashing_names(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").drop("n_chars")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    plain = toxicity.fit(docs, labels, "doc_id", "text", "toxic", F.lit(True))
    odd = toxicity.fit(clashing(docs), labels.withColumn("_key", F.lit("x")).withColumn("_y", F.lit(9)), "doc_id", "text", "toxic", F.lit(True))
    assert odd.weights == plain.weights
    kept = corpus_pipeline.without_toxic(spark, clashing(docs), FOLDER)
    assert kept.columns == clashing(docs).columns and {r["score"] for r in kept.select("score").distinct().collect()} == {"own score"}


def test_url_verdicts_with_clashing_names(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url")
    plain = {r.page_id: r.verdict for r in urls.judged(pages, "url", catalogue.URL_RULES).collect()}
    odd = urls.judged(clashing(pages).drop("score"), "url", catalogue.URL_RULES).collect()
    assert {r.page_id: r.verdict for r in odd} == plain and all(r["_text"] == "own _text" and r["text_judged"] == "own text_judged" for r in odd)


def test_lines_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "one long line of text here\nother"), (2, "one long line of text here\nfree words stand here")], "doc_id bigint, text string")
    got = lines.without_near_lines(clashing(docs), "doc_id", "text")
    assert got.columns == clashing(docs).columns
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[2].text == "free words stand here" and all(r["line_key"] == "own line_key" and r["_line_dropped" if "_line_dropped" in r else "line_dropped"].startswith("own") for r in rows.values())


def test_mixing_returns_a_documents_own_columns(spark):
    docs = clashing(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    got = corpus_pipeline.mixed(spark, docs, FOLDER)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.select("copy", "repeats", "_order", "order_drawn").distinct().collect()} == {("own copy", "own repeats", "own _order", "own order_drawn")}
    plain = corpus_pipeline.mixed(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    assert [r.doc_id for r in got.select("doc_id").collect()] == [r.doc_id for r in plain.select("doc_id").collect()]


def test_an_id_with_two_vectors_asks_with_both(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 2.0]), (40, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = ann.nearest_by_product(table, "vec_id", "embedding", F.col("id") % 20 == 0, k=2, lists=2, probes=2).collect()
    by = defaultdict(list)
    for r in got:
        by[r.query_id].append((r.score, r.vec_id))
    assert sorted(by[40], reverse=True)[0] == (3.0, 1)
    assert sorted(by[20], reverse=True)[:2] == [(3.0, 1), (2.0, 2)]
