"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import ann, bytebpe, decontaminate, infill, lines, mixing, secrets, sharding, simhash, spelling, toxicity, urls, warc
from corpusloom.llm.scratch import keep, new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    """
WITH counted AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rates AS (
  SELECT source, (SELECT count(*) FROM documents)::DOUBLE * (1.0::DOUBLE / (SELECT count(*) FROM counted)) / n AS rate
  FROM counted),
steps AS (
  SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1.0)) AS p
  FROM rates, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 12) AS BIGINT))) AS k)),
cdfs AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM steps),
tables AS (SELECT source, list(c ORDER BY k) AS cdf FROM cdfs GROUP BY source),
drawn AS (
  SELECT d.*, len(list_filter(t.cdf, lambda c: c < CAST(concat('0x', substr(md5(concat('7|', d.doc_id)), 1, 13)) AS BIGINT)
    / 4503599627370496.0)) AS repeats
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT * EXCLUDE (text), text, unnest(generate_series(0, repeats - 1)) AS copy FROM drawn WHERE repeats > 0)
SELECT doc_id, source, CAST(repeats AS INTEGER) AS repeats, CAST(copy AS INTEGER) AS copy, md5(text) AS text_md5,
  row_number() OVER (ORDER BY md5(concat('order|7|', doc_id, '|', copy)), doc_id, copy) - 1 AS position
FROM copies
"""
)
def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources at equal weight, the mix as large as the corpus, in one global order."""
    mixed = mixing.replicated(table(spark, sf_dir, "documents"), "doc_id", "source", seed=7)
    placed = mixing.shuffled(mixed, "doc_id", seed=7)
    return placed.select("doc_id", "source", "repeats", "copy", F.md5(F.col("text").cast("binary")).alias("text_md5"), F.col("position").cast("bigint").alias("position"))


@query()
def op3_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, whether it holds a benchmark passage, and which items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.tag_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaked_items") > 0).alias("leaked"), F.col("leaked_items").alias("item_ids"))


@query()
def op5_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over 16 shards of equal weight by doc_id, and where a seventeenth would put them."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = sharding.sharded(docs, "doc_id", [1.0] * 16)
    placed = sharding.sharded(placed, "doc_id", [1.0] * 17, shard="grown_shard")
    slots = sharding.slotted(placed, "shard", "doc_id", ["text_crc32", "size"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query()
def op6_segment_popcount_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word SimHash of every document and its component at 4 bits."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), "doc_id", "text", words=4, distance=4)
    return found.select(
        F.col("key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id")
    )


def held_out(key: str = "doc_id"):
    """The fold no label is learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


@query()
def op10_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, from a classifier fitted on the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic", ~held_out())
    judged = toxicity.scored(docs, "text", model)
    return judged.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op1_adaptive_dimension_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector."""
    return ann.nearest_by_product(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0)


DIGIT = "CAST(concat('0x', substr(sha1(coalesce(html, '')), {at}, 5)) AS BIGINT)"
LETTERS = " || ".join(
    f"substr('{warc.BASE32}', CAST((({DIGIT.format(at=5 * part + 1)} >> {15 - 5 * n}) & 31) + 1 AS BIGINT), 1)"
    for part in range(8)
    for n in range(4)
)


@query(
    f"""
WITH summed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, {LETTERS} AS payload_digest FROM pages),
lasts AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM summed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to, TRUE AS intact
FROM lasts
"""
)
def op4_warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages into WARC archives and back, their captures merged into one order."""
    pages = warc.with_revisits(table(spark, sf_dir, "pages"), "page_id", "html")
    folder = new_folder(spark, "warc")
    warc.write_archives(pages, folder, "page_id", "url", "html")
    runs = keep(warc.captures(spark, folder), new_folder(spark, "runs"))
    merged = warc.histories(runs)
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@query()
def op7_secret_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, open and under encodings."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"), "doc_id", "text")

    def joined(spans: str):
        names = F.array(*[F.lit(k) for k in secrets.KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = [count(kind).alias(f"n_{name}") for kind, name in enumerate(secrets.KINDS)]
    return found.select(F.col("key").alias("doc_id"), *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query()
def op8_url_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    found = urls.judged(table(spark, sf_dir, "pages").select("page_id", "url"), "url", URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict", "score")


@query()
def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document, its number of lines and those that repeat an earlier or nearly equal line."""
    found = lines.fuzzy_lines(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(F.col("key").alias("doc_id"), "lines", F.size("dropped").alias("n_dropped"), F.array_join("dropped", ",").alias("dropped"))


@query()
def op11_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document under a public byte-level vocabulary, and the bytes they decode to."""
    import public_tokenizers

    ranks = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bytebpe.encoded(table(spark, sf_dir, "documents"), "doc_id", "text", ranks, public_tokenizers.PATTERN)
    back = bytebpe.decoded(coded, "ids", bytebpe.token_bytes(spark, ranks))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return back.select(
        F.col("key").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def _crc_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text of code points below 256; a byte is taken in and then shifted out bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    octets = f"flatten(list_transform({codes}, lambda c: CASE WHEN c < 128 THEN [c::BIGINT] ELSE [(192 | (c >> 6))::BIGINT, (128 | (c & 63))::BIGINT] END))"
    steps = f"flatten(list_transform({octets}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)"
        " ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT)"
    )


@query(
    f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{spelling.UPPER}', '{spelling.LOWER}') AS run
  FROM documents),
counted AS (SELECT k, run, count(*) AS c FROM runs WHERE length(run) >= 7 GROUP BY k, run),
hashed AS (SELECT run, c, {_crc_sql("k || ':' || run")} AS h FROM counted),
observed AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM observed WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cuts AS MATERIALIZED (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT DISTINCT a, b FROM (
    SELECT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION ALL SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
    UNION ALL SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word)),
best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS form, max(w.n) AS form_n FROM pairs JOIN words w ON w.word = b GROUP BY a),
forms AS MATERIALIZED (
  SELECT w.word, CASE WHEN form_n >= 10 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
way AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT y.word, f.form FROM way y JOIN forms f ON f.word = y.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, y.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN way y ON y.word = f.word JOIN forms e ON e.word = y.at WHERE e.form IS NULL
"""
)
def op12_composed_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, the frequent word it is one edit from, and where that leads."""
    return spelling.variants(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST(concat('0x', substr(hex, 1, 8)) AS BIGINT) AS h1, CAST(concat('0x', substr(hex, 9, 8)) AS BIGINT) AS h2,
    CAST(concat('0x', substr(hex, 17, 8)) AS BIGINT) AS h3, CAST(concat('0x', substr(hex, 25, 8)) AS BIGINT) AS h4 FROM units),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
      WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
)
def op13_seekable_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rewritten for infilling, and rebuilt from the result."""
    made = infill.transformed(infill.stored(table(spark, sf_dir, "documents"), "doc_id", "text"), seed=7)
    return made.select(
        F.col("key").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        infill.digest("output").alias("output_sha256"), infill.digest(infill.restored("output", "form")).alias("restored_sha256"),
    )
