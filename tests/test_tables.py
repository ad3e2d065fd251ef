"""Sampling, sequences, groups, sources, vocabulary and streams on small fixtures."""

import json
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import arrays as A
from corpusloom.operators import corpus as C
from corpusloom.operators import groups as G
from corpusloom.operators import sampling as P
from corpusloom.operators import sequences as Q
from corpusloom.operators import vocabulary as V
from corpusloom.sources import readers, writers
from corpusloom.streaming import chunks as K


def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("run")


# --- sampling ----------------------------------------------------------------------------------


def test_shuffle_is_a_permutation_and_ignores_partitioning(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    one = {r["k"]: r["rank"] for r in P.shuffled(rows.repartition(1), "k").collect()}
    many = {r["k"]: r["rank"] for r in P.shuffled(rows.repartition(7), "k").collect()}
    other = {r["k"]: r["rank"] for r in P.shuffled(rows, "k", epoch=1).collect()}
    assert one == many and one != other
    assert sorted(one.values()) == list(range(1000))


@pytest.mark.parametrize("n, skip, expected", [(32, 0, 4), (33, 0, 5), (33, 4, 1), (33, 5, 0), (32, 4, 0), (3, 0, 1), (3, 1, 0)])
def test_batches(spark, n, skip, expected):
    rows = spark.range(n).withColumnRenamed("id", "rank")
    got = P.batches(rows, 8, skip).groupBy("batch_id").count().collect()
    assert len(got) == expected
    assert spark.range(1).select(P.batch_count(F.lit(n), 8, skip).alias("n")).first()["n"] == expected


def test_sample_has_exact_size(spark):
    rows = spark.range(500).withColumnRenamed("id", "k")
    sizes = [P.sample_rows(rows, "k", n).count() for n in (0, 1, 77, 500, 900)]
    assert sizes == [0, 1, 77, 500, 500]


# --- sequences ---------------------------------------------------------------------------------


def test_positions_with_one_hot_sequence(spark):
    rows = [(0, t) for t in range(3000)] + [(k, t) for k in range(1, 20) for t in range(5)]
    df = spark.createDataFrame(rows, "k int, t int")
    got = Q.number_positions(df, "k", "t", F.floor(F.col("t") / 50)).collect()
    assert all(r["pos"] == r["t"] for r in got) and len(got) == len(rows)


@pytest.mark.parametrize("block, levels", [(4, 1), (4, 2), (128, 2), (3, 3)])
def test_recurrence_against_a_loop(spark, block, levels):
    rng = random.Random(5)
    rows = [(k, t, rng.uniform(-1, 1), rng.uniform(0.5, 1)) for k, n in ((1, 200), (2, 1), (3, 17)) for t in range(n)]
    want = {}
    for k, t, a, f in sorted(rows, reverse=True):
        want[k, t] = a + f * want.get((k, t + 1), 0.0)
    df = spark.createDataFrame(rows, "k int, pos int, a double, f double")
    got = {(r["k"], r["pos"]): r["x"] for r in Q.backward_recurrence(df, "k", "a", "f", block=block, levels=levels).collect()}
    assert got.keys() == want.keys()
    assert all(got[x] == pytest.approx(want[x]) for x in want)


def test_advantages_in_rows_and_arrays_agree(spark):
    rng = random.Random(6)
    rows = [(k, t, rng.uniform(-1, 1), rng.uniform(-1, 1)) for k in range(3) for t in range(40)]
    df = spark.createDataFrame(rows, "k int, pos int, token_reward double, value double")
    long = {(r["k"], r["pos"]): r["advantage"] for r in Q.gae(df, "k", gamma=0.9, block=7).collect()}
    arrays = df.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("pos", "token_reward", "value"))).alias("s"))
    for r in arrays.select("k", Q.gae_array(F.col("s.token_reward"), F.col("s.value"), 0.9).alias("a")).collect():
        assert r["a"] == pytest.approx([long[r["k"], t] for t in range(40)])


def test_end_cut_edges(spark):
    df = spark.createDataFrame([(1, [5, 2, 7]), (2, [5, 6, 7]), (3, [2, 2]), (4, [9])], "k int, ids array<int>")
    got = df.select("k", A.first_end_position(F.col("ids")).alias("e")).orderBy("k").collect()
    assert [r["e"] for r in got] == [1, 2, 0, 0]


def test_reply_mask(spark):
    # opener 1 10 11, closer 2 11
    ids = [1, 9, 11, 5, 2, 11, 1, 10, 11, 7, 8, 2, 11, 1, 10, 11, 6]
    want = [0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 1, 1, 0, 0, 0, 1]
    df = spark.createDataFrame([(ids,), ([],)], "ids array<int>")
    got = [r["m"] for r in df.select(A.reply_mask(F.col("ids"), [1, 10, 11], [2, 11]).alias("m")).collect()]
    assert got == [want, []]


def test_reply_mask_against_a_loop(spark):
    rng = random.Random(3)
    pieces = [[1, 10, 11], [2, 11], [1, 9], [5], [11], [1, 10], [2]]
    rows, want = [], []
    for _ in range(150):
        ids = [t for _ in range(rng.randint(0, 12)) for t in rng.choice(pieces)]
        mask = [0] * len(ids)
        for o in range(len(ids)):
            if ids[o : o + 3] == [1, 10, 11]:
                closer = next((c for c in range(o + 3, len(ids)) if ids[c : c + 2] == [2, 11]), None)
                for i in range(o + 3, len(ids) if closer is None else closer + 2):
                    mask[i] = 1
        rows.append((ids,))
        want.append(mask)
    df = spark.createDataFrame(rows, "ids array<int>").coalesce(1)
    assert [r["m"] for r in df.select(A.reply_mask(F.col("ids"), [1, 10, 11], [2, 11]).alias("m")).collect()] == want


def test_padding_and_cutting(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([],), (list(range(1, 8)),)], "ids array<int>")
    c = F.col("ids")
    rows = df.select(A.pad_right(A.head(c, 4), 4).alias("r"), A.pad_left(A.tail(c, 4), 4).alias("l")).collect()
    assert [r["r"] for r in rows] == [[1, 2, 3, 0], [0, 0, 0, 0], [1, 2, 3, 4]]
    assert [r["l"] for r in rows] == [[0, 1, 2, 3], [0, 0, 0, 0], [4, 5, 6, 7]]


def test_pack_keeps_the_tail(spark):
    df = spark.createDataFrame([([1, 2, 3], [4, 5, 6], [1, 1, 0], [-1.0, -2.0, 0.0])], "p array<int>, r array<int>, m array<int>, l array<double>")
    for n, want in ((10, ([1, 2, 3, 4, 5, 6], [0, 0, 0, 1, 1, 0], [0.0, 0.0, -1.0, -2.0, 0.0], 3)), (4, ([3, 4, 5, 6], [0, 1, 1, 0], [-1.0, -2.0, 0.0], 1))):
        s = df.select(Q.pack(*[F.col(x) for x in "prml"], n).alias("s")).first()["s"]
        assert (s["ids"], s["mask"], s["logps"], s["prompt_len"]) == want


def test_group_advantage_sums_to_zero_and_survives_zero_spread(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 5.0), (2, 5.0)], "g int, r double")
    got = G.group_advantage(df, ["g"], "r").groupBy("g").agg(F.sum("advantage").alias("s"), F.max("advantage").alias("m")).orderBy("g").collect()
    assert [r["s"] for r in got] == pytest.approx([0.0, 0.0])
    assert got[1]["m"] == 0.0 and got[0]["m"] == pytest.approx(1 / 1.0001)


def test_a_third_of_all_rows_in_one_group(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("g"), (F.col("id") % 17).cast("double").alias("r")
    )
    got = G.group_advantage(rows, ["g"], "r").toPandas()
    groups = got.groupby("g")["r"]
    want = (got["r"] - groups.transform("mean")) / (groups.transform("std", ddof=0) + 1e-4)
    assert len(got) == 30000 and (got["advantage"] - want).abs().max() < 1e-9


def test_row_mean_differs_from_token_mean(spark):
    df = spark.createDataFrame([(1, 1.0, 1), (2, 3.0, 1), (2, 5.0, 1), (3, 9.0, 0)], "s int, x double, m int")
    x, m = F.col("x"), F.col("m")
    assert df.agg(G.token_mean(x, m).alias("v")).first()["v"] == pytest.approx(3.0)
    assert G.row_mean(df, ["s"], x, m).first()[0] == pytest.approx((1 + 4 + 0) / 3)
    assert G.row_mean(df, ["s"], x, m, drop_empty=True).first()[0] == pytest.approx(2.5)


# --- corpus ------------------------------------------------------------------------------------


def test_one_text_copied_many_times(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, F.lit("same ")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("t"))
    kept = C.drop_exact_copies(df, "k", "t")
    assert kept.count() == 2001 and kept.filter("trim(t) = 'same'").first()["k"] == 0


def test_overlap_needs_a_whole_window(spark):
    docs = spark.createDataFrame([(1, "x a b c d e f g h y"), (2, "a b c d e f g x h"), (3, "short one"), (4, "Short, one")], "k int, t string")
    bench = spark.createDataFrame([("A b c d e f g h",), ("short one",)], "q string")
    assert sorted(r["k"] for r in C.overlapping(docs, bench, "k", "t", "q").collect()) == [1, 3]


# --- sources -----------------------------------------------------------------------------------


def test_json_readers(spark, tmp_path_factory):
    path = folder(tmp_path_factory) / "c.jsonl"
    good = {"conversations": [{"role": "user", "content": "hi"}]}
    lines = [json.dumps(good).encode(), b"{bad", b'{"conversations": [{"role": "user", "content": "a\xffb"}]}', json.dumps(good).encode()]
    path.write_bytes(b"\n".join(lines) + b"\n")
    rows, bad = readers.read_tolerant(spark, str(path))
    assert [r["conversations"][0]["content"] for r in rows.collect()] == ["hi", "ab", "hi"]
    assert [r["line"] for r in bad.collect()] == ["{bad"]
    rows, bad = readers.read_tolerant(spark, str(path), first_lines=2)
    assert (rows.count(), bad.count()) == (1, 1)
    declared = readers.read_declared(spark, str(path)).filter("conversations is not null")
    assert declared.first()["conversations"][0]["tools"] is None
    with pytest.raises(Exception):
        readers.read_strict(spark, str(path), "conversation").collect()


def test_registry(spark, tmp_path_factory):
    place = folder(tmp_path_factory)
    (place / "dpo.jsonl").write_text(json.dumps({"chosen": [{"role": "user", "content": "q"}], "rejected": []}) + "\n")
    assert readers.registry(spark).count() == 8
    assert readers.register_views(spark, str(place), ["dpo.jsonl"]) == ["dpo"]
    assert spark.table("dpo").first()["chosen"][0]["content"] == "q"


def test_writers(spark, tmp_path_factory):
    place = str(folder(tmp_path_factory))
    samples = spark.range(20).select(F.lit(0).alias("epoch"), (F.col("id") % 2).alias("shard"), F.array("id").alias("ids"))
    writers.write_samples(samples, place + "/s")
    assert spark.read.parquet(place + "/s").count() == 20
    steps = spark.createDataFrame([("a", 1, 0.5, None), ("a", 2, 0.25, 1.0)], "run string, step bigint, loss double, kl double")
    writers.append_metrics(writers.metric_rows(steps, ["loss", "kl"]), place + "/m")
    writers.append_metrics(writers.metric_rows(steps, ["loss"]), place + "/m")
    assert spark.read.parquet(place + "/m").count() == 5


# --- vocabulary --------------------------------------------------------------------------------

TEXTS = [
    "low lower lowest newer newest wider  wide\n\nwidest",
    "You're it's  don't, 123 abc123\tüber straße",
    "你好世界，世界你好。hello world hello",
    "aaaa aaa aa banana bandana",
] * 3


def test_training_matches_a_known_trainer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer(tokenizers.models.BPE())
    reference.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=340, show_progress=False, initial_alphabet=tokenizers.pre_tokenizers.ByteLevel.alphabet(), special_tokens=V.fixed.reserved_tokens()
    )
    reference.train_from_iterator(TEXTS, trainer=trainer)
    reference.decoder = tokenizers.decoders.ByteLevel()
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    tokens, merges = V.train_vocabulary(rows, "t", 340)
    got = {r["token"]: r["token_id"] for r in tokens.collect()}
    assert got == reference.get_vocab()

    encoder = V.Encoder(tokens, merges)
    probe = ["<|im_start|>user\nhello  <think>世界</think>!<|im_end|>\n", "  lower  \n", "", "naïve 🙂 x"]
    df = spark.createDataFrame([(t,) for t in probe], "t string")
    ids = [r["i"] for r in df.select(encoder.encode(F.col("t")).alias("i")).collect()]
    assert ids == [reference.encode(t).ids for t in probe]
    back = df.select(encoder.decode(encoder.encode(F.col("t"))).alias("b")).collect()
    assert [r["b"] for r in back] == probe
    # A token list cut inside a character is not complete yet.
    cut = spark.createDataFrame([(ids[3],), (ids[3][:-3],)], "i array<int>").select(encoder.complete(F.col("i")).alias("c"))
    assert [r["c"] for r in cut.collect()] == [True, False]


def test_sketches_merge_within_their_error(spark):
    from corpusloom.operators import corpus as C

    n = 60_000
    rows = spark.range(n).select(F.repeat(F.lit("x"), ((F.col("id") * 7919) % 997 + F.col("id") % 3).cast("int")).alias("t"), (F.col("id") % 50).alias("day"), F.lit("s").alias("source"))
    rows = rows.union(spark.createDataFrame([(None, 99, "s")], "t string, day bigint, source string"))
    sizes = sorted((i * 7919) % 997 + i % 3 for i in range(n))
    for k, error in ((200, 0.02), (4096, 0.003)):
        daily = C.length_sketches(rows, "t", ["source", "day"], k)
        got = C.sketched_profile(C.merged_sketches(daily, ["source"], k), {"a": 0.1, "b": 0.5, "c": 0.99}).collect()
        assert len(got) == 1 and got[0]["n_rows"] == n
        for name, q in (("a", 0.1), ("b", 0.5), ("c", 0.99)):
            below = sum(s < got[0][name] for s in sizes) / n
            upto = sum(s <= got[0][name] for s in sizes) / n
            assert below - error <= q <= upto + error
    assert C.merged_sketches(C.length_sketches(rows.limit(0), "t", ["source", "day"]), ["source"]).count() == 0


def test_length_quantiles_of_large_groups_are_exact(spark, tmp_path):
    from corpusloom.plans import corpus_queries as Q
    from corpusloom.plans.registry import ORACLES
    from tests.compare import compare

    n = 30_000
    text = F.repeat(F.lit("x"), (F.col("id") * 7919 % 9973).cast("int"))
    rows = spark.range(n).select(F.when(F.col("id") % 10 > 0, text).alias("text"), F.when(F.col("id") % 3 > 0, "en").alias("lang"), (F.col("id") % 7).cast("string").alias("source"))
    rows.union(spark.createDataFrame([(None, "fr", None), ("", "de", None)], rows.schema)).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, "length_sketch", str(tmp_path), Q.length_sketch, ORACLES["length_sketch"]) is None


def test_reserved_tokens():
    tokens = V.fixed.reserved_tokens()
    assert len(tokens) == 36 and tokens[:3] == ["<|endoftext|>", "<|im_start|>", "<|im_end|>"]
    assert tokens.index("<tool_call>") == 21 and tokens.index("</think>") == 26 and tokens[27] == "<|buffer1|>"


# --- streams -----------------------------------------------------------------------------------


def drain(spark, stream, place, mode="append"):
    q = stream.writeStream.format("memory").queryName("t" + place.name).outputMode(mode).option("checkpointLocation", str(place / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table("t" + place.name)


def test_stream_out_of_order_with_a_cut_tag(spark, tmp_path_factory):
    place = folder(tmp_path_factory)
    source = place / "in"
    source.mkdir()
    parts = [(1, 0, "why "), (1, 1, "so</thi"), (1, 2, "nk>\n"), (1, 3, "\nanswer"), (1, 4, None), (2, 0, "never </th"), (2, 1, None)]
    for i, index in enumerate([2, 0, 6, 4, 1, 5, 3]):
        r, s, c = parts[index]
        (source / f"{i}.json").write_text(json.dumps({"request_id": r, "seq": s, "chunk": c}))
    schema = "request_id bigint, seq bigint, chunk string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(source))
    deltas = drain(spark, K.stream_deltas(stream), place).orderBy("request_id", "part").collect()
    text = {}
    assert [(d["request_id"], d["finish_reason"]) for d in deltas if d["kind"] == "finish"] == [(1, "stop"), (2, "stop")]
    for d in deltas:
        if d["kind"] == "finish":
            continue
        text[d["request_id"], d["kind"]] = text.get((d["request_id"], d["kind"]), "") + d["text"]
    assert text == {(1, "reasoning"): "why so", (1, "content"): "answer", (2, "reasoning"): "never </th"}

    # Repeats and chunks behind the end change nothing; a request that stays silent is ended.
    late = folder(tmp_path_factory)
    source = late / "in"
    source.mkdir()
    again = [(1, 0, "a</think>b"), (1, 0, "a</think>b"), (1, 1, None), (1, 0, "again"), (1, 2, "late"), (2, 0, "open"), (2, 2, "gap")]
    again += [(3, 0, "x"), (3, 1, None), (4, 0, "y")]
    for i, (r, s, c) in enumerate(again):
        at = f"2024-01-0{1 if r < 3 else r} 00:00:{i:02d}"
        (source / f"{i}.json").write_text(json.dumps({"request_id": r, "seq": s, "chunk": c, "at": at}))
        os.utime(source / f"{i}.json", (1.7e9 + i, 1.7e9 + i))  # the order in which files are taken
    timed = spark.readStream.schema(schema + ", at timestamp").option("maxFilesPerTrigger", 1).json(str(source))
    rows = drain(spark, K.stream_deltas(timed.withWatermark("at", "1 second"), at="at", idle_ms=60_000), late).collect()
    assert sorted((r["request_id"], r["kind"], r["text"] or "") for r in rows) == [
        (1, "content", "b"), (1, "finish", ""), (1, "reasoning", "a"), (2, "finish", ""), (2, "reasoning", "open"),
        (3, "finish", ""), (3, "reasoning", "x"), (4, "reasoning", "y"),
    ]

    other = folder(tmp_path_factory)
    grouped = drain(spark, K.split_responses(stream).select("request_id", "reasoning", "content"), other, "complete")
    assert sorted(map(tuple, grouped.collect())) == [(1, "why so", "answer"), (2, "never </th", "")]


def test_shown_prefix_holds_back_cut_characters(spark):
    raw = "é你🙂".encode()
    df = spark.createDataFrame([(raw[:n],) for n in range(len(raw) + 1)], "b binary")
    got = [bytes(r["p"]).decode() for r in df.select(K.showable_prefix(F.col("b")).alias("p")).collect()]
    assert got == ["", "", "é", "é", "é", "é你", "é你", "é你", "é你", "é你🙂"]


def test_checkpoint_folder_comes_from_the_session(spark):
    from corpusloom.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_equal_symbols_merge_in_the_trainers_order(spark):
    words = spark.createDataFrame([("aaa",)] * 100 + [("cd",)] * 60, "t string")
    size = len(V.base_vocabulary(spark)[0].collect()) + 3
    merges = V.train_vocabulary(words, "t", size)[1].orderBy("rank").collect()
    assert [(m["left"], m["right"]) for m in merges] == [("a", "a"), ("aa", "a"), ("c", "d")]


def test_encoder_takes_nulls_and_empty_texts(spark):
    encoder = V.Encoder(*V.base_vocabulary(spark))
    df = spark.createDataFrame([("aé",), (None,), ("",)], "t string").coalesce(1)
    rows = df.select("t", encoder.encode(F.col("t")).alias("ids")).select(
        "t", "ids", encoder.decode(F.col("ids")).alias("back"), encoder.lossy_text(F.slice("ids", 1, 2)).alias("cut")
    )
    got = {r["t"]: (len(r["ids"]), r["back"], r["cut"]) for r in rows.collect()}
    assert got == {"aé": (3, "aé", "a\ufffd"), None: (0, "", ""), "": (0, "", "")}


def test_values_behind_the_end_token_do_not_count(spark):
    rows = [(1, i, 0.5, float(i), int(i < 3)) for i in range(6)]
    df = spark.createDataFrame(rows, "k int, pos bigint, token_reward double, value double, mask int")
    cut = [(1, i, 0.5, float(i) * m, m) for _, i, _, _, m in rows]
    plain = spark.createDataFrame(cut, df.schema)
    got = {r["pos"]: (r["advantage"], r["returns"]) for r in Q.gae(df, "k", gamma=0.9, block=4, mask="mask").collect()}
    assert got == {r["pos"]: (r["advantage"], r["returns"]) for r in Q.gae(plain, "k", gamma=0.9, block=4).collect()}
    arrays = df.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("pos", "token_reward", "value", "mask"))).alias("s"))
    made = arrays.select(Q.gae_array(F.col("s.token_reward"), F.col("s.value"), 0.9, mask=F.col("s.mask")).alias("a")).first()["a"]
    assert all(abs(made[i] - got[i][0]) < 1e-12 for i in range(6))


def test_padding_is_no_end_and_no_last_position(spark):
    rows = [(1, 0, "x", False), (1, 1, "end", True), (1, 2, "x", False), (1, 3, "x", True), (2, 0, "end", True)]
    df = spark.createDataFrame(rows, "k int, pos bigint, t string, pad boolean")
    cut = Q.cut_at_end(df, "k", F.col("t") == "end", padding=F.col("pad")).orderBy("k", "pos").collect()
    assert [(r["end_pos"], r["mask"]) for r in cut] == [(2, 1), (2, 0), (2, 1), (2, 0), (None, 0)]


def test_valid_replacement_characters_stay(spark, tmp_path_factory):
    path = folder(tmp_path_factory) / "r.jsonl"
    path.write_bytes(json.dumps({"text": "a\ufffdb"}, ensure_ascii=False).encode() [:-2] + b'\xff"}\n')
    rows, _ = readers.read_tolerant(spark, str(path), "text")
    assert [r["text"] for r in rows.collect()] == ["a\ufffdb"]


def test_blank_benchmark_items_match_nothing(spark):
    docs = spark.createDataFrame([(1, ""), (2, "a b c"), (3, None)], "id int, text string")
    bench = spark.createDataFrame([("  ",), ("",), ("a b c",)], "text string")
    assert [r["id"] for r in C.overlapping(docs, bench, "id", "text", "text").collect()] == [2]


def test_hot_keys_are_split(spark):
    """With broadcasting off and low thresholds the final plan has a skewed join for each of these."""
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        n = 60_000
        hot = spark.range(0, n, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"), F.rand(1).alias("value")
        )
        found = [
            G.group_advantage(hot, ["k"], "value"),
            Q.cut_at_end(hot.withColumnRenamed("id", "pos"), "k", F.col("value") > 0.9),
        ]
        for df in found:
            assert df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_last_query_in_rows_and_arrays(spark):
    from corpusloom.functions import fixed
    from corpusloom.operators import messages as M
    from corpusloom.sources.readers import nest_turns

    wrapped = f"{fixed.RESPONSE_OPEN}x{fixed.RESPONSE_CLOSE}"
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", wrapped), (2, 0, "assistant", "a"), (2, 1, "system", None), (3, 0, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    long = {r["conv_id"]: r["query_turn"] for r in M.last_query_turn(turns).collect()}
    nested = nest_turns(turns).select("conv_id", M.last_query_index(F.col("conversations")).alias("i")).collect()
    assert long == {r["conv_id"]: r["i"] for r in nested}
    assert sorted((r["conv_id"], r["turn"]) for r in M.recent_turns(turns, 2).collect()) == [(1, 1), (1, 2), (2, 0), (2, 1), (3, 0)]
