"""Vocabulary training and encoding at full size against a known trainer, and the sample jobs under that vocabulary."""

import hashlib
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.bytepairs import merge_pairs
from corpusloom.functions.lists import row_bounds, row_runs
from corpusloom.operators import merges as MG
from corpusloom.operators import messages as M
from corpusloom.operators import vocabulary as V
from corpusloom.operators.render import render
from corpusloom.plans import jobs
from corpusloom.plans.conversation_queries import nested
from corpusloom.plans.corpus_queries import trained
from corpusloom.plans.job_queries import preference_pairs
from corpusloom.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def known(spark):
    made = tokenizers.Tokenizer(tokenizers.models.BPE())
    made.pre_tokenizer = tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False)
    trainer = tokenizers.trainers.BpeTrainer(
        vocab_size=V.fixed.VOCAB_SIZE, show_progress=False, initial_alphabet=tokenizers.pre_tokenizers.ByteLevel.alphabet(), special_tokens=V.fixed.reserved_tokens()
    )
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect() if r.text]
    made.train_from_iterator(texts, trainer=trainer)
    return made


def md5(ids):
    return hashlib.md5(",".join(map(str, ids)).encode()).hexdigest()


def test_full_vocabulary_equals_the_known_trainers(spark, known):
    assert {r.token: r.token_id for r in trained(spark, FOLDER)[0].collect()} == known.get_vocab()


@pytest.mark.parametrize("sample", [1, 40])
def test_merges_do_not_depend_on_the_sample(spark, sample):
    dice = random.Random(4)
    words = ["".join(dice.choice("abcde") for _ in range(dice.randint(1, 9))) for _ in range(300)]
    rows = spark.createDataFrame([(w,) for w in words for _ in range(dice.randint(1, 9))], "t string")
    size = len(V.base_vocabulary(spark)[0].collect()) + 60
    whole = V.train_vocabulary(rows, "t", size)[1].orderBy("rank").collect()
    assert V.train_vocabulary(rows, "t", size, sample)[1].orderBy("rank").collect() == whole
    assert V.train_vocabulary(rows.limit(0), "t", size)[1].count() == 0


def test_packed_pieces_merge_like_lists():
    dice = random.Random(8)
    pieces = [[dice.randint(0, 3) for _ in range(dice.randint(1, 9))] for _ in range(60)]
    freqs = [dice.randint(1, 5) for _ in pieces]
    batch = pa.RecordBatch.from_arrays([pa.array(pieces, pa.list_(pa.int32())), pa.array(freqs, pa.int64())], names=["symbols", "freq"])
    held = MG.Flat.of_table(MG.Flat.of_pieces(iter([batch.slice(0, 20), batch.slice(20)])).rows())

    def counted():
        return Counter(p for s, n in zip(pieces, freqs) for p in zip(s, s[1:]) for _ in range(n))

    for merge in ((0, 0, 4), (1, 2, 5), (4, 4, 6), (5, 1, 5), (3, 3, 7), (9, 9, 10)):
        before = counted()
        for i, old in enumerate(pieces):
            made = []
            while old:
                joined = tuple(old[:2]) == merge[:2]
                made, old = [*made, merge[2] if joined else old[0]], old[2 if joined else 1 :]
            pieces[i] = made
        after = counted()
        assert MG._by_pair(*held.apply(merge)) == {p: after[p] - before[p] for p in before | after if after[p] != before[p]}
    packed = [s for s in held.symbols.tolist()]
    assert packed[:1] == [-1] and [x for x in packed if x >= 0] == [x for s in pieces for x in s]


def test_tables_are_written_anew_without_change(spark, monkeypatch):
    rows = spark.createDataFrame([(f"{a}{b}{a}c",) for a in "abcdefgh" for b in "abcdefgh"], "t string")
    size = len(V.base_vocabulary(spark)[0].collect()) + 40
    whole = V.train_vocabulary(rows, "t", size)[1].orderBy("rank").collect()
    monkeypatch.setattr(MG, "REPLAYED", 3)
    assert V.train_vocabulary(rows, "t", size, 5)[1].orderBy("rank").collect() == whole


def test_merging_by_heap_is_merging_one_at_a_time():
    dice = random.Random(2)
    for _ in range(300):
        pairs = [(a + b) for a in ("a", "b", "ab", "ba", "aa") for b in ("a", "b", "ab")]
        ranks = {p: i for i, p in enumerate(dice.sample(pairs, 6))}
        parts = list("".join(dice.choice("ab") for _ in range(dice.randint(0, 14))))
        want = list(parts)
        while len(want) > 1:
            rank, at = min((ranks.get(x + y, 99), i) for i, (x, y) in enumerate(zip(want, want[1:])))
            if rank == 99:
                break
            want[at : at + 2] = [want[at] + want[at + 1]]
        assert merge_pairs(parts, lambda x, y: ranks.get(x + y)) == want


def test_ids_of_all_documents(spark, known):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["encoded_ids"](spark, FOLDER).collect():
        ids = known.encode(texts[r.doc_id] or "").ids
        assert (r.n_tokens, r.ids_md5) == (len(ids), md5(ids))


def labelled(known, ids):
    """1 on the tokens from behind a reply's opener through its closer."""
    opener, closer = known.encode("<|im_start|>assistant\n").ids, known.encode("<|im_end|>\n").ids
    mask, at = [0] * len(ids), 0
    while at < len(ids):
        if ids[at : at + len(opener)] != opener:
            at += 1
            continue
        start = end = at + len(opener)
        while end < len(ids) and ids[end : end + len(closer)] != closer:
            end += 1
        for i in range(start, min(end + len(closer), len(ids))):
            mask[i] = 1
        at = end + len(closer)
    return mask


def padded(ids, n):
    return (ids + [0] * n)[:n]


def test_text_samples(spark, known):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in QUERIES["pretrain_trained"](spark, FOLDER).collect():
        ids = padded([1, *known.encode(texts[r.doc_id]).ids[:510], 2], 512)
        assert (r.input_ids_md5, r.labels_md5) == (md5(ids), md5([i or -100 for i in ids]))


def test_chat_samples(spark, known):
    text = jobs.chat_text(F.col("conversations"), F.col("conv_id"))
    texts = {r.conv_id: r.t for r in nested(spark, FOLDER).select("conv_id", text.alias("t")).collect()}
    for r in QUERIES["chat_trained"](spark, FOLDER).collect():
        ids = padded(known.encode(texts[r.conv_id]).ids, 1024)
        labels = [i if m else -100 for i, m in zip(ids, labelled(known, ids))]
        assert (r.input_ids_md5, r.labels_md5) == (md5(ids), md5(labels))


def test_preference_samples(spark, known):
    def text(side):
        key = F.concat_ws(":", F.col("conv_id").cast("string"), F.lit(side))
        return M.strip_empty_think(render(M.full_messages(F.col(side))), key, 0.2, 42).alias(side)

    texts = {r.conv_id: r for r in preference_pairs(spark, FOLDER).select("conv_id", text("chosen"), text("rejected")).collect()}
    for r in QUERIES["preference_trained"](spark, FOLDER).collect():
        for side in ("chosen", "rejected"):
            ids = padded(known.encode(texts[r.conv_id][side]).ids, 512)
            mask = labelled(known, ids)
            assert [r[f"{c}_{side}_md5"] for c in "xy"] + [r[f"mask_{side}_md5"]] == [md5(ids[:-1]), md5(ids[1:]), md5(mask[1:])]


def test_encoding_takes_little_more_memory_than_its_batch():
    ids = {letter: i + 10 for i, letter in enumerate(V.BYTE_LETTERS)}
    rows = [[f" w{(i * 7 + k) % 997}" for k in range(300)] for i in range(3000)]
    column = pa.array([None, [], *rows, []], pa.list_(pa.string()))
    del rows
    tracemalloc.start()
    held, out = pa.total_allocated_bytes(), []
    for part in V._encode_batches(iter([column, column.slice(0, 0)]), ids, {}):
        out.append((len(part), len(part.flatten())))
        del part
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n = sum(len(f" w{(i * 7 + k) % 997}") for i in range(3000) for k in range(300))
    assert sum(rows for rows, _ in out) == len(column) and sum(tokens for _, tokens in out) == n
    assert most < 4 * column.nbytes and pa.total_allocated_bytes() <= held  # 900,000 Python strings and arrays alone are more


def test_encoding_of_rows_in_runs_and_slices(spark):
    encoder = V.Encoder(*V.base_vocabulary(spark))
    texts = ["", None, "ab 日本", "<|im_start|>x", "a" * 5000] * 300
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = {r.i: r.ids for r in df.select("i", encoder.encode(F.col("t")).alias("ids")).collect()}
    start, size = encoder.ids["<|im_start|>"], [len((t or "").encode()) for t in texts]
    assert [len(got[i]) for i in range(len(texts))] == [2 if (t or "").startswith("<|im") else n for t, n in zip(texts, size)]
    assert got[3] == [start, encoder.ids["x"]] and bytes(V.BYTE_LETTERS.index(encoder.tokens[i]) for i in got[2]).decode() == "ab 日本"
    column = pa.array([["a", "b"], None, [], ["c"] * 5, ["d"]], pa.list_(pa.string()))
    assert [p.to_pylist() for p in row_runs(column, 3)] == [[["a", "b"], None, []], [["c"] * 5], [["d"]]]
    assert row_bounds(column.slice(1)).tolist() == [0, 0, 0, 5, 6]
