"""Byte-level BPE, spelling variants and infilling against brute force, with nulls, ties, repeats, long texts and empty tables."""

import hashlib
import random
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F

from corpusloom.llm import bytebpe, catalogue, infill, spelling

FOLDER = "/root/testdata/sf0.001"
TEXTS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def ranks():
    return bytebpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def known(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(raw):
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


# 11 ------------------------------------------------------------------------------------------------


def test_ids_of_the_whole_table(spark, known):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = catalogue.QUERIES["op11_distinct_word_bpe"](spark, FOLDER).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = known.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(texts[r.doc_id]))


def test_every_kind_of_code_point(ranks, known):
    pieces = bytebpe.regex.compile(public_tokenizers.PATTERN)
    for start in range(0, 0x110000, 0x1000):
        codes = [c for c in range(start, start + 0x1000, 7) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{chr(c)}b 1{chr(c)} x{chr(c)}{chr(c)}!" for c in codes)
        assert [i for w in pieces.findall(text) for i in bytebpe.word_ids(w.encode(), ranks)] == known.encode_ordinary(text)


def test_decoding_holds_the_bytes_of_a_few_rows(ranks):
    tokens = sorted(ranks.items(), key=lambda x: x[1])
    assert [n for _, n in tokens] == list(range(len(tokens)))
    ids = [list(range(k % 50, 300 + k % 50)) for k in range(2000)] + [None, [], [10**8]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2003)), pa.array(ids, pa.list_(pa.int32()))], names=["key", "ids"])
    found = list(bytebpe._looked_up(iter([batch]), pa.array([w for w, _ in tokens], pa.large_binary()), 1, "decoded"))
    assert max(b.num_rows for b in found) <= bytebpe.ROWS_OUT and [k for b in found for k in b.column(0).to_pylist()] == list(range(2003))
    want = [b"".join(tokens[i][0] for i in row) for row in ids[:2000]] + [None, b"", None]
    assert [t for b in found for t in b.column(2).to_pylist()] == want


def test_encoding_odd_rows(spark, ranks, known, monkeypatch):
    monkeypatch.setattr(bytebpe, "BLOCK_CHARS", 500)
    dice = random.Random(3)
    long = "".join(dice.choice(["tion", " the", "\n", "é", "ß", " ", "7", "日本", "😀"]) for _ in range(20000))
    texts = [None, "", " ", "\n\n \t x", "<|endoftext|>", "a" * 5000, long, "same", "same", "I'll 'S it's", "  x 　y", "\x00\x1c\x85"]
    rows = [(i if i != 4 else None, t, "word", 9, b"x") for i, t in enumerate(texts)] + [(1, "again", "w", 1, b"")]
    docs = spark.createDataFrame(rows, f"{TEXTS}, word string, block int, ids binary").repartition(3)
    coded = bytebpe.encoded(docs, "doc_id", "text", ranks, public_tokenizers.PATTERN)
    back = bytebpe.decoded(coded, "ids", bytebpe.token_bytes(spark, ranks)).collect()
    want = Counter((k, tuple(known.encode_ordinary(t or "")), (t or "").encode()) for k, t, *_ in rows)
    assert Counter((r.key, tuple(r.ids), bytes(r.decoded)) for r in back) == want
    assert bytebpe.encoded(docs.limit(0), "doc_id", "text", ranks, public_tokenizers.PATTERN).count() == 0
    nothing = docs.withColumn("text", F.lit(None).cast("string"))
    assert {tuple(r.ids) for r in bytebpe.encoded(nothing, "doc_id", "text", ranks, public_tokenizers.PATTERN).collect()} == {()}


def test_decoding_unknown_ids_and_taken_names(spark, ranks):
    rows = spark.createDataFrame([(1, [0, 1]), (2, [999999]), (3, None), (4, []), (5, [0, None]), (6, [-1])], "k int, ids array<int>")
    tokens = bytebpe.token_bytes(spark, ranks)
    got = {r.k: r.decoded for r in bytebpe.decoded(rows, "ids", tokens).collect()}
    by_id = {i: t for t, i in ranks.items()}
    assert got == {1: by_id[0] + by_id[1], 2: None, 3: None, 4: b"", 5: None, 6: None}
    assert bytebpe.decoded(rows, "ids", tokens.limit(0)).filter("decoded IS NOT NULL").count() == 1
    with pytest.raises(ValueError):
        bytebpe.decoded(rows.withColumn("Decoded", F.lit(1)), "ids", tokens)


# 12 ------------------------------------------------------------------------------------------------


def near(u, v):
    u, v = sorted((u, v), key=len)
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def variants_by_force(rows):
    import re

    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            seen[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 7 and c >= 2}
    by_rest = {}
    for w in n:
        for rest in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by_rest.setdefault(rest, set()).add(w)
    out = {}
    for w in n:
        close = {x for rest in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))} for x in by_rest[rest] if near(w, x)}
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= 10 * n[w] else None
        out[w] = (form, n[w], len(close), n[form] if form else None)
    roots = {}
    for w in n:
        at = w
        while out[at][0]:
            at = out[at][0]
        roots[w] = at
    return {(w, f, roots[w], c, k, fn) for w, (f, c, k, fn) in out.items()}


def variants(docs, **more):
    return {tuple(r) for r in spelling.variants(docs, "doc_id", "text", **more).collect()}


def test_pairs_of_the_composition():
    dice = random.Random(1)
    for _ in range(150):
        size, letters = dice.randint(0, 5), "abc"[: dice.randint(1, 3)]
        short, long = (sorted({"".join(dice.choice(letters) for _ in range(n)) for _ in range(dice.randint(0, 25))}) for n in (size, size + 1))
        for within in (None, 0, 2):
            got = [tuple(sorted(p)) for p in spelling.one_edit_pairs(short, long, within)]
            want = set()
            for i, a in enumerate(short):
                for b in short[i + 1 :] + long:
                    first = next((k for k in range(size) if a[k] != b[k]), size)
                    if near(a, b) and (within is None or first < within):
                        want.add(tuple(sorted((a, b))))
            assert len(got) == len(set(got)) and set(got) == want


def test_acceptor_shares_equal_states():
    machine = spelling.Acceptor()
    start = machine.start(sorted(a + b + "xyz" for a in "abc" for b in "de"))
    assert len(machine.arcs) == 6 and sorted(machine.residual(start))[0] == "adxyz"


@pytest.mark.parametrize("most", [20_000, 3])
def test_variants_with_hot_partitions(spark, most):
    dice = random.Random(8)
    stems = ["".join(dice.choice("abcdefgé") for _ in range(dice.randint(7, 11))) for _ in range(12)]
    words = [w for w in stems for _ in range(60)]
    for w in stems:
        for _ in range(8):
            i, c = dice.randrange(len(w)), dice.choice("abcdefgé")
            words += [dice.choice((w[:i] + c + w[i + 1 :], w[:i] + c + w[i:], w[:i] + w[i + 1 :]))] * dice.randint(1, 7)
    words += ["samefir" + a for a in "abcdefgh"] * 2 + ["samefir" + a + b for a in "abc" for b in "ab"] * 3 + [a + "samelast" for a in "uvwxyz"] * 2
    dice.shuffle(words)
    rows = [(i % 50, " ".join(words[i::60])) for i in range(60)]
    docs = spark.createDataFrame(rows, TEXTS)
    assert variants(docs, most=most) == variants_by_force(rows)


def test_variants_of_odd_rows(spark):
    chain = ["abcdefgh"] * 500 + ["abcdefgx"] * 40 + ["abcdefyx"] * 3
    rows = [(1, None), (2, ""), (None, "Größere größere GRÖSSERE ×÷×÷×÷×÷ ×÷×÷×÷×÷"), (4, " ".join(chain)), (4, " ".join(chain)), (5, "z" * 30000), (5, "z" * 30000)]
    rows += [(6, "tiedone1 tiedonea tiedonea tiedoneb tiedoneb tiedonec tiedonec")]
    docs = spark.createDataFrame([(k, t, "w", 1) for k, t in rows], f"{TEXTS}, word string, n int")
    got = variants(docs)
    assert got == variants_by_force(rows)
    assert next(r for r in got if r[0] == "abcdefyx")[1:3] == ("abcdefgx", "abcdefgh")
    assert variants(docs.limit(0)) == set() and variants(docs.filter("text IS NULL")) == set()


# 13 ------------------------------------------------------------------------------------------------


def rewritten_by_force(key, text, seed, rate=100, spm=50):
    import re

    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexed = sha(f"{seed}:{'' if key is None else key}")
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in infill.MARKS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def joined(frames):
    return b"".join(zstandard.decompress(f) for f in frames).decode()


@pytest.mark.parametrize("size", [4, 7, 64, infill.FRAME_BYTES])
def test_infilling_and_back(spark, size):
    dice = random.Random(size)
    texts = ["".join(dice.choice(["a", "\n", "é ", "日本", "😀", "xy", "\r\n", "<", ">", "<P", "S>", "M"]) for _ in range(dice.randint(0, 60))) for _ in range(60)]
    texts += [None, "", "\n", "\n\n\n", "no end", "<P>", "a<M>b", "<P<S", "line\n" * 3000, "z" * 5000, "twice", "twice"]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(10, "another of the key\nx")]
    docs = spark.createDataFrame([(k, t, 1, "f") for k, t in rows], f"{TEXTS}, n int, form string").repartition(3)
    made = infill.transformed(infill.framed(docs, "doc_id", "text", size), 7)
    back = made.select("*", infill.restored("output", "form").alias("text"), infill.digest("output").alias("sha")).collect()
    want = Counter((k, *rewritten_by_force(k, t, 7), t or "") for k, t in rows)
    assert Counter((r.key, r.n, r.form, r.prefix_chars, r.middle_chars, joined(r.output), joined(r.text)) for r in back) == want
    assert all(r.sha == sha(joined(r.output)) for r in back)
    assert infill.transformed(infill.framed(docs.limit(0), "doc_id", "text"), 7).count() == 0


def test_infilling_rates(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a\nb\nc").alias("text"))
    for rate, spm in ((0, 50), (30, 0), (100, 100)):
        made = infill.transformed(infill.framed(docs, "doc_id", "text"), 1, rate, spm).collect()
        assert {r.key: r.form for r in made} == {i: rewritten_by_force(i, "a\nb\nc", 1, rate, spm)[1] for i in range(400)}


def test_only_cut_frames_are_unpacked(monkeypatch):
    text = ("word\n" * 1000).encode()
    frames, lines = [], 0
    for piece in infill.cut_frames(text, 100):
        frames.append({"before": lines, "units": piece.count(b"\n"), "chars": len(piece), "data": zstandard.compress(piece)})
        lines += piece.count(b"\n")
    opened = []
    monkeypatch.setattr(infill.zstandard, "decompress", lambda f, real=zstandard.decompress: opened.append(f) or real(f))
    parts, chars = infill.divided(frames, 333, 777)
    assert len(opened) == 2 and chars == [333 * 5, 444 * 5, 223 * 5]


def test_rebuilding_from_any_frames():
    text = "<P>pre\n<S>suf<<M>mid"
    for size in range(1, len(text) + 1):
        frames = [zstandard.compress(text[i : i + size].encode()) for i in range(0, len(text), size)]
        assert joined(infill.rebuilt(frames, "psm")) == "pre\nmidsuf<"


def test_infill_digests_of_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in catalogue.QUERIES["op13_seekable_infill"](spark, FOLDER).collect():
        n, form, p, m, out = rewritten_by_force(r.doc_id, texts[r.doc_id], 7)
        assert tuple(r) == (r.doc_id, n, form, p, m, sha(out), sha(texts[r.doc_id] or ""))
