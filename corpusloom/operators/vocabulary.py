"""Byte-level vocabulary: word counts, merge training, encoding, decoding and checks.

Text is cut into pre-tokens by a JVM regular expression. Training works on the table of
distinct pre-tokens (see ``merges``); encoding touches Python once per Arrow batch and remembers the pre-tokens a
task has seen. Decoding stays in the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import fixed
from corpusloom.functions.bytepairs import merge_pairs
from corpusloom.functions.lists import row_bounds, row_runs
from corpusloom.functions.text import WORD_PATTERN, WS_CLASS, words
from corpusloom.operators.merges import SAMPLE_PIECES, train_merges


def _byte_letters() -> list[str]:
    """Printable stand-in for each byte: printable Latin-1 bytes stand for themselves, the others
    take the code points from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


BYTE_LETTERS = _byte_letters()
_RESERVED = frozenset(fixed.reserved_tokens())
REMEMBERED_PIECES = 200_000  # per task


def _special() -> str:
    return "|".join(re.sub(r"([|<>/])", r"\\\1", t) for t in fixed.reserved_tokens())


def pretoken_pattern() -> str:
    """Reserved tokens whole, then contractions, words, numbers and other runs with one leading
    space each, then whitespace (the last blank before a word goes with the word)."""
    special = _special()
    ws = f"[{WS_CLASS}]"
    return (
        f"{special}|'s|'t|'re|'ve|'m|'ll|'d| ?\\p{{L}}+| ?\\p{{N}}+"
        f"| ?(?:(?!{special})[^{WS_CLASS}\\p{{L}}\\p{{N}}])+"
        f"|{ws}+(?={special})|{ws}+(?![^{WS_CLASS}])|{ws}+"
    )


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(pretoken_pattern()), F.lit(0))


def _symbols(piece: Column, byte_ids: list[int]) -> Column:
    """A pre-token as symbol ids: its UTF-8 bytes in hex, looked up one by one."""
    table = F.array(*[F.lit(i) for i in byte_ids])
    pairs = F.regexp_extract_all(F.hex(F.encode(piece, "UTF-8")), F.lit("(..)"), F.lit(1))
    return F.transform(pairs, lambda h: F.get(table, F.conv(h, 16, 10).cast("int")))


def word_counts(rows: DataFrame, text: str) -> DataFrame:
    """Frequency of lower-cased words and punctuation marks."""
    return rows.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def pretoken_counts(rows: DataFrame, text: str) -> DataFrame:
    """Frequency of pre-tokens; hot ones combine map-side."""
    return rows.select(F.explode(pretokens(F.col(text))).alias("piece")).groupBy("piece").agg(
        F.count(F.lit(1)).alias("freq")
    )


def pair_counts(pieces: DataFrame, symbols: str = "symbols", freq: str = "freq") -> DataFrame:
    """Frequency of adjacent symbol pairs over a table of distinct pre-tokens."""
    s = F.col(symbols)
    pairs = F.transform(
        F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))),
        lambda left, i: F.struct(left.alias("left"), F.get(s, i + 1).alias("right")),
    )
    return pieces.select(F.explode(pairs).alias("p"), F.col(freq)).groupBy("p.left", "p.right").agg(
        F.sum(freq).alias("freq")
    )


def train_vocabulary(
    rows: DataFrame, text: str, vocab_size: int = fixed.VOCAB_SIZE, sample_pieces: int = SAMPLE_PIECES
) -> tuple[DataFrame, DataFrame]:
    """Runs one job per round. Byte-pair training; returns (tokens, merges).

    Reserved tokens take the first ids, the 256 byte letters follow by code point, then merges
    by frequency (ties: smaller ids first). The corpus is counted once; every round after that
    reads only the distinct pre-token table and makes as many merges as ``merges.train_merges`` can prove.
    """
    spark = rows.sparkSession
    tokens = fixed.reserved_tokens() + sorted(BYTE_LETTERS)
    known = {t: i for i, t in enumerate(tokens)}
    counts = pretoken_counts(rows, text).filter(~F.col("piece").isin(fixed.reserved_tokens()))
    symbols = _symbols(F.col("piece"), [known[letter] for letter in BYTE_LETTERS])
    pieces = counts.select(symbols.alias("symbols"), "freq").filter(F.size("symbols") > 1)
    tokens, merges, _ = train_merges(pieces, tokens, vocab_size, sample_pieces)
    return _vocabulary_tables(spark, tokens, merges)


def _vocabulary_tables(spark: SparkSession, tokens: list[str], merges: list[tuple[int, int, int]]) -> tuple[DataFrame, DataFrame]:
    special = set(fixed.SPECIAL_TOKENS)
    vocabulary = spark.createDataFrame(
        [(i, t, t in special) for i, t in enumerate(tokens)], "token_id int, token string, special boolean"
    )
    ranked = [(r, tokens[a], tokens[b]) for r, (a, b, _) in enumerate(merges)]
    return vocabulary, spark.createDataFrame(ranked, "rank int, left string, right string")


def base_vocabulary(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Reserved tokens and byte letters without any merge: one token per byte."""
    return _vocabulary_tables(spark, fixed.reserved_tokens() + sorted(BYTE_LETTERS), [])


def _encode_piece(piece: str, ids: dict[str, int], ranks: dict[tuple[str, str], int]) -> list[int]:
    """Token ids of one pre-token: the best-ranked adjacent pair is joined until none is left."""
    if piece in _RESERVED:
        return [ids[piece]]
    letters = [BYTE_LETTERS[b] for b in piece.encode("utf-8")]
    return [ids[p] for p in merge_pairs(letters, lambda a, b: ranks.get((a, b)))]


def _encode_batches(batches: Iterator[pa.Array], ids: dict[str, int], ranks: dict[tuple[str, str], int]) -> Iterator[pa.Array]:
    """Lists of pre-tokens to lists of token ids, for one task, which remembers the pre-tokens it has encoded up to a bound.

    A batch is encoded a few rows at a time and only its different pre-tokens become Python strings, so the memory taken is
    little more than the batch.
    """
    known: dict[str, bytes] = {}

    def of(piece: str) -> bytes:
        got = known.get(piece)
        if got is None:
            got = np.asarray(_encode_piece(piece, ids, ranks), np.int32).tobytes()
            if len(known) < REMEMBERED_PIECES:
                known[piece] = got
        return got

    for column in batches:
        for part in row_runs(column):
            starts, found = row_bounds(part), part.flatten().dictionary_encode()
            made = [of(p) for p in found.dictionary.to_pylist()]
            each = np.array([len(m) // 4 for m in made], np.int64)
            at, one = np.cumsum(each) - each, found.indices.to_numpy()
            n = each[one]
            ends = np.concatenate([[0], np.cumsum(n)])
            flat = np.frombuffer(b"".join(made), np.int32)[np.repeat(at[one] - ends[:-1], n) + np.arange(ends[-1])]
            yield pa.ListArray.from_arrays(pa.array(ends[starts], pa.int32()), pa.array(flat, pa.int32()))


class Encoder:
    """A trained vocabulary on the driver, for building encode and decode columns.

    The tables hold at most ``max_size`` rows (checked), so they travel with the task.
    """

    def __init__(self, vocabulary: DataFrame, merges: DataFrame, max_size: int = 1_000_000):
        tokens = vocabulary.limit(max_size + 1).collect()
        ranks = merges.limit(max_size + 1).collect()
        if max(len(tokens), len(ranks)) > max_size:
            raise ValueError(f"vocabulary has more than {max_size} entries")
        self.ids = {r["token"]: r["token_id"] for r in tokens}
        self.tokens = {r["token_id"]: r["token"] for r in tokens}
        self.special = {r["token_id"] for r in tokens if r["special"]}
        self.ranks = {(r["left"], r["right"]): r["rank"] for r in ranks}

    def _piece_ids(self, piece: str) -> list[int]:
        return _encode_piece(piece, self.ids, self.ranks)

    def reply_marks(self) -> tuple[list[int], list[int]]:
        """Token ids of a reply's opener and closer."""
        opener = [fixed.START, "assistant", "\n"]
        closer = [fixed.END, "\n"]
        return tuple([i for piece in mark for i in self._piece_ids(piece)] for mark in (opener, closer))

    def encode(self, text: Column) -> Column:
        """Token ids of a text. Pre-tokens are cut in the JVM; Python sees arrays of them."""
        return self._encode_pieces(pretokens(text))

    def _encode_pieces(self, pieces: Column) -> Column:
        """Null arrays have no tokens."""
        ids, ranks = self.ids, self.ranks

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from _encode_batches(batches, ids, ranks)

        return encode(pieces)

    def decode(self, ids: Column, skip_special: bool = False) -> Column:
        """Token ids back to text: token letters joined, turned into bytes, read as UTF-8."""
        return F.decode(self._bytes(ids, skip_special), "UTF-8")

    def byte_lengths(self) -> np.ndarray:
        """By token id, how many bytes of text the token stands for."""
        sizes = np.zeros(max(self.tokens, default=-1) + 1, np.int32)
        for i, token in self.tokens.items():
            sizes[i] = len(token.encode("utf-8")) if token in _RESERVED else len(token)
        return sizes

    def _bytes(self, ids: Column, skip_special: bool) -> Column:
        reserved = set(fixed.reserved_tokens())
        value_of = {letter: b for b, letter in enumerate(BYTE_LETTERS)}
        hexed = {}
        for i, token in self.tokens.items():
            if skip_special and i in self.special:
                hexed[i] = ""
            elif token in reserved:
                hexed[i] = token.encode("utf-8").hex()
            else:
                hexed[i] = bytes(value_of[ch] for ch in token).hex()

        last = max(hexed, default=-1)
        table = F.split(F.lit(",".join(hexed.get(i, "") for i in range(last + 1))), ",")
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))

    def complete(self, ids: Column) -> Column:
        """True when the tokens decode to whole characters, so they can be shown."""
        return ~F.contains(self.lossy_text(ids), F.lit("�"))

    def lossy_text(self, ids: Column) -> Column:
        """Decoded text with a replacement character for incomplete bytes."""
        return F.make_valid_utf8(self._bytes(ids, False).cast("string"))


def round_trip(rows: DataFrame, text: str, encoder: Encoder) -> DataFrame:
    """Rows, rows that decode to themselves, and tokens, over the whole table."""
    encoded = rows.select(F.col(text).alias("t"), encoder.encode(F.col(text)).alias("ids"))
    return encoded.select(
        (encoder.decode(F.col("ids")) == F.col("t")).alias("same"), F.size("ids").alias("n")
    ).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("same").alias("n_same"), F.sum("n").alias("n_tokens")
    )


def hashed_ids(tokens: Column, size: int = fixed.VOCAB_SIZE) -> Column:
    """Word ids without a trained vocabulary: reserved markers keep their id, every other token gets
    a hash-derived id behind the reserved range."""
    reserved = fixed.reserved_tokens()
    listed = F.array(*[F.lit(t) for t in reserved])

    def one(token: Column) -> Column:
        at = F.when(F.startswith(token, F.lit("<")), F.array_position(listed, token)).otherwise(F.lit(0))
        spread = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")
        hashed = F.lit(len(reserved)) + F.pmod(spread, F.lit(size - len(reserved)))
        return F.when(at > 0, at - 1).otherwise(hashed).cast("int")

    return F.transform(tokens, one)


MARKED_WORDS = rf"<\|im_start\|>|<\|im_end\|>|\n|{WORD_PATTERN}"


def marked_words(text: Column) -> Column:
    """Words, punctuation, newlines and block markers of a rendered text."""
    return F.regexp_extract_all(F.lower(text), F.lit(MARKED_WORDS), F.lit(0))
