"""Byte-pair training over a table of distinct pieces: many merges a round, each proven by exact counts.

The table stays in the cluster, as arrays of symbols that hold many pieces each. A round sends out a list of merges that are likely to come next.
The tasks make them in turn and return the signed change that each step makes to each pair's count. The driver holds pair counts and a heap of them, fed by those changes only. It goes through the steps
again, and takes them as long as the listed merge is the best pair by the exact counts; the rest of the list is void.
The list comes from a bounded sample of the most frequent pieces, so the sample decides how many merges a round
makes, but never which.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import remove_folder, written

Pair = tuple[int, int]
Merge = tuple[int, int, int]  # left, right, new

SAMPLE_PIECES = 100_000
MOST_LISTED = 1024
REPLAYED = 150  # merges that tasks make again before the table is written anew


class Counts:
    """Pair counts and the best pair: the most frequent, of equals the one with smaller ids."""

    def __init__(self, counts: dict[Pair, float]):
        self.counts = dict(counts)
        self.heap = [(-n, pair) for pair, n in counts.items() if n > 0]
        heapify(self.heap)

    def best(self) -> Pair | None:
        while self.heap:
            n, pair = self.heap[0]
            if self.counts.get(pair, 0) == -n:
                return pair
            heappop(self.heap)
        return None

    def change(self, changes: dict[Pair, float]) -> None:
        for pair, change in changes.items():
            n = self.counts[pair] = self.counts.get(pair, 0) + change
            if n > 0:
                heappush(self.heap, (-n, pair))
            else:
                del self.counts[pair]


class Flat:
    """Pieces as one array of symbols, -1 before, between and after them, and each place's frequency."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray):
        self.symbols, self.freqs = symbols, freqs

    @classmethod
    def of_pieces(cls, batches: Iterator[pa.RecordBatch]) -> Flat:
        symbols, freqs = [np.full(1, -1, np.int32)], [np.zeros(1, np.int64)]
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            made = np.full(int(sizes.sum()) + len(sizes), -1, np.int32)
            inner = np.ones(len(made), bool)
            inner[np.cumsum(sizes + 1) - 1] = False
            made[inner] = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            symbols.append(made)
            freqs.append(np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes + 1))
        return cls(np.concatenate(symbols), np.concatenate(freqs))

    @classmethod
    def of_table(cls, batches: Iterator[pa.RecordBatch]) -> Flat:
        symbols, freqs = [np.full(1, -1, np.int32)], [np.zeros(1, np.int64)]
        for batch in batches:
            symbols += [np.frombuffer(v.as_buffer(), np.int32) for v in batch.column(0)]
            freqs += [np.frombuffer(v.as_buffer(), np.int64) for v in batch.column(1)]
        return cls(np.concatenate(symbols), np.concatenate(freqs))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The table's rows: some thousand pieces each, cut between pieces."""
        ends = np.flatnonzero(self.symbols == -1)[::ROW_PIECES]
        for start, stop in zip(ends, np.r_[ends[1:], len(self.symbols)]):
            row = [pa.array([part[start:stop].tobytes()], pa.binary()) for part in (self.symbols, self.freqs)]
            yield pa.RecordBatch.from_arrays(row, names=["symbols", "freqs"])

    def pairs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that begin at these places, as one number each, and their frequencies."""
        left, right = self.symbols[at].astype(np.int64), self.symbols[at + 1].astype(np.int64)
        held = (left >= 0) & (right >= 0)
        return (left << 32 | right)[held], self.freqs[at][held]

    def apply(self, merge: Merge) -> tuple[np.ndarray, np.ndarray]:
        """Make a merge everywhere, left to right. (pairs, changes of their counts). The old arrays are left as they were."""
        left, right, new = merge
        at = np.flatnonzero((self.symbols[:-1] == left) & (self.symbols[1:] == right))
        if left == right and len(at):
            first = np.r_[True, np.diff(at) > 1]
            nth = np.arange(len(at))
            at = at[(nth - np.maximum.accumulate(np.where(first, nth, 0))) % 2 == 0]
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        old, old_n = self.pairs(np.unique(np.concatenate([at - 1, at, at + 1])))
        kept = np.ones(len(self.symbols), bool)
        kept[at + 1] = False
        self.symbols, self.freqs = self.symbols[kept], self.freqs[kept]
        at = at - np.arange(len(at))
        self.symbols[at] = new
        made, made_n = self.pairs(np.unique(np.concatenate([at - 1, at])))
        return summed(np.concatenate([old, made]), np.concatenate([-old_n, made_n]))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys and the sums of their values, without those that come to nothing."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    keys, values = keys[starts], np.add.reduceat(values, starts)
    return keys[values != 0], values[values != 0]


def _likely(counts: Counts, sample: Flat, texts: list[str], known: dict[str, int], room: int, most: int) -> list[Merge]:
    """The next merges as the sample sees them: exact counts to begin with, then the sample's changes scaled to them."""
    guess, before, added = Counts(counts.counts), (sample.symbols, sample.freqs), {}
    listed: list[Merge] = []
    names = dict(enumerate(texts))
    while len(listed) < most and room > 0:
        pair = guess.best()
        if pair is None:
            break
        text = names[pair[0]] + names[pair[1]]
        new = known.get(text, added.get(text))
        if new is None:
            new = added[text] = len(names)
            names[new] = text
            room -= 1
        listed.append((*pair, new))
        total = guess.counts[pair]
        changes = _by_pair(*sample.apply(listed[-1]))
        held = -changes.pop(pair, 0)
        scale = total / held if held > 0 else 0
        guess.change({p: c * scale for p, c in changes.items()} | {pair: -total})
    sample.symbols, sample.freqs = before
    return listed


ROW_PIECES = 100_000
FLAT = "symbols binary, freqs binary"


def _changes(table: DataFrame, made: list[Merge], listed: list[Merge]) -> dict[int, dict[Pair, int]]:
    """Runs a job. Per step of ``listed`` the change of every pair's count, after ``made`` has been made in every piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Flat.of_table(batches)
        for merge in made:
            held.apply(merge)
        for step, merge in enumerate(listed):
            keys, changes = held.apply(merge)
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), step, np.int32)), pa.array(keys), pa.array(changes)], names=["step", "pair", "n"])

    found = table.mapInArrow(work, "step int, pair bigint, n bigint").toArrow()
    steps, keys, changes = (c.to_numpy() for c in found.columns)
    out: dict[int, dict[Pair, int]] = defaultdict(dict)
    for step in range(len(listed)):
        mine = steps == step
        out[step] = _by_pair(*summed(keys[mine], changes[mine]))
    return out


def _by_pair(keys: np.ndarray, values: np.ndarray) -> dict[Pair, int]:
    return dict(zip(zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist()), values.tolist()))


def _start(table: DataFrame) -> dict[Pair, int]:
    """Runs a job. The count of every pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Flat.of_table(batches)
        keys, counts = summed(*held.pairs(np.arange(len(held.symbols) - 1)))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

    found = table.mapInArrow(work, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    return _by_pair(*(c.to_numpy() for c in found.columns))


def _packed(pieces: DataFrame) -> DataFrame:
    """Pieces (symbols array<int>, freq) as a table of arrays."""
    return pieces.mapInArrow(lambda batches: Flat.of_pieces(batches).rows(), FLAT)


def _merged(table: DataFrame, made: list[Merge]) -> DataFrame:
    """The table after ``made``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Flat.of_table(batches)
        for merge in made:
            held.apply(merge)
        yield from held.rows()

    return table.mapInArrow(work, FLAT)


def train_merges(pieces: DataFrame, texts: list[str], vocab_size: int, sample_pieces: int = SAMPLE_PIECES) -> tuple[list[str], list[Merge], int]:
    """Runs one job per round. (texts, merges, rounds) from distinct pieces (symbols array<int>, freq), ``texts`` being the symbols' own texts.

    Merges the most frequent pair (ties: smaller ids) until there are ``vocab_size`` texts or no pairs. A merge that makes a text already there
    keeps that symbol. The result doesn't depend on ``sample_pieces``. The driver holds one count per different pair, the sample, and per
    round the changed pairs; pieces stay in the cluster, written anew now and then so that a lost task never replays much.
    """
    texts, known = list(texts), {t: i for i, t in enumerate(texts)}
    pieces, pieces_folder = written(pieces)
    head = pieces.orderBy(F.desc("freq"), "symbols").limit(sample_pieces).toArrow()
    sample = Flat.of_pieces(iter(head.combine_chunks().to_batches()))
    # The table is small for its work, so spread it over all cores instead of by size.
    table, folder = written(_packed(pieces.repartition(2 * pieces.sparkSession.sparkContext.defaultParallelism)))
    remove_folder(pieces.sparkSession, pieces_folder)
    counts = Counts(_start(table))
    merges: list[Merge] = []
    replay: list[Merge] = []
    rounds, most = 0, 32
    while len(texts) < vocab_size:
        listed = _likely(counts, sample, texts, known, vocab_size - len(texts), most)
        if not listed:
            break
        changes = _changes(table, replay, listed)
        rounds += 1
        taken = 0
        for step, merge in enumerate(listed):
            if counts.best() != merge[:2]:
                break
            text = texts[merge[0]] + texts[merge[1]]
            if text not in known:
                known[text] = len(texts)
                texts.append(text)
            counts.change(changes[step])
            sample.apply(merge)
            taken += 1
        merges += listed[:taken]
        replay += listed[:taken]
        most = min(2 * most, MOST_LISTED) if taken == len(listed) else max(16, 2 * taken)
        if len(replay) > REPLAYED and len(texts) < vocab_size:
            after, new_folder = written(_merged(table, replay))
            remove_folder(pieces.sparkSession, folder)
            table, folder, replay = after, new_folder, []
    remove_folder(pieces.sparkSession, folder)
    return texts, merges, rounds
