"""Benchmark decontamination: q-gram counts in overlapping diagonal bands, then banded alignment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.scratch import fresh, keep, new_folder
from corpusloom.llm.scratch import pieces as slices

GAP = re.compile(r"[\W_]+")
BASE = 0x9E3779B97F4A7C15  # fixed odd multiplier of the rolling hash


def plain(text: str | None) -> str:
    """Lower case; every run of anything but letters and digits is one space."""
    return GAP.sub(" ", (text or "").lower()).strip()


def pieces(text: str, passage: int, size: int) -> list[str]:
    """One normalised item in pieces of at most ``size`` characters; every ``passage`` consecutive characters stand in one of them."""
    return [text[s : s + size] for s in range(0, max(len(text) - passage, 0) + 1, size - passage + 1)] if text else []


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """Rolling hash of every q-gram of an array of code points."""
    codes = codes.astype(np.uint64) + np.uint64(1)
    out = np.zeros(max(0, len(codes) - q + 1), np.uint64)
    for k in range(q):
        out *= np.uint64(BASE)
        out += codes[k : k + len(out)]
    out ^= out >> np.uint64(29)
    out *= np.uint64(BASE)
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def alignment(pattern: np.ndarray, region: np.ndarray, first: int, width: int, budget: int) -> int | None:
    """Smallest edit distance of the pattern to a stretch of the region, or None if above the budget.

    Only cells within ``width`` diagonals from diagonal ``first`` on are filled in; the stretch may begin and
    end anywhere.
    """
    steps = np.arange(width)
    far = budget + 1
    row = np.where((first + steps >= 0) & (first + steps <= len(region)), 0, far)
    for i in range(1, len(pattern) + 1):
        at = first + i + steps  # end position in the region of each cell of this row
        here = (at >= 1) & (at <= len(region))
        match = np.zeros(width, bool)
        match[here] = region[at[here] - 1] == pattern[i - 1]
        new = np.where(here, row + ~match, far)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)  # the pattern's character is missing in the text
        new = np.where((at >= 0) & (at <= len(region)), new, far)
        new = np.minimum.accumulate(new - steps) + steps  # extra characters in the text
        row = np.minimum(new, far)
        if row.min() > budget:
            return None
    best = int(row.min())
    return best if best <= budget else None


@dataclass
class Index:
    """Q-grams of a block of item pieces: sorted hashes, and for each the pieces and places it stands at."""

    items: np.ndarray
    patterns: list[np.ndarray]
    strings: list[str]
    sizes: np.ndarray  # of each piece
    lengths: np.ndarray  # of a passage of each piece
    budgets: np.ndarray
    needed: np.ndarray
    q: int
    hashes: np.ndarray
    starts: np.ndarray
    where: np.ndarray
    place: np.ndarray
    sieve: np.ndarray
    short: list[tuple[int, str]]

    @classmethod
    def of(cls, rows: list[tuple[int, str]], q: int, rate: float, passage: int) -> Index:
        short = [(i, p) for i, p in rows if len(p) < 2 * q]
        rows = [(i, p) for i, p in rows if len(p) >= 2 * q]
        codes = [_codes(p) for _, p in rows]
        # The lemma: e edits leave at least n - q + 1 - q * e of a passage's q-grams; the budget keeps that above 0.
        lengths = [min(len(p), passage) for _, p in rows]
        budgets = [min(int(rate * n), (n - q) // q) for n in lengths]
        needed = [n - q + 1 - q * e for n, e in zip(lengths, budgets, strict=True)]
        grams = [gram_hashes(c, q) for c in codes]
        flat = np.concatenate([np.empty(0, np.uint64), *grams])
        where = np.repeat(np.arange(len(rows)), [len(g) for g in grams]).astype(np.int32)
        place = np.concatenate([np.empty(0, np.int64), *(np.arange(len(g)) for g in grams)]).astype(np.int32)
        order = np.argsort(flat, kind="stable")
        hashes, starts = np.unique(flat[order], return_index=True)
        sieve = np.zeros(1 << 22, bool)
        sieve[(hashes >> np.uint64(42)).astype(np.int64)] = True
        return cls(
            np.array([i for i, _ in rows], np.int64), codes, [p for _, p in rows], np.array([len(p) for _, p in rows], np.int64), np.array(lengths, np.int64), np.array(budgets, np.int64),
            np.array(needed, np.int64), q, hashes, np.r_[starts, len(flat)], where[order], place[order], sieve, short,
        )

    def hits(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in the text, pattern, position in the pattern) of every shared q-gram."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for low in range(0, len(text), 1 << 18):
            grams = gram_hashes(_codes(text[low : low + (1 << 18) + self.q - 1]), self.q)
            at = np.flatnonzero(self.sieve[(grams >> np.uint64(42)).astype(np.int64)])
            slot = np.searchsorted(self.hashes, grams[at])
            real = slot < len(self.hashes)
            real[real] = self.hashes[slot[real]] == grams[at][real]
            at, slot = at[real], slot[real]
            count = self.starts[slot + 1] - self.starts[slot]
            entry = np.repeat(self.starts[slot], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            found.append((np.repeat(at, count) + low, self.where[entry], self.place[entry]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))  # type: ignore[return-value]

    def leaks(self, texts: list[str | None]) -> list[list[int]]:
        """For each text, the sorted items of which a passage is in it within its edit budget."""
        out: list[set[int]] = [set() for _ in texts]
        clean = [plain(t) for t in texts]
        for i, p in self.short:
            for n, t in enumerate(clean):
                if f" {p} " in f" {t} ":
                    out[n].add(i)
        low = 0
        while low < len(clean):  # texts are searched together, about 262,000 characters at a time
            high, size = low, 0
            while high < len(clean) and (high == low or size + len(clean[high]) <= 1 << 18):
                size += len(clean[high]) + 1
                high += 1
            self._search(clean, low, high, out)
            low = high
        return [sorted(s) for s in out]

    def _search(self, clean: list[str], low: int, high: int, out: list[set[int]]) -> None:
        joined = "\0".join(clean[low:high])
        if len(joined) < self.q or not len(self.hashes):
            return
        begin = np.cumsum([0, *(len(clean[n]) + 1 for n in range(low, high))])
        at, pattern, place = self.hits(joined)
        if not len(at):
            return
        step = self.budgets[pattern] + 1
        band = (at - place + len(joined)) // step  # bands are two steps wide and begin at every step
        wide = 2 * len(joined) + 4
        keys = np.concatenate([pattern * wide + band, pattern * wide + band - 1])
        at, place = np.concatenate([at, at]), np.concatenate([place, place]).astype(np.int64)
        order = np.lexsort((at, keys))
        keys, at, place = keys[order], at[order], place[order]
        # A passage begins with some hit of its band and has as many as it needs within its length and budget.
        owner = keys // wide
        last = np.arange(len(keys)) + self.needed[owner] - 1
        inside = np.minimum(last, len(keys) - 1)
        near = (last < len(keys)) & (keys[inside] == keys) & (at[inside] - at <= self.lengths[owner] + self.budgets[owner] - self.q)
        first = np.flatnonzero(near)
        if not len(first):
            return
        # The hits that a passage needs reach at most this far behind its first one, so it begins no earlier.
        reach = self.budgets[owner[first]] * (self.q + 1) + 1
        origin = np.repeat(first, reach)
        s = place[origin] - (np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach))
        fits = (s >= 0) & (s <= self.sizes[owner[origin]] - self.lengths[owner[origin]])
        size = int(self.sizes.max()) + 1
        windows, index = np.unique((keys[origin] * size + s)[fits], return_index=True)
        origin = origin[fits][index]
        likely = np.unique(keys[first])
        held = likely[np.minimum(np.searchsorted(likely, keys), len(likely) - 1)] == keys
        missed = self._uncovered(windows, owner[origin], np.unique(keys[held] * size + place[held]))
        possible = missed <= self.budgets[owner[origin]]
        windows, origin, missed = windows[possible], origin[possible], missed[possible]
        docs = np.searchsorted(begin, at[origin], side="right") - 1
        for w in np.lexsort((missed, owner[origin], docs)).tolist():
            n, key = int(docs[w]), int(windows[w]) // size
            p, k = divmod(key, wide)
            item = int(self.items[p])
            if item not in out[low + n] and self._stands(p, int(windows[w]) % size, k * (int(self.budgets[p]) + 1) - len(joined) - int(begin[n]), clean[low + n]):
                out[low + n].add(item)

    def _uncovered(self, windows: np.ndarray, owner: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """How many edits it takes to spoil the q-grams of each passage that aren't among the hits of its band: one spoils q in a row at most."""
        grams = self.lengths[owner] - self.q + 1
        edits, covered = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
        for c in range(int(grams.max(initial=0))):
            slot = np.minimum(np.searchsorted(hits, windows + c), len(hits) - 1)
            spoiled = (hits[slot] != windows + c) & (c < grams) & (c >= covered)
            edits += spoiled
            covered[spoiled] = c + self.q
        return edits

    def _stands(self, p: int, s: int, diagonal: int, text: str) -> bool:
        """The passage of piece ``p`` from ``s`` on stands in the text within its budget, near a diagonal (text minus piece position)."""
        length, budget = int(self.lengths[p]), int(self.budgets[p])
        step, start = budget + 1, diagonal + s
        cut = max(0, start - step)
        region = text[cut : max(0, start + length + 3 * step)]
        if len(region) < length - budget:
            return False
        if self.strings[p][s : s + length] in region:
            return True
        return budget > 0 and alignment(self.patterns[p][s : s + length], _codes(region), start - step - cut, 4 * step, budget) is not None


def tag_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    q: int = 8, rate: float = 0.08, passage: int = 40, piece: int = 2000, block: int = 2_000_000,
    to: str = "leaked_items",
) -> DataFrame:
    """Runs jobs over the benchmark. ``docs`` with an array of the benchmark items found in each text.

    Both sides are normalised (case, punctuation and symbols do not count). An item is found where any ``passage`` consecutive characters of it
    (seven or eight words; the whole of a shorter item) are within floor(``rate`` x their number) edits of a stretch of the text. Items shorter
    than 2 ``q`` must stand there exactly, between word borders. Items without letters or digits, null items and
    null texts match nothing; items with a null id are searched under the id null is not part of, so they are skipped.

    The items' q-grams are indexed once, in pieces of ``piece`` characters. The grams a text shares with a piece are counted in diagonal bands over
    stretches as long as a passage; where there are as many as the edit budget must leave, the passages there are aligned within the band.

    Documents are read once and never shuffled. The pieces are written to the checkpoint folder in blocks of
    about ``block`` characters and sent out block by block, so what is broadcast is bounded however large the benchmark is;
    each further block is one more step over the same rows. A column named ``to`` is replaced.
    """
    spark = docs.sparkSession

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for p in pieces(plain(t), passage, piece):
                    ids.append(i)
                    parts.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.string())], names=["i", "p"])

    items = benchmark.filter(F.col(item).isNotNull()).select(
        F.col(item).cast("bigint").alias("i"), F.col(item_text).cast("string").alias("p")
    )
    patterns = keep(items.mapInArrow(cut, "i bigint, p string").distinct(), new_folder(spark, "patterns"))
    blocks = max(1, -(-(patterns.agg(F.sum(F.length("p"))).first()[0] or 0) // block))
    rest = [c for c in docs.columns if c.lower() != to.lower()]
    named = fresh(rest, "text_to_search")
    rows = docs.select(*[F.col(f"`{c}`") for c in rest])
    if text not in rest or docs.schema[text].dataType != T.StringType():
        rows = rows.withColumn(named, F.col(text).cast("string"))  # else the text would travel twice
    text_at = rows.columns.index(named if named in rows.columns else text)
    schema = rows.schema.add(to, T.ArrayType(T.LongType()))
    rows = rows.withColumn(to, F.array().cast("array<bigint>"))
    for number in range(blocks):
        mine = patterns.filter(F.pmod(F.xxhash64("p"), F.lit(blocks)) == number)
        index = spark.sparkContext.broadcast(Index.of(sorted((r.i, r.p) for r in mine.collect()), q, rate, passage))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = index.value.leaks(batch.column(text_at).to_pylist())
                before = batch.column(batch.num_columns - 1).to_pylist()
                both = [sorted({*a, *b}) for a, b in zip(before, found, strict=True)]
                columns = [*batch.columns[:-1], pa.array(both, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        rows = rows.mapInArrow(search, schema)
    return rows.drop(named)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Rows of ``docs`` in which no benchmark item is found (see ``tag_leaks``); the same columns."""
    mark = fresh(docs.columns, "leaked_items")
    return tag_leaks(docs, benchmark, to=mark, **options).filter(F.size(mark) == 0).drop(mark)
