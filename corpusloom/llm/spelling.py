"""Spelling variants: words one edit apart, found by composing acceptors of the vocabulary with a one-edit transducer.

The composed machine V o E o V is not built whole. Two words one edit apart share the first half of the shorter one
or its last half, so the machine is taken apart by the state behind that shared half (its initial-state partitions, the second
kind over reversed halves). Within a partition the words' remaining middles are kept in one minimal acceptor, and the pairs that
the composition accepts are enumerated from there. A partition with too many words is taken apart further by
halves of the middle, which loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.scratch import keep, new_folder

RUNS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_WORDS = 20_000  # of a partition; larger ones are taken apart


def observed_words(docs: DataFrame, key: str, text: str, every: int = 31, min_length: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n): lower-cased words of the texts and how often they occur, after a deletion in every ``every``-th occurrence.

    Where the CRC-32 of ``<key>:<run>`` is a multiple of ``every``, the run loses the code point at that number modulo its length.
    Null texts have no words; a null key counts as the empty text. Counts combine before the shuffle.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    runs = docs.select(name.alias("k"), F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(RUNS), F.lit(0))).alias("run"))
    lowered = runs.select("k", F.translate("run", UPPER, LOWER).alias("run")).filter(F.length("run") >= min_length)
    h = F.crc32(F.concat("k", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = lowered.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


class Acceptor:
    """Minimal acyclic acceptor of equally long words each; a state is the number of a set of equal residual words.

    Words are added in sorted order per start; states behind the last word's own path are final and shared.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]  # state 0 accepts the empty word
        self._known: dict[tuple, int] = {(): 0}
        self._residual: dict[int, list[str]] = {0: [""]}

    def start(self, words: list[str]) -> int | None:
        """The state that accepts ``words``: sorted, distinct and of one length. None for no words."""
        if not words:
            return None
        path: list[dict[str, int]] = [{} for _ in range(len(words[0]))]  # arcs along the word before
        last = words[0]
        for word in words[1:]:
            same = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), len(word))
            self._close(path, last, same)
            last = word
        self._close(path, last, 0)
        return self._state(path[0]) if path else 0

    def _close(self, path: list[dict[str, int]], word: str, down_to: int) -> None:
        target = 0
        for depth in range(len(word) - 1, down_to - 1, -1):
            path[depth][word[depth]] = target
            if depth > down_to:
                target = self._state(path[depth])
                path[depth] = {}

    def _state(self, arcs: dict[str, int]) -> int:
        mark = tuple(arcs.items())
        state = self._known.get(mark)
        if state is None:
            state = self._known[mark] = len(self.arcs)
            self.arcs.append(arcs)
        return state

    def residual(self, state: int) -> list[str]:
        """All words accepted from a state."""
        got, stack = [], [(state, "")]
        if state in self._residual:
            return self._residual[state]
        while stack:
            s, word = stack.pop()
            if s == 0:
                got.append(word)
            stack += [(to, word + symbol) for symbol, to in self.arcs[s].items()]
        self._residual[state] = got
        return got

    def common(self, a: int, b: int) -> Iterator[str]:
        """Words accepted from both states."""
        stack = [(a, b, "")]
        while stack:
            s, t, word = stack.pop()
            if s == t:
                yield from (word + rest for rest in self.residual(s))
                continue
            s, t = self.arcs[s], self.arcs[t]
            if len(s) > len(t):
                s, t = t, s
            stack += [(to, t[symbol], word + symbol) for symbol, to in s.items() if symbol in t]


def one_edit_pairs(short: list[str], long: list[str], within: int | None = None) -> Iterator[tuple[str, str]]:
    """Pairs one edit apart of sorted distinct words: two of ``short`` (one length), or one of it and one of ``long`` (a letter more).

    Every pair comes once, from the place of its first difference; with ``within`` only if that is before this place.
    The states of the composition before the edit are (p, p) for a replacement and (p, q) for an insertion; after it
    both sides read the same word.
    """
    machine = Acceptor()
    p, q = machine.start(short), machine.start(long)
    if p is None:
        return
    stack: list[tuple[int, int | None, str]] = [(p, q, "")]
    while stack:
        p, q, read = stack.pop()
        if within is not None and len(read) >= within:
            continue
        arcs = list(machine.arcs[p].items())
        for i, (x, left) in enumerate(arcs):
            for y, right in arcs[i + 1 :]:
                for rest in machine.common(left, right):
                    yield read + x + rest, read + y + rest
        if q is not None:
            for y, right in machine.arcs[q].items():
                for rest in machine.common(p, right):
                    if rest[:1] != y:  # else the first difference comes later
                        yield read + rest, read + y + rest
        for x, left in arcs:
            stack.append((left, None if q is None else machine.arcs[q].get(x), read + x))


def _half(n: Column) -> Column:
    return F.floor(n / 2).cast("int")


def _keyed(rows: DataFrame, head: Column, tail: Column, unlike: Column) -> DataFrame:
    """``rows`` (word, n, short) under the partition of their first ``head`` and last ``tail`` letters."""
    w = F.col("word")
    shared = F.concat(F.substring(w, F.lit(1), head), F.lit(" "), F.when(tail > 0, F.substring(w, F.length(w) - tail + 1, tail)).otherwise(""))
    return rows.select("word", "n", "short", head.alias("head"), tail.alias("tail"), unlike.alias("unlike"), shared.alias("shared"))


PARTITION = ["short", "head", "tail", "unlike", "shared"]


def partitions(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """Runs jobs. Every word in the partitions it may find a near word in: (word, n, short, head, tail, unlike, shared).

    ``short`` is the length of the shorter word of a pair. A partition shares ``head`` first and ``tail`` last letters; where ``unlike`` is not
    null, pairs that share that many first letters belong to another one. A partition of over ``most`` words gives way to two that share half of
    its middle more, until a middle has one letter left.
    """
    lengths = F.array(F.length("word"), F.length("word") - 1)
    roles = words.select("word", "n", F.explode(lengths).alias("short"))
    half = _half(F.col("short"))
    none = F.lit(None).cast("int")
    due = _keyed(roles, half, F.lit(0), none).unionAll(_keyed(roles, F.lit(0), F.col("short") - half, half))
    ready = None
    while True:
        free = F.col("short") - F.col("head") - F.col("tail")
        large = due.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("size")).filter((F.col("size") > most) & (free > 1))
        large = keep(large.drop("size"), new_folder(words.sparkSession, "large"))
        if large.isEmpty():
            return due if ready is None else ready.unionAll(due)
        same = [F.col(f"d.{c}").eqNullSafe(F.col(f"l.{c}")) for c in PARTITION]
        small = due.alias("d").join(large.alias("l"), same, "left_anti")
        ready = small if ready is None else ready.unionAll(small)
        rest = due.alias("d").join(large.alias("l"), same, "left_semi")
        more = _half(free)
        first = _keyed_from(rest, F.col("head") + more, F.col("tail"), F.col("unlike"))
        second = _keyed_from(rest, F.col("head"), F.col("tail") + free - more, F.col("head") + more)
        due = keep(first.unionAll(second), new_folder(words.sparkSession, "halves"))


def _keyed_from(rows: DataFrame, head: Column, tail: Column, unlike: Column) -> DataFrame:
    named = rows.select("word", "n", "short", head.cast("int").alias("h"), tail.cast("int").alias("t"), unlike.cast("int").alias("u"))
    return _keyed(named, F.col("h"), F.col("t"), F.col("u"))


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted partitions to (word, n_near, best_n, best): what each word finds in each partition."""
    names = ["word", "n_near", "best_n", "best"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        out.clear()
        return made

    def solve(mark: tuple, members: list[tuple[str, int]]) -> None:
        short, head, tail, unlike, _ = mark
        counts = dict(members)
        middles: dict[int, list[str]] = {short: [], short + 1: []}
        for word in sorted(counts):
            middles[len(word)].append(word[head : len(word) - tail])
        if not middles[short]:
            return
        first, last = members[0][0][:head], members[0][0][len(members[0][0]) - tail :]
        found: dict[str, list] = {}
        for a, b in one_edit_pairs(middles[short], middles[short + 1], None if unlike is None else unlike - head):
            a, b = first + a + last, first + b + last
            for one, other in ((a, b), (b, a)):
                sums, n = found.setdefault(one, [0, -1, ""]), counts[other]
                sums[0] += 1
                if n > sums[1] or (n == sums[1] and other < sums[2]):
                    sums[1:] = n, other
        out.extend((word, *sums) for word, sums in found.items())

    mark, members = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for word, n, *place in zip(*columns):
            place = tuple(place)
            if place != mark:
                if len(members) > 1:
                    solve(mark, members)
                mark, members = place, []
            members.append((word, n))
        if len(out) > 1 << 15:
            yield flush()
    if len(members) > 1:
        solve(mark, members)
    if out:
        yield flush()


def near_words(words: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """Runs jobs. (word, n_near, best, best_n): how many of the distinct ``words`` (word, n) are exactly one inserted, deleted or replaced
    code point away, and the one of largest n among them (ties: smallest). Words without a near one are left out.

    Pairs are summed up per word within a partition and again over all; they are not kept as rows.
    """
    parts = partitions(words, most).select("word", "n", *PARTITION)
    rows = parts.repartition(*PARTITION).sortWithinPartitions(*PARTITION)
    found = rows.mapInArrow(_summaries, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return summed.select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def with_roots(forms: DataFrame, word: str = "word", form: str = "form") -> DataFrame:
    """Runs jobs. ``forms`` and ``root``, the end of the way from form to form; a word without form is its own root.

    The way mustn't lead in a circle. Every round doubles the steps taken, and only words not yet at an end take part. Few words can
    have one and the same form (it is one edit away), so the joins have no hot key.
    """
    spark = forms.sparkSession
    links = keep(forms.filter(F.col(form).isNotNull()).select(F.col(word).alias("a"), F.col(form).alias("b")), new_folder(spark, "links"))
    while True:
        further = links.alias("x").join(links.alias("y"), F.col("x.b") == F.col("y.a"), "left")
        jumped = keep(
            further.select(F.col("x.a").alias("a"), F.coalesce("y.b", "x.b").alias("b"), F.col("y.b").isNotNull().alias("moved")), new_folder(spark, "links")
        )
        moved = jumped.filter("moved").limit(1).count()
        links = jumped.drop("moved")
        if not moved:
            break
    ends = links.select(F.col("a").alias("_a"), F.col("b").alias("root"))
    joined = forms.join(ends, F.col(word) == F.col("_a"), "left").drop("_a")
    return joined.withColumn("root", F.coalesce("root", word))


def variants(docs: DataFrame, key: str, text: str, ratio: int = 10, every: int = 31, min_length: int = 7, min_count: int = 2, most: int = MOST_WORDS) -> DataFrame:
    """Runs jobs. (word, form, root, n, n_near, form_n) of every observed word.

    ``form`` is the near word of largest n (ties: the smallest) if it occurs at least ``ratio`` times as often, else null like
    ``form_n``; ``root`` is where forms of forms end. Empty tables, null and empty texts give no words; repeated rows count again.
    """
    spark = docs.sparkSession
    words = keep(observed_words(docs, key, text, every, min_length, min_count), new_folder(spark, "words"))
    near = near_words(words, most)
    clear = F.col("best_n") >= F.col("n") * ratio
    forms = words.join(near, "word", "left").select(
        "word", F.when(clear, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(clear, F.col("best_n")).alias("form_n")
    )
    forms = keep(forms, new_folder(spark, "forms"))
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
