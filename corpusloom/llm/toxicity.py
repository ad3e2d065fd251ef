"""Toxicity: a linear text classifier whose scores may not move when identity terms are swapped."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.llm.scratch import draw, fresh, keep, new_folder, pieces

WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
PREFIXES = (3, 4, 5, 6)
CACHED_WORDS = 200_000
LEAST_TEXTS = 5  # a feature in fewer texts is left out
UNKNOWN = 0.25  # score of every text where no label was given

# Words that name groups of people, interchangeable within a line. A parameter everywhere.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "citizens", "locals"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


def traits(word: str) -> list[int]:
    """Features of one word, as 32-bit codes: itself and its beginnings."""
    own = [f"={word}", *(word[:n] for n in PREFIXES if len(word) >= n)]
    return [zlib.crc32(t.encode("utf-8", "replace")) for t in own]


def coded(text: str | None, memory: dict[str, list[int]] | None = None) -> np.ndarray:
    """The different features of a text, sorted."""
    memory = {} if memory is None else memory
    found: set[int] = set()
    for w in set(WORD.findall((text or "").lower())):
        known = memory.get(w)
        if known is None:
            known = traits(w)
            if len(memory) < CACHED_WORDS:
                memory[w] = known
        found.update(known)
    return np.sort(np.fromiter(found, np.uint32, len(found)))


def swapped(text: str, terms: tuple[tuple[str, ...], ...]) -> list[str]:
    """Counterfactuals of a labelled text: in each sentence every identity term becomes another of its line.

    One text per shift (the next term of the line, the one after it), none if no sentence names a group.
    """
    place = {t: (row, i) for row in terms for i, t in enumerate(row)}
    found = []
    for shift in (1, 2):
        changed, parts = False, []
        for sentence in SENTENCE.split(text):
            words = WORD.findall(sentence.lower())
            for k, w in enumerate(words):
                if w in place:
                    row, i = place[w]
                    words[k] = row[(i + shift) % len(row)]
                    changed = True
            parts.append(" ".join(words))
        if changed:
            found.append("\n".join(parts))
    return found


@dataclass
class Classifier:
    """Weights by feature code, at most ``max_features`` of them, and what the fit left behind."""

    bias: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    examples: int = 0
    counterfactuals: int = 0

    def scores(self, texts: list[str | None], memory: dict[str, tuple[int, ...]] | None = None) -> np.ndarray:
        """Probability of label 1 for each text; null and empty texts have the bias alone. ``memory`` keeps words between calls."""
        memory = {} if memory is None else memory
        weights, out = self.weights, np.empty(len(texts))
        for n, text in enumerate(texts):
            hit: set[int] = set()
            for w in set(WORD.findall((text or "").lower())):
                known = memory.get(w)
                if known is None:
                    known = tuple(t for t in traits(w) if t in weights)
                    if len(memory) < CACHED_WORDS:
                        memory[w] = known
                if known:
                    hit.update(known)
            out[n] = self.bias + sum(weights[t] for t in sorted(hit))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


@dataclass
class Example:
    label: int
    codes: np.ndarray
    swaps: list[np.ndarray]


def example(text: str | None, label: int, terms: tuple[tuple[str, ...], ...], memory: dict | None = None) -> Example:
    return Example(int(label), coded(text, memory), [coded(t, memory) for t in swapped(text or "", terms)])


def _design(rows: list[np.ndarray], named: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), len(named)), np.float32)
    for n, codes in enumerate(rows):
        out[n] = np.isin(named, codes, assume_unique=True)
    return out


def _counts(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.empty(0, np.uint32), *rows]), return_counts=True)


def train(
    examples: list[Example],
    penalty: float = 4.0,
    ridge: float = 2e-4,
    max_features: int = 1000,
    rounds: int = 300,
) -> Classifier:
    """Fit on labelled texts: logistic loss + ridge + ``penalty`` x mean squared score change under swaps.

    Features in under 5 texts are left out and the ``max_features`` that tell the labels apart best (by
    log odds times the root of how common they are) are kept. One class only, or no feature left, gives the base rate for
    every text, and no example at all ``UNKNOWN``.
    """
    y = np.array([e.label for e in examples], np.float32)
    positive, total = int(y.sum()), len(examples)
    rate = (positive + 0.5) / (total + 1) if total else UNKNOWN
    base = Classifier(bias=float(np.log(rate / (1 - rate))), examples=total)
    if not 0 < positive < total:
        return base
    every, both = _counts([e.codes for e in examples])
    ones, some = _counts([e.codes for e in examples if e.label])
    a = np.zeros(len(every))
    a[np.searchsorted(every, ones)] = some
    b = both - a
    odds = np.log((a + 0.5) / (positive + 1)) - np.log((b + 0.5) / (total - positive + 1))
    worth = np.where(both >= LEAST_TEXTS, np.abs(odds) * np.sqrt(a / positive + b / (total - positive)), -1)
    named = np.sort(every[np.argsort(-worth, kind="stable")[:max_features]][: int((worth >= 0).sum())])
    if not len(named):
        return base
    x = _design([e.codes for e in examples], named)
    moved = [_design(e.swaps, named) - x[n] for n, e in enumerate(examples) if e.swaps]
    delta = np.concatenate([np.zeros((0, len(named)), np.float32), *moved])
    balance = np.where(y == 1, total / (2 * positive), total / (2 * (total - positive))).astype(np.float32)
    w, bias = np.zeros(len(named), np.float32), 0.0
    m, v, step = np.zeros(len(named) + 1), np.zeros(len(named) + 1), 0.05
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        error = (p - y) * balance / total
        grad = np.r_[x.T @ error + 2 * ridge * w, error.sum()]
        if len(delta):
            grad[:-1] += 2 * penalty * (delta.T @ (delta @ w)) / len(delta)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = step * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, bias = (w - move[:-1]).astype(np.float32), bias - move[-1]
    weights = {int(t): float(w[k]) for k, t in enumerate(named)}
    return Classifier(float(bias), weights, total, len(delta))


def _telling(made: DataFrame, positive: int, total: int, max_features: int) -> np.ndarray:
    """Runs a job. The features ``train`` keeps, counted in the tasks."""
    each = made.select("y", F.explode("codes").alias("code")).groupBy("code")
    counted = each.agg(F.sum(F.when(F.col("y") != 0, 1.0).otherwise(0.0)).alias("a"), F.count(F.lit(1)).cast("double").alias("n"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    odds = F.log((a + 0.5) / (positive + 1)) - F.log((b + 0.5) / (total - positive + 1))
    worth = F.abs(odds) * F.sqrt(a / positive + b / (total - positive))
    best = counted.filter(F.col("n") >= LEAST_TEXTS).orderBy(worth.desc(), "code").limit(max_features)
    return np.sort(np.array([r["code"] for r in best.select("code").collect()], np.uint32))


def fit(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, training: Column, max_examples: int = 6000,
    max_features: int = 1000, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, **options,
) -> Classifier:
    """Runs jobs. A classifier from at most ``max_examples`` labelled keys.

    ``training`` says which rows may be learnt from. More labelled keys than the bound: those with the smallest md5
    draw are taken, the same ones every time. A key is one example: of several texts of a key the smallest counts, of several
    labels the largest. Texts become feature codes in the tasks and the features are chosen there; the driver gets, in the
    order of the draws, only the codes of the ``max_features`` chosen, however long the texts are. These bounds hold for the fit
    alone; scoring covers every row. Rows without a label or key are not learnt from. Other columns play no part, whatever their names.
    """
    marked = labels.filter(F.col(label).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(label).cast("int").alias("_y"))
    learnt = docs.filter(training).select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    known = learnt.select(F.col("k").alias("_key")).distinct().join(marked, "_key")
    drawn = known.withColumn("_d", draw(F.col("_key"))).orderBy("_d", "_key").limit(max_examples).select("_key", "_y", "_d")
    drawn = keep(drawn, new_folder(docs.sparkSession, "examples"))  # at most ``max_examples`` rows
    rows = learnt.join(F.broadcast(drawn), F.col("k") == F.col("_key"))
    rows = rows.groupBy("_key", "_y", "_d").agg(F.min("t").alias("t")).select("t", "_y", "_d", "_key")
    codes = pa.list_(pa.int64())

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, list[int]] = {}
        for batch in pieces(batches):
            texts, ys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            made = [example(t, y, terms, memory) for t, y in zip(texts, ys, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), batch.column(2), pa.array(ys, pa.int32()), pa.array([e.codes for e in made], codes), pa.array([e.swaps for e in made], pa.list_(codes))],
                names=["key", "d", "y", "codes", "swaps"],
            )

    kind = docs.schema[key].dataType.simpleString()
    shape = f"key {kind}, d double, y int, codes array<bigint>, swaps array<array<bigint>>"
    made = keep(rows.mapInArrow(code, shape), new_folder(docs.sparkSession, "examples"))
    total, positive = made.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    named = _telling(made, positive, total, max_features) if 0 < positive < total else np.empty(0, np.uint32)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen(values: list[int]) -> list[int]:
            values = np.array(values, np.int64)
            return values[np.isin(values, named)].tolist()

        for batch in pieces(batches):
            own = pa.array([chosen(c) for c in batch.column(3).to_pylist()], codes)
            swaps = pa.array([[chosen(c) for c in s] for s in batch.column(4).to_pylist()], pa.list_(codes))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], own, swaps], names=batch.schema.names)

    read = made.mapInArrow(narrow, shape).orderBy("d", "key")
    examples = [
        Example(row["y"], np.array(row["codes"], np.uint32), [np.array(s, np.uint32) for s in row["swaps"]])
        for row in read.toLocalIterator()
    ]
    return train(examples, max_features=max_features, **options)


def _string(docs: DataFrame, name: str) -> bool:
    """The column is a string as it is, so it needn't travel a second time as one."""
    return docs.schema[name].dataType == StringType()


def scored(docs: DataFrame, text: str, model: Classifier, score: str = "score") -> DataFrame:
    """``docs`` with a ``score`` column (0 to 1, double), replacing one of that name. One pass, no shuffle."""
    rest = [c for c in docs.columns if c.lower() != score.lower()]
    named = fresh(rest, "text_to_score")
    rows = docs.select(F.col(text).cast("string").alias(named), *[F.col(f"`{c}`") for c in rest if c != text or not _string(docs, c)])
    at = [0 if c == text and _string(docs, c) else rows.columns.index(c) for c in rest]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, tuple[int, ...]] = {}
        for batch in pieces(batches):
            values = model.scores(batch.column(0).to_pylist(), memory)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in at), pa.array(values)], names=[*rest, score])

    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).schema.add(score, "double")
    return rows.mapInArrow(judge, schema)
