"""SimHash near-duplicates: segment-popcount embedding, grid join under Manhattan distance, exact check."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import components
from corpusloom.llm.scratch import fresh, keep, new_folder, scope
from corpusloom.operators.neardup import dealt, similar_classes
from corpusloom.session import lean

BITS = 64
PAIR_LOW = 0x5555555555555555  # the lower bit of every two-bit segment


def fingerprint(text: str | None, words: int, seed: int = 42) -> int:
    """SimHash of one text: bit set where over half of the shingle hashes have it; no words give 0.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text with fewer words than
    a shingle is one shingle.
    """
    tokens = (text or "").encode("utf-8").lower().split()
    if not tokens:
        return 0
    joined, ends, at = b" ".join(tokens), [], -1
    for token in tokens:
        at += len(token) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], seed) for s, e in zip(starts, ends[words - 1 :], strict=False)]
    total, counts = len(hashes), np.zeros(BITS, np.int64)
    if not hashes:
        return digest(joined, seed)
    for low in range(0, total, 65536):  # a bounded piece at a time
        piece = np.array(hashes[low : low + 65536], dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def fingerprints(docs: DataFrame, key: str, text: str, words: int = 5) -> DataFrame:
    """(key, fp): one row per row of ``docs``, the fingerprint as a signed 64-bit number."""
    kind = docs.schema[key].dataType

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["key", "fp"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(sign, f"key {kind.simpleString()}, fp bigint")


def counts_code(fp: Column) -> Column:
    """The bit counts (0 to 2) of the 32 two-bit segments, each in unary within its own two bits.

    The Manhattan distance of two count vectors is then the bit count of the xor of their codes.
    It never exceeds the Hamming distance of the fingerprints.
    """
    up = F.shiftrightunsigned(fp, 1)
    some = fp.bitwiseOR(up).bitwiseAND(F.lit(PAIR_LOW))
    both = fp.bitwiseAND(up).bitwiseAND(F.lit(PAIR_LOW))
    return some.bitwiseOR(F.shiftleft(both, 1))


def group_masks(groups: int) -> list[int]:
    """Signed masks that cut the 32 segments into ``groups`` runs of near equal length."""
    masks, low = [], 0
    for g in range(groups):
        high = 32 * (g + 1) // groups
        mask = ((1 << (2 * (high - low))) - 1) << (2 * low)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
        low = high
    return masks


def links(nodes: DataFrame, fp: str = "fp", distance: int = 4, equal: int = 3) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in at most ``distance`` bits.

    The segments are cut into ``distance + equal`` groups. Each unit of Manhattan distance can
    change one group, so of two near fingerprints at least ``equal`` groups have the same
    counts. A cell of the grid is the counts of ``equal`` chosen groups; every fingerprint is put into
    the cell of each choice and meets only those in its cells. There the Manhattan distance of the
    whole count vectors and then the exact bit distance decide, inside the join. A pair is reported from
    its first common cell only. Nothing is capped: a hot cell is a skewed join, which Spark splits.
    Groups of copies are one fingerprint each and meet nobody.
    """
    groups = distance + equal
    masks = group_masks(groups)
    cells = []
    for chosen in combinations(range(groups), equal):
        mask = 0
        for g in chosen:
            mask |= masks[g]
        cells.append(F.struct(F.lit(sum(1 << g for g in chosen)).alias("c"), F.col("t").bitwiseAND(F.lit(mask)).alias("cell")))
    coded = nodes.select(F.col(fp).alias("fp")).withColumn("t", counts_code(F.col("fp")))
    placed = coded.select("fp", "t", F.inline(F.array(*cells)))
    a = placed.select("c", "cell", F.col("fp").alias("a"), F.col("t").alias("ta"))
    b = placed.select("c", "cell", F.col("fp").alias("b"), F.col("t").alias("tb"))
    apart = F.col("ta").bitwiseXOR(F.col("tb"))
    same = F.lit(0)
    for g, mask in enumerate(masks):
        same = same + F.when(apart.bitwiseAND(F.lit(mask)) == 0, F.lit(1 << g)).otherwise(F.lit(0))
    rest = F.col("same")
    for _ in range(equal):
        rest = rest.bitwiseAND(rest - 1)
    near = (
        (F.col("a") < F.col("b"))
        & (F.bit_count(apart) <= distance)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    met = a.join(b, ["c", "cell"]).filter(near).select("c", "a", "b", same.alias("same"))
    return met.filter(F.col("same").bitwiseXOR(rest) == F.col("c")).select("a", "b")


@lean
def simhash_components(docs: DataFrame, key: str, text: str, words: int = 5, distance: int = 4) -> DataFrame:
    """Runs jobs. (key, fp, component): one row per row of ``docs``; component is the smallest key reachable.

    Null and empty texts have fingerprint 0 and are linked like any other. Rows with a null key are
    returned, but never name a component (null only if all its keys are null). Repeated rows come
    back as often as they are given; other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    signed = keep(fingerprints(docs, key, text, words), new_folder(spark, "simhash"))
    nodes = keep(signed.groupBy("fp").agg(F.min("key").alias("low")), new_folder(spark, "simhash"))
    pairs = keep(links(nodes, distance=distance), new_folder(spark, "simhash"))
    member = components(pairs).withColumnRenamed("node", "fp")
    linked = member.join(nodes, "fp")
    least = linked.groupBy("root").agg(F.min("low").alias("component"))
    found = linked.join(least, "root").select("fp", "component")
    named = nodes.join(found, "fp", "left").select("fp", F.coalesce("component", "low").alias("component"))
    named = keep(named, new_folder(spark, "simhash"))
    return signed.join(named, "fp").select("key", "fp", "component")


# --- similarity regime: wide fingerprints, sampled grid cells -------------------------------------

WORDS_WIDE = 4  # 64-bit words of a wide fingerprint
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # fixed odd multipliers of a 64-bit mixer


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the different word shingles (lower-cased, white space as above)."""
    tokens = (text or "").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = [t.encode("utf-8", "replace") for t in tokens]
    parts = {b" ".join(joined[i : i + words]) for i in range(max(1, len(joined) - words + 1))}
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(p) for p in parts), dtype=np.uint64, count=len(parts)))


def set_name(hashes: np.ndarray) -> int:
    """A signed 64-bit number that stands for a shingle set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), 7)).astype(np.int64))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """SimHash of 256 bits over a shingle set; 32 bytes."""
    if not len(hashes):
        return bytes(8 * WORDS_WIDE)
    counts = np.zeros(BITS * WORDS_WIDE, np.int64)
    for low in range(0, len(hashes), 32768):
        piece = hashes[low : low + 32768, None] + np.arange(1, WORDS_WIDE + 1, dtype=np.uint64) * np.uint64(MIX[0])
        piece = (piece ^ (piece >> np.uint64(30))) * np.uint64(MIX[1])
        piece = (piece ^ (piece >> np.uint64(27))) * np.uint64(MIX[2])
        piece ^= piece >> np.uint64(31)
        counts += np.unpackbits(piece.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def distance_for(similarity: float, slack: float = 1.0) -> int:
    """Bits of a wide fingerprint in which sets of that Jaccard similarity differ, plus ``slack`` deviations."""
    size = BITS * WORDS_WIDE
    share = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(size * share + slack * np.sqrt(size * share * (1 - share)))


def _samples(cells: int, width: int) -> np.ndarray:
    """For each kind of cell, the ``width`` bit numbers it looks at: a fixed pseudo-random choice."""
    chooser = np.random.Generator(np.random.PCG64(20240607))
    return np.stack([chooser.choice(BITS * WORDS_WIDE, width, replace=False) for _ in range(cells)])


def _forest(bits: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the rows (words of 64 bits) that differ in at most ``distance`` bits."""
    left, edges = np.ones(len(bits), bool), []
    while left.any():
        start = int(np.flatnonzero(left)[0])
        left[start], frontier = False, [start]
        while frontier:
            at = frontier.pop()
            rest = np.flatnonzero(left)
            near = rest[np.bitwise_count(bits[rest] ^ bits[at]).sum(axis=1, dtype=np.int64) <= distance]
            left[near] = False
            edges += [(at, int(n)) for n in near]
            frontier += near.tolist()
    return edges


@lean
def near_links(
    nodes: DataFrame, distance: int, cells: int = 128, width: int = 18, block: int = 2048, at_once: int = 32, ahead: int = 8
) -> DataFrame:
    """Runs jobs. (a, b): links that connect all fingerprints found within ``distance`` bits of each other.

    ``nodes`` has wide fingerprints ``fp`` and a number ``low`` each. Segments are single bits here: with
    distances this wide, counts of longer segments are too coarse a bound (see README). A cell is the
    counts of ``width`` sampled segments; of ``cells`` kinds of cells, two texts of Jaccard similarity 0.8
    share one with probability about 0.99, at 0.9 nearly always. Within a cell the Manhattan distance of
    all segments decides, and only a spanning forest of the near pairs goes out, so a cell of n near copies
    gives n - 1 rows. A cell of over ``block`` members is cut into blocks that meet in pairs.

    ``at_once`` kinds of cells are shuffled at a time, and each turn drops its shuffle, so the disk needed is that of one. The first turn has ``ahead`` kinds only; what it connects is known to the
    others, which report links between different trees of it, so a large group of near copies isn't reported once more by every cell.
    """
    spark = nodes.sparkSession
    chosen, parts = _samples(cells, width), []
    grown = nodes.select("low", F.col("low").alias("tree"), "fp")
    turns = [0, *range(min(ahead, cells), cells, at_once), cells]
    for first, stop in zip(turns, turns[1:]):
        folder = new_folder(spark, "simhash")
        with scope(spark):
            parts.append(keep(_cell_links(grown, distance, chosen[first:stop], first, block), folder))
        if not first:
            trees = components(parts[0])
            grown = nodes.join(trees, F.col("low") == F.col("node"), "left").select("low", F.coalesce("root", "low").alias("tree"), "fp")
            grown = keep(grown, new_folder(spark, "simhash"))
    return keep(reduce(DataFrame.unionAll, parts).distinct(), new_folder(spark, "simhash"))


def _cell_links(nodes: DataFrame, distance: int, chosen: np.ndarray, first: int, block: int) -> DataFrame:
    """Runs a job. The links between different trees in the kinds of cells that look at the bits ``chosen``, numbered from ``first`` on."""
    spark = nodes.sparkSession
    cells, width = chosen.shape

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = (1 << np.arange(width, dtype=np.int64)).astype(np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                raw = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(-1, 8 * WORDS_WIDE)
                bits = np.unpackbits(raw, axis=1)
                keys = (bits[:, chosen].astype(np.int64) @ weights) + (np.arange(first, first + cells, dtype=np.int64) << (width + 1))
                again = np.repeat(np.arange(len(part)), cells)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), *(part.column(k).take(pa.array(again)) for k in range(3))], names=["cell", "low", "tree", "fp"]
                )

    placed = nodes.select("low", "tree", "fp").mapInArrow(place, "cell bigint, low bigint, tree bigint, fp binary")
    crowded = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    blocks = crowded.select("cell", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    blocks = keep(blocks, new_folder(spark, "simhash"))
    mine = F.pmod(F.xxhash64("low"), F.col("blocks")).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.least("mine", other) * 65536 + F.greatest("mine", other)
    )
    spread = (
        placed.join(blocks, "cell", "left")
        .withColumn("mine", mine)
        .select("cell", F.explode(F.coalesce(meets, F.array(F.lit(0)))).alias("meeting"), "low", "tree", "fp")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> pa.RecordBatch:
            cell, meeting = (table.column(k).to_numpy() for k in (0, 1))
            low, tree = (table.column(k).to_numpy() for k in (2, 3))
            bits = np.frombuffer(b"".join(table.column(4).to_pylist()), np.uint64).reshape(-1, WORDS_WIDE)
            new = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (meeting[1:] != meeting[:-1])])
            size = np.diff(np.r_[new, len(cell)])
            out_a, out_b = [], []
            small = (size > 1) & (size <= 24)
            group = np.repeat(np.where(small, np.arange(len(size)), -1 - np.arange(len(size))), size)
            for step in range(1, int(size[small].max(initial=1))):
                i = np.flatnonzero((group[step:] == group[:-step]) & (group[step:] >= 0) & (tree[step:] != tree[:-step]))
                near = i[np.bitwise_count(bits[i] ^ bits[i + step]).sum(axis=1, dtype=np.int64) <= distance]
                out_a.append(low[near])
                out_b.append(low[near + step])
            for g in np.flatnonzero(size > 24):
                rows = slice(new[g], new[g] + size[g])
                pairs = np.array(_forest(bits[rows], distance), dtype=np.int64).reshape(-1, 2)
                pairs = pairs[tree[rows][pairs[:, 0]] != tree[rows][pairs[:, 1]]]
                out_a.append(low[rows][pairs[:, 0]])
                out_b.append(low[rows][pairs[:, 1]])
            a = np.concatenate([np.empty(0, np.int64), *out_a])
            b = np.concatenate([np.empty(0, np.int64), *out_b])
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cells_now = batch.column(0).to_numpy()
            meets_now = batch.column(1).to_numpy()
            last = (cells_now != cells_now[-1]) | (meets_now != meets_now[-1])
            keep_from = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            head, tail = batch.slice(0, keep_from), batch.slice(keep_from)
            if head.num_rows:
                yield solve(pa.Table.from_batches([*held, head]))
                held = [tail]
            elif held and (held[-1].column(0)[0] != tail.column(0)[0] or held[-1].column(1)[0] != tail.column(1)[0]):
                yield solve(pa.Table.from_batches(held))
                held = [tail]
            else:
                held.append(tail)
        if held:
            yield solve(pa.Table.from_batches(held))

    met = spread.repartition("cell", "meeting").sortWithinPartitions("cell", "meeting", "low")
    return met.mapInArrow(link, "a bigint, b bigint").filter("a < b").distinct()


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b, same): every pair of ``pairs`` and whether the Jaccard similarity of its two sets is ``similarity`` or more.

    ``sets`` is (c, hashes), one row per set. Two empty sets do not meet here: they have one name.
    """
    one = sets.select(F.col("c").alias("a"), F.col("hashes").alias("ha"))
    two = sets.select(F.col("c").alias("b"), F.col("hashes").alias("hb"))
    na, nb, common = F.size("ha"), F.size("hb"), F.size(F.array_intersect("ha", "hb"))
    may = F.least(na, nb) >= similarity * F.greatest(na, nb)
    same = F.when(may, common >= similarity * (na + nb - common)).otherwise(F.lit(False))
    return pairs.join(one, "a").join(two, "b").select("a", "b", same.alias("same"))


def likely(rows: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Runs jobs. All ``rows`` whose bigint key is among ``keys``, and few others: about one in eight of those.

    For a join that would else shuffle texts of which most are not wanted. A bit table with one byte a key goes to every task.
    """
    page = 32768  # bits of what bitmap_construct_agg returns
    pages = max(1, -(-8 * keys.count() // page))
    place = F.pmod(F.xxhash64(key), F.lit(pages * page))
    number, bit = F.floor(place / page).cast("int"), (place % page).cast("int")
    marked = keys.select(number.alias("_page"), bit.cast("bigint").alias("_bit")).groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    marked = F.broadcast(keep(marked, new_folder(keys.sparkSession, "simhash")))
    octet = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_page", number).join(marked, "_page").filter(F.getbit(octet, bit % 8) == 1)
    return found.select(*rows.columns)


@lean
def near_copies(
    docs: DataFrame, key: str, text: str, words: int = 5, similarity: float = 0.8, slack: float = 3.0
) -> DataFrame:
    """Runs jobs. (key, component): the group of every row with a key, named by its smallest key.

    Texts are linked when the Jaccard similarity of their ``words``-word shingle sets is ``similarity`` or more. 256-bit
    fingerprints only propose the pairs, at the distance of that similarity plus ``slack`` deviations. A spanning
    forest of the proposals is verified; a tree in which one of its links fails is taken apart by an exact join of its members'
    sets, which tests few pairs of a group (see ``similar_classes``) and loses none. Null and empty texts are copies of each other. Rows with
    a null key take no part; rows that share a key are one document, whatever their texts.
    """
    spark = docs.sparkSession

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
            names = pa.array([set_name(s) for s in sets], pa.int64())
            fps = pa.array([wide_fingerprint(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), names, fps], names=["key", "c", "fp"])

    def reread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
            mine = [n for n, s in enumerate(sets) if set_name(s) == batch.column(0)[n].as_py()]
            hashes = pa.array([sets[n].view(np.int64) for n in mine], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(mine, pa.int64())), hashes], names=["key", "items"])

    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    signed = keep(rows.mapInArrow(sign, "key bigint, c bigint, fp binary"), new_folder(spark, "simhash"))
    nodes = keep(signed.groupBy("c").agg(F.min("key").alias("key"), F.first("fp").alias("fp")), new_folder(spark, "simhash"))

    def sets_of(ends: DataFrame) -> DataFrame:
        wanted = keep(ends.join(nodes, "c").select("c", "key"), new_folder(spark, "simhash"))
        sets = likely(rows, wanted).join(wanted, "key").select("c", "text").mapInArrow(reread, "key bigint, items array<bigint>")
        return dealt(sets.withColumn("size", F.size("items")), once=True)

    named = nodes.select(F.col("c").alias("low"), "fp")
    proposed = near_links(named, distance_for(similarity, slack))
    sets = sets_of(proposed.select(F.col("a").alias("c")).unionAll(proposed.select("b")).distinct())
    compared = verified(proposed, sets.select(F.col("key").alias("c"), F.col("items").alias("hashes")), similarity)
    first = keep(compared, new_folder(spark, "simhash"))
    good = first.filter("same").select("a", "b")
    failed = first.filter("NOT same").select("a", "b")
    if not failed.isEmpty():
        trees = keep(components(first), new_folder(spark, "simhash"))
        open_trees = failed.select(F.col("a").alias("node")).join(trees, "node").select("root").distinct()
        within = trees.join(open_trees, "root").select(F.col("node").alias("key"))
        exact = similar_classes(dealt(sets, keep(within, new_folder(spark, "simhash")), again=True), similarity, is_dealt=True)
        good = good.unionAll(exact.select(F.col("node").alias("a"), F.col("label").alias("b")))
    lows = nodes.select("c", F.col("key").alias("low"))
    pairs = good.join(lows.select(F.col("c").alias("a"), F.col("low").alias("x")), "a")
    pairs = pairs.join(lows.select(F.col("c").alias("b"), F.col("low").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    copies = signed.join(lows, "c").filter("key <> low").select(F.col("key").alias("a"), F.col("low").alias("b"))
    member = components(pairs.unionAll(copies))
    return signed.select("key").distinct().join(member, F.col("key") == F.col("node"), "left").select(
        "key", F.coalesce("root", "key").alias("component")
    )


@lean
def first_of_each(docs: DataFrame, key: str, text: str, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """Runs jobs. ``docs`` without the rows whose key is not the smallest of its group of near copies.

    All columns and nothing else. Rows with a null key stay; rows that share a key stay or go together.
    The keys to drop are written first, so texts are shuffled only when there are too many of those keys.
    """
    found = near_copies(docs, key, text, words, similarity).filter("key <> component")
    mark = fresh(docs.columns, "later")
    later = keep(found.select(F.col("key").alias(mark)), new_folder(docs.sparkSession, "simhash"))
    return docs.join(later, F.col(key) == F.col(mark), "left_anti")
