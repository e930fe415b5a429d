"""SimHash near-duplicates by a hierarchical index over fingerprints in Gray order.

Two fingerprints of 64 bits that differ in 3 bits or fewer agree in one of four blocks of 16 bits. Each distinct
fingerprint is therefore filed four times, rotated so that another block stands in front, and only neighbours with the
same front block are compared. The rotated fingerprints are sorted by Gray rank and dealt out by range, so that a front
block shared by very many of them spans several tasks.

Within a task, runs of equal leading bits form the nodes of a tree. A node keeps the bits that all its fingerprints share
(a mask and a pattern). Pairs of nodes are followed downwards; a pair is given up as a whole when the shared patterns
already differ in more than 3 bits, or when all its fingerprints are known to be connected. Where a front block spans
tasks, the same test on its parts decides which pairs of parts are compared. A task returns a spanning forest, never its
pairs; forests are joined to components by star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newstide.llm.common import column, free_name, map_batches, texts_of
from newstide.session import cut, stage

SEED = 42
#: Rotated fingerprints per task, and pairs of nodes looked at together; both bound memory only.
TASK_ROWS = 100_000
BLOCK_PAIRS = 2_000_000
LEVELS = (16, 24, 32, 40, 48, 56, 64)


def fingerprint(text: str, width: int = 3) -> int:
    """64-bit SimHash over shingles of ``width`` words, repeats included; zero for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A to Z, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        set_bits += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: dict[str, str], width: int = 3) -> DataFrame:
    """Columns ``keep`` (name to type) of ``docs`` and ``fp``, the fingerprint of ``text`` as a signed long; null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, width) for t in texts_of(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in keep], pa.array(fp)], [*keep, "fp"])

    rows = docs.select(*[F.col(c).cast(t).alias(c) for c, t in keep.items()], "text")
    return map_batches(rows, run, ", ".join(f"{c} {t}" for c, t in [*keep.items(), ("fp", "long")]))


def gray_rank(bits: Column) -> Column:
    """Place of a bit pattern in Gray order: every bit is the parity of itself and those before it."""
    for step in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, step))
    return bits


def rotated(fp: Column, turn: int) -> Column:
    return fp if not turn else F.shiftleft(fp, 16 * turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - 16 * turn))


def _find(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of a[i] and b[i]; parent[i] is the lowest member of i's set, before and after."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def forest(bits: np.ndarray, turn: np.ndarray, side: np.ndarray, most: int = 3) -> np.ndarray:
    """For each rotated fingerprint, the lowest place of the component it was found to belong to.

    Input is sorted by (side, turn, Gray rank) and distinct within (side, turn). With two sides only pairs across them
    are followed, otherwise all pairs of one turn and front block.
    """
    n = len(bits)
    parent = np.arange(n)
    if n < 2:
        return parent
    # Neighbours in Gray order first: they join most of a dense group, and what is joined is skipped below.
    for gap in (1, 2, 3):
        if n > gap:
            near = (turn[gap:] == turn[:-gap]) & (np.bitwise_count(bits[gap:] ^ bits[:-gap]) <= most)
            at = np.flatnonzero(near)
            parent = _find(parent, at, at + gap)

    starts, child, low, high = [], [], [], []
    base = np.concatenate([[True], (turn[1:] != turn[:-1]) | (side[1:] != side[:-1])])
    for level in LEVELS:
        front = bits >> np.uint64(64 - level)
        at = np.flatnonzero(base | np.concatenate([[True], front[1:] != front[:-1]]))
        starts.append(np.append(at, n))
        low.append(np.bitwise_and.reduceat(bits, at))
        high.append(np.bitwise_or.reduceat(bits, at))
    for k in range(len(LEVELS) - 1):
        child.append(np.searchsorted(starts[k + 1], starts[k]))
    last = len(LEVELS) - 1
    to_leaf = [s[:-1] for s in starts]  # first leaf of a node; leaves are single fingerprints

    top = np.arange(len(starts[0]) - 1)
    if side[0] == side[-1]:
        a = b = top[np.diff(starts[0]) > 1]
    else:
        front = bits[starts[0][:-1]] >> np.uint64(48)
        first = {(int(t), int(f)): i for i, (t, f, s) in enumerate(zip(turn[starts[0][:-1]], front, side[starts[0][:-1]], strict=True)) if s == side[0]}
        both = [(first[k], i) for i, (t, f, s) in enumerate(zip(turn[starts[0][:-1]], front, side[starts[0][:-1]], strict=True)) if s != side[0] and (k := (int(t), int(f))) in first]
        a, b = (np.array([p[i] for p in both], np.int64) for i in (0, 1))

    work = [(0, a, b)]
    while work:
        level, a, b = work.pop()
        if not len(a):
            continue
        at = starts[level]
        # Skip pairs whose fingerprints are all in one component already.
        lo = np.minimum.reduceat(parent, at[:-1])
        hi = np.maximum.reduceat(parent, at[:-1])
        open_ = ~((lo[a] == hi[a]) & (lo[b] == hi[b]) & (lo[a] == lo[b]))
        a, b = a[open_], b[open_]
        if not len(a):
            continue
        size_a, size_b = at[a + 1] - at[a], at[b + 1] - at[b]
        small = size_a * size_b <= 1024
        for chosen, down in ((small, last), (~small, level + 1)):
            x, y = a[chosen], b[chosen]
            if not len(x):
                continue
            kids = to_leaf[level] if down == last else child[level][:-1]
            count = (at[1:] - at[:-1]) if down == last else np.diff(child[level])
            pairs = count[x] * count[y]
            if len(x) > 1 and pairs.sum() > BLOCK_PAIRS:
                half = max(1, int(np.searchsorted(np.cumsum(pairs), pairs.sum() // 2)))
                half = min(half, len(x) - 1)
                work += [(level, x[half:], y[half:]), (level, x[:half], y[:half])]
                continue
            which = np.repeat(np.arange(len(x)), pairs)
            k = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
            i = kids[x[which]] + k // count[y[which]]
            j = kids[y[which]] + k % count[y[which]]
            same = x[which] == y[which]
            keep = ~same | (i < j if down == last else i <= j)
            i, j = i[keep], j[keep]
            if down == last:
                linked = np.bitwise_count(bits[i] ^ bits[j]) <= most
                parent = _find(parent, i[linked], j[linked])
                continue
            shared = ~(low[down][i] ^ high[down][i]) & ~(low[down][j] ^ high[down][j])
            keep = np.bitwise_count((low[down][i] ^ low[down][j]) & shared) <= most
            single = np.diff(starts[down]) == 1
            keep &= (i != j) | ~single[i]
            work.append((down, i[keep], j[keep]))
    return parent


def _edges(table: pa.Table, most: int) -> pa.Table:
    get = lambda c: table.column(c).to_numpy()
    bits, turn, side, rank, fp = get("bits").view(np.uint64), get("turn"), get("side"), get("rank").view(np.uint64), get("fp")
    order = np.lexsort((rank, turn, side))
    bits, turn, side, fp = bits[order], turn[order], side[order], fp[order]
    parent = forest(bits, turn, side, most)
    # The lowest fingerprint of a component is its root in every task, so that forests of different tasks meet soon.
    ids = np.argsort(parent, kind="stable")
    cutoff = np.flatnonzero(np.concatenate([[True], parent[ids][1:] != parent[ids][:-1]]))
    root = np.empty_like(fp)
    root[ids] = np.repeat(np.minimum.reduceat(fp[ids], cutoff), np.diff(np.append(cutoff, len(ids))))
    linked = np.flatnonzero(root != fp)
    found = np.unique(np.stack([fp[linked], root[linked]], 1), axis=0)
    return pa.table({"a": pa.array(found[:, 0], pa.int64()), "b": pa.array(found[:, 1], pa.int64())})


def link_edges(unique: DataFrame, most: int) -> DataFrame:
    """(a, b) with a > b: edges whose components are those of all fingerprints at ``most`` or fewer differing bits."""
    if most > 3:
        raise ValueError("four blocks find pairs within 3 bits only")
    spark = unique.sparkSession
    n = unique.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * n // TASK_ROWS))
    turns = F.explode(F.array(*[F.struct(F.lit(t).alias("turn"), rotated(F.col("fp"), t).alias("bits")) for t in range(4)])).alias("x")
    filed = unique.select("fp", turns).select("fp", "x.turn", "x.bits").withColumn("rank", gray_rank(F.col("bits")))
    filed = filed.repartitionByRange(parts, "turn", "rank").withColumn("part", F.spark_partition_id())
    filed = stage(filed.withColumn("front", F.shiftrightunsigned("bits", 48)), "gray")

    # A front block that spans tasks: its parts, with the bits each part shares, and the pairs that may hold links.
    leaves = filed.groupBy("turn", "front", "part").agg(F.bit_and("bits").alias("low"), F.bit_or("bits").alias("high"))
    w = Window.partitionBy("turn", "front")
    leaves = cut(leaves.withColumn("of", F.count("*").over(w)).where("of > 1").drop("of"))
    left, right = leaves.alias("l"), leaves.alias("r")
    shared = F.bitwise_not(F.col("l.low").bitwiseXOR(F.col("l.high"))).bitwiseAND(F.bitwise_not(F.col("r.low").bitwiseXOR(F.col("r.high"))))
    pairs = left.join(right, (F.col("l.turn") == F.col("r.turn")) & (F.col("l.front") == F.col("r.front")) & (F.col("l.part") < F.col("r.part")))
    pairs = pairs.where(F.bit_count(F.col("l.low").bitwiseXOR(F.col("r.low")).bitwiseAND(shared)) <= most)
    pairs = cut(pairs.select(F.col("l.turn").alias("turn"), F.col("l.front").alias("front"), F.col("l.part").alias("p"), F.col("r.part").alias("q")))
    sides = pairs.select("turn", "front", "p", "q", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("p").alias("part")), F.struct(F.lit(1).alias("side"), F.col("q").alias("part")))).alias("s"))
    sides = sides.select("turn", "front", "p", "q", "s.side", "s.part")

    rows = filed.select("fp", "turn", "bits", "rank", F.lit(0).alias("side"), F.lit(-1).alias("t"), F.lit(-1).cast("long").alias("f"), F.col("part").alias("p"), F.col("part").alias("q"))
    across = filed.join(sides, ["turn", "front", "part"]).select("fp", "turn", "bits", "rank", "side", F.col("turn").alias("t"), F.col("front").alias("f"), "p", "q")
    return rows.unionByName(across).groupBy("t", "f", "p", "q").applyInArrow(lambda table: _edges(table, most), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the lowest node that can be reached.

    Alternating star contraction: each node's greater neighbours, then each node's lesser ones, are tied to the lowest
    node known. Every round is cut by a checkpoint; rounds grow with the logarithm of the component size.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = cut(both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def named_components(unique: DataFrame, most: int) -> DataFrame:
    """(fp, component_id) of distinct fingerprints ``fp`` with ``first_id``: the smallest one in the component."""
    tied = cut(components(link_edges(unique, most)))
    tied = tied.unionByName(tied.select(F.col("root").alias("node"), "root").distinct())
    ids = cut(tied.join(unique, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first_id").alias("component_id")))
    named = tied.join(ids, "root").select(F.col("node").alias("fp"), "component_id")
    return stage(unique.join(named, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "components")


def near_duplicates(docs: DataFrame, width: int = 3, keep: dict[str, str] | None = None, most: int = 3) -> DataFrame:
    """Columns ``keep`` (default ``doc_id``), ``fp`` and ``component_id`` for every row of ``docs``.

    Rows are linked when their fingerprints differ in ``most`` bits or fewer, 3 at most; ``component_id`` is the smallest ``doc_id``
    that can be reached. Null and empty texts have fingerprint zero and link like any other. Repeated rows stay.
    A component in which every ``doc_id`` is null has a null id. An empty table gives an empty result.
    """
    keep = keep or {"doc_id": "long"}
    marked = stage(fingerprints(docs, keep, width), "fingerprints")
    unique = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "unique")
    named = named_components(unique, most)
    return marked.join(named, "fp").select(*keep, "fp", "component_id")


def keep_one(docs: DataFrame, width: int = 3, most: int = 3) -> DataFrame:
    """One row of each component of near-duplicates, with all columns: that of the smallest ``doc_id``, ties by the hash of
    the text; of rows equal in both, any one. Rows with a null id stand behind others. Fingerprints of shingles of ``width``
    words link at ``most`` or fewer differing bits."""
    names = docs.columns
    key, check = free_name(docs, "key"), free_name(docs, "check")
    keyed = docs.withColumns({key: F.xxhash64("doc_id", "text"), check: F.hash("text", "doc_id")})
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("key"), F.col("check"))
    marked = stage(fingerprints(keyed.select("doc_id", "text", F.col(key).alias("key"), F.col(check).alias("check")), {"doc_id": "long", "key": "long", "check": "int"}, width), "fingerprints")
    unique = stage(marked.groupBy("fp").agg(F.min(rank).alias("first_id")), "unique")
    first = named_components(unique, most).select(F.col("component_id.key").alias(key), F.col("component_id.check").alias(check))
    first = stage(first.distinct(), "first")
    return keyed.join(first, [key, check], "left_semi").dropDuplicates([key, check]).select(*names)
