"""Near-duplicate vectors by sorted projection passes.

In each pass a vector is turned by several random orthogonal maps; the axis nearest to it, with its sign, is one hash, and
the hashes one after another are its place in the order of the pass. Vectors are sorted lexicographically by them, and
each is compared with a bounded window of the ones after it. What a window holds is compared on 16-bit floats, with a bound
on their error; pairs the bound leaves open are verified in double precision on the vectors themselves. A task returns a
spanning forest of its pairs, and forests of all passes are joined to components.

Equal vectors are counted, not compared. A window cannot hold a group of copies larger than itself, so links are counted
afterwards within components, where no window applies: members so near a centre that any two of them link are counted
as a whole, and only the others are compared with the members, tile by tile.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import column, map_batches, usable_vector
from newstide.llm.simhash import components
from newstide.session import cut, stage

PASSES, WINDOW = 4, 1024
#: Random maps per pass, each a hash of an axis and its sign, so that a key has HASHES * log2(2 * dimensions) bits.
HASHES = 4
#: Rows of a task, of a tile and of one comparison; they bound memory only.
TASK_ROWS = 50_000
TILE_ROWS = 2048
CHUNK = 256
#: Rounding of one comparison in single precision on unit vectors.
SLACK = 1e-5


def turns(dimensions: int, seed: int) -> np.ndarray:
    """Random orthogonal maps, one below another."""
    rng = np.random.default_rng([seed, dimensions])
    return np.concatenate([np.linalg.qr(rng.standard_normal((dimensions, dimensions)))[0] for _ in range(HASHES)])


def sort_keys(unit: np.ndarray, seed: int) -> np.ndarray:
    """HASHES hashes of 16 bits per row, one after another in a signed 64-bit number."""
    n, d = unit.shape
    turned = (unit.astype(np.float32) @ turns(d, seed).T.astype(np.float32)).reshape(n, HASHES, d)
    axis = np.abs(turned).argmax(2)
    sign = np.take_along_axis(turned, axis[:, :, None], 2)[:, :, 0] < 0
    hashes = ((2 * axis + sign) & 0xFFFF).astype(np.int64)
    key = np.zeros(n, np.int64)
    for h in range(HASHES):
        key = (key << 16) | hashes[:, h]
    return key


def join_sets(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unite the sets of a[i] and b[i]; parent[i] is the lowest member of the set of i, before and after."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def window_pairs(half: np.ndarray, place: np.ndarray, least: float, window: int, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Compare sorted rows of one group with those after them, up to ``window`` places on.

    Returns the lowest linked row per row, and the pairs that the precision leaves open and no links connect. Rows start a
    pair where ``first`` is set.
    """
    n = len(half)
    parent = np.arange(n)
    rough = half.astype(np.float32)
    # What rounding to 16 bits took away: half a step of 2**-10 of an entry at most, or half of the smallest step.
    rest = np.sqrt(((np.abs(rough) * 2.0**-11 + 2.0**-25) ** 2).sum(1))
    open_: list[np.ndarray] = []
    for at in range(0, n, CHUNK):
        to = min(at + CHUNK, n)
        if not first[at:to].any():
            continue
        end = int(np.searchsorted(place, place[to - 1] + window, "right"))
        like = rough[at:to] @ rough[at:end].T
        off = float(rest[at:end].max()) * 2 + SLACK
        i, j = np.nonzero(like >= least - off)
        gap = place[at + j] - place[at + i]
        fits = (gap > 0) & (gap <= window) & first[at + i]
        i, j = i[fits], j[fits]
        sure = like[i, j] - off >= least
        parent = join_sets(parent, at + i[sure], at + j[sure])
        if not sure.all():
            open_.append(np.stack([at + i[~sure], at + j[~sure]], 1))
    return parent, [p[parent[p[:, 0]] != parent[p[:, 1]]] for p in open_]


def usable_rows(rows: DataFrame, vec: str, group: str) -> DataFrame:
    """Add ``grp``, ``a`` and ``b``: the group of equal label and length, and 128 bits of hash of the vector.

    ``grp`` is null for rows that link with nothing.
    """
    v = F.col(vec)
    good = usable_vector(v) & F.exists(v, lambda x: x != 0) & F.col(group).isNotNull()
    return rows.withColumns({
        "grp": F.when(good, F.xxhash64(group, F.size(v))),
        "a": F.when(good, F.xxhash64(F.lit(1), v)),
        "b": F.when(good, F.xxhash64(F.lit(2), v)),
    })


def unit_rows(batch: pa.RecordBatch, name: str = "vec") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, unit vectors) for each length of vector in a batch; each row is scaled to avoid overflow."""
    vec = column(batch, name)
    sizes = np.diff(vec.offsets.to_numpy())
    flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        m = flat[starts[at, None] + np.arange(d)]
        m = m / np.abs(m).max(1, keepdims=True)
        yield at, m / np.linalg.norm(m, axis=1, keepdims=True)


PASS_ROW = "turn int, grp long, key long, a long, b long, half binary"
#: A task's results: links found, pairs to verify, its number of rows, and its rows at either end of its range.
FOUND = "kind string, grp long, la long, lb long, ra long, rb long, part int, place int, turn int, half binary"


def _pass_rows(base: DataFrame, passes: int) -> DataFrame:
    """Each vector once per pass, with its place in the order; a task does not repeat the copies it has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int, int]] = set()
        for batch in batches:
            ids = list(zip(*(column(batch, c).to_pylist() for c in ("grp", "a", "b")), strict=True))
            fresh = []
            for i, key in enumerate(ids):
                if key not in met:
                    met.add(key)
                    fresh.append(i)
            if len(met) > 300_000:
                met.clear()
            if not fresh:
                continue
            batch = batch.take(pa.array(fresh))
            grp, a, b = (column(batch, c) for c in ("grp", "a", "b"))
            for at, unit in unit_rows(batch):
                rows, size = pa.array(at), 2 * unit.shape[1]
                half = unit.astype("<f2").tobytes()
                halves = pa.array([half[i : i + size] for i in range(0, len(half), size)], pa.binary())
                for turn in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), turn, np.int32)), grp.take(rows), pa.array(sort_keys(unit, turn)), a.take(rows), b.take(rows), halves],
                        ["turn", "grp", "key", "a", "b", "half"],
                    )

    return map_batches(base.where("grp is not null").select("grp", "a", "b", "vec"), run, PASS_ROW)


def _found(kind: str, n: int, **columns: pa.Array) -> pa.RecordBatch:
    schema = pa.schema([("kind", pa.string()), *[(c, pa.int64()) for c in ("grp", "la", "lb", "ra", "rb")], *[(c, pa.int32()) for c in ("part", "place", "turn")], ("half", pa.binary())])
    values = {"kind": pa.array([kind] * n)} | columns
    return pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)


def _compare(grp, turn, a, b, halves: list[bytes], place: np.ndarray, first: np.ndarray, least: float, window: int) -> Iterator[pa.RecordBatch]:
    """Links and open pairs of sorted rows, as rows of FOUND."""
    # Rows of one group and pass follow one another; lengths are equal within a group.
    cut_at = np.flatnonzero(np.concatenate([[True], (grp[1:] != grp[:-1]) | (turn[1:] != turn[:-1]), [True]]))
    for lo, hi in zip(cut_at[:-1].tolist(), cut_at[1:].tolist(), strict=True):
        if hi - lo < 2:
            continue
        half = np.frombuffer(b"".join(halves[lo:hi]), "<f2").reshape(hi - lo, -1)
        parent, pairs = window_pairs(half, place[lo:hi], least, window, first[lo:hi])
        linked = np.flatnonzero(parent != np.arange(hi - lo))
        for kind, i, j in (("link", linked, parent[linked]), *[("open", p[:, 0], p[:, 1]) for p in pairs]):
            if len(i):
                ends = {"la": a[lo + i], "lb": b[lo + i], "ra": a[lo + j], "rb": b[lo + j]}
                yield _found(kind, len(i), grp=pa.array(grp[lo + i]), **{k: pa.array(v) for k, v in ends.items()})


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> list:
    """Columns of the distinct vectors of sorted batches; copies follow one another."""
    keep: list[list] = [[], [], [], [], []]
    last = None
    for batch in batches:
        for row in zip(*(column(batch, c).to_pylist() for c in ("turn", "grp", "a", "b", "half")), strict=True):
            if row[:4] != last:
                last = row[:4]
                for values, value in zip(keep, row, strict=True):
                    values.append(value)
    return [np.array(keep[0], np.int32), *[np.array(c, np.int64) for c in keep[1:4]], keep[4]]


def found_in_passes(base: DataFrame, n: int, least: float, passes: int, window: int) -> DataFrame:
    """Rows of FOUND for the windows of all passes, within tasks and across their borders; staged."""
    spark = base.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * passes // TASK_ROWS))
    order = ["turn", "grp", "key", "a", "b"]
    placed = _pass_rows(base, passes).repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[int] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows and not part:
                    part.append(column(batch, "part")[0].as_py())
                yield batch

        turn, grp, a, b, halves = _sorted_rows(noted())
        n_rows = len(grp)
        if not n_rows:
            return
        yield _found("size", 1, part=pa.array(part, pa.int32()), place=pa.array([n_rows], pa.int32()))
        yield from _compare(grp, turn, a, b, halves, np.arange(n_rows), np.ones(n_rows, bool), least, window)
        for kind, lo, hi in (("head", 0, min(window, n_rows)), ("tail", max(0, n_rows - window), n_rows)):
            for i in range(lo, hi, 1000):
                to = min(i + 1000, hi)
                # Places of a tail count back from the border.
                at = np.arange(i, to, dtype=np.int32) - (n_rows if kind == "tail" else 0)
                yield _found(
                    kind, to - i, grp=pa.array(grp[i:to]), la=pa.array(a[i:to]), lb=pa.array(b[i:to]), turn=pa.array(turn[i:to]),
                    part=pa.array(part * (to - i), pa.int32()), place=pa.array(at.astype(np.int32)), half=pa.array(halves[i:to], pa.binary()),
                )

    found = stage(map_batches(placed, run, FOUND), "passes")
    # One number per task: which ranges follow a border within a window.
    sizes = {r["part"]: r["place"] for r in found.where("kind = 'size'").select("part", "place").collect()}
    ranges = sorted(sizes)
    seats = []
    for k, left in enumerate(ranges):
        before = 0
        for right in ranges[k + 1 :]:
            if before >= window:
                break
            seats.append((left, right, before))
            before += sizes[right]
    if not seats:
        return found
    seats = spark.createDataFrame(seats, "border int, part int, before int")
    lefts = seats.select("border").distinct()
    tails = found.where("kind = 'tail'").join(F.broadcast(lefts), F.col("part") == F.col("border")).select("border", "place", "turn", "grp", "la", "lb", "half")
    heads = found.where("kind = 'head'").join(F.broadcast(seats), "part").select("border", (F.col("place") + F.col("before")).cast("int").alias("place"), "turn", "grp", "la", "lb", "half")

    def across(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        get = lambda c: table.column(c).to_numpy()
        place = get("place").astype(np.int64)
        out = list(_compare(get("grp"), get("turn"), get("la"), get("lb"), table.column("half").to_pylist(), place, place < 0, least, window))
        return pa.Table.from_batches(out or [_found("none", 0)])

    return stage(found.unionByName(tails.unionByName(heads).groupBy("border").applyInArrow(across, FOUND)), "found")


def _exact_cosine(x: Column, y: Column) -> Column:
    """In double precision, each vector scaled by its greatest entry so that no square overflows."""

    def dot(p: Column, q: Column) -> Column:
        return F.aggregate(F.zip_with(p, q, lambda i, j: i * j), F.lit(0.0), lambda s, v: s + v)

    return dot(x, y) / (F.sqrt(dot(x, x)) * F.sqrt(dot(y, y)))


def _scaled(vec: Column) -> Column:
    top = F.array_max(F.transform(vec, lambda v: F.abs(v.cast("double"))))
    return F.zip_with(vec, F.array_repeat(top, F.size(vec)), lambda v, t: v.cast("double") / t)


def link_edges(base: DataFrame, reps: DataFrame, least: float, passes: int, window: int) -> DataFrame:
    """(a, b): edges between nodes of ``reps`` that connect what the verified pairs of all passes connect."""
    found = found_in_passes(base, reps.count(), least, passes, window)
    left, right = ["grp", "la", "lb"], ["grp", "ra", "rb"]
    node = reps.select("grp", "a", "b", "node")
    at_left, at_right = node.toDF(*left, "l"), node.toDF(*right, "r")
    links = found.where("kind = 'link'").select("grp", "la", "lb", "ra", "rb").distinct()
    links = links.join(at_left, left).join(at_right, right).select(F.col("l").alias("a"), F.col("r").alias("b"))
    open_ = cut(found.where("kind = 'open'").select("grp", "la", "lb", "ra", "rb").distinct().join(at_left, left).join(at_right, right).select("l", "r"))
    if open_.limit(1).count():
        wanted = open_.select(F.explode(F.array("l", "r")).alias("node")).distinct()
        vecs = cut(vectors_of(base, reps.join(wanted, "node")).select("node", _scaled(F.col("vec")).alias("x")))
        pairs = open_.join(vecs.toDF("l", "x"), "l").join(vecs.toDF("r", "y"), "r")
        links = links.unionByName(pairs.where(_exact_cosine(F.col("x"), F.col("y")) >= least).select(F.col("l").alias("a"), F.col("r").alias("b")))
    return links


def vectors_of(base: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` with their vectors, one row each; read from the row of the lowest id, so that copies do not travel."""
    chosen = nodes.withColumnRenamed("first_id", "own_id")
    same = F.col("id").eqNullSafe(F.col("own_id")) & (base["grp"] == chosen["grp"]) & (base["a"] == chosen["a"]) & (base["b"] == chosen["b"])
    return base.join(chosen, same).select(*[chosen[c] for c in chosen.columns], "vec").dropDuplicates(["node"])


def _counted(least: float):
    """Counts links in a bucket of whole components."""

    def run(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        root, node, n = (column(batch, c).to_numpy() for c in ("root", "node", "n"))
        links = np.zeros(len(root), np.int64)
        for at, unit in unit_rows(batch):
            order = np.argsort(root[at], kind="stable")
            at, unit = at[order], unit[order]
            starts = np.flatnonzero(np.concatenate([[True], root[at][1:] != root[at][:-1], [True]]))
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                near = unit[lo:hi] @ unit[lo:hi].T >= least
                np.fill_diagonal(near, True)
                links[at[lo:hi]] = near @ n[at[lo:hi]] - 1
        return pa.table({"node": node, "links": links})

    return run


def count_links(vecs: DataFrame, least: float) -> DataFrame:
    """(node, links) for rows (root, node, n, vec): rows of other nodes, and copies, that link with a node.

    Links lie within components, so each is counted apart: small ones as a whole, in buckets; large ones by a centre and
    tiles, as the head of this module says.
    """
    spark = vecs.sparkSession
    sizes = cut(vecs.groupBy("root").agg(F.count("*").alias("size")))
    rows = vecs.join(sizes, "root")
    small, large = rows.where(F.col("size") <= TILE_ROWS), rows.where(F.col("size") > TILE_ROWS)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    bucket = F.pmod(F.xxhash64("root"), F.lit(buckets)).alias("bucket")
    out = small.select(bucket, "root", "node", "n", "vec").groupBy("bucket").applyInArrow(_counted(least), "node long, links long")
    if not sizes.where(F.col("size") > TILE_ROWS).limit(1).count():
        return out

    def part_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def give() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["root", "sum"])
            sums.clear()
            return made

        for batch in batches:
            root = column(batch, "root").to_numpy()
            for at, unit in unit_rows(batch):
                for r in np.unique(root[at]):
                    sums[int(r)] = sums.get(int(r), 0) + unit[root[at] == r].sum(0)
            if len(sums) > 2000:
                yield give()
        if sums:
            yield give()

    parts = map_batches(large.select("root", "vec"), part_sums, "root long, sum array<double>")
    lines = parts.select("root", F.posexplode("sum").alias("i", "s")).groupBy("root", "i").agg(F.sum("s").alias("s"))
    centres = lines.groupBy("root").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "s"))), lambda c: c["s"]).alias("centre"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = math.cos(math.acos(least) / 2 - 1e-6)  # two members within half the angle of the centre link
        for batch in batches:
            core = np.zeros(batch.num_rows, bool)
            centre = {tuple(at.tolist()): unit for at, unit in unit_rows(batch, "centre")}
            for at, unit in unit_rows(batch):
                core[at] = (unit * centre[tuple(at.tolist())]).sum(1) >= reach
            yield pa.RecordBatch.from_arrays([*[column(batch, c) for c in ("root", "node", "n", "size", "vec")], pa.array(core)], ["root", "node", "n", "size", "vec", "core"])

    kind = vecs.schema["vec"].dataType.simpleString()
    marked = large.join(centres, "root").select("root", "node", "n", "size", "vec", "centre")
    marked = stage(map_batches(marked, mark, f"root long, node long, n long, size long, vec {kind}, core boolean"), "members")
    whole = marked.groupBy("root").agg(
        F.sum(F.when(F.col("core"), F.col("n"))).alias("core_n"), F.count_if(~F.col("core")).alias("shell")
    )
    marked = marked.join(whole, "root")
    wholly = marked.select("node", F.when(F.col("core"), F.col("core_n") - 1).otherwise(F.lit(-1)).cast("long").alias("links"))

    def blocks(count: str) -> Column:
        return F.ceil(F.col(count) / F.lit(TILE_ROWS)).cast("int")

    def own_block(count: str) -> Column:
        return F.pmod(F.xxhash64("node"), blocks(count).cast("long")).cast("int")

    def all_blocks(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), blocks(count) - 1))

    tiled = marked.where("shell > 0")
    shells = tiled.where("not core").select("root", own_block("shell").alias("x"), all_blocks("size").alias("y"), F.lit(0).alias("side"), "node", "n", "core", "vec")
    members = tiled.select("root", all_blocks("shell").alias("x"), own_block("size").alias("y"), F.lit(1).alias("side"), "node", "n", "core", "vec")

    def tile(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        side, node, n = (column(batch, c).to_numpy() for c in ("side", "node", "n"))
        core = column(batch, "core").to_numpy(zero_copy_only=False)
        (_, unit), = unit_rows(batch)
        s, m = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        near = unit[s] @ unit[m].T >= least
        near |= node[s][:, None] == node[m][None, :]
        inner = core[m]
        return pa.table({
            "node": np.concatenate([node[s], node[m][inner]]),
            "links": np.concatenate([near @ n[m], near[:, inner].T @ n[s]]).astype(np.int64),
        })

    tiles = shells.unionByName(members).groupBy("root", "x", "y").applyInArrow(tile, "node long, links long")
    return out.unionByName(wholly.unionByName(tiles).groupBy("node").agg(F.sum("links").alias("links")))


def near_duplicates(
    rows: DataFrame, least: float = 0.93, passes: int = PASSES, window: int = WINDOW, vec: str = "embedding", group: str = "label", key: str = "vec_id"
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row: rows are linked where the group is equal and the cosine at least ``least``.

    Links are found in windows; a pair that no window of any pass holds, and that no chain of links connects, is missed.
    Within a component every link is counted. Copies link with one another. A vector that is null, empty or zero, or has
    null or non-finite entries, and one with a null group or another length, links with nothing (``n_links`` 0, itself as
    component). Null keys stand behind others: a component of null keys only has a null id, and a row with a null key is
    not kept. Rows that repeat a key are rows of their own. Other columns are not read.
    """
    spark = rows.sparkSession
    base = usable_rows(rows.select(F.col(key).alias("id"), F.col(group).alias("label"), F.col(vec).alias("vec")), "vec", "label").select("id", "grp", "a", "b", "vec")
    reps = base.where("grp is not null").groupBy("grp", "a", "b").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    reps = stage(reps.withColumn("node", F.monotonically_increasing_id()), "distinct")
    tied = cut(components(link_edges(base, reps, least, passes, window)))
    tied = tied.unionByName(tied.select(F.col("root").alias("node"), "root").distinct())
    members = stage(reps.join(tied, "node"), "tied")
    vecs = stage(vectors_of(base, members).select("root", "node", "n", "vec"), "linked")
    heads = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    info = members.join(heads, "root").join(count_links(vecs, least), "node").select("grp", "a", "b", "links", "component_id")
    alone = reps.where("n > 1").join(members.select("node"), "node", "left_anti")
    info = stage(info.unionByName(alone.select("grp", "a", "b", (F.col("n") - 1).alias("links"), F.col("first_id").alias("component_id"))), "links")
    known = base.select("id", "grp", "a", "b").join(info.withColumn("known", F.lit(True)), ["grp", "a", "b"], "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("id"))
    out = known.select(F.col("id").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
