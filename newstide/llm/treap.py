"""Ranked lexical search by a K2-treap over the grid of terms and documents.

A shard of documents is a grid with a row for each term, the most frequent first, and a column for each document, in the
order of their ids. The grid is a quadtree: a cell that holds an occurrence has a bit for each of its quarters and the
greatest impact within. Levels are kept as packed bits in Morton order, so that a child is found by counting the bits
before it, and maxima as differences to the cell above. The lowest level keeps term counts, from which the impact follows.

An item descends with all its terms together. A document range is a column interval of some level with one cell per term
on that term's row path; its bound is the sum of weight times maximum over these cells, and that of a single column is the
score itself. Ranges are taken up best first, in groups, and a range is given up once its bound lies below the last of the
best scores known. Shards are independent: a task makes them of the documents it reads, without a shuffle, and a search
returns the best of each shard, of which the best overall are kept.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count as serial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newstide.llm.common import column, map_batches, texts_of
from newstide.session import cut, scratch_path

#: A term is a run of letters and digits, in ASCII, and of all that lies beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Occurrences (terms and documents) of one shard, and document ranges looked at together; both bound memory only.
SHARD_CELLS = 1_000_000
GROUP_RANGES = 512
#: Terms of the items searched in one reading of the index; more items are searched in several.
BLOCK_TERMS = 200_000

INDEX_SCHEMA = "n_docs long, n_terms long, height int, doc_ids binary, lengths binary, terms binary, df binary, bits binary, maxima binary, tf binary"
_find_terms = re.compile(TERM).findall


def term_counts(text: str) -> Counter:
    """Occurrences of every term of the whole text; A to Z become lower case and nothing else changes."""
    return Counter(_find_terms(text.encode().lower().decode()))  # bytes: A to Z only


def lengths_to_m(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Share of a document's length in the scores, in whole hundredths."""
    return 50 + (50 * n.astype(np.int64) * n_docs) // n_terms


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _spaced(v: np.ndarray) -> np.ndarray:
    """The low 32 bits of a number, at every other place."""
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v


def build_shard(ids: list[int | None], counts: list[Counter], n_docs: int, n_terms: int) -> dict:
    """One row of the index, from the term counts of its documents."""
    by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    number: defaultdict[str, int] = defaultdict()
    number.default_factory = number.__len__  # new terms get the next number
    place, tf, sizes, lengths = [], [], [], []
    for i in by_id:
        own = counts[i]
        place += map(number.__getitem__, own)
        tf += own.values()
        sizes.append(len(own))
        lengths.append(sum(own.values()))
    row, tf = np.array(place, np.int64), np.array(tf, np.int64)
    col = np.repeat(np.arange(len(by_id)), sizes)
    df = np.bincount(row, minlength=len(number))
    order = np.argsort(-df, kind="stable")
    moved = np.empty(len(order), np.int64)
    moved[order] = np.arange(len(order))
    names = list(number)
    lengths = np.array(lengths, np.int64)

    height = max(1, int(max(len(names), len(by_id)) - 1).bit_length())
    code = (_spaced(moved[row]) << np.uint64(1)) | _spaced(col)
    sort = np.argsort(code)
    code, tf = code[sort], tf[sort]
    top = impact(tf, lengths_to_m(lengths, n_docs, n_terms)[col[sort]])
    bits, gaps = [], []
    for level in range(height - 1, -1, -1):  # from the cells of the level below
        up = code >> np.uint64(2)
        new = np.concatenate([[True], up[1:] != up[:-1]])
        first, parent = np.flatnonzero(new), np.cumsum(new) - 1
        above = np.maximum.reduceat(top, first)
        used = np.zeros(4 * len(first), bool)
        used[4 * parent + (code & np.uint64(3)).astype(np.int64)] = True
        bits.insert(0, np.packbits(used).tobytes())
        if level < height - 1:
            gaps.insert(0, (above[parent] - top).astype("<u4"))
        code, top = up[first], above
    gaps.insert(0, top.astype("<u4"))  # of the whole grid
    planes = np.concatenate(gaps).view(np.uint8).reshape(-1, 4).T  # bytes of one order side by side compress better
    named = np.packbits([ids[i] is not None for i in by_id]).tobytes()
    keys = np.array([ids[i] or 0 for i in by_id], "<i8").tobytes()
    squeezed = {
        "doc_ids": keys + named, "lengths": lengths.astype("<i8").tobytes(), "terms": "\n".join(names[i] for i in order).encode(),
        "df": df[order].astype("<i4").tobytes(), "bits": b"".join(bits), "maxima": planes.tobytes(), "tf": tf.astype("<u4").tobytes(),
    }
    return {"n_docs": n_docs, "n_terms": n_terms, "height": height} | {k: zlib.compress(v, 1) for k, v in squeezed.items()}


class Shard:
    """A row of the index, unpacked for searches."""

    def __init__(self, row: dict):
        raw = {k: zlib.decompress(row[k]) for k in ("doc_ids", "lengths", "terms", "bits", "maxima", "tf")}
        self.height = row["height"]
        lengths = np.frombuffer(raw["lengths"], "<i8")
        n = len(lengths)
        keys = np.frombuffer(raw["doc_ids"], "<i8", n)
        named = np.unpackbits(np.frombuffer(raw["doc_ids"], np.uint8, offset=8 * n), count=n)
        self.doc_ids = [k if known else None for k, known in zip(keys.tolist(), named.tolist(), strict=True)]
        self.m = lengths_to_m(lengths, row["n_docs"], row["n_terms"])
        self.row_of = {t: i for i, t in enumerate(raw["terms"].decode().split("\n"))}
        gaps = np.ascontiguousarray(np.frombuffer(raw["maxima"], np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
        tf = np.frombuffer(raw["tf"], "<u4").astype(np.int64)
        #: child[l][4 * cell + quarter] is the cell of level l + 1; the place after the last cell stands for none.
        self.child, self.top = [], []
        at, taken, cells, above = 0, 0, 1, None
        for level in range(self.height):
            used = np.unpackbits(np.frombuffer(raw["bits"], np.uint8, -(-4 * cells // 8), at), count=4 * cells).astype(bool)
            at += -(-4 * cells // 8)
            below = int(used.sum())
            child = np.full(4 * (cells + 1), below, np.int64)
            child[np.flatnonzero(used)] = np.arange(below)
            top = gaps[taken : taken + cells]
            if level:
                top = above - top
            taken += cells
            self.top.append(np.append(top, 0))
            self.child.append(child)
            above = np.repeat(top, used.reshape(-1, 4).sum(1))
            cells = below
        self.tf = np.append(tf, 0)

    def best(self, terms: dict[str, int], k: int) -> list[tuple[int, int]]:
        """(column, score) of the ``k`` best documents for terms with weights: highest first, then in order of columns."""
        known = [(self.row_of[t], w) for t, w in terms.items() if t in self.row_of and w > 0]
        if not known:
            return []
        rows = np.array([r for r, _ in known], np.int64)
        weights = np.array([w for _, w in known], np.int64)
        n, turn = len(self.doc_ids), serial()
        floor = 1  # scores below this are of no use
        scores, cols = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bound = int((weights * self.top[0][0]).sum())
        open_ = [(-bound, next(turn), 0, np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int64), np.array([bound]))]
        while open_ and -open_[0][0] >= floor:
            _, _, level, col, cell, bound = heapq.heappop(open_)
            still = bound >= floor
            col, cell = col[still], cell[still]
            high = 2 * ((rows >> (self.height - 1 - level)) & 1)
            col = np.concatenate([2 * col, 2 * col + 1])
            cell = np.concatenate([self.child[level][4 * cell + high], self.child[level][4 * cell + high + 1]])
            within = col << (self.height - 1 - level) < n
            col, cell = col[within], cell[within]
            leaves = level == self.height - 1
            values = impact(self.tf[cell], self.m[col][:, None]) if leaves else self.top[level + 1][cell]
            bound = (values * weights).sum(1)
            good = bound >= floor
            col, cell, bound = col[good], cell[good], bound[good]
            if leaves:
                scores, cols = np.concatenate([scores, bound]), np.concatenate([cols, col])
                if len(scores) >= k:
                    order = np.lexsort((cols, -scores))[:k]
                    scores, cols = scores[order], cols[order]
                    floor = max(1, int(scores[-1]))  # equal scores may still belong to an earlier column
                continue
            order = np.argsort(-bound, kind="stable")
            for i in range(0, len(order), GROUP_RANGES):
                part = order[i : i + GROUP_RANGES]
                heapq.heappush(open_, (-int(bound[part[0]]), next(turn), level + 1, col[part], cell[part], bound[part]))
        order = np.lexsort((cols, -scores))[:k]
        return list(zip(cols[order].tolist(), scores[order].tolist(), strict=True))


@dataclass(frozen=True)
class Index:
    """Shards at ``path``, and counts over all documents: with a term, and their terms with repeats."""

    spark: SparkSession
    path: str
    n_docs: int
    n_terms: int

    def shards(self) -> DataFrame:
        return self.spark.read.schema(INDEX_SCHEMA).parquet(self.path)


def build_index(docs: DataFrame, path: str | None = None) -> Index:
    """Index every document of (doc_id, text), under ``path`` (by default a new folder in the shared one).

    A null or empty text has no terms and is never found. A null ``doc_id`` is kept, behind all others. Repeated rows are
    documents of their own. Other columns are not read. An empty table makes an empty index.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "treap")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(_find_terms(t)) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], ["docs", "terms"])

    totals = map_batches(rows.select("text"), sizes, "docs long, terms long").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms")).first()
    n_docs, n_terms = totals["docs"] or 0, totals["terms"] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.split()[1]]) for f in INDEX_SCHEMA.split(", ")])
        ids: list[int | None] = []
        counts: list[Counter] = []
        cells = 0
        for batch in batches:
            for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts_of(batch), strict=True):
                own = term_counts(text)
                if not own:
                    continue
                ids.append(doc_id)
                counts.append(own)
                cells += len(own)
                if cells >= SHARD_CELLS:
                    yield pa.RecordBatch.from_pylist([build_shard(ids, counts, n_docs, n_terms)], schema)
                    ids, counts, cells = [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([build_shard(ids, counts, n_docs, n_terms)], schema)

    # A shard a file, so that searches spread over tasks.
    map_batches(rows, run, INDEX_SCHEMA).write.option("compression", "none").option("maxRecordsPerFile", 1).parquet(path)
    return Index(spark, path, n_docs, n_terms)


def document_frequencies(index: Index, terms: list[str]) -> dict[str, int]:
    """Documents that hold each of ``terms``, over all shards; terms that no document holds are left out."""
    wanted = set(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, df in zip(column(batch, "terms").to_pylist(), column(batch, "df").to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(df), "<i4").tolist()
                found = [(t, c) for t, c in zip(zlib.decompress(names).decode().split("\n"), counts, strict=True) if t in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([c for _, c in found], pa.int64())], ["term", "df"])

    parts = map_batches(index.shards().select("terms", "df"), run, "term string, df long")
    return {r["term"]: r["df"] for r in parts.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def search(index: Index, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of the highest score above 0 for each row of (item_id, text).

    Equal scores are ranked by ascending ``doc_id``, null ids last. Every item row is searched by itself, so repeated rows
    have repeated results, and a null ``item_id`` is kept. An item without terms, or whose terms no document holds, has no
    rows. Items are read in blocks of a bounded number of terms, and each block reads the index once.
    """
    spark = index.spark

    def terms_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [sorted(term_counts(t)) for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([column(batch, "item"), column(batch, "item_id"), pa.array(terms, pa.list_(pa.string())), pa.array([len(t) for t in terms], pa.int64())], ["item", "item_id", "terms", "size"])

    kind = items.schema["item_id"].dataType.simpleString()
    keyed = items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())
    keyed = cut(map_batches(keyed.select("item", "item_id", "text"), terms_of_items, f"item long, item_id {kind}, terms array<string>, size long"))
    total = keyed.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    found = spark.createDataFrame([], "item long, doc_id long, score long")
    for block in range(blocks):
        chosen = {r["item"]: r["terms"] for r in keyed.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "terms").collect()}
        df = document_frequencies(index, [t for terms in chosen.values() for t in terms])
        weighted = {item: {t: weight(df[t], index.n_docs) for t in terms if t in df} for item, terms in chosen.items()}

        def run(batches: Iterator[pa.RecordBatch], weighted: dict = weighted) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    shard = Shard(row)
                    rows = [(item, shard.doc_ids[c], score) for item, terms in weighted.items() for c, score in shard.best(terms, k)]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["item", "doc_id", "score"])

        found = found.unionByName(map_batches(index.shards(), run, "item long, doc_id long, score long"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(keyed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
