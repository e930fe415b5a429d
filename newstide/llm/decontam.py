"""Benchmark decontamination: a BM25 index of test items, searched by every passage with block-max WAND.

The index holds the benchmark, which is small beside the corpus; it is built in shards of a bounded number of items, and
every passage of every document is looked up in each shard. Weights are normalised so that an item scores 1 against
itself, and the passage against an item the share of it that the passage covers. Passages overlap by half and are twice as
long as the longest item, so an item copied into a text lies whole in one of them. What scores above the threshold is
verified by the overlap with the item's question and with its answer; a low share of word shingles must be found as well, so
that the same words in another order are no copy.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import bounded_batches, column, map_batches, texts_of
from newstide.session import stage

WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class LeakConfig:
    """``least_score`` selects candidates, ``least_overlap`` of the words of question and answer verifies them, ``least_shingles``
    guards the order of words; ``answer_words`` is the least number of distinct words of an answer, and ``shard_items`` bounds
    what is sent to tasks at once."""

    least_score: float = 0.6
    least_overlap: float = 0.8
    least_shingles: float = 0.2
    answer_words: int = 8
    shingle: int = 5
    block: int = 4
    shard_items: int = 1024
    k1: float = 1.2
    b: float = 0.75


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str | None, least: int = 8) -> tuple[list[str], list[str]]:
    """Words of an item's question and answer: the answer is its last sentence, or as many of the last ones as have ``least``
    distinct words, but for the first; of a single one, the second half."""
    parts = [w for s in re.split(r"[.!?\n]+", text or "") if (w := words_of(s))]
    if len(parts) == 1:
        half = len(parts[0]) // 2
        return parts[0][:half], parts[0][half:]
    while len(parts) > 2 and len(set(parts[-1])) < least:
        parts[-2:] = [parts[-2] + parts[-1]]
    if len(parts) == 2 and len(set(parts[1])) < least:  # the end of the only other sentence belongs to it
        words = parts[0] + parts[1]
        at = min(len(parts[0]), max(len(words) // 2, len(words) - least))
        return words[:at], words[at:]
    return [w for p in parts[:-1] for w in p], parts[-1] if parts else []


def shingles(words: list[str], width: int) -> set[tuple[str, ...]]:
    """Runs of ``width`` words; fewer words make one shingle."""
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


@dataclass
class Item:
    key: int | None
    words: list[str]
    question: set[str]
    answer: set[str]
    shingles: set[tuple[str, ...]] = field(repr=False)


@dataclass
class Counts:
    """Items with words, words in all, and the number of items that have a word."""

    items: int
    words: int
    items_with: dict[str, int]


class ItemIndex:
    """Postings of normalised BM25 weights, in blocks of items with the highest weight of each block."""

    def __init__(self, items: list[tuple[int | None, str | None]], passage: int, cfg: LeakConfig, whole: Counts | None = None):
        """``whole`` has the counts of the whole benchmark; without it the items given are all there are."""
        self.cfg = cfg
        self.passage, self.step = passage, passage // 2
        self.items: list[Item] = []
        for key, text in items:
            question, answer = question_and_answer(text, cfg.answer_words)
            if question or answer:
                words = question + answer
                self.items.append(Item(key, words, set(question), set(answer), shingles(words, cfg.shingle)))
        if whole is None:
            words = sum(len(i.words) for i in self.items)
            whole = Counts(len(self.items), words, Counter(w for item in self.items for w in set(item.words)))
        n, df, mean = whole.items, whole.items_with, whole.words / max(whole.items, 1)
        postings: dict[str, list[tuple[int, float]]] = {}
        for number, item in enumerate(self.items):
            norm = cfg.k1 * (1 - cfg.b + cfg.b * len(item.words) / mean)
            weight = {w: np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (cfg.k1 + 1) / (tf + norm) for w, tf in Counter(item.words).items()}
            total = sum(weight.values())
            for w, x in weight.items():
                postings.setdefault(w, []).append((number, x / total))
        self.term = {w: i for i, w in enumerate(postings)}
        self.lists = [([d for d, _ in p], [x for _, x in p]) for p in postings.values()]
        self.blocks = -(-max(len(self.items), 1) // cfg.block)
        self.block_max = np.zeros((len(self.lists) + 1, self.blocks), np.float32)  # the last row is that of unknown words
        for t, (docs, weights) in enumerate(self.lists):
            np.maximum.at(self.block_max[t], np.array(docs) // cfg.block, np.array(weights, np.float32))
        self.list_max = self.block_max.max(1)

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items that the distinct terms of a passage cover to ``least_score`` or more, by block-max WAND."""
        least, block, found = self.cfg.least_score, self.cfg.block, []
        cursors = [[self.lists[t][0][0], 0, t] for t in terms]  # item, place, term
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, (_, _, t) in enumerate(cursors):
                bound += self.list_max[t]
                if bound >= least - 1e-6:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            here = item // block
            if sum(self.block_max[c[2], here] for c in cursors[: pivot + 1]) < least - 1e-6:
                # No item up to the end of the block, or to the next list's item, can reach the threshold.
                goal = (here + 1) * block
                if pivot + 1 < len(cursors):
                    goal = min(goal, max(cursors[pivot + 1][0], item + 1))
                move = cursors[: pivot + 1]
            elif cursors[0][0] == item:
                score = sum(self.lists[t][1][at] for _, at, t in cursors[: pivot + 1])
                if score >= least:
                    found.append((item, float(score)))
                goal, move = item + 1, cursors[: pivot + 1]
            else:
                goal, move = item, cursors[:pivot]
            for c in move:
                docs = self.lists[c[2]][0]
                at = c[1]
                while at < len(docs) and docs[at] < goal:
                    at += 1
                c[0], c[1] = (docs[at], at) if at < len(docs) else (-1, at)
            cursors = [c for c in cursors if c[0] >= 0]
        return found

    def search(self, text: str | None) -> list[tuple[int | None, float, float, float, float]]:
        """Verified items of a whole text: key, score, question overlap, answer overlap and overlap, the best passage of each."""
        words = words_of(text)
        if not words or not self.items:
            return []
        unknown = len(self.lists)
        get = self.term.get
        terms = np.array([get(w, unknown) for w in words], np.int64)
        at = np.arange(0, max(1, len(words) - self.step), self.step)
        end = np.minimum(at + self.passage, len(words))
        total = np.concatenate([[0.0], np.cumsum(self.list_max[terms], dtype=np.float64)])
        open_ = np.flatnonzero(total[end] - total[at] >= self.cfg.least_score - 1e-6)
        best: dict[int, tuple[float, float, float, float]] = {}
        for p in open_.tolist():
            own = np.unique(terms[at[p] : end[p]])
            own = own[own < unknown]
            if self.block_max[own].sum(0).max(initial=0.0) < self.cfg.least_score - 1e-5:
                continue
            part, cut = words[at[p] : end[p]], None
            for number, score in self.retrieve(own.tolist()):
                item = self.items[number]
                cut = cut or (set(part), shingles(part, self.cfg.shingle))
                grams = cut[1] if len(item.words) >= self.cfg.shingle else shingles_of_width(part, len(item.words))
                overlap = len(item.shingles & grams) / len(item.shingles)
                question = len(item.question & cut[0]) / len(item.question) if item.question else 1.0
                answer = len(item.answer & cut[0]) / len(item.answer) if item.answer else 1.0
                if min(question, answer) >= self.cfg.least_overlap and overlap >= self.cfg.least_shingles and (number not in best or overlap > best[number][3]):
                    best[number] = (score, question, answer, overlap)
        return [(self.items[n].key, *x) for n, x in sorted(best.items())]


def shingles_of_width(words: list[str], width: int) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [words_of(t) for t in texts_of(batch)]
        made = [pa.array([len(w) for w in words], pa.int64()), pa.array([sorted(set(w)) for w in words], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([column(batch, "item_id"), column(batch, "text"), *made], ["item_id", "text", "n_words", "words"])


def indexes(benchmark: DataFrame, cfg: LeakConfig) -> Iterator[ItemIndex]:
    """The benchmark in shards of about ``shard_items`` items; only one shard is on the driver at a time, with the counts of
    its own words. All counts are those of the whole benchmark, so scores do not depend on the shards."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    items = stage(map_batches(items, item_words, "item_id long, text string, n_words long, words array<string>"), "items").where("n_words > 0")
    n, words, longest = items.agg(F.count("*"), F.sum("n_words"), F.max("n_words")).first()
    shards = -(-n // cfg.shard_items)
    if not shards:
        return
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).alias("shard")
    held = items.select(shard, F.explode("words").alias("word"))
    counts = stage(held.distinct().join(held.groupBy("word").agg(F.count("*").alias("n")), "word"), "word-counts")
    for number in range(shards):
        rows = items.where(shard == number).select("item_id", "text").collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        own = {r["word"]: r["n"] for r in counts.where(F.col("shard") == number).collect()}
        yield ItemIndex([(r["item_id"], r["text"]) for r in rows], 2 * max(32, longest), cfg, Counts(n, words, own))


SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, overlap double"


def find_leaks(docs: DataFrame, benchmark: DataFrame, cfg: LeakConfig = LeakConfig()) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, overlap): the items that a document contains.

    A leak covers the item's words to ``least_score`` by BM25 weight and, in one passage, at least ``least_overlap`` of its
    question's distinct words and of its answer's, and ``least_shingles`` of its five-word shingles. Null or empty texts and items give none; repeated
    documents each have rows of their own, repeated items one. Empty tables give an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text <> ''")
    found = None
    for index in indexes(benchmark, cfg):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = [(key, *hit) for key, text in zip(column(batch, "doc_id").to_pylist(), texts_of(batch), strict=True) for hit in index.search(text)]
                cols = list(zip(*hits, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[2:]]], [c.split()[0] for c in SCHEMA.split(", ")])

        own = map_batches(rows, run, SCHEMA)
        found = own if found is None else found.unionByName(own)
    return docs.sparkSession.createDataFrame([], SCHEMA) if found is None else found


def drop_leaked(docs: DataFrame, benchmark: DataFrame, cfg: LeakConfig = LeakConfig()) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns stay, and so do rows with a null or empty text."""
    bounded_batches(docs.sparkSession)
    for index in indexes(benchmark, cfg):
        docs = docs.where(~_leaked(index)("text"))
    return docs


def _leaked(index: ItemIndex):
    @F.pandas_udf("boolean")
    def leaked(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(index.search(t)) for t in texts], dtype=bool)

    return leaked
