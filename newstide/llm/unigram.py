"""Token counts under a unigram vocabulary: the best segmentation's length, without making the segmentation.

An Aho-Corasick automaton enumerates the vocabulary's matches in a piece of text; dynamic programming over positions
carries the best score and the number of pieces on that path. Ties are broken as the ``tokenizers`` library's Unigram model
does: matches are tried in order of their start, then of their length, and only a greater score replaces a path, so of
equal paths to a position the one whose last piece starts earliest stays. A character without a match of its own costs
the lowest score less ten; a run of such characters is one unknown token, or its bytes where the vocabulary has them.

Where no vocabulary entry reaches from other text into a space mark, texts are cut there, each piece is counted once per
worker, and the counts are added up.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import bounded_batches, free_name

SPACE = "▁"
#: Pieces remembered per worker; it bounds memory and has no effect on results.
CACHE_ENTRIES = 500_000
UNKNOWN_PENALTY = 10.0


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores (log-probabilities up to a constant); ``byte_pieces`` when unknown text falls back to bytes."""

    pieces: tuple[tuple[str, float], ...]
    byte_pieces: bool = False
    add_prefix_space: bool = True


def read_vocabulary(path: str) -> Vocabulary:
    """Normal pieces of a sentencepiece model file, with their stored scores, read as a unigram vocabulary."""
    from sentencepiece import sentencepiece_model_pb2 as model_format

    model = model_format.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    normal = model_format.ModelProto.SentencePiece.NORMAL
    return Vocabulary(
        tuple((p.piece, p.score) for p in model.pieces if p.type == normal),
        bool(model.trainer_spec.byte_fallback),
        bool(model.normalizer_spec.add_dummy_prefix),
    )


class Counter:
    """Counts tokens of whole texts under a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        # Without a space mark of its own, unknown text could run on across a cut; it is then not made.
        alone = vocabulary.byte_pieces or any(p == SPACE for p, _ in vocabulary.pieces)
        self.whole = not alone or any(SPACE in p.lstrip(SPACE) for p, _ in vocabulary.pieces)
        if self.automaton:
            self.automaton.make_automaton()
        # The library takes the lowest score over all entries, those of special and byte pieces included.
        self.unknown = min([s for _, s in vocabulary.pieces], default=0.0) - UNKNOWN_PENALTY
        self.cache: dict[str, tuple[int, float]] = {}
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def piece(self, text: str) -> tuple[int, float]:
        """Tokens and score of the best path through ``text``, which stands alone."""
        n = len(text)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]  # by start: (length, score), shorter first
        if self.automaton:
            for last, (length, score) in self.automaton.iter(text):
                ends[last - length + 1].append((length, score))
        best = [0.0] * (n + 1)
        came = [-1] * (n + 1)
        unknown_step = [False] * (n + 1)
        tokens = [0] * (n + 1)
        came[0] = 0
        for start in range(n):
            base, alone = best[start], False
            for length, score in sorted(ends[start]):
                end = start + length
                if came[end] < 0 or base + score > best[end]:
                    best[end], came[end], unknown_step[end] = base + score, start, False
                    tokens[end] = tokens[start] + 1
                alone = alone or length == 1
            if not alone:
                end, score = start + 1, base + self.unknown
                if came[end] < 0 or score > best[end]:
                    best[end], came[end], unknown_step[end] = score, start, True
                    if self.vocabulary.byte_pieces:
                        tokens[end] = tokens[start] + len(text[start].encode("utf-8", "surrogatepass"))
                    else:
                        tokens[end] = tokens[start] + (0 if start and unknown_step[start] else 1)
        return tokens[n], best[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """Tokens and score of a whole text; an empty one has none."""
        if not text:
            return 0, 0.0
        text = text.replace(" ", SPACE)
        if self.vocabulary.add_prefix_space:
            text = SPACE + text
        if self.whole:
            return self.piece(text)
        cache, tokens, score = self.cache, 0, 0.0
        get = cache.get
        for unit in self.cut(text):
            found = get(unit)
            if found is None:
                found = self.piece(unit)
                if len(unit) < 100:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[unit] = found
            tokens += found[0]
            score += found[1]
        return tokens, score


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per Python worker and file."""
    return Counter(read_vocabulary(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs``, ``n_tokens`` and ``best_score`` (both of the best segmentation of the whole text).

    Columns of these names in the input are replaced. A null or empty text has no tokens and a score of zero. Repeated rows
    stay; an empty table gives an empty result.
    """
    docs = docs.drop("n_tokens", "best_score")
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("n_tokens long, best_score double")
    def counted(texts: pd.Series) -> pd.DataFrame:
        count = counter(path).count
        found = [count(t) for t in texts]
        return pd.DataFrame({"n_tokens": np.array([f[0] for f in found], np.int64), "best_score": np.array([f[1] for f in found], float)})

    out = free_name(docs, "counts")
    return docs.withColumn(out, counted("text")).select(*docs.columns, f"{out}.*")
