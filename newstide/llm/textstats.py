"""Rule statistics of a whole text, counted on its UTF-8 bytes; shared by the quality operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import map_batches, marks_of, texts_of
from newstide.session import broadcast_if_small, stage

SPACES = np.array([9, 10, 11, 12, 13, 32])
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
UPPER = np.arange(65, 91)
DIGITS = np.arange(48, 58)
STOPS = np.frombuffer(b".,;:", np.uint8)
OTHER = np.frombuffer(b"!?@=/\\_^~+\"'()[]{}-`", np.uint8)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts that the models use beside the base statistics.
MORE = ("n_lines", "n_distinct", "top_word", "n_upper", "n_digits", "n_stops", "n_marks", "n_pipes", "n_bangs", "n_long")
COUNTS = BASE + MORE


def repeated_words(ids: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first one included."""
    if len(ids) <= width:
        return 0
    key = ids[: len(ids) - width + 1].astype(np.int64)
    for i in range(1, width):
        # Pairs are numbered anew at every step, so that keys never overflow.
        _, key = np.unique(key, return_inverse=True)
        step = ids[i : len(ids) - width + 1 + i].astype(np.int64)
        key = key * (int(step.max()) + 1) + step
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[where] > 1
    if not twice.any():
        return 0
    inside = np.zeros(len(ids), bool)
    for i in range(width):
        inside[i : len(ids) - width + 1 + i] |= twice
    return int(inside.sum())


def counts(text: str) -> list[int]:
    """The statistics named in ``COUNTS``; all are zero for an empty text, but for its one line."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # ASCII white space only
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lines = [x for x in data.split(b"\n") if x.strip()]
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    return [
        len(words),
        len(text) - int(by_byte[SPACES].sum()),
        int(by_byte[SYMBOLS].sum()),
        len(lines) - len(set(lines)),
        repeated_words(ids) if len(seen) < len(words) else 0,
        len(lines),
        len(seen),
        int(np.bincount(ids).max()) if words else 0,
        int(by_byte[UPPER].sum()),
        int(by_byte[DIGITS].sum()),
        int(by_byte[STOPS].sum()),
        int(by_byte[OTHER].sum()),
        int(by_byte[ord("|")]),
        int(by_byte[ord("!")]),
        sum(len(w) > 40 for w in words),
    ]


def table(texts: list[str]) -> np.ndarray:
    """One row of counts per text."""
    return np.array([counts(t) for t in texts], np.int64).reshape(len(texts), len(COUNTS))


def ratios(rows: np.ndarray) -> np.ndarray:
    """Length-free features of rows of counts; a text without words has zeros but for its length."""
    c = {name: rows[:, i].astype(float) for i, name in enumerate(COUNTS)}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            np.log1p(c["n_distinct"]) / np.log1p(words),
            c["top_word"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_stops"] / words,
            c["n_marks"] / words,
            c["n_pipes"] / words,
            c["n_bangs"] / words,
            c["n_long"] / words,
        ],
        axis=1,
    )


def counted(rows: DataFrame) -> DataFrame:
    """(doc_id, label) of (doc_id, text, label) and the counts of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = table(texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array(rows[:, i]) for i in range(len(COUNTS))]], ["doc_id", "label", *COUNTS])

    schema = "doc_id long, label double, " + ", ".join(f"{c} long" for c in COUNTS)
    return map_batches(rows.selectExpr("cast(doc_id as long) doc_id", "text", "label"), run, schema)


def labelled_counts(docs: DataFrame, labels: DataFrame, label: str, usable=None) -> DataFrame:
    """(doc_id, label) and the counts of all labelled documents, of those that ``common.labelled_sample`` takes some from.

    Texts are counted where they lie, and only their counts meet the labels. Of labelled ids that occur more than once the
    smallest text counts; only these texts are moved.
    """
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    marks = stage(marks_of(labels, label, usable), "marks")
    again = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = stage(marks.join(again, "doc_id"), "again")
    found = counted(docs.withColumn("label", F.lit(None).cast("double"))).drop("label")
    found = found.join(marks.join(again, "doc_id", "left_anti"), "doc_id").select("doc_id", "label", *COUNTS)
    if again.isEmpty():
        return found
    texts = docs.join(broadcast_if_small(again), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    return found.unionByName(counted(texts))


def collect(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts and labels of a bounded sample (doc_id, text, label), in the order of ``doc_id``: numbers only reach the driver."""
    found = counted(sample).toPandas().sort_values("doc_id")
    return found[list(COUNTS)].to_numpy(np.int64), found["label"].to_numpy(float)
