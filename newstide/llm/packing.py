"""Cost-balanced packing of documents into training sequences.

The cost of a piece of n tokens is ``linear * n + quadratic * n * n``: the work of the dense layers and of attention
within the piece. Documents go in descending order of length to the sequence of the lowest cost that still has room.

Packing needs no view of the whole corpus. Each Spark task fills shards of a bounded number of tokens from its own
documents, so nothing is shuffled, memory is bounded by the shard and by the longest document, and a task that is run
again after a lost executor gives the same rows. Within a shard the token capacity offered is exactly the number of
tokens: as many sequences of full length as they fill, and the rest in sequences whose lengths are powers of two, which
need no padding. So no sequence of the output is padded at all, and a shard has at most 12 shorter ones.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newstide.llm.common import column, map_batches, texts_of
from newstide.llm.tokenizing import encoder

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

Piece = tuple[int, int, int, int, int]  # document (index in the shard), start, length, sequence, offset


class OpenSequences:
    """Open sequences (cost, sequence, used, size) by their room, under a tree of the cheapest of each range of rooms."""

    def __init__(self, most: int):
        self.most = most
        self.heaps: list[list[tuple]] = [[] for _ in range(most)]
        self.least: list[tuple] = [(math.inf,)] * (2 * most)

    def _mend(self, room: int) -> None:
        heap, i = self.heaps[room - 1], self.most + room - 1
        self.least[i] = heap[0] if heap else (math.inf,)
        while i > 1:
            i >>= 1
            self.least[i] = min(self.least[2 * i], self.least[2 * i + 1])

    def add(self, cost: float, seq: int, used: int, size: int) -> None:
        heapq.heappush(self.heaps[size - used - 1], (cost, seq, used, size))
        self._mend(size - used)

    def take(self, length: int) -> tuple[float, int, int, int]:
        """Remove the cheapest with room for ``length``, or the cheapest of all where none has it."""
        found, low, high = (math.inf,), self.most + length - 1, 2 * self.most
        while low < high:
            if low & 1:
                found = min(found, self.least[low])
                low += 1
            if high & 1:
                high -= 1
                found = min(found, self.least[high])
            low, high = low >> 1, high >> 1
        found = found if len(found) > 1 else self.least[1]
        room = found[3] - found[2]
        heapq.heappop(self.heaps[room - 1])
        self._mend(room)
        return found


def assign(lengths: list[int], seq_len: int = 4096, linear: float = 1.0, quadratic: float = 1 / 24576) -> list[Piece]:
    """Pieces of documents of the given lengths, and the sequence and offset of each.

    Every multiple of ``seq_len`` within a document fills a sequence of its own. What remains goes, longest first, to the
    lowest-cost of all sequences that can hold it whole; where none can, it is cut to fill the cheapest, and its rest waits
    its turn by length. Ties go to the lower sequence and the earlier document.
    """
    out: list[Piece] = []
    waiting: list[tuple[int, int, int]] = []  # (-length, document, start)
    n_seq = 0
    for doc, length in enumerate(lengths):
        for start in range(0, length - seq_len + 1, seq_len):
            out.append((doc, start, seq_len, n_seq, 0))
            n_seq += 1
        if length % seq_len:
            waiting.append((-(length % seq_len), doc, length - length % seq_len))
    full, rest = divmod(-sum(w[0] for w in waiting), seq_len)
    sizes = [seq_len] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    open_ = OpenSequences(seq_len)
    for i, size in enumerate(sizes):
        # A shorter sequence counts as one whose missing tokens have been spent already.
        open_.add(linear * (seq_len - size), n_seq + i, 0, size)
    heapq.heapify(waiting)
    while waiting:
        minus, doc, start = heapq.heappop(waiting)
        length = -minus
        cost, seq, used, size = open_.take(length)
        put = min(length, size - used)
        out.append((doc, start, put, seq, used))
        if put < size - used:
            open_.add(cost + linear * put + quadratic * put * put, seq, used + put, size)
        if put < length:
            heapq.heappush(waiting, (put - length, doc, start + put))
    return out


def pack(docs: DataFrame, tokenizer: str, end_id: int | None = 2, seq_len: int = 4096, shard_tokens: int = 1 << 21, linear: float = 1.0, quadratic: float = 1 / 24576) -> DataFrame:
    """Pieces of all documents in sequences of at most ``seq_len`` tokens; ``seq_len`` is a power of two.

    Reads ``doc_id`` and ``text`` only. A null or empty text has the end id alone. Rows with the same or a null ``doc_id``
    are documents of their own. An empty table gives no rows. ``ids`` holds the piece's ids, little-endian unsigned 32 bits.
    """
    if seq_len & (seq_len - 1):
        raise ValueError("seq_len must be a power of two")
    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        ids: list[bytes] = []
        keys: list[int | None] = []
        tokens, part, next_seq = 0, 0, 0

        def emit() -> pa.RecordBatch:
            nonlocal next_seq
            lengths = [len(x) // 4 for x in ids]
            pieces = assign(lengths, seq_len, linear, quadratic)
            doc, start, length, seq, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
            cut = [ids[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in pieces]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[d] for d in doc], pa.int64()), pa.array(start), pa.array(length), pa.array(cut, pa.binary()),
                    pa.array(np.array(lengths, np.int64)[doc]), pa.array((part << 32) + next_seq + seq), pa.array(offset),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            next_seq += int(seq.max()) + 1
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            part = column(batch, "part")[0].as_py()
            for key, text in zip(column(batch, "doc_id").to_pylist(), texts_of(batch), strict=True):
                own = encode(text) + end
                if not own:
                    continue
                ids.append(own)
                keys.append(key)
                tokens += len(own) // 4
                if tokens >= shard_tokens:
                    yield emit()
                    ids, keys, tokens = [], [], 0
        if ids:
            yield emit()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.spark_partition_id().cast("long").alias("part"))
    return map_batches(rows, shards, SCHEMA)
