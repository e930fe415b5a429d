"""Token ids in a binary format: static range asymmetric numeral system over interleaved blocks.

Documents are dealt out by range of ``doc_id`` and sorted, so that the files hold their ids in that order. A task encodes
its documents in segments of a bounded number of tokens. A segment has one frequency table, shared by its blocks. A block
is a run of ids that is encoded in 32 interleaved lanes and can be decoded alone: the header has a checkpoint for each
block (place in the stream, lane states) and a checksum of its ids. All blocks of a segment are coded side by side, lanes
being the columns of arrays.

One row of the table of files is a segment: its header, and its stream. Spark writes and commits the rows, so a task that
is run again after a lost executor leaves no halves.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newstide.llm.common import column, map_batches, texts_of
from newstide.llm.tokenizing import encoder

MAGIC = b"TRA1"
LANES = 32
BLOCK_TOKENS = 4096
SEGMENT_TOKENS = 1 << 20
#: Frequencies sum to 2**SCALE; a state lies in [2**31, 2**63) and gives off or takes in 32 bits at a time.
SCALE = 20
LOW = np.uint64(1 << 31)


class ChecksumError(ValueError):
    """A block or a header does not have the content it had when it was written."""


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 for counts above 0, adding up to 2**SCALE; ties go to the lower symbol."""
    total, size = int(counts.sum()), 1 << SCALE
    used = np.flatnonzero(counts)
    if len(used) > size:
        raise ValueError("more symbols than the table has places")
    freq = np.maximum(1, counts[used] * size // total)
    # The largest ones make up for what rounding left over or took away.
    order = np.argsort(-freq, kind="stable")
    gap = size - int(freq.sum())
    while gap:
        if gap > 0:
            freq[order[0]] += gap
            gap = 0
        else:
            take = np.minimum(freq[order] - 1, np.maximum(1, freq[order] * -gap // size))
            take = np.minimum(take, np.maximum(0, -gap - (np.cumsum(take) - take)))
            freq[order] -= take
            gap += int(take.sum())
    out = np.zeros(len(counts), np.int64)
    out[used] = freq
    return out


def encode_segment(ids: np.ndarray) -> bytes:
    """Header, frequency table, checkpoints and stream of the ids (unsigned 32 bits) of one segment."""
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    if n and int(ids.max()) < 1 << 22:  # a table by id is faster than sorting
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts).astype(np.uint32)
        counts = counts[symbols]
        number = np.zeros(int(symbols[-1]) + 1, np.int64)
        number[symbols] = np.arange(len(symbols))
        place = number[ids]
    else:
        symbols, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
    freq = scaled(counts) if n else counts
    start = np.cumsum(freq) - freq
    blocks = -(-n // BLOCK_TOKENS) if n else 0
    steps = BLOCK_TOKENS // LANES
    grid = np.full(blocks * BLOCK_TOKENS, -1, np.int64)
    grid[:n] = place
    grid = grid.reshape(blocks, steps, LANES)
    f, s = freq.astype(np.uint64), start.astype(np.uint64)
    limit = ((LOW >> np.uint64(SCALE)) << np.uint64(32)) * f
    state = np.full((blocks, LANES), LOW, np.uint64)
    words = np.zeros((steps, blocks, LANES), np.uint32)
    given = np.zeros((steps, blocks, LANES), bool)
    whole = n == blocks * BLOCK_TOKENS
    for t in range(steps - 1, -1, -1):
        sym = grid[:, t]
        if whole:
            own, x = sym, state
        else:
            used = sym >= 0
            own, x = np.where(used, sym, 0), state
        out = x >= limit[own]
        if not whole:
            out &= used
        words[t] = x.astype(np.uint32)  # the low 32 bits
        given[t] = out
        x = np.where(out, x >> np.uint64(32), x)
        fo = f[own]
        q = x // fo
        x = (q << np.uint64(SCALE)) + (x - q * fo) + s[own]
        state = x if whole else np.where(used, x, state)
    # A decoder reads step by step and lane by lane within a block.
    mask = given.transpose(1, 0, 2)
    stream = words.transpose(1, 0, 2)[mask]
    lengths = mask.sum((1, 2)).astype(np.uint32)
    raw = ids.tobytes()
    sums = np.array([zlib.crc32(raw[4 * i : 4 * (i + BLOCK_TOKENS)]) for i in range(0, n, BLOCK_TOKENS)], np.uint32)
    table = zlib.compress(np.diff(symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    head = struct.pack("<4sQIII", MAGIC, n, blocks, len(symbols), len(table)) + table + lengths.astype("<u4").tobytes() + sums.astype("<u4").tobytes() + state.astype("<u8").tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + stream.astype("<u4").tobytes()


def decode_segment(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of the blocks from ``first`` up to ``last`` (all by default), each checked against its checksum."""
    magic, n, blocks, n_symbols, table_len = struct.unpack_from("<4sQIII", data)
    at = 24
    head_end = at + table_len + 8 * blocks + 8 * blocks * LANES
    if magic != MAGIC or zlib.crc32(data[:head_end]) != struct.unpack_from("<I", data, head_end)[0]:
        raise ChecksumError("damaged header")
    table = np.frombuffer(zlib.decompress(data[at : at + table_len]), "<u4")
    symbols, freq = np.cumsum(table[:n_symbols], dtype=np.uint32), table[n_symbols:].astype(np.int64)
    at += table_len
    lengths = np.frombuffer(data, "<u4", blocks, at).astype(np.int64)
    sums = np.frombuffer(data, "<u4", blocks, at + 4 * blocks)
    states = np.frombuffer(data, "<u8", blocks * LANES, at + 8 * blocks).reshape(blocks, LANES)
    stream = np.frombuffer(data, "<u4", int(lengths.sum()), head_end + 4).astype(np.uint64)
    last = blocks if last is None else min(last, blocks)
    if first >= last:
        return np.zeros(0, np.uint32)
    slot = np.repeat(np.arange(n_symbols, dtype=np.uint32), freq)
    start = np.cumsum(freq) - freq
    f, base = freq.astype(np.uint64), start.astype(np.uint64)
    state = states[first:last].astype(np.uint64)
    next_word = (np.cumsum(lengths) - lengths)[first:last]
    counts = np.minimum(n - np.arange(first, last) * BLOCK_TOKENS, BLOCK_TOKENS)
    steps = BLOCK_TOKENS // LANES
    out = np.zeros((last - first, steps, LANES), np.uint32)
    whole = bool((counts == BLOCK_TOKENS).all())
    mask = np.uint64((1 << SCALE) - 1)
    lane = np.arange(LANES)
    stream = np.append(stream, np.uint64(0))
    for t in range(steps):
        low = state & mask
        sym = slot[low]
        x = f[sym] * (state >> np.uint64(SCALE)) + low - base[sym]
        need = x < LOW
        if not whole:
            used = t * LANES + lane[None, :] < counts[:, None]
            need &= used
        took = np.cumsum(need, axis=1)
        word = stream[np.where(need, next_word[:, None] + took - 1, len(stream) - 1)]
        x = np.where(need, (x << np.uint64(32)) | word, x)
        next_word = next_word + took[:, -1]
        out[:, t] = sym
        state = x if whole else np.where(used, x, state)
    if (state != LOW).any():  # where the encoder began
        raise ChecksumError("damaged stream")
    flat = symbols[out.reshape(-1)]
    if not whole:
        flat = flat[: int(counts.sum())]
    raw = flat.astype("<u4").tobytes()
    for i in range(last - first):
        if zlib.crc32(raw[4 * i * BLOCK_TOKENS : 4 * (i + 1) * BLOCK_TOKENS]) != sums[first + i]:
            raise ChecksumError(f"damaged block {first + i}")
    return flat


FILE_SCHEMA = "part long, segment long, n_docs long, n_tokens long, doc_ids binary, doc_lengths binary, data binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2) -> None:
    """Write the ids of all whole texts, in ascending order of ``doc_id``, to the table of segments at ``path``.

    A null text counts as an empty one. Null ids come first, as in Spark's order; rows of equal ``doc_id`` follow one
    another in the order of their texts, so equal rows cannot be told apart. An empty table writes no segment.
    """
    end = b"" if end_id is None else end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).ids
        keys: list[int | None] = []
        ids: list[bytes] = []
        tokens, segment, part = 0, 0, 0

        def emit() -> pa.RecordBatch:
            lengths = np.array([len(x) // 4 for x in ids], "<u4").tobytes()
            # The first byte of a key says whether there is one.
            named = b"".join(struct.pack("<?q", k is not None, k or 0) for k in keys)
            data = encode_segment(np.frombuffer(b"".join(ids), "<u4"))
            return pa.RecordBatch.from_pylist(
                [{"part": part, "segment": segment, "n_docs": len(keys), "n_tokens": tokens, "doc_ids": zlib.compress(named, 1), "doc_lengths": zlib.compress(lengths, 1), "data": data}],
                pa.schema([("part", pa.int64()), ("segment", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.binary()), ("doc_lengths", pa.binary()), ("data", pa.binary())]),
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            part = column(batch, "part")[0].as_py()
            for key, text in zip(column(batch, "doc_id").to_pylist(), texts_of(batch), strict=True):
                own = encode(text) + end
                keys.append(key)
                ids.append(own)
                tokens += len(own) // 4
                if tokens >= SEGMENT_TOKENS:
                    yield emit()
                    keys, ids, tokens, segment = [], [], 0, segment + 1
        if keys:
            yield emit()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The text only breaks ties between rows of one id, and lets a crowded id span several tasks.
    placed = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    map_batches(placed.select("doc_id", "text", F.spark_partition_id().cast("long").alias("part")), run, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, **derived) -> DataFrame:
    """(doc_id, start, n_tokens) of every document in the files at ``path`` and ``derived`` columns, each a function of the
    column of ids (little-endian, unsigned 32 bits); ``ids`` itself by default. ``start`` counts the ids before it."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.select("part", "segment", "n_tokens")  # one row per segment
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("in_part"))
    parts = parts.select("part", (F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")).alias("part_start"))
    within = sizes.select("part", "segment", (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_tokens")).alias("in_part"))
    starts = within.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("in_part")).alias("segment_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_segment(row["data"]).astype("<u4")
                lengths = np.frombuffer(zlib.decompress(row["doc_lengths"]), "<u4").astype(np.int64)
                keys = [k if known else None for known, k in struct.iter_unpack("<?q", zlib.decompress(row["doc_ids"]))]
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(keys), pa.int64()), pa.array([row["segment"]] * len(keys), pa.int64()),
                        pa.array(keys, pa.int64()), pa.array(ends - lengths), pa.array(lengths),
                        pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer((4 * np.concatenate([[0], ends])).astype(np.int32).tobytes()), pa.py_buffer(ids.tobytes())]),
                    ],
                    ["part", "segment", "doc_id", "in_segment", "n_tokens", "ids"],
                )

    rows = map_batches(files.select("part", "segment", "doc_ids", "doc_lengths", "data"), run, "part long, segment long, doc_id long, in_segment long, n_tokens long, ids binary")
    made = {name: fn(F.col("ids")) for name, fn in (derived or {"ids": lambda c: c}).items()}
    rows = rows.select("part", "segment", "doc_id", "in_segment", "n_tokens", *[c.alias(n) for n, c in made.items()])
    # Derived before the join, so that a digest travels instead of the ids.
    joined = rows.join(starts, ["part", "segment"])
    return joined.select("doc_id", (F.col("segment_start") + F.col("in_segment")).alias("start"), "n_tokens", *made)
