"""Token ids as binary segments of patched frame-of-reference blocks.

Segment layout (little endian), one segment for each row of the written table:
  8 x uint32    magic 'PFR1', block length, blocks, tokens, documents, width in percent, two zeros
  documents x   int64 doc_id, uint8 has-id, uint32 tokens (three arrays)
  blocks x      uint64 byte position of the block from the segment's begin (the index of block starts)
  each block    uint32 minimum, uint8 width, uint16 exceptions, then 32*width bytes of packed differences,
                then uint8 positions and uint32 differences of the exceptions
A block holds 256 ids. Its width is the bit length that ``percentile`` of its differences to the minimum need;
wider ones are exceptions. Segments are rows of a Parquet table, so they can lie in any store that Spark writes to.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import byte_slices
from .word_tokens import open_tokenizer

BLOCK = 256
MAGIC = int.from_bytes(b"PFR1", "little")
LANES = BLOCK // 64
SEGMENT_TOKENS = 1 << 18


def pack_words(values: np.ndarray, width: int) -> np.ndarray:
    """(n, 64) unsigned values below 2**width as (n, width) 64-bit words."""
    words = np.zeros((len(values), width), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[:, word] |= values[:, i] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= values[:, i] >> np.uint64(64 - shift)
    return words


def unpack_words(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of ``pack_words``."""
    values = np.zeros((len(words), 64), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(64) if width else ():
        word, shift = divmod(i * width, 64)
        part = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            part = part | (words[:, word + 1] << np.uint64(64 - shift))
        values[:, i] = part & mask
    return values


def bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each unsigned value below 2**32 needs (0 for 0)."""
    return np.where(values > 0, np.frexp(values.astype(np.float64))[1], 0)


def pack_blocks(ids: np.ndarray, percentile: float) -> tuple[bytes, np.ndarray]:
    """Blocks of the ids laid end to end, and the byte position of each."""
    blocks = -(-len(ids) // BLOCK)
    if not blocks:
        return b"", np.zeros(0, np.uint64)
    padded = np.full(blocks * BLOCK, ids[-1], np.uint64)
    padded[:len(ids)] = ids
    padded = padded.reshape(blocks, BLOCK)
    least = padded.min(axis=1)
    over = padded - least[:, None]
    bits = bit_lengths(over)
    widths = np.sort(bits, axis=1)[:, min(BLOCK - 1, int(np.ceil(BLOCK * percentile)) - 1)]
    outlier = bits > widths[:, None]
    exceptions = outlier.sum(axis=1)
    sizes = 7 + 32 * widths + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(blocks, 4)
    out[starts + 4] = widths
    out[starts[:, None] + np.arange(5, 7)] = exceptions.astype("<u2").view(np.uint8).reshape(blocks, 2)
    inside = np.where(outlier, 0, over)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if width:
            words = pack_words(inside[rows].reshape(-1, 64), int(width)).astype("<u8")
            out[starts[rows][:, None] + 7 + np.arange(32 * width)] = words.view(np.uint8).reshape(len(rows), -1)
    row, position = np.nonzero(outlier)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        base = starts[row] + 7 + 32 * widths[row]
        out[base + nth] = position
        values = over[row, position].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[(base + exceptions[row] + 4 * nth)[:, None] + np.arange(4)] = values
    return out.tobytes(), starts.astype(np.uint64)


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` of the bytes, padding included."""
    starts = starts.astype(np.int64)
    least = data[starts[:, None] + np.arange(4)].copy().view("<u4").reshape(-1).astype(np.uint64)
    widths = data[starts + 4].astype(np.int64)
    exceptions = data[starts[:, None] + np.arange(5, 7)].copy().view("<u2").reshape(-1).astype(np.int64)
    over = np.zeros((len(starts), BLOCK), np.uint64)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        if width:
            words = data[starts[rows][:, None] + 7 + np.arange(32 * width)].copy().view("<u8").reshape(-1, width)
            over[rows] = unpack_words(words, int(width)).reshape(len(rows), BLOCK)
    row = np.repeat(np.arange(len(starts)), exceptions)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions)
        base = starts[row] + 7 + 32 * widths[row]
        position = data[base + nth]
        over[row, position] = data[(base + exceptions[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    return (over + least[:, None]).astype(np.uint32)


def pack_segment(doc_ids: list, counts: np.ndarray, ids: np.ndarray, percentile: float) -> bytes:
    """One segment: header, documents, block index, blocks."""
    blocks, starts = pack_blocks(ids, percentile)
    head = np.array([MAGIC, BLOCK, len(starts), len(ids), len(doc_ids), int(percentile * 100), 0, 0], "<u4").tobytes()
    head += np.array([i or 0 for i in doc_ids], "<i8").tobytes()
    head += np.array([i is not None for i in doc_ids], np.uint8).tobytes()
    head += np.asarray(counts, "<u4").tobytes()
    return head + (starts + np.uint64(len(head) + 8 * len(starts))).astype("<u8").tobytes() + blocks


def read_head(payload: bytes) -> tuple[list, np.ndarray, np.ndarray, int]:
    """Document ids, their token counts, the block starts and the number of tokens."""
    magic, block, blocks, tokens, documents = np.frombuffer(payload, "<u4", 5).tolist()
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of this format")
    at = 32
    doc_ids = np.frombuffer(payload, "<i8", documents, at)
    has_id = np.frombuffer(payload, np.uint8, documents, at + 8 * documents)
    counts = np.frombuffer(payload, "<u4", documents, at + 9 * documents).astype(np.int64)
    starts = np.frombuffer(payload, "<u8", blocks, at + 13 * documents)
    return [int(i) if h else None for i, h in zip(doc_ids, has_id)], counts, starts, tokens


def read_segment(payload: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, their token counts, and all ids."""
    doc_ids, counts, starts, tokens = read_head(payload)
    if not tokens:
        return doc_ids, counts, np.zeros(0, np.uint32)
    return doc_ids, counts, unpack_blocks(np.frombuffer(payload, np.uint8), starts).reshape(-1)[:tokens]


def read_range(payload: bytes, begin: int, end: int) -> np.ndarray:
    """Ids begin..end of a segment; only the blocks that hold them are unpacked."""
    _, _, starts, tokens = read_head(payload)
    end = min(end, tokens)
    if begin >= end:
        return np.zeros(0, np.uint32)
    first = begin // BLOCK
    some = starts[first:-(-end // BLOCK)]
    return unpack_blocks(np.frombuffer(payload, np.uint8), some).reshape(-1)[begin - first * BLOCK:end - first * BLOCK]


SEGMENTS = "part int, segment int, part_offset long, n_docs long, n_tokens long, payload binary"


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, percentile: float = 0.9,
                 segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode whole texts (NULL: empty), end each with ``end_id``, and write segments in ascending doc_id order.

    The documents are range-partitioned by doc_id, so part numbers ascend with the ids and no task holds more than its
    range. NULL ids come first and are dealt by their text; repeated ids keep all their rows. An empty table gives no
    segments. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = open_tokenizer(tokenizer_path)
        part, segment, offset = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal segment, offset, held
            payload = pack_segment(doc_ids, np.concatenate(counts), np.concatenate(ids), percentile)
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([offset], pa.int64()),
                 pa.array([len(doc_ids)], pa.int64()), pa.array([held], pa.int64()), pa.array([payload], pa.binary())],
                names=["part", "segment", "part_offset", "n_docs", "n_tokens", "payload"])
            segment, offset, held = segment + 1, offset + held, 0
            doc_ids.clear(), counts.clear(), ids.clear()
            return out

        for batch in byte_slices(batches, "text", 16 << 20):
            flat, each = tokenizer.encode(batch.column("text"))
            ends = np.cumsum(each)
            flat = np.insert(flat, ends, end_id)
            each = each + 1
            ends = np.cumsum(each)
            names = batch.column("doc_id").to_pylist()
            row = 0
            while row < len(names):
                begin = int(ends[row] - each[row])
                until = int(np.searchsorted(ends, begin + max(1, segment_tokens - held), side="left")) + 1
                until = min(until, len(names))
                doc_ids += names[row:until]
                counts.append(each[row:until])
                ids.append(flat[begin:ends[until - 1]])
                held += int(ends[until - 1]) - begin
                row = until
                if held >= segment_tokens:
                    yield flush()
        if doc_ids:
            yield flush()

    dealt.mapInArrow(encode, SEGMENTS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the segments: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # One row for each written part: bounded by the partitions of the write, so one task orders them and all tasks get them.
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    placed = segments.join(F.broadcast(starts), "part").select(
        (F.col("part_start") + F.col("part_offset")).alias("start"), "payload")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, payload in zip(batch.column("start").to_pylist(), batch.column("payload")):
                doc_ids, counts, ids = read_segment(payload.as_buffer())
                ends = np.cumsum(counts)
                data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                checks = [zlib.crc32(data[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(begin + ends - counts), pa.array(counts),
                     pa.array(checks, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
