"""Token-ID output: documents as patched frame-of-reference blocks, in ascending document order, and back.

A stored table holds one row per segment: ``part`` and ``segment`` number it in document order, ``data`` is its bytes. A segment:

    header          magic, documents, ids, blocks, first id's place within the part
    document table  doc_id (with a flag for null), number of ids
    block index     per block of 1024 ids: minimum, width in bits, first 64-bit word of the block, first exception
    words           the low ``width`` bits of id - minimum, 64-bit little endian
    exceptions      place in the block and the high bits of the values that need more than ``width`` bits

The width is the one that holds ``percentile`` of a block's values. Segments travel in Parquet, so that Spark's commit protocol keeps
lost executors from leaving half-written output, and any store that Spark writes will do. A document stays whole in one segment;
null texts count as empty, a null doc_id comes first, rows of equal doc_ids are ordered by the hash of their text and then by the text, within parts and across them.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import id_text, in_steps
from .tokens import codec

BLOCK = 1024
#: A segment is closed once it has so many ids.
SEGMENT_IDS = 1 << 20
_MAGIC = b"PFB1"
_HEAD = struct.Struct("<4sIQIQ")
SEGMENTS = "part int, segment int, n_docs int, n_ids long, data binary"


def _widths(blocks: np.ndarray, last: int, percentile: float) -> np.ndarray:
    """Bits that hold ``percentile`` of each block; ``last`` values of the final block count."""
    rank = np.full(len(blocks), int(np.ceil(percentile * BLOCK)) - 1)
    cut = np.partition(blocks, rank[0], axis=1)[:, rank[0]]
    if last < BLOCK:
        own = np.sort(blocks[-1, :last])
        cut[-1] = own[int(np.ceil(percentile * last)) - 1]
    return np.ceil(np.log2(cut.astype(np.float64) + 1)).astype(np.uint8)


def pack_ids(ids: np.ndarray, percentile: float = 0.9) -> tuple[bytes, int]:
    """Index, words and exceptions of ``ids``, and the number of blocks."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return b"", 0
    padded = np.full(blocks * BLOCK, ids[-1], np.uint32)
    padded[:n] = ids
    padded = padded.reshape(blocks, BLOCK)
    low = padded.min(axis=1)
    rest = padded - low[:, None]
    width = _widths(rest, n - (blocks - 1) * BLOCK, percentile)
    over = rest >> width[:, None].astype(np.uint32) if (width < 32).all() else np.where(width[:, None] < 32, rest >> np.minimum(width, 31)[:, None], 0)
    over.reshape(-1)[n:] = 0
    where = np.flatnonzero(over)
    counts = np.bincount(where // BLOCK, minlength=blocks)
    lengths = width.astype(np.int64) * (BLOCK // 64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    words = np.zeros(starts[-1], np.uint64)
    for w in np.unique(width[width > 0]):
        at = np.flatnonzero(width == w)
        words[(starts[at][:, None] + np.arange(lengths[at[0]])).reshape(-1)] = _pack(rest[at], int(w)).reshape(-1)
    index = b"".join(x.tobytes() for x in (low.astype("<u4"), width, starts.astype("<u4"), np.concatenate([[0], np.cumsum(counts)]).astype("<u4")))
    return index + words.astype("<u8").tobytes() + (where % BLOCK).astype("<u2").tobytes() + over.reshape(-1)[where].astype("<u4").tobytes(), blocks


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    lanes = (values.astype(np.uint64) & np.uint64((1 << width) - 1)).reshape(-1, 64)
    out = np.zeros((len(lanes), width), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[:, word] |= lanes[:, i] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= lanes[:, i] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = words.reshape(-1, width)
    out = np.empty((len(lanes), 64), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[:, i] = lanes[:, word] >> np.uint64(shift)
        if shift + width > 64:
            out[:, i] |= lanes[:, word + 1] << np.uint64(64 - shift)
    return (out & np.uint64((1 << width) - 1)).reshape(-1, BLOCK).astype(np.uint32)


def unpack_ids(data: memoryview, n: int, blocks: int) -> np.ndarray:
    if not blocks:
        return np.zeros(0, np.uint32)
    at = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    low, width = take("<u4", blocks), take("u1", blocks)
    starts, first = take("<u4", blocks + 1).astype(np.int64), take("<u4", blocks + 1).astype(np.int64)
    words, place, high = take("<u8", int(starts[-1])), take("<u2", int(first[-1])), take("<u4", int(first[-1]))
    out = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        length = int(w) * (BLOCK // 64)
        out[mine] = _unpack(words[(starts[mine][:, None] + np.arange(length)).reshape(-1)], int(w))
    block = np.repeat(np.arange(blocks), np.diff(first))
    out[block, place] |= high << width[block].astype(np.uint32)
    return (out + low[:, None]).reshape(-1)[:n]


def pack_segment(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, first: int, percentile: float) -> bytes:
    body, blocks = pack_ids(ids, percentile)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join((_HEAD.pack(_MAGIC, len(doc_ids), len(ids), blocks, first), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known.tobytes(), lengths.astype("<u4").tobytes(), body))


def unpack_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """doc_ids, which of them are known, numbers of ids, all ids, place of the first id within the part."""
    magic, docs, n, blocks, first = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a token segment")
    at = _HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    known = np.frombuffer(data, "u1", docs, at + 8 * docs)
    lengths = np.frombuffer(data, "<u4", docs, at + 9 * docs).astype(np.int64)
    return doc_ids, known, lengths, unpack_ids(memoryview(data)[at + 13 * docs:], n, blocks), first


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 2, percentile: float = 0.9, parts: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and store the ids in ascending document order below ``path``."""
    rows = id_text(docs, id_col, text_col)
    parts = parts or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segment, first, doc_ids, lengths, ids, held = TaskContext.get().partitionId(), 0, 0, [], [], [], 0
        made: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            nonlocal segment, first, doc_ids, lengths, ids, held
            flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            data = pack_segment(doc_ids, np.array(lengths, np.int64), flat, first, percentile)
            out = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "segment": pa.array([segment], pa.int32()), "n_docs": pa.array([len(doc_ids)], pa.int32()),
                                              "n_ids": pa.array([len(flat)], pa.int64()), "data": pa.array([data], pa.binary())})
            segment, first = segment + 1, first + len(flat)
            doc_ids, lengths, ids, held = [], [], [], 0
            return out

        def work(batch: pa.RecordBatch) -> None:
            nonlocal held
            flat, bounds = codec(tokenizer).encode(batch.column("text"))
            sizes = np.diff(bounds) + 1
            with_end = np.insert(flat, bounds[1:], end_id).astype(np.uint32)
            ends = np.cumsum(sizes)
            names, a = batch.column("doc_id").to_pylist(), 0
            while a < len(names):  # whole documents until the segment is full
                b = min(len(names), int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SEGMENT_IDS - held)) + 1)
                doc_ids.extend(names[a:b])
                lengths.extend(sizes[a:b].tolist())
                ids.append(with_end[(ends[a - 1] if a else 0):ends[b - 1]])
                held += len(ids[-1])
                if held >= SEGMENT_IDS:
                    made.append(close())
                a = b

        for _ in in_steps(work, chars=2_000_000)(batches):
            pass  # work only fills ``made``
        if doc_ids:
            made.append(close())
        yield from made

    order = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))  # hashes, so that range bounds hold no texts
    rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text").mapInArrow(encode, SEGMENTS).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """Per document from the stored segments: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, unless ``ids`` is false, its ids.

    What is gathered to place the parts is one total per part of the written table, however many documents there are.
    """
    segments = spark.read.schema(SEGMENTS).parquet(path)
    totals = sorted((r["part"], r["n"]) for r in segments.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    base = dict(zip((p for p, _ in totals), np.cumsum([0, *(n for _, n in totals)]).tolist(), strict=False))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("data"), strict=True):
                doc_ids, known, lengths, flat, first = unpack_segment(data.as_buffer().to_pybytes())
                raw, ends = memoryview(flat.astype("<u4").tobytes()), np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                columns = {"doc_id": pa.array(doc_ids, pa.int64(), mask=known == 0), "start": pa.array(ends - lengths + first + base[part], pa.int64()),
                           "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
                if ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)

    return segments.select("part", "data").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else ""))
