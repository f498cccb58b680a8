"""Arrow helpers that the text operators share: bounded batches, words as codes, hashes and written stages."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that one step of a task works on (a single longer text is one step).
STEP_CHARS = 3_000_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor reaches.

    Where the setting is missing, the context's checkpoint folder serves, and on a local master a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends here, lost executors cost no rework before it."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; every other column stays out of the way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def in_steps(work: Callable[[pa.Table], pa.Table | pa.RecordBatch | None], column: str = "text", chars: int = STEP_CHARS):
    """A mapInArrow function that hands ``work`` at most about ``chars`` bytes of ``column`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.nan_to_num(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))).astype(np.int64)
            step = np.cumsum(sizes) // chars
            cuts = [0, *(np.flatnonzero(np.diff(step)) + 1), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                out = work(batch.slice(a, b - a))
                if out is not None and out.num_rows:
                    yield from (out.to_batches() if isinstance(out, pa.Table) else [out])
            pa.default_memory_pool().release_unused()  # workers live long; what they keep adds up beside the executor's heap
    return run


class Words(NamedTuple):
    """Words of a batch of texts: ``codes[offsets[d]:offsets[d + 1]]`` index ``distinct`` for text d."""
    codes: np.ndarray
    offsets: np.ndarray
    distinct: pa.StringArray


def words(texts, *, lower: bool = False) -> Words:
    """Words between ASCII white space; a null text has none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    parts = pc.ascii_split_whitespace(pc.utf8_lower(texts) if lower else texts)
    offsets = np.asarray(parts.offsets).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    codes, distinct, offsets = np.asarray(coded.indices).astype(np.int64), coded.dictionary, offsets - offsets[0]
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py() if len(distinct) else -1
    if empty >= 0:
        full = codes != empty
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        codes = codes[full]
    return Words(codes, offsets, distinct)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def string_hashes(strings: pa.StringArray) -> np.ndarray:
    """64-bit hashes of strings: a polynomial over their bytes, finished by length; equal on every machine."""
    if not len(strings):
        return np.zeros(0, np.uint64)
    wide = pa.types.is_large_string(strings.type)
    buffers = strings.buffers()
    bounds = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    sums = polynomial(data.astype(np.uint64) + np.uint64(1))
    return mix(span(sums, bounds[:-1] - bounds[0], bounds[1:] - bounds[0]) ^ mix((bounds[1:] - bounds[:-1]).astype(np.uint64)))


_B = np.uint64(0x5851F42D4C957F2D)
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out[:n]


def polynomial(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values[i] * B**i, and the powers that shift a span's sum back to the start."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_B, len(values)), out=sums[1:])
    return sums, powers(_B_INVERSE, len(values) + 1)


def span(parts: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end], the same wherever the span stands."""
    sums, back = parts
    return mix((sums[end] - sums[start]) * back[start])


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. for lengths[0] steps, then the same for the next."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
