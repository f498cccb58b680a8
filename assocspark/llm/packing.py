"""Best-fit packing of documents into training sequences, certified by lower bounds.

Documents become pieces of at most ``capacity`` tokens (only longer ones are cut). Pieces are dealt to partitions of about
``PER_PART``; each packs its own by best-fit decreasing and compares the number of bins with a lower bound from dual-feasible
functions. A partition that meets its own bound may still leave most of a bin empty, so the number of all bins is held against
the bound over all pieces too. Until that is met, full bins stay, the pieces of all others are thrown together, dealt anew and
packed again. It ends when the bins left meet the bound of their own pieces, when one partition held them all, when a deal gains
nothing (the deal before it stands) or after ``rounds``. The work of a round is that of the pieces still open. What reaches the
driver is counts, one for each length that occurs, at most ``capacity`` of them.
"""
from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import id_text, in_steps, stage
from .tokens import codec

#: Pieces that one task packs at a time.
PER_PART = 8192
#: Deals after the first; each takes only pieces of bins that are not full.
ROUNDS = 8
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Fixed: multipliers k of the rounding dual-feasible functions.
_ROUNDING = range(1, 33)


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids with ``end_id`` appended, cut into pieces: where each starts, its length and the crc32 of its ids."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, bounds = codec(tokenizer).encode(batch.column("text"))
        sizes = np.diff(bounds) + 1
        raw = memoryview(np.insert(flat, bounds[1:], end_id).astype("<u4").tobytes())
        count = -(-sizes // capacity)
        doc, ends = np.repeat(np.arange(len(sizes)), count), np.cumsum(sizes)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = piece * capacity
        length = np.minimum(capacity, sizes[doc] - start)
        begin = (ends - sizes)[doc] + start
        crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(doc)), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                                           "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    return id_text(docs, id_col, text_col).mapInArrow(in_steps(work), PIECES)


def lower_bound(lengths: np.ndarray, capacity: int, times: np.ndarray | None = None) -> int:
    """Bins that any packing needs: the largest total over dual-feasible functions of length / capacity. ``times``: how often each length occurs."""
    if not len(lengths):
        return 0
    size, place = np.unique(np.asarray(lengths, np.int64), return_inverse=True)
    count = np.zeros(len(size), np.int64)
    np.add.at(count, place, 1 if times is None else times)
    best = -(-int((size * count).sum()) // capacity)
    for small in size[size <= capacity // 2]:  # sizes below ``small`` count nothing, those that leave less than it count whole
        kept = np.where(size > capacity - small, capacity, np.where(size < small, 0, size))
        best = max(best, -(-int((kept * count).sum()) // capacity))
    for k in _ROUNDING:  # multiples of 1 / (k + 1)
        whole = (size * (k + 1)) % capacity == 0
        scaled = np.where(whole, size * k, (size * (k + 1)) // capacity * capacity)
        best = max(best, -(-int((scaled * count).sum()) // (capacity * k)))
    return best


def bound_of(parts: DataFrame, capacity: int) -> int:
    """The lower bound over all pieces, from how often each length occurs."""
    rows = parts.groupBy("length").agg(F.count("*").alias("n")).collect()
    return lower_bound(np.array([r["length"] for r in rows], np.int64), capacity, np.array([r["n"] for r in rows], np.int64))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in it of every length, longest first, each into the fullest open bin that it fits."""
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    used: list[int] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(used), capacity
            used.append(0)
        bins[i], places[i] = b, used[b]
        used[b] += need
        left = room - need
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(b)
    return bins, places


def _pack_group(capacity: int):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece", "ids_crc32"], na_position="first", ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        bins, places = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths)
        return group.assign(bin=bins, offset=places, full=fill[bins] == capacity, certified=len(fill) <= lower_bound(lengths, capacity))
    return pack


def pack(parts: DataFrame, *, capacity: int = 2048, rounds: int = ROUNDS, per_part: int = PER_PART) -> DataFrame:
    """Every piece with its sequence_id, its offset there, the round that placed it, and whether its partition met its lower bound.

    ``parts`` is read once a round and should be a written table. A sequence's pieces are gapless from 0. Repeated rows are packed one by
    one and dealt by their place in the table, so that any number of them spreads; pieces without an id are packed like others; an empty
    input gives an empty result.
    """
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    todo, done, best, base = parts.select(*columns), [], None, 0
    n = todo.count()
    for r in range(rounds + 1):
        groups = max(1, -(-n // per_part))
        dealt = todo.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(r)), F.lit(groups)).cast("int"))
        packed = stage(dealt.groupBy("part").applyInPandas(_pack_group(capacity), f"{PIECES}, part int, bin long, offset long, full boolean, certified boolean"))
        bins, unfilled, left = packed.selectExpr("count_if(offset = 0)", "count_if(offset = 0 AND NOT full)", "count_if(NOT full)").first()
        last = groups == 1 or bins == bound_of(todo, capacity)
        if best is None or bins <= best[1]:
            placed = packed.select(*columns, ((F.lit(base) + F.col("part")) * F.lit(1 << 32) + F.col("bin")).alias("sequence_id"), "offset", F.lit(r).alias("round"), "certified", "full")
            done.append(placed.where("full"))
            best = placed.where("NOT full"), unfilled
            todo, n = best[0].select(*columns), left
        if last:
            break
        base += groups
    done.append(best[0])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("full")


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents; a null or empty text is one piece, its end id."""
    return pack(stage(pieces(docs, tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col)), capacity=capacity, rounds=rounds)
