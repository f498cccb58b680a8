"""Benchmark decontamination: benchmark items found in documents within an edit budget, by the q-gram lemma and banded alignment.

Texts are compared in lower case with every run of white space as one blank. An item of n characters is found where a stretch of a
document is within e = min(n / 10, (n - 8) / 8) edits of the whole item. By the q-gram lemma such a stretch shares at least
n - 7 - 8 e of the item's 8-grams, and all of them lie within e diagonals of each other. Shared 8-grams are counted per item in
bands of 2 (e + 1) diagonals that overlap by half; bands with too few cannot hold the item.

Benchmarks are often templated. An item leaves out 8-grams that many items have, as many as the lemma allows, and needs that many fewer. A band
that passes then has to hold n - 3 - 4 e of the item's 4-grams, which the lemma asks for as well; only what passes both is aligned.

A task holds the index of a bounded chunk of the benchmark (``CHUNK_CHARS`` characters or one longer item); a larger benchmark takes
more than one pass over the documents, each with its own chunk. Documents are never shuffled.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import only_ids
from .text import expand, id_text, in_steps, stage

Q = 8
#: Items with fewer characters take no part: too little to tell them from chance.
SHORTEST = 2 * Q
CHUNK_CHARS = 2_000_000
#: Places in a chunk from which on an 8-gram may be left out, the length of the second sieve's grams, and places looked up at a time.
COMMON, SMALL = 32, 4
STEP = 2_000_000
_B = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 21
FOUND = "doc_id long, item_id long, begin long, end long, distance int"


def normal(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, lower case with blanks squeezed; where each text begins and ends; each one's place in its own text."""
    lower = pc.fill_null(pc.utf8_lower(texts), "").to_pylist()
    sizes = np.fromiter((len(t) for t in lower), np.int64, len(lower))
    flat = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    blank = (flat == 32) | ((flat >= 9) & (flat <= 13)) | (flat == 0)
    first = np.zeros(len(flat), bool)
    first[bounds[:-1][sizes > 0]] = True
    keep = ~blank
    keep[1:] |= ~blank[:-1] & ~first[1:]
    at = np.flatnonzero(keep)
    return np.where(blank[at], 32, flat[at]).astype(np.uint32), np.concatenate([[0], np.cumsum(keep)])[bounds], at - np.repeat(bounds[:-1], sizes)[at]


def grams(points: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of every ``q`` characters (a power of two), by doubling."""
    h, width, b = points.astype(np.uint64) + np.uint64(1), 1, int(_B)
    while width < q:
        h = h[:-width] + h[width:] * np.uint64(b) if len(h) > width else h[:0]
        width, b = 2 * width, b * b % (1 << 64)
    return h * _B ^ (h >> np.uint64(29))


def budget(n: int) -> int:
    return max(0, min(n // 10, (n - Q) // Q))


class Index(NamedTuple):
    """8-grams of a chunk of items: a table of slots in use, the distinct hashes, and where each occurs."""
    used: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    at: np.ndarray
    ids: np.ndarray
    texts: list
    edits: np.ndarray
    least: np.ndarray
    fours: np.ndarray
    four_first: np.ndarray
    four_codes: np.ndarray


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def build_index(ids: list[int], texts: list[str]) -> Index:
    points, bounds, _ = normal(pa.array(texts, pa.string()))
    clean = [points[a:b - (b > a and points[b - 1] == 32)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    clean = [c[1:] if len(c) and c[0] == 32 else c for c in clean]
    kept = [i for i, c in enumerate(clean) if len(c) >= SHORTEST]
    clean, ids = [clean[i] for i in kept], np.array([ids[i] for i in kept], np.int64)
    n = np.array([len(c) for c in clean], np.int64)
    edits = np.array([budget(x) for x in n], np.int64)
    all_grams = [grams(c) for c in clean]
    count = np.array([len(g) for g in all_grams], np.int64)
    flat = np.concatenate(all_grams) if kept else np.zeros(0, np.uint64)
    item, at = np.repeat(np.arange(len(kept)), count), expand(np.zeros(len(kept), np.int64), count)
    _, which, times = np.unique(flat, return_inverse=True, return_counts=True)
    least = n - Q + 1 - Q * edits
    # Of an item's 8-grams, the most frequent ones beyond COMMON places go, but for as many as it needs; ``rank`` counts them within the item.
    by_use = np.lexsort((at, -times[which], item)) if len(flat) else np.zeros(0, np.int64)
    rank = np.empty(len(flat), np.int64)
    rank[by_use] = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
    out = (times[which] > COMMON) & (rank < (least - 1)[item])
    least = least - np.bincount(item[out], minlength=len(kept))
    flat, item, at = flat[~out], item[~out], at[~out]
    order = np.argsort(flat, kind="stable")
    hashes, first = np.unique(flat[order], return_index=True)
    used = np.zeros(1 << _TABLE_BITS, bool)
    used[_slot(hashes)] = True
    small = [grams(c, SMALL) for c in clean]
    fours, codes = np.unique(np.concatenate(small) if kept else np.zeros(0, np.uint64), return_inverse=True)
    return Index(used, hashes, np.append(first, len(flat)), item[order], at[order], ids, clean, edits, least, fours, np.cumsum([0, *map(len, small)]), codes)


def align(item: np.ndarray, region: np.ndarray, edits: int) -> tuple[int, int] | None:
    """Least number of edits that turns ``item`` into a stretch of ``region``, and where the first such stretch ends; None beyond ``edits``.

    Cell k of row i stands for the first i characters of the item ending at character i + k - edits of the region, so the band is as wide as the
    region is longer than the item, and ``edits`` on either side.
    """
    width = max(0, len(region) - len(item)) + 2 * edits + 1
    padded = np.full(len(item) + width + 2 * edits, 0xFFFFFFFF, np.uint32)
    padded[edits:edits + len(region)] = region[:len(padded) - edits]
    cell = np.arange(width)
    far = len(item) + len(region) + 1
    row = np.where((cell >= edits) & (cell - edits <= len(region)), 0, far)
    for i in range(1, len(item) + 1):
        end = i + cell - edits
        step = row + (padded[i - 1:i - 1 + width] != item[i - 1])
        step[:-1] = np.minimum(step[:-1], row[1:] + 1)
        step = np.minimum.accumulate(step - cell) + cell
        row = np.where((end >= 0) & (end <= len(region)), step, far)
        if row.min() > edits:
            return None
    best = int(row.argmin())
    return int(row[best]), len(item) + best - edits


def _stretch(item: np.ndarray, region: np.ndarray, edits: int) -> tuple[int, int, int] | None:
    """Distance, begin and end of the best stretch."""
    whole = region.tobytes().find(item.tobytes())
    while whole >= 0 and whole % 4:
        whole = region.tobytes().find(item.tobytes(), whole + 1)
    if whole >= 0:
        return 0, whole // 4, whole // 4 + len(item)
    found = align(item, region, edits)
    if found is None:
        return None
    distance, end = found
    back = align(item[::-1], region[:end][::-1], distance)
    return distance, end - (back[1] if back else len(item)), end


def _bands(index: Index, place: np.ndarray, doc: np.ndarray, gram: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document and item, band of diagonals) with enough shared 8-grams, sorted."""
    posting = expand(index.first[gram], times)
    item = index.item[posting]
    diagonal = np.repeat(place, times) - index.at[posting]
    band = diagonal // (index.edits[item] + 1)
    pair = np.repeat(doc, times) * len(index.ids) + item
    pair, band = np.concatenate([pair, pair]), np.concatenate([band, band - 1])
    key, count = np.unique((pair << 32) + (band + (1 << 31)), return_counts=True)
    pair, band = key >> 32, (key & 0xFFFFFFFF) - (1 << 31)
    enough = count >= index.least[pair % len(index.ids)]
    return pair[enough], band[enough]


def _may_hold(index: Index, points: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
    """The lemma for 4-grams: whether enough places of each item have a 4-gram of points[begin:end].

    Regions are first looked up by the page around them, of two to four times their length, all items of a page at once; then one by one.
    """
    keep = np.ones(len(item), bool)
    have = np.zeros(len(index.fours) + 1, bool)
    width = 1 << np.ceil(np.log2(np.maximum(end - begin, 1))).astype(np.int64)
    for low, high in ((begin // width * width, begin // width * width + 2 * width), (begin, end)):
        todo = np.flatnonzero(keep)
        order = todo[np.lexsort((high[todo], low[todo]))]
        new = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        for group in np.split(order, np.flatnonzero(new) + 1) if len(order) else ():
            h = grams(points[low[group[0]]:high[group[0]]], SMALL)
            at = np.minimum(np.searchsorted(index.fours, h), len(index.fours) - 1)
            seen = at[index.fours[at] == h]
            have[seen] = True
            i = item[group]
            size = index.four_first[i + 1] - index.four_first[i]
            hits = have[index.four_codes[expand(index.four_first[i], size)]]
            count = np.bincount(np.repeat(np.arange(len(group)), size), hits, len(group))
            have[seen] = False
            keep[group] = count >= size - SMALL * index.edits[i]
    return keep


def scan(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch | None:
    points, bounds, original = normal(batch.column("text"))
    h = grams(points)
    hit = np.flatnonzero(index.used[_slot(h)])
    if not len(hit) or not len(index.hashes):
        return None
    doc = np.searchsorted(bounds, hit, side="right") - 1
    gram = np.minimum(np.searchsorted(index.hashes, h[hit]), len(index.hashes) - 1)
    real = (index.hashes[gram] == h[hit]) & (hit + Q <= bounds[doc + 1])
    hit, doc, gram = hit[real], doc[real], gram[real]
    times = index.first[gram + 1] - index.first[gram]
    steps = np.cumsum(np.bincount(doc, times, batch.num_rows)) // STEP  # a document is looked up in one step
    parts = [_bands(index, hit[take] - bounds[doc[take]], doc[take], gram[take], times[take]) for take in (steps[doc] == k for k in np.unique(steps[doc]))]
    pair, band = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2
    if not len(pair):
        return None
    out = []
    start = np.ones(len(pair), bool)
    start[1:] = (np.diff(pair) != 0) | (np.diff(band) > 2)
    a = np.flatnonzero(start)
    doc, item = pair[a] // len(index.ids), pair[a] % len(index.ids)
    edits, sizes = index.edits[item], np.array([len(t) for t in index.texts], np.int64)[item]
    low, size = bounds[doc], bounds[doc + 1] - bounds[doc]
    begin = low + np.maximum(0, band[a] * (edits + 1) - edits)
    end = low + np.minimum(np.maximum(0, (band[np.append(a[1:], len(pair)) - 1] + 2) * (edits + 1) + sizes + edits), size)
    for k in np.flatnonzero(_may_hold(index, points, begin, end, item)).tolist():
        found = _stretch(index.texts[item[k]], points[begin[k]:end[k]], int(edits[k]))
        if found:
            place, first = original[low[k]:low[k] + size[k]], int(begin[k] - low[k])
            out.append((int(doc[k]), int(index.ids[item[k]]), int(place[first + found[1]]) if first + found[1] < len(place) else 0, int(place[first + found[2] - 1]) + 1, found[0]))
    if not out:
        return None
    d, ids, begin, end, distance = zip(*out, strict=True)
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(d)), "item_id": pa.array(ids, pa.int64()), "begin": pa.array(begin, pa.int64()),
                                       "end": pa.array(end, pa.int64()), "distance": pa.array(distance, pa.int32())})


def _indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes of bounded chunks of the benchmark; how many there are follows its size."""
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = -(-total // CHUNK_CHARS)
    for c in range(chunks):
        rows = items.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)) == c).collect()
        yield build_index([r["doc_id"] for r in rows], [r["text"] for r in rows])


def find_items(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per place where a document holds a benchmark item: doc_id, item_id, begin and end in characters, distance in edits.

    Items that are null or have under 16 characters, and items without an item_id, take no part; null and empty documents hold nothing. Repeated rows are scanned one by one.
    """
    rows = id_text(docs, id_col, text_col)
    items = id_text(benchmark, item_col, item_text_col).where("doc_id IS NOT NULL AND text IS NOT NULL")
    context, out = docs.sparkSession.sparkContext, None
    for index in _indexes(items):
        shared = context.broadcast(index)

        def work(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch | None:
            return scan(shared.value, batch)

        found = rows.mapInArrow(in_steps(work, chars=2_000_000), FOUND)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], FOUND)


def without_items(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; rows without a doc_id stay."""
    held = stage(find_items(docs, benchmark, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col).where("doc_id IS NOT NULL").select("doc_id").distinct())
    names = [f"c{i}" for i in range(len(docs.columns))]
    keyed = docs.toDF(*names).withColumn("doc_id", F.col(names[docs.columns.index(id_col)]).cast("long"))
    return only_ids(keyed, held, "left_anti").select(*names).toDF(*docs.columns)
