"""Removal of runs of words that an earlier document, or an earlier place of the same document, already has: winnowed line hashes.

Passages are pasted in the middle of physical lines and wrapped anew, so a line here is any ``LINE`` consecutive words: one starts at every
word. Of every ``WINDOW`` neighbouring line hashes, which span ``LINE + WINDOW - 1`` = 40 words, the smallest (the last of equals) is kept as
a fingerprint; equal stretches of 40 words keep the same one, so positions are joined by fingerprint.

A joined position is extended both ways over all stretches that keep its fingerprint (20 starts at most): that window is one hash. Equal windows are
matched whole, each later one with the first. Only where the windows of one fingerprint differ, at the ends of runs, are the stretches of the first of
each window compared one by one. The first occurrence of a stretch in (doc_id, word) order stays, whatever documents have it; the words of every later one
are marked, and marks that overlap or touch are one deleted run, of ``MIN_WORDS`` words at least.

Both comparisons are one shuffle each, of what a batch of texts does not match within itself, read as a sorted stream that holds one row: a fingerprint that
every document has needs no memory, and sends one row a batch to its task.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import only_ids
from .text import expand, id_text, in_steps, mix, polynomial, span, stage, string_hashes, words

LINE, WINDOW = 21, 20
MIN_WORDS = LINE + WINDOW - 1
_LOW = np.uint64((1 << 20) - 1)
#: Words between ASCII white space, as ``words`` splits them.
_WORD = re.compile("[^ \t\n\r\x0b\x0c]+")


def _chosen(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all lines of a batch, and for every 40 words inside one text the position of the first word and of the line they keep."""
    n = len(hashes)
    if n < MIN_WORDS:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n - LINE + 1)
    lines = span(polynomial(hashes), at, at + LINE)
    inside = at - np.repeat(offsets[:-1], np.diff(offsets))[:len(at)]  # within its text, so that a text's choice never depends on its batch
    key = (lines & ~_LOW) | (_LOW - (inside.astype(np.uint64) & _LOW))
    low, width = key, 1
    while width < WINDOW:
        step = min(width, WINDOW - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    ends = np.repeat(offsets[1:], np.diff(offsets))
    first = np.flatnonzero(np.arange(len(low)) + MIN_WORDS <= ends[:len(low)])
    return lines, first, first + ((_LOW - (low[first] & _LOW)).astype(np.int64) - inside[first]) % (1 << 20)


def winnow(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions (in the whole batch) of the chosen lines, and their hashes."""
    lines, _, place = _chosen(hashes, offsets)
    chosen = np.zeros(len(lines), bool)
    chosen[place] = True
    place = np.flatnonzero(chosen)
    return place, lines[place]


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    codes, offsets, distinct = words(batch.column("text"))
    return string_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64), offsets


def _earliest(keys: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the rows of a batch: the first of every key in (doc_id, start) order, the later ones, and the first row of each of those."""
    order = np.lexsort((start, doc, *reversed(keys)))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    source = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
    later = (doc[order] != doc[source]) | (start[order] != start[source])
    return order[new], order[later], source[later]


def _windows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Every fingerprint with its window: the stretches that keep it start at ``start`` and the ``n - 1`` words after.

    What a batch repeats is matched at once: later rows have a ``src`` and are dealt by their place, so that no copy follows a frequent line to its task.
    """
    hashes, offsets = _hashes(batch)
    lines, first, place = _chosen(hashes, offsets)
    doc = np.searchsorted(offsets, first, side="right") - 1
    new = np.ones(len(first), bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(first)))
    start, doc = first[head], doc[head]
    window = span(polynomial(hashes), start, start + n + (MIN_WORDS - 1))
    line, at, ids = lines[place[head]], (start - offsets[doc]).astype(np.int32), np.asarray(batch.column("doc_id"))[doc]
    first, later, source = _earliest([line, window], ids, at)
    rows = np.concatenate([first, later])
    line = np.concatenate([line[first], mix(ids[later].view(np.uint64) ^ mix(at[later].astype(np.uint64)))])
    return pa.RecordBatch.from_pydict({"line": pa.array(line.view(np.int64)), "hash": pa.array(window[rows].view(np.int64)), "doc_id": pa.array(ids[rows]), "start": pa.array(at[rows]), "n": pa.array(n[rows].astype(np.int32)),
                                       "src": pa.array(np.concatenate([ids[first], ids[source]]), mask=np.arange(len(rows)) < len(first))})


def _stretches(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Every 40 words of the windows asked for, as a hash and the position of the first word."""
    hashes, offsets = _hashes(batch)
    doc, asked = _flat(batch.column("windows"))
    start, n, window = (np.asarray(asked.field(name)) for name in ("start", "n", "hash"))
    begin, end = offsets[doc] + start, offsets[doc] + start + n + (MIN_WORDS - 1)
    sums = polynomial(hashes)
    keep = np.flatnonzero(end <= offsets[doc + 1])
    keep = keep[span(sums, begin[keep], end[keep]) == window[keep].view(np.uint64)]  # the others are in another text of the same doc_id
    at, doc = expand(begin[keep], n[keep].astype(np.int64)), np.repeat(doc[keep], n[keep])
    stretch, at, ids = span(sums, at, at + MIN_WORDS), (at - offsets[doc]).astype(np.int32), np.asarray(batch.column("doc_id"))[doc]
    first, later, source = _earliest([stretch], ids, at)
    rows = np.concatenate([first, later])
    deal = np.concatenate([stretch[first], mix(ids[later].view(np.uint64) ^ mix(at[later].astype(np.uint64)))])
    return pa.RecordBatch.from_pydict({"deal": pa.array(deal.view(np.int64)), "hash": pa.array(stretch[rows].view(np.int64)), "doc_id": pa.array(ids[rows]), "start": pa.array(at[rows]),
                                       "n": pa.array(np.ones(len(rows), np.int32)), "src": pa.array(np.concatenate([ids[first], ids[source]]), mask=np.arange(len(rows)) < len(first))})


def _matched(groups: tuple[str, ...]):
    """Of rows sorted by ``groups``, doc_id, start: later rows of each group with the first one's doc_id as ``src``; rows that have one pass.

    With a fingerprint above the window, the first rows of the windows of a fingerprint that has several follow, without ``src``.
    """
    outer = groups[0] if len(groups) > 1 else None

    def run(batches):
        last = None  # the first row of the group that is being read: its keys, doc_id, start
        held = None  # that row as a batch, not known yet to have another window beside it; and whether one came before
        for batch in batches:
            known = pc.is_valid(batch.column("src"))
            ready = batch.filter(known).select(_MARK_NAMES)
            if ready.num_rows:
                yield ready
            batch = batch.filter(pc.invert(known))
            if not batch.num_rows:
                continue
            keys = [np.asarray(batch.column(g)) for g in groups]
            doc, start = np.asarray(batch.column("doc_id")), np.asarray(batch.column("start"))
            new = np.ones(len(doc), bool)
            for c, k in enumerate(keys):
                change = np.ones(len(doc), bool)
                change[1:] = k[1:] != k[:-1]
                change[0] = last is None or k[0] != last[0][c]
                new = change if not c else new | change
            at = np.maximum.accumulate(np.where(new, np.arange(len(doc)), -1))
            src = np.where(at < 0, 0 if last is None else last[1], doc[np.maximum(at, 0)])
            src_start = np.where(at < 0, 0 if last is None else last[2], start[np.maximum(at, 0)])
            later = np.flatnonzero((doc != src) | (start != src_start))
            out = [pa.RecordBatch.from_arrays([pa.array(doc[later]), pa.array(start[later]), batch.column("n").take(pa.array(later)), batch.column("hash").take(pa.array(later)), pa.array(src[later])], _MARK_NAMES)]
            heads = np.flatnonzero(new)
            if len(heads):
                last = tuple(k[heads[-1]] for k in keys), doc[heads[-1]], start[heads[-1]]
            if outer and len(heads):
                first = pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(heads)) for c in ("doc_id", "start", "n", "hash")), pa.nulls(len(heads), pa.int64())], _MARK_NAMES)
                line = keys[0][heads]
                before = np.concatenate([[held is not None and held[1] == line[0]], line[1:] == line[:-1]])
                after = np.append(line[1:] == line[:-1], False)
                if held is not None and (held[2] or before[0]):
                    out.append(held[0])
                out.append(first.slice(0, len(heads) - 1).filter(pa.array((before | after)[:-1], pa.bool_())))
                held = first.slice(len(heads) - 1), line[-1], bool(before[-1])
            yield from (b for b in out if b.num_rows)
        if held is not None and held[2]:
            yield held[0]
    return run


_MARKS = "doc_id long, start int, n int, hash long, src long"
_MARK_NAMES = [c.split()[0] for c in _MARKS.split(", ")]


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray | pa.StructArray]:
    """Row of every element of the lists, and the elements."""
    values = lists.flatten()
    return np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets))), values if pa.types.is_struct(values.type) else np.asarray(values)


def _clean(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Merged runs of each text, and the text without them."""
    codes, offsets, distinct = words(batch.column("text"))
    hashes = string_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    doc, marks = _flat(batch.column("runs"))
    start, n, stretch, src = (np.asarray(marks.field(name)) for name in ("start", "n", "hash", "src"))
    begin = offsets[doc] + start
    end = begin + n + (MIN_WORDS - 1)
    fits = end <= offsets[doc + 1]
    doc, begin, end, stretch, src = doc[fits], begin[fits], end[fits], stretch[fits], src[fits]
    same = span(polynomial(hashes), begin, end) == stretch.view(np.uint64)  # the others are in another text of the same doc_id
    order = np.flatnonzero(same)[np.argsort(begin[same], kind="stable")]
    doc, begin, end, src = doc[order], begin[order], end[order], src[order]
    reach = np.maximum.accumulate(end) if len(end) else end  # texts follow one another, so a later text's marks reach further
    new = np.ones(len(begin), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (begin[1:] > reach[:-1])
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(begin))[:len(head)] - 1
    source = np.minimum.reduceat(src, head) if len(head) else src
    owner = doc[head]
    merged = np.stack([begin[head] - offsets[owner], reach[last] - offsets[owner], source], axis=1).tolist()
    bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
    texts, found = [], []
    for d, text in enumerate(batch.column("text").to_pylist()):
        runs = merged[bounds[d]:bounds[d + 1]]
        places = [m.span() for m in _WORD.finditer(text or "")] if runs else []
        kept, at, out = [], 0, []
        for a, b, src in runs:
            start, stop = places[a][0], places[b][0] if b < len(places) else len(text)
            kept.append(text[at:start])
            at = stop
            out.append({"begin": start, "end": stop, "n_words": b - a, "source_doc_id": src})
        texts.append("".join(kept) + text[at:] if runs else text)
        found.append(out)
    runs = pa.array(found, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()), ("source_doc_id", pa.int64())])))
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c not in ("text", "runs")), pa.array(texts, pa.string()), runs],
                                      [*(c for c in batch.schema.names if c not in ("text", "runs")), "text", "removed"])


_REMOVED = "array<struct<begin: long, end: long, n_words: long, source_doc_id: long>>"


def later_runs(rows: DataFrame) -> DataFrame:
    """Per document with matches: doc_id and the stretches of 40 words and more that an earlier place has, each with a document that has it. ``rows`` has doc_id and text."""
    rows = rows.where("doc_id IS NOT NULL")
    windows = rows.mapInArrow(in_steps(_windows), "line long, hash long, doc_id long, start int, n int, src long")
    key = ["line", "hash", "doc_id", "start"]
    found = stage(windows.repartition("line").sortWithinPartitions(*key).mapInArrow(_matched(("line", "hash")), _MARKS))
    asked = stage(found.where("src IS NULL").groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "hash")).alias("windows")))
    stretches = only_ids(rows, asked.select("doc_id")).join(asked, "doc_id").mapInArrow(in_steps(_stretches), "deal long, hash long, doc_id long, start int, n int, src long")
    later = stretches.repartition("deal").sortWithinPartitions("hash", "doc_id", "start").mapInArrow(_matched(("hash",)), _MARKS)
    marks = found.where("src IS NOT NULL").unionByName(later)
    return stage(marks.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "hash", "src")).alias("runs")))


def removed_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per deleted run: doc_id, characters begin to end, n_words, source_doc_id (a document that has it earlier), kept_crc32 of the text left."""
    rows = id_text(docs, id_col, text_col)
    runs = later_runs(rows)
    cleaned = only_ids(rows, runs.select("doc_id")).join(runs, "doc_id").mapInArrow(in_steps(_clean), f"doc_id long, text string, removed {_REMOVED}")
    return cleaned.select("doc_id", F.crc32(F.encode("text", "UTF-8")).alias("kept_crc32"), F.explode("removed").alias("run")).select("doc_id", "run.*", "kept_crc32")


def remove_later_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", drop_emptied: bool = False) -> DataFrame:
    """``docs`` with every later run cut out of its text; all other columns and rows stay as they are.

    With ``drop_emptied``, documents of which nothing but white space is left go; those that were blank before stay.

    Null and empty texts, texts under 40 words and rows without a doc_id are returned unchanged. Rows that share a doc_id and a text are one
    occurrence; a run that a shared doc_id has in one of its texts only is cut only there.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    key, body = (names[docs.columns.index(c)] for c in (id_col, text_col))
    runs = later_runs(id_text(docs, id_col, text_col))
    keyed = plain.withColumn("doc_id", F.col(key).cast("long"))
    hit = only_ids(keyed.where("doc_id IS NOT NULL"), runs.select("doc_id")).join(runs, "doc_id").withColumnRenamed(body, "text")
    rest = [c for c in names if c != body]
    schema = ", ".join(f"{c} {plain.schema[c].dataType.simpleString()}" for c in rest)
    cut = hit.select(*rest, F.col("text").cast("string").alias("text"), "runs").mapInArrow(in_steps(_clean), f"{schema}, text string, removed {_REMOVED}")
    if drop_emptied:
        cut = cut.where("size(removed) = 0 OR text RLIKE '[^ \\t\\n\\r\\x0b\\f]'")
    same = only_ids(keyed, runs.select("doc_id"), "left_anti").select(*names)
    return same.unionByName(cut.withColumnRenamed("text", body).select(*names)).toDF(*docs.columns)
