"""Near-duplicate classes by DartMinHash: weighted signatures of word shingles, banded joining, exact verification.

A text is the multiset of its five-word shingles (lower case, between white space); a shingle that occurs w times is a region of
weight w, made of w unit strips. Darts are thrown on every strip at random ranks, fixed by a hash of shingle, strip and number of
the throw, so two texts that share a strip share its darts. Each dart belongs to one of ``K`` coordinates, and a coordinate keeps
its earliest dart. Only darts up to rank (K ln K + 2 K) / weight are thrown, then, for the few texts with an empty coordinate, up
to twice that, and so on; the chance that a coordinate agrees is the weighted Jaccard similarity. 32 bands of 4 coordinates miss a pair
of similarity 0.8 with probability 5e-8.

Equal texts collapse before banding. In each bucket every text is compared with the smallest one. Texts of a bucket that are then
still in different components are compared in blocks, skipping what is connected already, so that no link is lost and no group of
copies is expanded into pairs. Every link is verified on the shingles themselves.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, only_ids
from .text import id_text, in_steps, mix, polynomial, span, stage, string_hashes, words

SHINGLE = 5
SIMILARITY = 0.8
K, ROWS = 128, 4
_THROW = K * (np.log(K) + 2)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Texts of a bucket that are compared in one task.
BLOCK = 128


def strips(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit strips of a batch, sorted within each text; where each text's strips begin and end; hashes of the whole word sequences."""
    codes, offsets, distinct = words(texts, lower=True)
    sums = polynomial(string_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64))
    n = np.diff(offsets)
    whole = span(sums, offsets[:-1], offsets[1:]) ^ mix(n.astype(np.uint64))
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    start = offsets[:-1][doc] + np.arange(bounds[-1]) - bounds[:-1][doc]
    shingle = span(sums, start, np.minimum(start + SHINGLE, offsets[1:][doc]))
    shingle = shingle[np.lexsort((shingle, doc))]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(shingle))
    nth = at - np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
    return np.where(nth > 0, mix(shingle ^ (nth.astype(np.uint64) * _GOLD)), shingle), bounds, whole


def signatures(strip: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The earliest dart of each coordinate, a row per text; texts without strips keep the largest value throughout."""
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    weight = np.diff(bounds)
    out = np.full((len(weight), K), none)
    todo, reach = np.flatnonzero(weight), 1.0
    while len(todo):
        each = weight[todo]
        ends = np.cumsum(each)
        doc = np.repeat(np.arange(len(todo)), each)
        live = strip[np.repeat(bounds[todo] - (ends - each), each) + np.arange(ends[-1])]
        limit = reach * _THROW / each
        best = np.full(len(todo) * K, none)
        rank, throw = np.zeros(len(live)), 0
        while len(live):
            dart = mix(live + np.uint64(throw * int(_GOLD) % (1 << 64)))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
            hit = rank < limit[doc]
            live, doc, rank, dart = live[hit], doc[hit], rank[hit], mix(dart[hit])
            key = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | (dart & np.uint64(0xFFFFFFFF))
            np.minimum.at(best, doc * K + (dart >> np.uint64(57)).astype(np.int64), key)
            throw += 1
        best = best.reshape(-1, K)
        full = (best != none).all(axis=1)
        out[todo[full]] = best[full]
        todo, reach = todo[~full], reach * 2
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A hash per band, different for equal values in different bands."""
    dart = (signature & np.uint64(0xFFFFFFFF)).reshape(len(signature), K // ROWS, ROWS)
    out = np.broadcast_to(mix(np.arange(K // ROWS, dtype=np.uint64)), dart.shape[:2])
    for r in range(ROWS):
        out = mix(out ^ dart[:, :, r])
    return out.view(np.int64)


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    strip, bounds, whole = strips(batch.column("text"))
    keys = bands(signatures(strip, bounds))
    second = mix(whole ^ _GOLD) ^ np.add.reduceat(np.append(strip, np.uint64(0)), bounds[:-1])
    empty = np.diff(bounds) == 0
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * keys.shape[1], pa.int32()), pa.array(keys.reshape(-1)))
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "k1": pa.array(whole.view(np.int64), mask=empty), "k2": pa.array(second.view(np.int64), mask=empty), "bands": lists})


def _content(batch: pa.RecordBatch) -> pa.RecordBatch:
    strip, bounds, whole = strips(batch.column("text"))
    data = [np.sort(strip[a:b]).tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "k1": pa.array(whole.view(np.int64)), "strips": pa.array(data, pa.binary())})


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of strips, which is the weighted one of the texts."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or len(a) < SIMILARITY * len(b):
        return 0.0
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return both / (len(a) + len(b) - both)


def _verify(batches):
    for batch in batches:
        left, right = batch.column("strips_a"), batch.column("strips_b")
        keep = [similarity(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= SIMILARITY for x, y in zip(left, right, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a bucket that connect components; pairs that are connected are not compared."""
    group = group.drop_duplicates("node")
    nodes, side = group["node"].tolist(), group["block"].tolist()
    sets = [np.frombuffer(x, np.uint64) for x in group["strips"]]
    root = {c: c for c in group["component"]}
    comp = group["component"].tolist()

    def top(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    apart = len(set(side)) > 1
    found = []
    for i in range(len(nodes)):
        for j in range(i):
            if (not apart or side[i] != side[j]) and (x := top(comp[i])) != (y := top(comp[j])) and similarity(sets[i], sets[j]) >= SIMILARITY:
                root[max(x, y)] = min(x, y)
                found.append((nodes[i], nodes[j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and class_id, the smallest doc_id of its class.

    Classes are connected components under weighted Jaccard similarity of at least 0.8 on five-word shingles; a text of one to four
    words is one shingle. Texts that are null or hold no word are classes of their own. Rows that share a doc_id are one document as to
    class (each row is returned). A text whose doc_ids are all null is not linked and has a null class_id.
    """
    rows = id_text(docs, id_col, text_col)
    sketch = stage(rows.mapInArrow(in_steps(_sketch), "doc_id long, k1 long, k2 long, bands array<long>"))
    texts = stage(sketch.where("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("node"), F.min_by("bands", "doc_id").alias("bands")).where("node IS NOT NULL"))
    member = texts.select("node", F.explode("bands").alias("band"))
    centre = stage(member.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("set")).where("size > 1"))
    bucket = stage(member.join(centre.select("band", "centre", "size"), "band"))
    stars = stage(bucket.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    wanted = stage(stars.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    content = only_ids(rows, wanted).mapInArrow(in_steps(_content), "doc_id long, k1 long, strips binary").groupBy("doc_id").agg(F.min_by("strips", "k1").alias("strips"))
    content = stage(content)
    right = stars.join(content.select(F.col("doc_id").alias("b"), F.col("strips").alias("strips_b")), "b")
    links = stage(right.join(content.select(F.col("doc_id").alias("a"), F.col("strips").alias("strips_a")), "a").mapInArrow(_verify, "a long, b long"))
    labels = components(links)
    rest = _apart(bucket, centre, labels, content)
    if rest is not None:
        labels = components(links.unionByName(rest))
    of_text = texts.join(labels, "node", "left").select("k1", "k2", F.coalesce("component", "node").alias("class_id"))
    named = sketch.select("doc_id", "k1", "k2").join(of_text, ["k1", "k2"], "left")
    return named.select("doc_id", F.when(F.col("k1").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def _apart(bucket: DataFrame, centre: DataFrame, labels: DataFrame, content: DataFrame) -> DataFrame | None:
    """Links inside buckets between texts that the smallest text of the bucket did not connect."""
    small = bucket.where("size > 2 AND node <> centre").join(labels, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    split = small.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")
    split = split.join(centre, "band").groupBy("set", "size").agg(F.min("band").alias("band"))  # the same texts often share several bands
    mixed = stage(small.join(split.select("band"), "band"))
    if mixed.isEmpty():
        return None
    parts = mixed.groupBy("band", "component").count()
    major = stage(parts.groupBy("band").agg(F.max_by("component", F.struct("count", "component")).alias("major"), F.max("count").alias("n_major"), F.sum("count").alias("n")))
    dealt = mixed.join(major, "band")
    minor = F.col("component") != F.col("major")
    # The rest of all buckets in which a component is the largest meets its texts once, whichever bands they share.
    own = stage(dealt.where(~minor).select(F.col("major").alias("bucket"), "node", "component").distinct())
    rest = stage(dealt.where(minor).select(F.col("major").alias("bucket"), "node", "component").distinct())
    blocks = own.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("tall")).join(rest.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("wide")), "bucket")
    among = dealt.where(minor).withColumn("wide", F.ceil((F.col("n") - F.col("n_major")) / BLOCK).cast("int"))
    split = among.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band")

    def block(cuts):
        return F.pmod(F.xxhash64("node"), cuts).cast("int")

    def each(cuts):
        return F.explode(F.sequence(F.lit(0), F.col(cuts) - 1))

    tiles = [
        own.join(blocks, "bucket").select("bucket", (-1 - block("tall")).alias("i"), each("wide").alias("j"), F.lit(-1).alias("block"), "node", "component"),
        rest.join(blocks, "bucket").withColumn("j", block("wide")).select("bucket", F.explode(F.sequence(-F.col("tall"), F.lit(-1))).alias("i"), "j", F.col("j").alias("block"), "node", "component"),
        among.join(split, "band").withColumn("block", block("wide")).withColumn("other", each("wide")).select(
            F.col("band").alias("bucket"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component"),
    ]
    full = tiles[0].union(tiles[1]).union(tiles[2]).join(content.select(F.col("doc_id").alias("node"), "strips"), "node")
    return stage(full.groupBy("bucket", "i", "j").applyInPandas(_compare, "a long, b long"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose doc_id is that of their class, one row per doc_id; rows without a doc_id stay."""
    classes = stage(near_duplicates(docs, id_col=id_col, text_col=text_col))
    later = stage(classes.where("doc_id <> class_id").select("doc_id").distinct())
    twice = stage(classes.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    keyed = docs.toDF(*names).withColumn("doc_id", F.col(names[docs.columns.index(id_col)]).cast("long"))
    kept = only_ids(keyed, later, "left_anti")
    if not twice.isEmpty():
        body = names[docs.columns.index(text_col)]
        single = only_ids(kept.where("doc_id IS NOT NULL"), twice).groupBy("doc_id").agg(F.min_by(F.struct(*names), F.struct(body, F.xxhash64(*names))).alias("row"))
        kept = only_ids(kept, twice, "left_anti").select(*names).unionByName(single.select("row.*"))
    return kept.select(*names).toDF(*docs.columns)
