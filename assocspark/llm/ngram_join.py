"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters; every candidate pair is verified once.

A document is the set of its word n-grams, as sorted 64-bit hashes. Two documents link if 100 * intersection >= percent * union. Equal sets collapse
first. In one global order of n-grams, rarest first (number of documents, then hash), a pair that links shares one of the first
n - ceil(percent * n / 100) + 1 n-grams of either side, its prefix.

Counting documents per n-gram is what costs, so it is done in two rounds. A document most of whose n-grams stand nowhere else can have no partner: round one
counts only n-grams of a fixed quarter of the hash range, and drops documents with more single ones there than a link allows. Round two counts all n-grams of
the documents left, among these; again those with too many single ones go. What is left has a prefix whose first places are single n-grams, which meet
nobody; only the others become postings.

Documents of a posting list are compared with its centre, the one with fewest single n-grams; pairs of a list whose documents are then in different
components follow. Pairs pass the length filter (sizes), the positional filter (n-grams left behind the shared one) and, before the sets are
intersected, the suffix filter: sizes of 64 hash ranges bound how many n-grams differ.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import BROADCAST_IDS, components
from .text import expand, id_text, in_steps, mix, polynomial, span, stage, string_hashes, words

#: Round one counts the n-grams whose hash has these low bits all zero: a quarter of them.
_QUARTER = np.uint64(3)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_PIVOTS = np.arange(1, 64, dtype=np.uint64) << np.uint64(58)


def gram_sets(texts, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of every text, one after the other, and where each text's begin and end.

    Words stand between ASCII white space, A-Z in lower case; a text of fewer than ``n_words`` words is one n-gram, one without words none.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    codes, offsets, distinct = words(pc.ascii_lower(pc.fill_null(texts, "")))
    sums = polynomial(string_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64))
    n = np.diff(offsets)
    count = np.where(n >= n_words, n - n_words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    start = expand(offsets[:-1], count)
    end = np.minimum(start + n_words, offsets[1:][doc])
    gram = span(sums, start, end) ^ mix((end - start).astype(np.uint64))
    gram = gram[np.lexsort((gram, doc))]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
    return gram[new], np.concatenate([[0], np.cumsum(np.bincount(doc[new], minlength=len(n)))]).astype(np.int64)


def _digests(grams: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit digests of every set: sums of hashed members."""
    out = []
    for salt in (np.uint64(0), _GOLD):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams ^ salt))])
        out.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] ^ np.diff(bounds).astype(np.uint64)).view(np.int64))
    return out


def _sets(n_words: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, bounds = gram_sets(batch.column("text"), n_words)
        k1, k2 = _digests(grams, bounds)
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n": pa.array(np.diff(bounds)), "k1": pa.array(k1), "k2": pa.array(k2)})
    return work


def _quarter(n_words: int, percent: int):
    """(gram, k1) of a quarter of the n-grams, for sets large enough to link with another."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, bounds = gram_sets(batch.column("text"), n_words)
        n = np.diff(bounds)
        doc = np.repeat(np.arange(batch.num_rows), n)
        keep = (grams & _QUARTER == 0) & (100 * n // percent > n)[doc]
        return pa.RecordBatch.from_pydict({"gram": pa.array(grams[keep].view(np.int64)), "k1": pa.array(_digests(grams, bounds)[0][doc[keep]])})
    return work


def _grams(n_words: int):
    """(gram, sid, n) of the texts asked for; another text of the same doc_id is told apart by the digest."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, bounds = gram_sets(batch.column("text"), n_words)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        keep = (_digests(grams, bounds)[0] == np.asarray(batch.column("k1")))[doc]
        doc = doc[keep]
        return pa.RecordBatch.from_pydict({"gram": pa.array(grams[keep].view(np.int64)), "sid": batch.column("sid").take(pa.array(doc)), "n": pa.array(np.diff(bounds)[doc])})
    return work


def _content(n_words: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, bounds = gram_sets(batch.column("text"), n_words)
        own = np.flatnonzero(_digests(grams, bounds)[0] == np.asarray(batch.column("k1")))
        data = [grams[bounds[i]:bounds[i + 1]].tobytes() for i in own.tolist()]
        return pa.RecordBatch.from_pydict({"sid": batch.column("sid").take(pa.array(own)), "grams": pa.array(data, pa.binary())})
    return work


def shared(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Size of the intersection of two sorted sets, or 0 where the suffix filter shows that it is under ``need``."""
    sizes = [np.diff(np.searchsorted(x, _PIVOTS), prepend=0, append=len(x)) for x in (a, b)]
    if (len(a) + len(b) - int(np.abs(sizes[0] - sizes[1]).sum())) // 2 < need:
        return 0
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0


def _verify(percent: int):
    def work(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                need = -(-percent * (len(a) + len(b)) // (100 + percent))
                keep.append(shared(a, b, need) >= need)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return work


def _may_link(percent: int, x: str, y: str) -> Column:
    """Length filter and positional filter for two postings of one list: sizes, and n-grams from the shared one on."""
    nx, ny, px, py = F.col(f"{x}.n"), F.col(f"{y}.n"), F.col(f"{x}.place"), F.col(f"{y}.place")
    need = F.ceil(F.lit(percent) * (nx + ny) / F.lit(100 + percent))
    return (100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)) & (F.least(nx - px, ny - py) >= need)


def _texts(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The texts of ``rows`` that stand for ``sets`` (a written table with doc_id, k1, sid)."""
    few = F.broadcast(sets) if sets.count() <= BROADCAST_IDS else sets
    return rows.join(few.select("doc_id", "k1", "sid"), "doc_id")


def postings(rows: DataFrame, sets: DataFrame, *, n_words: int, percent: int, repeated: bool = False) -> DataFrame:
    """gram, sid, n, single, place of the prefix n-grams that more than one set has; a set's ``single`` ones are its first places.

    ``rows`` has doc_id and text, ``sets`` one row per distinct set: sid, doc_id of a text of it, n, k1. ``repeated``: a doc_id may have the set in two rows.
    """
    slack = F.col("n") - F.ceil(F.col("n") * percent / 100)  # single n-grams that a link leaves room for
    quarter = rows.mapInArrow(in_steps(_quarter(n_words, percent)), "gram long, k1 long")
    single = quarter.groupBy("gram").agg(F.min("k1").alias("k1"), F.max("k1").alias("other")).where("k1 = other").groupBy("k1").agg(F.count("*").alias("single"))
    able = sets.where(F.floor(100 * F.col("n") / percent) > F.col("n"))  # others link with equal sets only
    left = able.join(single, "k1", "left").where(F.coalesce("single", F.lit(0)) <= slack)
    left = stage(left.select("sid", "doc_id", "k1"))
    pairs = _texts(rows, left).mapInArrow(in_steps(_grams(n_words)), "gram long, sid long, n long")
    pairs = stage(pairs.distinct() if repeated else pairs)
    often = pairs.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    prefix = pairs.join(often, "gram").groupBy("sid").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("grams"))
    prefix = prefix.withColumn("single", F.col("n") - F.size("grams")).where(F.col("single") <= slack)
    width = (slack + 1 - F.col("single")).cast("int")
    return prefix.select("sid", "n", "single", F.posexplode(F.slice("grams", F.lit(1), width)).alias("i", "g")).select(
        F.col("g.gram").alias("gram"), "sid", "n", "single", (F.col("single") + F.col("i")).alias("place"))


def links(rows: DataFrame, sets: DataFrame, *, n_words: int, percent: int, repeated: bool = False) -> DataFrame:
    """Links (a, b) between sids: enough of them to connect all sets that any links connect."""
    post = stage(postings(rows, sets, n_words=n_words, percent=percent, repeated=repeated))
    centre = stage(post.groupBy("gram").agg(F.min(F.struct("single", "sid", "n", "place")).alias("c"), F.count("*").alias("docs")).where("docs > 1").select("gram", "c.*"))
    same = F.col("x.gram") == F.col("y.gram")
    ends = [F.least("x.sid", "y.sid").alias("a"), F.greatest("x.sid", "y.sid").alias("b")]
    stars = post.alias("x").join(centre.alias("y"), same & (F.col("x.sid") != F.col("y.sid")) & _may_link(percent, "x", "y"))
    tried = stage(stars.select(*ends).distinct())
    found = _verified(rows, sets, tried, n_words, percent, repeated)
    labels = components(found).withColumnRenamed("node", "sid")
    inside = post.join(labels, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    mixed = inside.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min_by("sid", F.struct("single", "sid")).alias("centre")).where("low < high")
    inside = stage(inside.join(mixed.select("gram", "centre"), "gram").where("sid <> centre").drop("centre"))
    if inside.isEmpty():
        return found
    # In every list the largest component meets the rest, and the rest meets itself; what is connected already is not paired.
    major = inside.groupBy("gram", "component").count().groupBy("gram").agg(F.max_by("component", F.struct("count", "component")).alias("major"))
    rest = inside.join(major, "gram").where("component <> major")
    apart = same & (F.col("x.component") != F.col("y.component")) & _may_link(percent, "x", "y") & ((F.col("y.component") == F.col("x.major")) | (F.col("x.sid") < F.col("y.sid")))
    more = rest.alias("x").join(inside.alias("y"), apart).select(*ends).distinct()
    more = stage(more.join(tried, ["a", "b"], "left_anti"))
    return found.unionByName(_verified(rows, sets, more, n_words, percent, repeated))


def _verified(rows: DataFrame, sets: DataFrame, pairs: DataFrame, n_words: int, percent: int, repeated: bool) -> DataFrame:
    """Those of the pairs (a, b) that link, by their whole sets."""
    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct().join(sets.select("sid", "doc_id", "k1"), "sid"))
    content = _texts(rows, wanted).mapInArrow(in_steps(_content(n_words)), "sid long, grams binary")
    content = stage(content.dropDuplicates(["sid"]) if repeated else content)
    left, right = (content.select(F.col("sid").alias(x), F.col("grams").alias(f"grams_{x}")) for x in "ab")
    return stage(pairs.join(left, "a").join(right, "b").mapInArrow(_verify(percent), "a long, b long"))


def jaccard_components(docs: DataFrame, *, n_words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (size of its set) and component_id, the smallest doc_id that links lead to.

    A text of fewer than ``n_words`` words is one n-gram; one that is null or has no word has an empty set and links with nothing. Equal sets link. Rows that
    share a doc_id are one document as to links, through any of their texts. Rows without a doc_id take no part and have a null component_id.
    An empty table gives no rows.
    """
    rows = id_text(docs, id_col, text_col)
    sketch = stage(rows.mapInArrow(in_steps(_sets(n_words)), "doc_id long, n long, k1 long, k2 long"))
    full = sketch.where("n > 0 AND doc_id IS NOT NULL")
    sets = stage(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")).withColumn("sid", F.monotonically_increasing_id()))
    repeated = not full.groupBy("doc_id", "k1").count().where("count > 1").isEmpty()
    found = links(rows.where("doc_id IS NOT NULL"), sets, n_words=n_words, percent=percent, repeated=repeated)
    ids = [sets.select(F.col("sid").alias(x), F.col("doc_id").alias(f"doc_{x}")) for x in "ab"]
    by_doc = found.join(ids[0], "a").join(ids[1], "b").select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    several = full.groupBy("doc_id").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low <> high").select("doc_id")
    tied = full.join(several, "doc_id").join(sets.select("k1", "k2", F.col("doc_id").alias("b")), ["k1", "k2"]).select(F.col("doc_id").alias("a"), "b")
    labels = components(by_doc.unionByName(tied))
    named = sets.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("k1", "k2", F.coalesce("component", "doc_id").alias("component_id"))
    out = sketch.join(named, ["k1", "k2"], "left").withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))

