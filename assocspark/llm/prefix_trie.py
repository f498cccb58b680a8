"""Trie of rebuilt conversations: prefixes named by composable monoid fingerprints, without writing out any rebuilt text.

A conversation is rebuilt from the first turns of its base and its own later turns. A turn is two 64-bit hashes of its role and text; a run of turns is an
affine map modulo 2 ** 64 (``scan``), so the fingerprint of a rebuilt prefix is the product of the base's head and a stretch of the conversation's own turns,
taken from running products as P[i] - P[h] shifted by a power of the base. Rows refer to the stored turn they end in, (conversation, place).

Rows with equal depth and fingerprint are a node. Equality is verified through those references: all rows of a node must end in the same turn hash and
have one parent; where they refer to different stored turns, those turns' roles and texts are compared. Then equal nodes are equal sequences, by
induction over the depth. If a comparison fails, all is done again with other hashes.

Sums over subtrees need no walk by levels. A node counts for the smallest member conversation; what a conversation counts for below each depth is a
running sum from its end, and a node adds up those of its members. Rows below the last shared node have one member and are known without.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import power, scanned
from .text import stage

#: Turns of the base that a conversation may begin with, at most.
HEAD = 5
#: Fixed: odd bases of the two fingerprints; 3 modulo 8 lose least of a difference of two turns that change places.
_BASES = (0x5851F42D4C957F2B, 0x2545F4914F6CDD1B)
_TRIES = 4
#: Hashes of turns that may be broadcast to find their texts.
_BROADCAST = 1_000_000


def _hashes(seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(seed), "role", "text"), F.xxhash64(F.lit(~seed), "text", "role")


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                                              F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_HEAD = "array<struct<place: long, h1: long, h2: long, size: long, sum_h1: long, sum_h2: long>>"
_ROW = ("conv_id long, depth long, f1 long, f2 long, g1 long, g2 long, h1 long, h2 long, size long, ref_conv long, ref_place long, ends boolean")
_ROW_NAMES = [c.split()[0] for c in _ROW.split(", ")]


def _bits(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.asarray(batch.column(name)).view(np.uint64)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c].view(np.int64) if columns[c].dtype == np.uint64 else columns[c]) for c in _ROW_NAMES], _ROW_NAMES)


def _head_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Root and head rows of every conversation: its base's stored turns."""
    for batch in batches:
        taken = np.asarray(batch.column("k"))
        rows = np.repeat(np.arange(batch.num_rows), taken + 1)
        depth = np.arange(len(rows)) - np.repeat(np.cumsum(taken + 1) - taken - 1, taken + 1)
        lists = batch.column("head")
        first = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
        turns, n = lists.flatten(), len(lists.flatten())
        at = np.minimum(first[rows] + np.maximum(depth - 1, 0), max(n - 1, 0))
        inner = depth > 0

        def field(name, at=at, inner=inner, turns=turns, n=n):
            values = np.asarray(turns.field(name)).view(np.uint64) if n else np.zeros(1, np.uint64)
            return np.where(inner, values[at], np.uint64(0))

        place = np.maximum(depth - 1, 0)
        sums, hashes = [field("sum_h1"), field("sum_h2")], [field("h1"), field("h2")]
        before = [s - h * power(b, place) for s, h, b in zip(sums, hashes, _BASES, strict=True)]
        conv, base = np.asarray(batch.column("conv_id"))[rows], np.asarray(batch.column("base"))[rows]
        yield _batch({"conv_id": conv, "depth": depth, "f1": sums[0], "f2": sums[1], "g1": before[0], "g2": before[1], "h1": hashes[0], "h2": hashes[1], "size": field("size").view(np.int64),
                      "ref_conv": np.where(inner, base, conv), "ref_place": np.where(inner, place, -1), "ends": depth == np.asarray(batch.column("length"))[rows]})


def _tail_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of own turns from place h on: head product composed with the own stretch."""
    for batch in batches:
        place, h, k = (np.asarray(batch.column(c)) for c in ("place", "h", "k"))
        full, before = [], []
        for i, base in zip((1, 2), _BASES, strict=True):
            own = _bits(batch, f"sum_h{i}")
            shift = power(base, k - h)
            full.append(_bits(batch, f"p{i}") + shift * (own - _bits(batch, f"o{i}")))
            before.append(full[-1] - shift * _bits(batch, f"h{i}") * power(base, place))
        conv, depth = np.asarray(batch.column("conv_id")), k + place - h + 1
        yield _batch({"conv_id": conv, "depth": depth, "f1": full[0], "f2": full[1], "g1": before[0], "g2": before[1], "h1": _bits(batch, "h1"), "h2": _bits(batch, "h2"),
                      "size": np.asarray(batch.column("size")), "ref_conv": conv, "ref_place": place, "ends": depth == np.asarray(batch.column("length"))})


def prefixes(turns: DataFrame, seed: int) -> DataFrame:
    """One row per conversation and depth of its rebuilt form: fingerprint, parent's fingerprint, the turn it ends in and where that is stored."""
    h1, h2 = _hashes(seed)
    keyed = turns.select("conv_id", "turn", "role", h1.alias("h1"), h2.alias("h2"), F.length("text").cast("long").alias("size"))
    stored = scanned(keyed, "conv_id", [F.col("turn").asc_nulls_first(), "role", "h1", "h2"], {"h1": _BASES[0], "h2": _BASES[1]}).drop("turn", "role", "part")
    turn = F.struct("place", "h1", "h2", "size", "sum_h1", "sum_h2")
    convs = stage(stored.groupBy("conv_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.when(F.col("place") < HEAD, turn))).alias("own"))
                  .withColumns({"base": F.expr("conv_id - conv_id % 100"), "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)}))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("head"))
    joined = convs.join(heads, "base", "left").withColumn("head", F.coalesce("head", F.array().cast(_HEAD)))
    joined = joined.withColumn("k", F.least(F.col("h"), F.size("head").cast("long"))).withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))

    def up_to(turns_col, count, field):
        return F.when(F.col(count) > 0, F.get(F.col(turns_col), F.least(F.col(count), F.size(turns_col)).cast("int") - 1)[field])

    plan = stage(joined.select("conv_id", "base", "n", "h", "k", "length", F.slice("head", 1, F.col("k").cast("int")).alias("head"),
                               *(F.coalesce(up_to("head", "k", f"sum_h{i}"), F.lit(0)).alias(f"p{i}") for i in (1, 2)), *(F.coalesce(up_to("own", "h", f"sum_h{i}"), F.lit(0)).alias(f"o{i}") for i in (1, 2))))
    tail = stored.join(plan.where("n > h").drop("head", "base", "n"), "conv_id").where("place >= h")
    return stage(plan.select("conv_id", "base", "k", "length", "head").mapInArrow(_head_rows, _ROW).unionByName(tail.mapInArrow(_tail_rows, _ROW)))


def _equal(nodes: DataFrame, turns: DataFrame, seed: int) -> bool:
    """Whether all members of each node are the same sequence: one last turn hash, one parent, and one text behind that hash."""
    if not nodes.where("low <> high").isEmpty():
        return False
    asked = stage(nodes.where("low_ref <> high_ref").select(F.col("low.h1").alias("h1"), F.col("low.h2").alias("h2")).distinct())
    h1, h2 = _hashes(seed)
    asked = F.broadcast(asked) if asked.count() <= _BROADCAST else asked
    pairs = turns.select("role", "text", h1.alias("h1"), h2.alias("h2")).join(asked, ["h1", "h2"])
    pair = F.struct("role", "text")
    return pairs.groupBy("h1", "h2").agg(F.min(pair).alias("a"), F.max(pair).alias("b")).where("a <> b").isEmpty()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined ids of each node, from rows sorted by node and id: a stream, however many end in one node."""
    key, sha, out = None, None, []
    schema = pa.schema([("depth", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        columns = [np.asarray(batch.column(c)) for c in ("depth", "f1", "f2")]
        change = np.zeros(max(batch.num_rows - 1, 0), bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        ids = batch.column("conv_id").to_pylist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            now, text = tuple(int(c[a]) for c in columns), ",".join(map(str, ids[a:b])).encode()
            if now == key:
                sha.update(b"," + text)
            else:
                if key is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = now, hashlib.sha256(text)
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
            out.clear()
    if key is not None:
        out.append((*key, sha.hexdigest()))
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role, text; other columns are ignored. Turns are ordered by turn (null first), those of one turn by role and then
    the hash of the text, so that equal rows, which all count, stand together. Null roles and texts are empty. Rows without a conv_id take no part. An
    empty table has no conversation and gives no rows; else the root is always there.
    """
    turns = _turns(conversations)
    node = ["depth", "f1", "f2"]
    for seed in range(_TRIES):
        rows = prefixes(turns, seed)
        ends_in = F.struct("h1", "h2", "g1", "g2")
        ref = F.when(F.col("depth") > 0, F.struct("ref_conv", "ref_place"))
        nodes = stage(rows.groupBy(*node).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), F.min(ends_in).alias("low"), F.max(ends_in).alias("high"),
                                              F.min(ref).alias("low_ref"), F.max(ref).alias("high_ref")))
        if _equal(nodes, turns, seed):
            break
    else:
        raise RuntimeError("fingerprints of different prefixes met under every hash")
    plain = nodes.select(*node, "n_convs", "conv_id", "size", F.col("low.g1").alias("g1"), F.col("low.g2").alias("g2"))
    up = [F.col("depth") - 1, F.col("g1"), F.col("g2")]
    children = plain.where("depth > 0").groupBy(*(c.alias(n) for c, n in zip(up, node, strict=True))).agg(F.count("*").alias("n_children"))
    parent = plain.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("g1"), F.col("f2").alias("g2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("n_parent"))
    full = stage(plain.join(children, node, "left").join(parent, ["depth", "g1", "g2"], "left").na.fill(0, ["n_children"]).drop("g1", "g2"))
    top = full.where("n_convs > 1 OR n_parent > 1 OR depth = 0").select(*node, "n_convs", F.col("conv_id").alias("first"), "size", "n_children")
    near = rows.select("conv_id", *node, "ends").join(top, node)
    mine = F.col("conv_id") == F.col("first")
    worth = F.when(mine, (F.col("n_convs") - 1) * F.col("size")).otherwise(0)
    leaf = F.when(mine & ((F.col("n_children") == 0) | (F.col("n_convs") == 1)), 1).otherwise(0)
    counted = scanned(near.select("conv_id", *node, "ends", "n_convs", worth.cast("long").alias("worth"), leaf.cast("long").alias("leaf")), "conv_id", [F.col("depth").desc()], {"worth": 1, "leaf": 1})
    below = counted.groupBy(*node).agg(F.sum("sum_worth").alias("saved_tokens"), F.sum("sum_leaf").alias("n_leaves"))
    ended = counted.where("ends").select(*node, "conv_id").repartition(*node).sortWithinPartitions(*node, "conv_id").mapInArrow(_ends, "depth long, f1 long, f2 long, ends_sha256 string")
    shared = below.join(ended, node, "left")
    single = F.when((F.col("n_convs") == 1) & (F.col("n_children") == 0), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return full.join(shared, node, "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
                                                  F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", single, nothing).alias("ends_sha256"))
