"""Running products over sorted rows of a key, of which one may have any share of the rows: a monoid scan over range partitions.

The monoid is that of affine maps x -> value + base ** length * x modulo 2 ** 64: two stretches compose to (v + base ** n * w, n + m). With base 1 it is a
running sum. Each range partition scans its own rows; only keys cut by a partition's border, two a partition at most, need what stands before it.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import stage


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo 2 ** 64; negative exponents need an odd base."""
    exponents = np.asarray(exponents, np.int64)
    out = np.ones(len(exponents), np.uint64)
    for sign in (1, -1):
        b, e = base % (1 << 64) if sign > 0 else pow(base, -1, 1 << 64) if base % 2 else 0, np.maximum(exponents * sign, 0)
        while e.any():
            out = np.where(e & 1, out * np.uint64(b), out)
            b, e = b * b % (1 << 64), e >> 1
    return out


def _local(key: str, values: list[str], bases: list[int]):
    """Per row: its place in its partition's stretch of the key, and the products up to and with it."""
    def run(batches):
        part = TaskContext.get().partitionId()
        last, count, carry = None, 0, [np.uint64(0)] * len(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.asarray(batch.column(key))
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            new[0] = k[0] != last
            at = np.arange(len(k))
            begin = np.maximum.accumulate(np.where(new, at, -1))
            place = np.where(begin < 0, at + count, at - begin)
            sums = []
            for name, base, before in zip(values, bases, carry, strict=True):
                term = np.asarray(batch.column(name)).view(np.uint64)
                total = np.cumsum(term * power(base, place) if base != 1 else term)
                sums.append(np.where(begin < 0, total + before, total - np.where(begin > 0, total[np.maximum(begin - 1, 0)], np.uint64(0))))
            last, count, carry = k[-1], int(place[-1]) + 1, [s[-1] for s in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(k), part, np.int32)), pa.array(place), *(pa.array(s.view(np.int64)) for s in sums)],
                                             [*batch.schema.names, "part", "place", *(f"sum_{v}" for v in values)])
    return run


def scanned(rows: DataFrame, key: str, order: list[str | Column], values: dict[str, int]) -> DataFrame:
    """``rows`` (no null ``key``, a long) with ``place`` from 0 in the order of the key's rows and ``sum_x`` for each of the long columns ``values`` (name -> base).

    Written to the shared folder. Columns of ``rows`` keep their names; ``part`` is the range partition.
    """
    names, bases = list(values), list(values.values())
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order)
    more = "part int, place long, " + ", ".join(f"sum_{v} long" for v in names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    local = stage(ranged.mapInArrow(_local(key, names, bases), f"{schema}, {more}"))
    sums = [f"sum_{v}" for v in names]
    ends = local.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    border = [(r["low"], r["high"]) for r in ends.select("low", "high").collect()]  # two ids a partition
    inside = sorted({k for pair in border for k in pair})
    touched = spark.createDataFrame([(k,) for k in inside], f"{key} long")
    last = local.join(F.broadcast(touched), key).groupBy(key, "part").agg(F.max(F.struct("place", *sums)).alias("end")).collect() if inside else []
    shift: dict[tuple[int, int], tuple] = {}
    total: dict[int, tuple] = {}
    for r in sorted(last, key=lambda r: (r[0], r[1])):
        n, before = total.get(r[0], (0, [0] * len(names)))
        if n:
            shift[r[0], r[1]] = (n, before)
        end = [(b + pow(base, n, 1 << 64) * (r["end"][s] % (1 << 64))) % (1 << 64) for b, base, s in zip(before, bases, sums, strict=True)]
        total[r[0]] = (n + r["end"]["place"] + 1, end)
    if not shift:
        return local

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    moved = spark.createDataFrame([(k, p, n, *map(signed, before)) for (k, p), (n, before) in shift.items()], f"{key} long, part int, ahead long, " + ", ".join(f"before_{v} long" for v in names))

    def compose(batches):
        for batch in batches:
            ahead = np.asarray(batch.column("ahead"))
            columns = {c: batch.column(c) for c in batch.schema.names if c != "ahead" and not c.startswith("before_")}
            columns["place"] = pa.array(np.asarray(columns["place"]) + ahead)
            for v, base in zip(names, bases, strict=True):
                before, own = (np.asarray(batch.column(c)).view(np.uint64) for c in (f"before_{v}", f"sum_{v}"))
                columns[f"sum_{v}"] = pa.array((before + power(base, ahead) * own).view(np.int64))
            yield pa.RecordBatch.from_pydict(columns)

    joined = local.join(F.broadcast(moved), [key, "part"], "left").na.fill(0, ["ahead", *(f"before_{v}" for v in names)])  # at most one row a partition
    return stage(joined.mapInArrow(compose, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields if f.name != "ahead" and not f.name.startswith("before_"))))
