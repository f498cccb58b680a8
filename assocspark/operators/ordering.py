"""Global ranks, exact medians and genomic order without a window over a large group."""
from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable, small

# Chromosome codes of the exported tables.
CHROMOSOME_CODES = {"X": "23", "Y": "24", "XY": "25", "M": "26", "MT": "26"}


def global_rank(df: DataFrame, order: Sequence[str], *, weight: Column | None = None, rank: str = "rank",
                partitions: int | None = None) -> DataFrame:
    """Add the number of rows (or total ``weight``) before each row in ``order``, which must be a total order.

    Rows are range-partitioned and sorted; each partition's total is shifted by the totals before it. Only
    those totals (one row per partition) meet in one task. The sorted table is checkpointed first: both
    passes must see the same partitions even if an executor is lost between them.
    """
    counting = weight is None
    weight = F.lit(1) if counting else weight
    ranged = (df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order))
    placed = durable(ranged.sortWithinPartitions(*order)
                     .select("*", weight.cast("bigint").alias("_w"), F.spark_partition_id().alias("_part"),
                             F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_within")))
    totals = placed.groupBy("_part").agg(F.sum("_w").alias("_total"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    if not counting:
        # Range partitions of a total order are of even size, so this running sum never meets a large group.
        within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        placed = placed.withColumn("_within", F.coalesce(F.sum("_w").over(within), F.lit(0)))
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # there is one offset for each at most
    return (placed.join(small(offsets, parts), "_part")
            .withColumn(rank, F.col("_offset") + F.col("_within")).drop("_w", "_part", "_within", "_offset"))


def exact_medians(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Exact median per group: equal values are counted first, then ranked in one global sort.

    No group is gathered anywhere, so a group holding most rows is spread over many range partitions.
    """
    groups = list(groups)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("_n"))
    ranked = global_rank(counted, [*groups, value], weight=F.col("_n"), rank="_before")
    totals = ranked.groupBy(*groups).agg(F.sum("_n").alias("_total"), F.min("_before").alias("_start"))
    low, high = F.expr("_start + (_total - 1) div 2"), F.expr("_start + _total div 2")

    def at(position):
        return F.max(F.when((F.col("_before") <= position) & (position < F.col("_before") + F.col("_n")), F.col(value)))

    return (ranked.join(totals, groups).groupBy(*groups)
            .agg(((at(low) + at(high)) / 2).alias("median")))


def chromosome_code(c: Column | str) -> Column:
    """Strip 'chr', upper-case, and recode sex and mitochondrial chromosomes."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.upper(F.regexp_replace(c.cast("string"), "^chr", ""))
    codes = F.create_map(*[F.lit(x) for pair in CHROMOSOME_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, text), text)


def position_key(c: Column | str) -> Column:
    """Positive whole number as DECIMAL(38,0), NULL if it is none; '2.0' and '2e1' are accepted exactly."""
    c = F.col(c) if isinstance(c, str) else c
    text = F.trim(c.cast("string"))
    plain = F.when(text.rlike(r"^[+]?[0-9]+$"), text.try_cast("decimal(38,0)"))
    loose = text.try_cast("double")
    whole = F.when(~F.isnan(loose) & (F.abs(loose) < 1e38) & (loose % 1 == 0), loose.try_cast("decimal(38,0)"))
    key = F.coalesce(plain, whole)
    return F.when(key > 0, key)


def position_keys(df: DataFrame, *, chrom="CHR", pos="BP") -> DataFrame:
    return df.withColumns({"_chr": position_key(chromosome_code(chrom)), "_bp": position_key(pos)})


def invalid_positions(df: DataFrame, *, chrom="CHR", pos="BP") -> DataFrame:
    return position_keys(df, chrom=chrom, pos=pos).filter(F.col("_chr").isNull() | F.col("_bp").isNull()).drop("_chr", "_bp")


def sort_by_position(df: DataFrame, tie: Sequence[str] = (), *, chrom="CHR", pos="BP") -> DataFrame:
    """Genomic order (range-partitioned sort); ``tie`` names the source order among equal positions."""
    return position_keys(df, chrom=chrom, pos=pos).orderBy("_chr", "_bp", *tie).drop("_chr", "_bp")


_EDGES = "part int, order_breaks long, first_chr decimal(38,0), first_bp decimal(38,0), last_chr decimal(38,0), last_bp decimal(38,0)"


def _edges(batches):
    """Breaks inside one range partition, and its first and last position."""
    breaks, first, last = 0, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        chrom, bp = batch.column("_chr"), batch.column("_bp")
        ahead = [c.slice(0, batch.num_rows - 1) for c in (chrom, bp)]
        behind = [c.slice(1) for c in (chrom, bp)]
        falls = pc.or_(pc.greater(ahead[0], behind[0]), pc.and_(pc.equal(ahead[0], behind[0]), pc.greater(ahead[1], behind[1])))
        here = (chrom[0].as_py(), bp[0].as_py())
        breaks += (pc.sum(falls).as_py() or 0) + (last is not None and last > here)
        first, last = first or here, (chrom[-1].as_py(), bp[-1].as_py())
    if first is not None:
        values = zip(_EDGES.replace("decimal(38,0)", "decimal").split(", "), (TaskContext.get().partitionId(), breaks, *first, *last), strict=True)
        types = {"int": pa.int32(), "long": pa.int64(), "decimal": pa.decimal128(38, 0)}
        yield pa.RecordBatch.from_pydict({field.split()[0]: pa.array([value], types[field.split()[1]]) for field, value in values})


def is_position_sorted(df: DataFrame, order: Sequence[str], *, chrom="CHR", pos="BP") -> DataFrame:
    """One row: are rows, read in ``order``, already in genomic order (ties allowed)? Unreadable positions count as the lowest.

    Neighbours are compared inside range partitions; only the partitions' first and last positions meet.
    """
    keys = position_keys(df, chrom=chrom, pos=pos).withColumns({c: F.coalesce(c, F.lit(0).cast("decimal(38,0)")) for c in ("_chr", "_bp")})
    edges = keys.select("_chr", "_bp", *order).repartitionByRange(*order).sortWithinPartitions(*order).select("_chr", "_bp").mapInArrow(_edges, _EDGES)
    before = Window.orderBy("part")
    falls = (F.lag(F.struct("last_chr", "last_bp")).over(before) > F.struct("first_chr", "first_bp")).cast("long")
    total = F.sum(F.col("order_breaks") + F.coalesce("falls", F.lit(0)))
    return edges.withColumn("falls", falls).agg((F.coalesce(total, F.lit(0)) == 0).alias("is_sorted"), F.coalesce(total, F.lit(0)).alias("order_breaks"))
