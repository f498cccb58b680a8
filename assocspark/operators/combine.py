"""N-weighted combination of all traits per SNP, and QC of the combined associations."""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, two_sided_p
from ..session import durable
from .alleles import orientation

PATTERN_BYTES = 64 << 20  # factors of all availability patterns up to which every task gets them; beyond it they meet their rows by pattern
PATTERN_ROWS = 50_000  # rows of a pattern that one task combines in the other case
COMBINED_SCHEMA = ("SNPID string, CHR bigint, BP bigint, EA string, OA string, EAF double, N_eff double, "
                   "N_obs double, BETA double, SE double, Z double, Direction string")
# Combined columns that must be numbers, and those that must also be positive.
POSITIVE_COLUMNS = ("SE", "N_eff", "N_obs")
ASSOCIATION_COLUMNS = ("BETA", "SE", "Z", "PVAL", "N_eff", "N_obs")


def snp_contributions(assoc: DataFrame) -> DataFrame:
    """One row per SNP with the aligned contributions of its traits, as arrays in manifest order.

    One shuffle on SNPID. (trait, SNPID) must be unique, which bounds each group by the number of traits.
    """
    record = F.struct("trait_order", "EA", "OA", "CHR", "BP", F.col("EAF").cast("double").alias("EAF"),
                      F.col("N").cast("double").alias("N"), F.col("Z").cast("double").alias("Z"))
    rows = assoc.groupBy("SNPID").agg(F.array_sort(F.collect_list(record)).alias("r"))
    first = F.get("r", F.lit(0))
    rows = rows.select("SNPID", first.CHR.alias("CHR"), first.BP.alias("BP"), first.EA.alias("EA"), first.OA.alias("OA"), "r")
    matched = F.filter("r", lambda x: orientation(x.EA, x.OA, F.col("EA"), F.col("OA")).isNotNull())
    swapped = lambda x: x.EA != F.col("EA")  # noqa: E731 - alleles match, so this means swapped
    return rows.withColumn("r", matched).select(
        "SNPID", "CHR", "BP", "EA", "OA",
        F.transform("r", lambda x: x.trait_order).alias("traits"),
        F.transform("r", lambda x: x.N).alias("n"),
        F.transform("r", lambda x: F.when(swapped(x), -x.Z).otherwise(x.Z)).alias("z"),
        F.transform("r", lambda x: F.when(swapped(x), 1 - x.EAF).otherwise(x.EAF)).alias("eaf"))


def availability_patterns(contributions: DataFrame, cti: np.ndarray) -> DataFrame:
    """The distinct sets of available traits, each with its rows and its part of the CTI factored once.

    ``traits`` is the set in manifest order, ``rows`` how many SNPs have it, ``factor`` the Cholesky factor of the CTI among them (row by row), or, where
    that is not positive definite (``definite`` false), the matrix itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            factors, definite = [], []
            for traits in batch.column("traits").to_pylist():
                part = cti[np.ix_(traits, traits)]
                try:
                    part, ok = np.linalg.cholesky(part), True
                except np.linalg.LinAlgError:
                    ok = False
                factors.append(np.ascontiguousarray(part).tobytes())
                definite.append(ok)
            yield pa.RecordBatch.from_arrays([batch.column("traits"), batch.column("rows"), pa.array(factors, pa.binary()), pa.array(definite, pa.bool_())], ["traits", "rows", "factor", "definite"])
    return contributions.groupBy("traits").agg(F.count("*").alias("rows")).mapInArrow(run, "traits array<int>, rows long, factor binary, definite boolean")


def _combine(rows: pa.Table | pa.RecordBatch, factor_of: Callable[[tuple], tuple[np.ndarray, bool]], loadings: np.ndarray) -> pa.RecordBatch:
    """Combined associations of a batch, pattern by pattern."""
    traits = len(loadings)
    lists = rows.column("traits")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.asarray(lists.value_lengths())
    row, trait = np.repeat(np.arange(len(size)), size), np.asarray(lists.flatten())

    def flat(name):
        column = rows.column(name)
        return np.asarray((column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten())
    n, z, eaf = flat("n"), flat("z"), flat("eaf")
    count = rows.num_rows
    present = np.zeros((count, traits), bool)
    present[row, trait] = True
    root_n = np.zeros((count, traits))
    root_n[row, trait] = np.sqrt(n)
    weight = root_n * loadings
    quadratic, effective = np.zeros(count), np.full(count, np.nan)
    patterns, member = np.unique(present, axis=0, return_inverse=True)
    for k, mask in enumerate(patterns):
        index = np.flatnonzero(mask)
        if not len(index):
            continue
        chosen = np.flatnonzero(member.ravel() == k)
        factor, definite = factor_of(tuple(index.tolist()))
        w, s = weight[np.ix_(chosen, index)], root_n[np.ix_(chosen, index)]
        if definite:
            quadratic[chosen] = ((w @ factor) ** 2).sum(1)
            effective[chosen] = (np.linalg.solve(factor, s.T) ** 2).sum(0)
        else:
            quadratic[chosen] = ((w @ factor) * w).sum(1)
            try:
                effective[chosen] = (s.T * np.linalg.solve(factor, s.T)).sum(0)
            except np.linalg.LinAlgError:
                pass
    numerator = np.bincount(row, weight[row, trait] * z, count)
    total_n = np.bincount(row, n, count)
    with np.errstate(divide="ignore", invalid="ignore"):
        mean_eaf = np.bincount(row, n * eaf, count) / total_n
        combined = np.where(quadratic > 0, numerator / np.sqrt(quadratic), np.nan)
        se = 1 / np.sqrt(total_n * 2 * mean_eaf * (1 - mean_eaf))
    signs = np.full((count, traits), "?", "U1")
    signs[row, trait] = np.where(z < 0, "-", "+")
    direction = np.ascontiguousarray(signs).view(f"U{traits}").ravel()
    numbers = dict(EAF=mean_eaf, N_eff=effective, N_obs=total_n, BETA=combined * se, SE=se, Z=combined)
    fixed = [c.combine_chunks() if isinstance(c := rows.column(name), pa.ChunkedArray) else c for name in ("SNPID", "CHR", "BP", "EA", "OA")]
    return pa.RecordBatch.from_arrays(fixed + [pa.array(v, mask=~np.isfinite(v)) for v in numbers.values()] + [pa.array(direction)],
                                      names=["SNPID", "CHR", "BP", "EA", "OA", *numbers, "Direction"])


def _unpack(traits: Sequence[int], factor: bytes, definite: bool) -> tuple[np.ndarray, bool]:
    return np.frombuffer(factor).reshape(len(traits), -1), definite


def _combined(contributions: DataFrame, cti: np.ndarray, loadings: np.ndarray) -> DataFrame:
    contributions = durable(contributions)
    patterns = durable(availability_patterns(contributions, cti))
    size = patterns.agg(F.coalesce(F.sum(F.length("factor")), F.lit(0))).first()[0]
    if size <= PATTERN_BYTES:
        known = {tuple(r["traits"]): (r["factor"], r["definite"]) for r in patterns.select("traits", "factor", "definite").collect()}  # at most PATTERN_BYTES
        shared = contributions.sparkSession.sparkContext.broadcast(known)

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    yield _combine(batch, lambda t: _unpack(t, *shared.value[t]), loadings)
        return contributions.mapInArrow(run, COMBINED_SCHEMA)
    numbered = durable(patterns.select("traits", F.monotonically_increasing_id().alias("pattern"), F.ceil(F.col("rows") / PATTERN_ROWS).alias("parts"), "factor", "definite"))
    rows = contributions.join(numbered.select("traits", "pattern", "parts"), "traits").withColumn("part", F.pmod(F.xxhash64("SNPID"), F.col("parts"))).drop("parts")
    copies = numbered.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    copies = copies.select(F.col("pattern").alias("of_pattern"), F.col("part").alias("of_part"), "factor", "definite")

    def meet(key, some, factors):
        if not some.num_rows:
            return pa.Table.from_batches([], pa.schema(_ARROW))
        known = factors.slice(0, 1).to_pylist()[0]
        return pa.Table.from_batches([_combine(some, lambda t: _unpack(t, known["factor"], known["definite"]), loadings)])
    return rows.groupBy("pattern", "part").cogroup(copies.groupBy("of_pattern", "of_part")).applyInArrow(meet, COMBINED_SCHEMA)


_ARROW = [(name, {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}[kind]) for name, kind in (c.split() for c in COMBINED_SCHEMA.split(", "))]


def combine_traits(assoc: DataFrame, cti: np.ndarray, loadings: Sequence[float], *,
                   combine: Callable[[pd.DataFrame, np.ndarray, np.ndarray], pd.DataFrame] | None = None) -> DataFrame:
    """Combined association per SNP over its available traits, weights ``sqrt(N) * loading``.

    ``Z = sum(w z) / sqrt(w' C w)``, ``N_eff = sqrt(N)' C^-1 sqrt(N)`` over the available traits,
    ``SE = 1 / sqrt(sum(N) 2 EAF (1 - EAF))``, ``BETA = Z SE``; EAF is the N-weighted mean and ``N_obs`` the
    sum of N. With all available weights zero Z is NULL, and :func:`combined_qc` reports it. The CTI is factored once for each set of available traits.

    ``combine`` replaces the kernel: a pandas function of a batch of :func:`snp_contributions` rows, the
    CTI and the loadings, returning the columns of ``COMBINED_SCHEMA``. PVAL is always derived from Z here.
    """
    cti, loadings = np.asarray(cti, float), np.asarray(loadings, float)
    if loadings.ndim != 1 or not len(loadings) or cti.shape != (len(loadings), len(loadings)):
        raise ValueError("need one loading per trait and a square CTI")
    rows = snp_contributions(assoc)
    if combine is None:
        combined = _combined(rows, cti, loadings)
    else:
        def run(batches):
            for batch in batches:
                yield combine(batch, cti, loadings)
        combined = rows.mapInPandas(run, COMBINED_SCHEMA)
    return combined.withColumn("PVAL", two_sided_p("Z"))


def direction_counts(df: DataFrame) -> DataFrame:
    """Number of absent, positive and negative traits per SNP."""
    return df.withColumns({f"count_{name}": F.regexp_count("Direction", F.lit(f"[{sign}]")).cast("bigint")
                           for name, sign in (("question", "?"), ("plus", "+"), ("minus", "-"))})


def invalid_directions(df: DataFrame) -> DataFrame:
    return df.filter(~F.coalesce(F.col("Direction").rlike(r"\A[+?\-]+\z"), F.lit(False)))


def _association_checks(columns: Sequence[str]) -> list[tuple[Column, str]]:
    checks = []
    for name in columns:
        value = F.col(name).try_cast("double") if name != "Direction" else F.col(name)
        if name in POSITIVE_COLUMNS:
            checks.append((is_finite(value) & (value > 0), f"{name}_not_finite_positive"))
        elif name == "PVAL":
            checks.append((is_finite(value) & value.between(0, 1), "PVAL_not_finite_or_outside_0_1"))
        else:
            checks.append((is_finite(value), f"{name}_not_finite"))
    return checks


def combined_qc(result: DataFrame, loadings: Sequence[float], *, assoc: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(issues, summary) of a combined table: one issue row per SNP and failed check.

    A SNP needs one available trait with a nonzero loading and positive N, tested per trait: signed weights
    that cancel are still valid. Pass ``assoc`` to check the inputs' N; without it every ``+``/``-`` counts.
    """
    names = [c for c in ASSOCIATION_COLUMNS if c in result.columns]
    repeated = result.groupBy("SNPID").count().filter("count > 1").select("SNPID", F.lit(True).alias("_repeated"))
    rows = result.join(repeated, "SNPID", "left")
    usable = F.array(*[F.lit(float(x) != 0.0) for x in loadings])
    rows = rows.withColumn("_available", F.transform(F.split("Direction", ""), lambda d: d.isin("+", "-")))
    if assoc is not None:
        with_n = assoc.filter(is_finite(F.col("N").cast("double")) & (F.col("N") > 0)).groupBy("SNPID").agg(
            F.collect_set("trait_order").alias("_with_n"))
        rows = rows.join(with_n, "SNPID", "left")
        has_n = lambda i: F.coalesce(F.array_contains("_with_n", i), F.lit(False))
    else:
        has_n = lambda i: F.lit(True)
    positions = F.sequence(F.lit(0), F.lit(len(loadings) - 1))
    weight = F.exists(positions, lambda i: F.get("_available", i) & F.get(usable, i) & has_n(i.cast("int")))
    direction_ok = F.coalesce(F.col("Direction").rlike("^[+?-]+$") & (F.length("Direction") == len(loadings)), F.lit(False))
    checks = [(F.col("SNPID").isNotNull() & (F.trim("SNPID") != "") & F.col("_repeated").isNull(), "missing_or_duplicate_SNPID")]
    checks += _association_checks(names)
    checks += [(direction_ok, "invalid_Direction_or_trait_count"),
               (~direction_ok | F.coalesce(weight, F.lit(False)), "zero_available_weight")]
    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for ok, text in checks]))
    failing = rows.select("SNPID", reasons.alias("_reasons"))
    issues = failing.filter(F.size("_reasons") > 0).select("SNPID", F.explode("_reasons").alias("Reason"))
    summary = failing.agg(
        F.count("*").alias("Total_Rows"), F.count_if(F.size("_reasons") > 0).alias("Invalid_Rows"),
        F.coalesce(F.sum(F.size("_reasons").cast("bigint")), F.lit(0)).alias("Issue_Count")).select(
        F.when((F.col("Issue_Count") == 0) & (F.col("Total_Rows") > 0), "passed").otherwise("failed").alias("Status"),
        "Total_Rows", "Invalid_Rows", "Issue_Count")
    return issues, summary


def export_qc(result: DataFrame, source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Per-source QC of stored results: (rows with joined reasons, pass/fail summary)."""
    from ..functions import failed_reasons
    names = [c for c in ASSOCIATION_COLUMNS if c in result.columns]
    checked = result.withColumn("Reason", failed_reasons(_association_checks(names)))
    issues = checked.filter(F.col("Reason") != "").select(source, "SNPID", "Reason")
    summary = checked.groupBy(source).agg(
        F.count("*").alias("Total_Rows"), F.count_if(F.col("Reason") != "").alias("Invalid_Rows")).withColumn(
        "Status", F.when(F.col("Invalid_Rows") > 0, "failed").otherwise("passed"))
    return issues, summary
