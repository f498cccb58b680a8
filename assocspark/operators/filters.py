"""Record filters and per-trait cutoffs: independent narrow passes plus small per-trait aggregates."""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_string, evaluate_once, is_finite, is_missing, list_reasons, quantile_from_parts, quantile_parts, to_double
from ..session import counted
from .ordering import exact_medians

# Spellings of a missing number in munged tables, and of a missing prevalence or N.
MUNGED_MISSING = ("", "NA", "NaN", "nan", ".")
PREVALENCE_MISSING = ("", ".", "na", "nan", "none")
MINIMUM_CHISQ_CUTOFF = 80.0
CHISQ_CUTOFF_PER_N = 0.001


@dataclass(frozen=True)
class VariantFilters:
    """Defaults of the extraction filters; region and palindrome removal are off unless asked for."""

    exclude_mhc: bool = False
    mhc_chr: int = 6
    mhc_start: int = 25_000_000
    mhc_end: int = 35_000_000
    info_min: float = 0.7
    maf_min: float = 0.01
    munge_maf_min: float = 0.005
    max_af_difference: float = 0.2
    remove_palindrome: bool = False
    pal_lower: float = 0.45
    pal_upper: float = 0.55


def exclude_region(df: DataFrame, chrom: int, start: int, end: int, *, chr_col="CHR", pos_col="POS") -> DataFrame:
    inside = (F.col(chr_col) == chrom) & F.col(pos_col).between(start, end)
    return df.filter(~F.coalesce(inside, F.lit(False)))


def vector_missing(value: Column | str) -> Column:
    """An INFO value is missing if absent or if any element of a comma list is '.'."""
    value = F.col(value) if isinstance(value, str) else value
    return value.isNull() | F.exists(F.split(value, ","), lambda x: x.isin(".", ""))


def af_difference_filter(df: DataFrame, max_difference: float, *, af="INFO_AF", eur="INFO_EUR") -> DataFrame:
    """Drop records whose reported and reference frequencies are missing or differ by more than the limit.

    Vectors are compared element by element; one excess difference drops the record. The limit is kept.
    """
    def values(name):
        return F.transform(F.split(name, ","), lambda x: x.try_cast("double"))

    # A one-element vector is compared with every element of the other.
    length = F.greatest(F.size(values(af)), F.size(values(eur)))

    def at(name, i):
        return F.when(F.size(values(name)) == 1, F.get(values(name), F.lit(0))).otherwise(F.get(values(name), i))

    excess = F.exists(F.sequence(F.lit(0), length - 1),
                      lambda i: ~F.coalesce(F.abs(at(af, i) - at(eur, i)) <= max_difference, F.lit(False)))
    return df.filter(~vector_missing(af) & ~vector_missing(eur)).filter(~excess)


def af_audit(df: DataFrame, *, af="INFO_AF", eur="INFO_EUR", group="trait") -> DataFrame:
    """Per trait: records seen, records without either frequency, and records lost to the union of both."""
    no_af, no_eur = vector_missing(af), vector_missing(eur)
    return df.groupBy(group).agg(
        F.count("*").alias("records_after_mhc"), F.count_if(no_af).alias("missing_info_af"),
        F.count_if(no_eur).alias("missing_info_eur"), F.count_if(no_af | no_eur).alias("excluded_missing_either"))


def info_maf_filter(df: DataFrame, info_min: float, maf_min: float, *, info="SI", af="AF") -> DataFrame:
    """Inclusive imputation-quality and allele-frequency bounds; NULL and NaN fail."""
    return df.filter(is_finite(info) & (F.col(info) >= info_min)
                     & is_finite(af) & F.col(af).between(maf_min, 1 - maf_min))


def is_palindromic(a: str = "REF", b: str = "ALT") -> Column:
    return F.concat(F.col(a), F.col(b)).isin("AT", "TA", "CG", "GC") & (F.length(a) == 1)


def palindrome_filter(df: DataFrame, lower: float, upper: float, *, ref="REF", alt="ALT", af="AF") -> DataFrame:
    """Drop strand-ambiguous alleles whose frequency cannot tell the strand."""
    doubtful = is_palindromic(ref, alt) & F.col(af).between(lower, upper)
    return df.filter(~F.coalesce(doubtful, F.lit(False)))


def fold_maf(eaf: Column | str) -> Column:
    eaf = F.col(eaf) if isinstance(eaf, str) else eaf
    return F.least(eaf, 1 - eaf)


def matched_snps(reference: DataFrame, weights: DataFrame) -> DataFrame:
    """SNPs of both LD-score tables; each side is reduced to distinct SNPs before they meet."""
    return reference.select("SNP").intersect(weights.select("SNP"))


def chisq_rows(df: DataFrame, *, keys: Sequence[str] = ("trait",)) -> DataFrame:
    """Add ``_missing_z``, numeric ``Z`` and ``CHISQ`` to a munged table (string or numeric columns)."""
    return df.withColumn("_missing_z", is_missing("Z", MUNGED_MISSING)).withColumn(
        "Z", to_double("Z", MUNGED_MISSING)).withColumn("CHISQ", F.col("Z") * F.col("Z"))


def auto_chisq_cutoff(df: DataFrame, matched: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per trait: ``max(80, 0.001 * largest N)`` over complete rows whose SNP has LD scores.

    A row removed later may still set its trait's cutoff. ``invalid_n`` counts matched rows whose N is not
    a positive number; callers treat any as fatal, and a trait absent from the result has no matched row.
    """
    columns = list(columns or df.columns)
    complete = ~F.coalesce(F.greatest(*[is_missing(c, MUNGED_MISSING).cast("int") for c in columns]), F.lit(0)).cast("boolean")
    n = to_double("N")
    valid = is_finite(n) & (n > 0)
    rows = df.filter(complete).withColumn("SNP", F.trim("SNP")).join(matched.select("SNP"), "SNP", "left_semi")
    return rows.groupBy("trait").agg(
        F.greatest(F.lit(MINIMUM_CHISQ_CUTOFF), CHISQ_CUTOFF_PER_N * F.max(F.when(valid, n))).alias("chisq_max"),
        F.max(F.when(valid, n)).alias("maximum_matched_n"),
        F.count("*").alias("complete_ld_matched_rows"), F.count_if(~valid).alias("invalid_n"))


def with_cutoff(df: DataFrame, cutoff: float | DataFrame) -> DataFrame:
    """Attach ``chisq_max``: a constant, or one row per trait joined back."""
    if isinstance(cutoff, DataFrame):
        return df.join(counted(cutoff.select("trait", "chisq_max")), "trait", "left")
    if isinstance(cutoff, bool) or not math.isfinite(cutoff) or cutoff <= 0:
        raise ValueError("chisq_max must be a positive finite number or a table of per-trait cutoffs")
    return df.withColumn("chisq_max", F.lit(float(cutoff)))


def chisq_filter(df: DataFrame, cutoff: float | DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``Z**2 <= cutoff`` keeps a row; rows without Z pass through. Returns (kept, excluded, summary).

    The summary's ``fatal_rows`` counts non-numeric or non-finite Z and overflowing squares; they are in
    neither output, and :func:`check_chisq_summary` turns them (or an empty result) into an error.
    """
    rows = evaluate_once(with_cutoff(chisq_rows(df), cutoff))
    usable = ~F.col("_missing_z") & is_finite("CHISQ")
    keep = usable & (F.col("CHISQ") <= F.col("chisq_max"))
    drop = usable & (F.col("CHISQ") > F.col("chisq_max"))
    kept = rows.filter(F.col("_missing_z") | keep).drop("_missing_z", "CHISQ", "chisq_max")
    excluded = rows.filter(drop).select("trait", "SNP", "Z", "CHISQ")
    summary = rows.groupBy("trait").agg(
        F.max("chisq_max").alias("chisq_max"),
        F.count("*").alias("variants_before"), F.count_if(drop).alias("variants_removed"),
        F.count_if(F.col("_missing_z") | keep).alias("variants_after"),
        F.count_if("_missing_z").alias("variants_missing_z"),
        F.max(F.when(usable, F.col("CHISQ"))).alias("maximum_chisq"),
        F.count_if(~F.col("_missing_z") & ~usable).alias("fatal_rows"))
    return kept, excluded, summary


def check_chisq_summary(summary: DataFrame) -> None:
    """Raise for unusable Z values or a trait left without a finite Z. Runs one job over a per-trait table."""
    finite_left = F.col("variants_after") - F.col("variants_missing_z")
    bad = summary.filter((F.col("fatal_rows") > 0) | (finite_left == 0)).take(1)
    if bad:
        raise ValueError(f"{bad[0]['trait']}: non-finite Z, Z^2 overflow, or no finite Z left: {bad[0].asDict()}")


def hm3_select(df: DataFrame, reference: DataFrame, *, snp: str = "SNP", keys: Sequence[str] = ("_row",)) -> tuple[DataFrame, DataFrame]:
    """Rows whose SNP is in the reference list, and audit rows for the others."""
    wanted = reference.select(F.col("SNP").alias(snp)).filter(F.col(snp).isNotNull()).distinct()
    kept = df.join(wanted, snp, "left_semi")
    removed = df.join(wanted, snp, "left_anti").select(
        "trait", *keys, F.lit("removed").alias("QC_action"), F.lit("SNP not in HapMap reference").alias("QC_reason"))
    return kept, removed


def override_n(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest N replaces the record's N where given; ``N_source`` says which one was used."""
    per_trait = counted(manifest.select("trait", F.col("N").alias("_n_override")))
    return (df.join(per_trait, "trait", "left")
            .withColumn("N_source", F.when(F.col("_n_override").isNotNull(), "manifest_N").otherwise("FORMAT/NEF"))
            .withColumn("N", F.coalesce("_n_override", "N")).drop("_n_override"))


def resolve_sample_metadata(manifest: DataFrame) -> DataFrame:
    """Numeric N and prevalences per trait, with every broken rule named in ``reason``."""
    def number(name):
        text = F.lower(F.trim(F.col(name).cast("string")))
        return clean_string(text, PREVALENCE_MISSING)

    def outside(name):
        value = number(name).try_cast("double")
        return number(name).isNotNull() & ~F.coalesce(is_finite(value) & (value > 0) & (value < 1), F.lit(False))

    n = number("N").try_cast("double")
    sample, population = number("sample_prevalence"), number("population_prevalence")
    marks = [
        (outside("sample_prevalence"), "sample_prevalence must be finite and strictly between 0 and 1"),
        (outside("population_prevalence"), "population_prevalence must be finite and strictly between 0 and 1"),
        (sample.isNull() != population.isNull(), "supply both prevalences or neither"),
        (number("N").isNotNull() & ~F.coalesce(is_finite(n) & (n > 0), F.lit(False)), "manifest N must be finite and positive"),
        (population.isNotNull() & number("N").isNull(), "binary trait requires explicit total N")]
    return manifest.select(
        "trait", "trait_order", n.alias("N"), sample.try_cast("double").alias("sample_prevalence"),
        population.try_cast("double").alias("population_prevalence"), list_reasons(marks).alias("reason"))


def infer_prevalence(df: DataFrame, *, cases="NC", controls="NCO") -> DataFrame:
    """Median cases, controls and case fraction per trait; ``invalid_counts`` must be zero to use them."""
    nc, nco = F.col(cases), F.col(controls)

    def positive(c):
        return F.coalesce(is_finite(c) & (c > 0), F.lit(False))

    bad = ~(positive(nc) & positive(nco) & positive(nc + nco))
    counts = df.groupBy("trait").agg(F.count("*").alias("variants"), F.count_if(bad).alias("invalid_counts"))
    medians = exact_medians(df.select("trait", F.inline(F.array(
        *[F.struct(F.lit(name).alias("name"), value.cast("double").alias("value"))
          for name, value in (("median_cases", nc), ("median_controls", nco),
                              ("case_fraction", F.try_divide(nc, nc + nco)))]))),
        ["trait", "name"], "value")
    wide = medians.groupBy("trait").agg(*[
        F.max(F.when(F.col("name") == name, F.col("median"))).alias(name)
        for name in ("median_cases", "median_controls", "case_fraction")])
    return counts.join(wide, "trait", "left")


def munge(df: DataFrame, alleles: DataFrame, *, info_min: float | None = 0.9, maf_min: float = 0.01,
          maf_inclusive: bool = False, effect: str = "BETA", order: Sequence[str] = ()) -> DataFrame:
    """Regression-ready ``(trait, SNP, A1, A2, N, Z)`` from a raw table.

    Keeps complete rows with ``INFO >= info_min``, MAF above the limit, ``0 < P <= 1`` and unambiguous single-base alleles
    that match the reference on either strand, the first record of each SNP, and sets
    ``Z = sign(effect) * |quantile(P / 2)|``, a zero effect counting as positive.
    """
    p = F.col("P")
    maf = fold_maf("EAF")
    keep = is_finite("P") & (p > 0) & (p <= 1) & is_finite("N") & is_finite(effect) & is_finite("EAF") & F.col("EAF").between(0, 1)
    keep = keep & ((maf >= maf_min) if maf_inclusive else (maf > maf_min))
    if info_min is not None:
        keep = keep & is_finite("INFO") & (F.col("INFO") >= info_min)
    rows = df.withColumns({"A1": F.upper("A1"), "A2": F.upper("A2")}).filter(
        keep & F.col("A1").rlike("^[ACGT]$") & F.col("A2").rlike("^[ACGT]$")
        & (F.col("A1") != F.col("A2")) & ~is_palindromic("A1", "A2"))
    # The first record of a SNP stays; a partial aggregate, so a repeated SNP is small before the shuffle. Keys in the order of
    # ``dedup_best``, whose sorted rows need no other sort.
    first = F.min_by(F.struct("A1", "A2", "N", p.alias("P"), F.col(effect).alias("effect")),
                     F.struct(*(order or ["A1", "A2", "N", "P"])))
    unique = rows.groupBy("SNP", "trait").agg(first.alias("r")).select("trait", "SNP", "r.*")
    reference = alleles.select("SNP", F.col("A1").alias("_r1"), F.col("A2").alias("_r2"))
    same = allele_match(F.col("A1"), F.col("A2"), F.col("_r1"), F.col("_r2"))
    q, r = quantile_parts(F.col("P") / 2)
    matched = evaluate_once(unique.join(reference, "SNP").filter(same).select(
        "trait", "SNP", "A1", "A2", F.col("N").cast("double").alias("N"), q.alias("q"), r.alias("r"), "effect"))
    z = F.when(F.col("effect") < 0, -1.0).otherwise(1.0) * F.abs(quantile_from_parts(F.col("q"), F.col("r")))
    return evaluate_once(matched.select("trait", "SNP", "A1", "A2", "N", z.alias("Z")))


def allele_match(a1: Column, a2: Column, r1: Column, r2: Column) -> Column:
    """Same pair of alleles, in either order and on either strand."""
    def flip(c):
        return F.translate(c, "ACGT", "TGCA")
    return (((a1 == r1) & (a2 == r2)) | ((a1 == r2) & (a2 == r1))
            | ((flip(a1) == r1) & (flip(a2) == r2)) | ((flip(a1) == r2) & (flip(a2) == r1)))
