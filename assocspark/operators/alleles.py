"""Allele compatibility within a trait and alignment across traits."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, to_double


def complement(c: Column | str) -> Column:
    return F.translate(F.col(c) if isinstance(c, str) else c, "ACGT", "TGCA")


def allele_reference_failures(reference: DataFrame) -> DataFrame:
    """Rows that make an allele reference unusable: bad SNP text, repeated SNPs, or not two distinct bases."""
    snp = F.col("SNP")
    base = F.col("A1").rlike("^[ACGT]$") & F.col("A2").rlike("^[ACGT]$") & (F.col("A1") != F.col("A2"))
    bad_row = reference.filter(~F.coalesce((snp != "") & (snp == F.trim(snp)) & base, F.lit(False))).select(
        "SNP", F.lit("empty or padded SNP, or invalid allele pair").alias("reason"))
    repeated = reference.groupBy("SNP").count().filter("count > 1").select(
        "SNP", F.lit("duplicate reference SNP").alias("reason"))
    return bad_row.unionByName(repeated)


def classify_alleles(df: DataFrame, reference: DataFrame, order: Sequence[str], *, n_override: str | None = None) -> DataFrame:
    """Add ``reference_A1/A2`` and ``reason`` (NULL = accepted), the first that applies per row.

    Alleles must equal the reference in content and order. ``order`` names the record order within a trait:
    later records of a SNP are duplicates of its first. ``n_override`` names a column of expected N.
    """
    order = list(order)
    first = df.groupBy("trait", "SNP").agg(F.min(F.struct(*order)).alias("_first"))
    ref = reference.select("SNP", F.col("A1").alias("reference_A1"), F.col("A2").alias("reference_A2"))
    pair, swapped = F.struct("A1", "A2"), F.struct(F.col("A2").alias("A1"), F.col("A1").alias("A2"))
    expected = F.struct(F.col("reference_A1").alias("A1"), F.col("reference_A2").alias("A2"))

    def flipped(a, b):
        return F.struct(complement(a).alias("A1"), complement(b).alias("A2"))

    n, z = to_double("N"), to_double("Z")
    reason = (F.when(F.struct(*order) != F.col("_first"), "duplicate SNP ID")
              .when(F.col("reference_A1").isNull(), "SNP absent from allele reference")
              .when((pair != expected) & (swapped == expected), "swapped allele order")
              .when((pair != expected) & (flipped("A1", "A2") == expected), "strand-complemented allele pair")
              .when((pair != expected) & (flipped("A2", "A1") == expected), "swapped strand-complemented allele pair")
              .when(pair != expected, "incompatible allele pair")
              .when(n.isNull() | z.isNull(), "nonnumeric N/Z")
              .when(~(is_finite(n) & (n > 0) & is_finite(z)), "invalid N/Z"))
    if n_override:
        limit = 1e-12 * F.greatest(F.abs(n), F.abs(F.col(n_override)))
        reason = reason.when(F.col(n_override).isNotNull() & (F.abs(n - F.col(n_override)) > limit),
                             "N differs from preparation override")
    return (df.join(first, ["trait", "SNP"]).join(ref, "SNP", "left")
            .withColumn("reason", reason).drop("_first"))


def allele_audit(classified: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per trait: accepted with its SNP count, or the first unusable record and why."""
    bad = F.when(F.col("reason").isNotNull(), F.struct(*order))
    first = F.min_by(F.struct("reason", "SNP", "A1", "A2", "reference_A1", "reference_A2"), bad)
    return classified.groupBy("trait").agg(
        F.count("*").alias("rows"), F.count_if(F.col("reason").isNull()).alias("n_snps"),
        first.alias("f")).select(
        "trait", F.when(F.col("rows") == F.col("n_snps"), "accepted").otherwise("error").alias("status"),
        F.coalesce(F.col("f.reason"), F.lit("exact reference allele order; no edits")).alias("reason"),
        F.col("f.SNP").alias("SNP"), F.col("f.A1").alias("A1"), F.col("f.A2").alias("A2"),
        F.col("f.reference_A1").alias("reference_A1"), F.col("f.reference_A2").alias("reference_A2"), "n_snps")


def orientation(ea: Column, oa: Column, anchor_ea: Column, anchor_oa: Column) -> Column:
    """1 if alleles equal the anchor's, -1 if swapped, NULL if they do not match (no strand flips)."""
    return (F.when((ea == anchor_ea) & (oa == anchor_oa), F.lit(1))
            .when((ea == anchor_oa) & (oa == anchor_ea), F.lit(-1)))


def align_traits(assoc: DataFrame) -> DataFrame:
    """Orient every trait's record to the SNP's anchor: the alleles of its first trait in manifest order.

    ``assoc`` is long: ``trait, trait_order, SNPID, EA, OA, EAF, N, Z``. Adds ``anchor_EA/OA`` and
    ``orientation``; swapped records get ``-Z`` and ``1 - EAF``; unmatched ones have NULL orientation and
    are removed by the caller for that trait only.
    """
    anchors = assoc.groupBy("SNPID").agg(F.min_by(F.struct("EA", "OA"), "trait_order").alias("_a")).select(
        "SNPID", F.col("_a.EA").alias("anchor_EA"), F.col("_a.OA").alias("anchor_OA"))
    sign = F.col("orientation")
    return (assoc.join(anchors, "SNPID")
            .withColumn("orientation", orientation(F.col("EA"), F.col("OA"), F.col("anchor_EA"), F.col("anchor_OA")))
            .withColumns({"Z": F.when(sign == -1, -F.col("Z")).otherwise(F.col("Z")),
                          "EAF": F.when(sign == -1, 1 - F.col("EAF")).otherwise(F.col("EAF"))}))
