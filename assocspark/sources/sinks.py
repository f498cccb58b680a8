"""Writers. Parquet is the working format; delimited text is for exchange."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.variant_qc import variant_id
from ..session import durable, small
from ..operators.filters import fold_maf

CHROMOSOMES = 22
LAYOUTS = ("shared", "legacy", "folded_maf")


def assoc_table(good: DataFrame, id_source: str = "chr_pos_ref_alt") -> DataFrame:
    """The nine association columns per trait from validated variants."""
    kept = [c for c in ("trait", "trait_order") if c in good.columns]
    return good.select(*kept, variant_id(id_source).alias("SNPID"), "CHR", F.col("POS").alias("BP"), F.col("A1").alias("EA"),
                       F.col("A2").alias("OA"), F.col("eaf_A1").alias("EAF"), "N", "Z", F.col("p").alias("P"))


def missing_chromosomes(assoc: DataFrame) -> DataFrame:
    """Traits without records on all 22 chromosomes, and which ones they lack."""
    per_trait = assoc.groupBy("trait").agg(F.collect_set(F.col("CHR").cast("int")).alias("_c"))
    every = F.sequence(F.lit(1), F.lit(CHROMOSOMES))
    return per_trait.select("trait", F.array_except(every, "_c").alias("missing")).filter(F.size("missing") > 0)


def writer_counts(assoc: DataFrame, keys: list[str], rows_per_file: int) -> DataFrame:
    """Per value of ``keys``: its rows and the number of writers they call for."""
    return assoc.groupBy(*keys).agg(F.count("*").alias("rows")).withColumn("writers", F.ceil(F.col("rows") / rows_per_file).cast("int"))


def write_assoc(assoc: DataFrame, path: str, *, split: bool = True, rows_per_file: int = 1_000_000) -> None:
    """Association table partitioned by trait, and by chromosome if ``split`` (which needs all 22 per trait), in one commit.

    Each part of the table gets writers in proportion to its rows: they are counted first, and rows are dealt by a hash of the SNP among as
    many files of about ``rows_per_file`` rows. One part is as many rows as all others together, or a few: files come out alike.
    """
    keys = ["trait", "CHR"] if split else ["trait"]
    counts = durable(writer_counts(assoc, keys, rows_per_file))
    if split:
        bad = missing_chromosomes(counts).take(1)
        if bad:
            raise ValueError(f"{bad[0]['trait']}: split output needs chromosomes 1-22; missing {bad[0]['missing']}")
    parts, files = counts.agg(F.count("*"), F.sum("writers")).first()
    dealt = assoc.join(small(counts.select(*keys, "writers"), parts), keys).withColumn("_writer", F.pmod(F.xxhash64("SNPID"), F.col("writers")))
    spread = dealt.repartition(max(1, int(files or 1)), *keys, "_writer").drop("writers", "_writer")
    spread.write.mode("errorifexists").partitionBy(*keys).parquet(path)


def munge_input(good: DataFrame, layout: str = "shared", id_source: str = "vcf_id") -> DataFrame:
    """Regression-side table in one of three column layouts."""
    snp = variant_id(id_source).alias("SNP")
    c = F.col
    if layout == "shared":
        return good.select("trait", snp, "CHR", c("POS").alias("BP"), "A1", "A2", c("eaf_A1").alias("EAF"), c("beta").alias("BETA"),
                           c("se").alias("SE"), c("p").alias("P"), "N", "INFO")
    if layout == "legacy":
        return good.select("trait", snp, "CHR", "POS", "A1", "A2", "eaf_A1", "beta", "se", "N", "p")
    if layout == "folded_maf":
        return good.select("trait", snp, "CHR", "POS", "A1", "A2", fold_maf("eaf_A1").alias("MAF"), "beta", "se", "N", "p", "INFO")
    raise ValueError(f"layout must be one of {LAYOUTS}")


def write_table(df: DataFrame, path: str, *, separator: str = ",", compression: str = "gzip") -> None:
    """Delimited text: doubles in their shortest exact form, NULL and '' as empty cells, quotes doubled within quoted cells."""
    df.write.mode("errorifexists").csv(path, sep=separator, header=True, nullValue="", emptyValue="", escape='"', compression=compression)
