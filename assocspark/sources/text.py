"""Text sources: variant files, manifests, summary statistics and LD scores.

Identifiers are never inferred or treated as missing: ``NA`` and ``001`` are legal names. Each reader
keeps the columns that say where a record came from, so later steps can break ties by source order.
"""
from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import evaluate_once
from ..session import small

# FORMAT keys of the preparation and extraction scans, and the SNP spellings treated as missing.
PREPARE_FIELDS = {"AF": "eaf_A1", "ES": "beta", "SE": "se", "LP": "LP", "NEF": "N"}
EXTRACT_FIELDS = {"EZ": "EZ", "LP": "LP", "AF": "AF", "NEF": "NEF", "SI": "SI", "NC": "NC", "NCO": "NCO"}
LD_SNP_MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                  "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
VCF_FIXED = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
ROW_ORDER = ("file_block", "file_row")


def format_field(key: str, keys: str = "_keys", values: str = "_values") -> Column:
    """Value of a FORMAT key from the split columns; NULL if absent, dropped at the end of the list, or '.'."""
    place = F.array_position(keys, key).cast("int") - 1
    value = F.get(values, F.when(place >= 0, place))
    return F.when(value != ".", value)


def info_field(key: str, info: str = "INFO") -> Column:
    """Text of an INFO key as written (vectors stay comma lists); NULL if absent or empty."""
    value = F.regexp_extract(info, f"(?:^|;){key}=([^;]*)", 1)
    return F.when(value != "", value)


def parse_vcf_lines(lines: DataFrame, fields: dict[str, str], *, info: Sequence[str] = ()) -> DataFrame:
    """Records of ``value`` lines: ``SNP, CHR, POS, A1 (= ALT), A2 (= REF)``, the wanted FORMAT and INFO keys as text.

    Other columns of ``lines`` are kept; header lines are dropped. A '.' becomes NULL. Lines, keys and values
    are each split once, whatever the number of fields read.
    """
    return _parsed(lines.filter(~F.col("value").startswith("#") & (F.col("value") != "")), fields, info)


def _parsed(body: DataFrame, fields: dict[str, str], info: Sequence[str]) -> DataFrame:
    kept = [c for c in body.columns if c != "value"]
    parts = evaluate_once(body.select(*kept, F.split(F.rtrim("value", F.lit("\r")), "\t").alias("_p")))

    def at(i):
        return F.get("_p", F.lit(i))

    def dot(i):
        return F.when(at(i) != ".", at(i))
    named = evaluate_once(parts.select(
        *kept, dot(2).alias("SNP"), dot(0).alias("CHR"), dot(1).alias("POS"), dot(4).alias("A1"), dot(3).alias("A2"),
        at(7).alias("_info"), F.split(at(8), ":").alias("_keys"), F.split(at(9), ":").alias("_values")))
    return named.select(*kept, "SNP", "CHR", "POS", "A1", "A2", *[format_field(key).alias(name) for key, name in fields.items()],
                        *[info_field(key, "_info").alias(f"INFO_{key}") for key in info])


def checked_vcf_lines(lines: DataFrame, group: str = "trait") -> DataFrame:
    """The record lines of single-sample files. A header or record with another number of sample columns stops the job that reads them.

    The check stands in the scan itself: files are read once, and nothing has to be counted beforehand. No other filter may stand on ``value``
    above it: the optimizer would put it first, and headers would go unseen.
    """
    width = F.size(F.split(F.rtrim("value", F.lit("\r")), "\t")) - len(VCF_FIXED)
    tested = F.col("value").startswith("#CHROM") | (~F.col("value").startswith("#") & (F.col("value") != ""))
    wrong = F.raise_error(F.concat(F.lit("expected exactly one sample per file; found "), F.greatest(width, F.lit(0)).cast("string"), F.lit(" in "), F.coalesce(F.col(group).cast("string"), F.lit("?"))))
    return lines.filter(F.when(tested & (width != 1), wrong.cast("boolean")).otherwise(~F.col("value").startswith("#") & (F.col("value") != "")))


def vcf_sample_counts(lines: DataFrame, group: str = "trait") -> DataFrame:
    """Sample columns per file, from its header line; a file without one has no row."""
    return lines.filter(F.col("value").startswith("#CHROM")).select(
        group, (F.size(F.split("value", "\t")) - len(VCF_FIXED)).alias("samples")).groupBy(group).agg(F.max("samples").alias("samples"))


def _plain(path: str) -> str:
    """The path part of a URI, as Spark reports it for a file and as a caller writes it."""
    return unquote(urlparse(path).path if "://" in path or path.startswith("file:") else path).rstrip("/")


def owners(spark: SparkSession, paths: dict[str, str], files: Sequence[str]) -> list[tuple[str, str]]:
    """(file, name of the path it is listed under, itself or a folder above it), for file names that Spark reports."""
    listed: dict[str, str] = {}
    for name, path in paths.items():
        if _plain(path) in listed:
            raise ValueError("a file is listed for more than one trait")
        listed[_plain(path)] = name
    out = []
    for file in files:
        at = _plain(file)
        while at and at not in listed:
            at = at.rpartition("/")[0]
        if at:
            out.append((file, listed[at]))
    return out


def read_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Lines of one file (or folder) per trait, all in one scan: ``trait, file_block, file_row, value``.

    The scan lists every file once; files are told apart by the name Spark itself reports for them.
    """
    scan = spark.read.text(list(paths.values()))
    owner = owners(spark, paths, scan.inputFiles())
    lookup = spark.createDataFrame(owner, "file string, trait string")
    lines = scan.select(
        "value", F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("file_row"))
    return lines.join(small(lookup, len(owner)), "file").select("trait", *ROW_ORDER, "value")


def header_lines(spark: SparkSession, paths: dict[str, str]) -> dict[str, str]:
    """First line of every named file (the same in all files of a folder), by one job however many there are; one short row a file reaches the driver."""
    scan = spark.read.text(list(paths.values()))
    lines = scan.select("value", F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    first = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", "row").alias("value"))
    found = {r["file"]: r["value"].lstrip("\ufeff").rstrip("\r") for r in first.collect()}
    out: dict[str, str] = {}
    for file, name in owners(spark, paths, list(found)):
        if out.setdefault(name, found[file]) != found[file]:
            raise ValueError(f"{paths[name]}: its files have different headers")
    for name, path in paths.items():
        if name not in out:
            raise ValueError(f"{path}: empty file")
    return out


def read_gwas_vcf(spark: SparkSession, paths: dict[str, str], fields: dict[str, str] | None = None, *, info: Sequence[str] = (),
                  partitions: int | None = None) -> DataFrame:
    """Long table of the records of one single-sample variant file per trait (plain or gzip): one scan, which also checks the number of samples.

    A gzip file is read by one task; ``partitions`` spreads the lines of a few such files before they are parsed. Store the
    parsed table once and work from that.
    """
    lines = checked_vcf_lines(read_lines(spark, paths))
    if partitions:
        lines = lines.repartition(partitions, "trait", "file_row")
    return _parsed(lines, fields or PREPARE_FIELDS, info)


def first_line(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path).limit(1).first()
    if row is None:
        raise ValueError(f"{path}: empty file")
    return row[0].lstrip("﻿").rstrip("\r")


def split_header(line: str) -> tuple[list[str], str]:
    """Column names and separator pattern of a table: tabs if the header has any, otherwise whitespace."""
    return (line.split("\t"), "\t") if "\t" in line else (line.split(), r"\s+")


def read_manifest(spark: SparkSession, path: str, required: Sequence[str] = ("traitname",)) -> DataFrame:
    """Manifest as text columns with ``trait`` and dense 0-based ``trait_order`` in file order. Checked at once.

    A manifest lists traits, so it is small; its header and names are validated on the driver.
    """
    rows = spark.read.option("columnPruning", "false").csv(path, header=True, inferSchema=False, nullValue=None, emptyValue="", enforceSchema=False, mode="FAILFAST",
                                                           ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    header = [h.strip('"') for h in first_line(spark, path).split(",")]
    if any(not h.strip() for h in header) or len(set(header)) != len(header):
        raise ValueError("manifest headers must be unique and non-empty")
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"manifest lacks columns {missing}")
    order = F.row_number().over(Window.orderBy("_id")) - 1
    rows = (rows.withColumn("_id", F.monotonically_increasing_id()).withColumns({"trait": F.trim("traitname"), "trait_order": order}).drop("_id"))
    rows = rows.na.fill("", [c for c, t in rows.dtypes if t == "string"])
    bad = rows.groupBy("trait").count().filter((F.col("trait") == "") | (F.col("count") > 1)).take(1)
    if bad:
        raise ValueError(f"manifest trait names must be unique and non-empty: {bad[0]['trait']!r}")
    return rows


def read_sumstats(spark: SparkSession, paths: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed lines) of one table per trait, tab or whitespace separated as each header says.

    Values stay text. Traits that share a header are read together.
    """
    layouts: dict[str, dict[str, str]] = {}
    for trait, header in header_lines(spark, paths).items():
        layouts.setdefault(header, {})[trait] = paths[trait]
    tables, broken = [], []
    for header, members in layouts.items():
        names, separator = split_header(header)
        if len(set(names)) != len(names):
            raise ValueError(f"duplicate columns in the header of {sorted(members)}")
        lines = read_lines(spark, members).withColumn("value", F.regexp_replace("value", "\r$", "")).filter(F.col("value") != header)
        text = F.col("value") if separator == "\t" else F.trim("value")
        parts = lines.withColumn("_p", F.split(text, separator, -1))
        fits = F.size("_p") == len(names)
        tables.append(parts.filter(fits).select("trait", *ROW_ORDER, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)]))
        broken.append(parts.filter(~fits).select("trait", *ROW_ORDER, "value"))
    rows, bad = tables[0], broken[0]
    for t, b in zip(tables[1:], broken[1:]):
        rows, bad = rows.unionByName(t, allowMissingColumns=True), bad.unionByName(b)
    return rows, bad


def read_ldscores(spark: SparkSession, folder: str, *, columns: Sequence[str] = ("CHR", "SNP", "BP", "L2")) -> DataFrame:
    """LD scores of chromosomes 1-22 exactly; only the wanted columns, rows with a missing SNP dropped."""
    paths = {str(c): f"{folder}/{c}.l2.ldscore.gz" for c in range(1, 23)}
    rows, _ = read_sumstats(spark, paths)
    types = {"CHR": "int", "BP": "bigint", "L2": "double"}
    return rows.filter(~F.col("SNP").isin(*LD_SNP_MISSING)).select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in columns])


def read_reference_snp_count(spark: SparkSession, folder: str) -> float:
    """Number of common reference SNPs behind the LD scores: the sum over the 22 one-line files."""
    paths = [f"{folder}/{c}.l2.M_5_50" for c in range(1, 23)]
    return spark.read.text(paths).agg(F.sum(F.trim("value").try_cast("double"))).first()[0]


def read_snp_list(spark: SparkSession, path: str) -> DataFrame:
    """Reference SNP list (``SNP``, optionally alleles), tab or whitespace separated."""
    rows, _ = read_sumstats(spark, {"reference": path})
    return rows.drop("trait", *ROW_ORDER).filter(F.col("SNP").isNotNull() & (F.col("SNP") != ""))
