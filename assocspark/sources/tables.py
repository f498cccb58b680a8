"""Delimited and Parquet tables: trait pairs, associations, matrix bundles."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pairs import BASE_NUMERIC, H2_COLUMNS, NATIVE_COLUMNS, coerce_numeric, raise_on_bad_cells, restrict
from ..session import small
from .text import first_line, header_lines, owners

# Required association columns, and the older names they may carry.
ASSOC_COLUMNS = ("SNPID", "CHR", "BP", "EA", "OA", "EAF", "N", "Z", "P")
ASSOC_ALIASES = {"A1": "EA", "A2": "OA", "p": "P"}
BUNDLE_MATRICES = ("S", "I", "S_Stand", "V", "V_Stand")


def detect_delimiter(header: str) -> str:
    return "\t" if header.count("\t") > header.count(",") else ","


def delimited(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """All-text read that keeps NA, padding and empty strings as they are. A row with too few or too many fields stops the job."""
    return _strict(spark).csv(path, header=True, sep=separator, inferSchema=False, nullValue=None, emptyValue="", mode="FAILFAST",
                              ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def _strict(spark: SparkSession):
    """Every field of a row is parsed, so that its width is checked even where few columns are wanted."""
    return spark.read.option("columnPruning", "false")


def _layouts(spark: SparkSession, paths: dict[str, str]) -> dict[str, dict[str, str]]:
    """Header line -> the named files that have it. Files of one header are read together, so plans grow with headers and not with files."""
    out: dict[str, dict[str, str]] = {}
    for name, header in header_lines(spark, paths).items():
        out.setdefault(header, {})[name] = paths[name]
    return out


def _named(rows: DataFrame, members: dict[str, str]) -> DataFrame:
    """``rows`` with ``_name`` of the path that ``_file`` belongs to."""
    spark = rows.sparkSession
    owner = owners(spark, members, spark.read.text(list(members.values())).inputFiles())
    lookup = spark.createDataFrame(owner, "_file string, _name string")
    return rows.join(small(lookup, len(owner)), "_file").drop("_file")


def read_pairs(spark: SparkSession, paths: Sequence[str], traits: DataFrame | None = None) -> DataFrame:
    """Typed pair rows of all files with ``source_file`` and ``source_row``; only pairs of ``traits`` if given.

    Raises on missing or half-present columns (headers only), on unreadable numbers and on blank trait
    names (one job).
    """
    numbered = {str(n): path for n, path in enumerate(paths)}
    tables = []
    for header, members in _layouts(spark, numbered).items():
        rows = delimited(spark, list(members.values()), detect_delimiter(header))
        columns, path = set(rows.columns), next(iter(members.values()))
        absent = ({"p1", "p2", *BASE_NUMERIC} - columns) or (set() if any(set(p) <= columns for p in H2_COLUMNS) else {"h2_obs or h2_liab pair"})
        if absent:
            raise ValueError(f"{path}: missing columns {sorted(absent)}")
        native = [c for c in NATIVE_COLUMNS if c in columns]
        if native and len(native) != len(NATIVE_COLUMNS):
            raise ValueError(f"{path}: native columns must be all present or all absent")
        wanted = ["p1", "p2", *BASE_NUMERIC, *[c for pair in H2_COLUMNS if set(pair) <= columns for c in pair], *native,
                  *[c for c in ("rg_trait_wide", "normalization_status") if c in columns]]
        tables.append(_named(rows.select(*[F.trim(c).alias(c) if c in ("p1", "p2") else F.col(c) for c in wanted], F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("source_row")), members))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    listed = spark.createDataFrame(list(enumerate(paths)), "source_number int, source_file string")
    rows = rows.withColumn("source_number", F.col("_name").cast("int")).drop("_name").join(small(listed, len(paths)), "source_number")
    blank = rows.filter((F.coalesce("p1", F.lit("")) == "") | (F.coalesce("p2", F.lit("")) == "")).take(1)
    if blank:
        raise ValueError(f"missing trait identifier in {blank[0]['source_file']}")
    if traits is not None:
        rows = restrict(rows, traits)
    rows = rows.withColumn("row_id", F.struct("source_number", "source_row"))
    numbers = [*BASE_NUMERIC, *[c for p in H2_COLUMNS for c in p], *NATIVE_COLUMNS, "rg_trait_wide"]
    typed, bad = coerce_numeric(rows, numbers, "row_id")
    raise_on_bad_cells(bad)
    return typed


def export_retained(spark: SparkSession, path: str, traits: DataFrame) -> DataFrame:
    """Original text columns of the rows whose two traits are retained."""
    rows = delimited(spark, path, detect_delimiter(first_line(spark, path)))
    keyed = rows.withColumns({"_p1": F.trim("p1"), "_p2": F.trim("p2")})
    names = traits.select("trait")
    return (keyed.join(names, keyed["_p1"] == names["trait"], "left_semi")
            .join(names, F.col("_p2") == names["trait"], "left_semi").drop("_p1", "_p2"))


def canonical_assoc_columns(columns: Sequence[str]) -> dict[str, str]:
    """Source column of every required association column; an explicit name wins over its alias."""
    if len(set(columns)) != len(columns):
        raise ValueError("duplicate association columns")
    chosen = {ASSOC_ALIASES[c]: c for c in columns if c in ASSOC_ALIASES}
    chosen.update({c: c for c in columns if c in ASSOC_COLUMNS})
    missing = [c for c in ASSOC_COLUMNS if c not in chosen]
    if missing:
        raise ValueError(f"association table is missing required columns {missing}; observed {list(columns)}")
    return {c: chosen[c] for c in ASSOC_COLUMNS}


def read_assoc(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Long association table from one file (or folder of chromosome files) per trait, in manifest order."""
    types = {"BP": "bigint", "CHR": "bigint", "EAF": "double", "N": "double", "Z": "double", "P": "double"}
    tables = []
    for line, members in _layouts(spark, paths).items():
        # Spark resolves names without case, so P and p would clash: names come from the header line, columns are read by position.
        header = [name.strip('"') for name in line.split("\t")]
        where = {name: f"c{header.index(column)}" for name, column in canonical_assoc_columns(header).items()}
        rows = _strict(spark).csv(list(members.values()), schema=", ".join(f"c{i} string" for i in range(len(header))), header=True, enforceSchema=True, sep="\t", nullValue=None, emptyValue="", mode="FAILFAST",
                                  ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        tables.append(_named(rows.select(F.input_file_name().alias("_file"), *[(F.col(where[c]).try_cast(types[c]) if c in types else F.col(where[c])).alias(c) for c in ASSOC_COLUMNS]), members))
    rows = reduce(DataFrame.unionByName, tables).withColumnRenamed("_name", "trait")
    order = spark.createDataFrame([(t, i) for i, t in enumerate(paths)], "trait string, trait_order int")
    return rows.join(small(order, len(paths)), "trait").select("trait", "trait_order", *ASSOC_COLUMNS)


def read_matrix_bundle(spark: SparkSession, path: str) -> DataFrame:
    """Long bundle ``(panel_id, matrix, i, j, value)`` from Parquet; sizes and symmetry are checked by one job.

    ``V`` and ``V_Stand`` index trait pairs in vech order. An entry missing on one side is allowed (a trait may
    be removed later); two finite entries that disagree are an error.
    """
    bundle = spark.read.parquet(path)
    check_bundle(bundle)
    return bundle


def bundle_sizes(bundle: DataFrame) -> DataFrame:
    """Per panel and matrix: entries, dimension, entries the dimension calls for, and finite asymmetric entries."""
    mirror = bundle.select("panel_id", "matrix", F.col("j").alias("i"), F.col("i").alias("j"), F.col("value").alias("m"))
    # NaN or NULL on either side makes the comparison false or NULL: only finite disagreements count.
    bad = (bundle.join(mirror, ["panel_id", "matrix", "i", "j"])
           .filter(~F.isnan("value") & ~F.isnan("m") & (F.abs(F.col("value") - F.col("m")) > 1e-8))
           .groupBy("panel_id", "matrix").agg(F.count("*").alias("asymmetric")))
    size = bundle.groupBy("panel_id", "matrix").agg(F.count("*").alias("entries"), (F.greatest(F.max("i"), F.max("j")) + 1).alias("dimension"))
    traits = size.filter("matrix = 'S'").select("panel_id", F.col("dimension").alias("k"))
    k = F.col("k")
    expected = F.when(F.col("matrix").isin("V", "V_Stand"), (k * (k + 1) / 2).cast("bigint")).otherwise(k)
    return (size.join(traits, "panel_id", "left").join(bad, ["panel_id", "matrix"], "left")
            .withColumns({"asymmetric": F.coalesce("asymmetric", F.lit(0)), "expected_dimension": expected.cast("bigint")})
            .withColumn("valid", F.coalesce((F.col("dimension") == F.col("expected_dimension"))
                                            & (F.col("entries") == F.col("dimension") * F.col("dimension")) & (F.col("asymmetric") == 0), F.lit(False))))


def check_bundle(bundle: DataFrame) -> None:
    sizes = bundle_sizes(bundle)
    bad = sizes.filter(~F.col("valid")).take(1)
    if bad:
        raise ValueError(f"matrix bundle has invalid dimensions or is asymmetric: {bad[0].asDict()}")
    absent = sizes.groupBy("panel_id").agg(F.collect_set("matrix").alias("m")).filter(F.size("m") < len(BUNDLE_MATRICES)).take(1)
    if absent:
        raise ValueError(f"matrix bundle must contain {BUNDLE_MATRICES}: panel {absent[0]['panel_id']}")


__all__ = ["ASSOC_COLUMNS", "bundle_sizes", "canonical_assoc_columns", "check_bundle", "delimited", "detect_delimiter",
           "export_retained", "read_assoc", "read_matrix_bundle", "read_pairs"]
