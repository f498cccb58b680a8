"""Association inputs derived from the given tables, as SQL text both engines run unchanged.

One ``lineitem`` row is one variant record: 8 traits by supplier, SNPs by part. Every table below is
computed from all rows of its source. ``row`` order is the total order in ``ORDER``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.operators import variant_qc as vq

TRAITS = 8
ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LOADINGS = [0.8, -0.6, 0.2, 0.5, 0.3, -0.4, 0.7, 0.1]
CTI_OFF_DIAGONAL = 0.1

_EFFECT = "((l_discount - CAST(5 AS DOUBLE) / 100) * 60 + (l_tax - CAST(4 AS DOUBLE) / 100) * 10)"
_BASE_A = "CASE l_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'G' END"
_BASE_B = "CASE l_partkey % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'T' ELSE 'A' END"
_EAF = "CAST(5 + l_partkey % 90 AS DOUBLE) / 100"

RAW = {
    "trait": "concat('T', CAST(l_suppkey % 8 AS VARCHAR(10)))",
    "trait_order": "CAST(l_suppkey % 8 AS INT)",
    "SNP": "concat('rs', CAST(l_partkey AS VARCHAR(20)))",
    "CHR": "CAST(l_partkey % 22 + 1 AS INT)",
    "POS": "l_partkey + 1",
    "A1": f"CASE WHEN l_orderkey % 97 = 0 THEN 'T' WHEN l_orderkey % 5 = 0 THEN {_BASE_B} ELSE {_BASE_A} END",
    "A2": f"CASE WHEN l_orderkey % 97 = 0 THEN 'G' WHEN l_orderkey % 5 = 0 THEN {_BASE_A} ELSE {_BASE_B} END",
    "eaf_A1": "CASE WHEN l_quantity = 50 THEN CAST(3 AS DOUBLE) / 2 "
              f"WHEN l_orderkey % 5 = 0 AND l_orderkey % 97 <> 0 THEN 1 - {_EAF} ELSE {_EAF} END",
    "beta": f"{_EFFECT} * CAST(l_linenumber AS DOUBLE) / 100",
    "se": "CASE WHEN l_linenumber = 7 AND l_tax < CAST(5 AS DOUBLE) / 1000 THEN CAST(0 AS DOUBLE) "
          "ELSE CAST(l_linenumber AS DOUBLE) / 100 END",
    "LP": f"CASE WHEN l_quantity = 49 THEN CAST(400 AS DOUBLE) ELSE 2 * abs({_EFFECT}) END",
    "N": "1000 * l_quantity",
    "INFO": "CASE WHEN l_quantity = 48 AND l_linenumber = 5 THEN NULL ELSE 1 - CAST(l_linenumber AS DOUBLE) / 20 END",
}
HM3 = {"SNP": "concat('rs', CAST(p_partkey AS VARCHAR(20)))",
       "A1": "CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'G' END",
       "A2": "CASE p_partkey % 3 WHEN 0 THEN 'G' WHEN 1 THEN 'T' ELSE 'A' END"}
LDSCORE = {"SNP": "concat('rs', CAST(p_partkey AS VARCHAR(20)))", "CHR": "CAST(p_partkey % 22 + 1 AS INT)",
           "BP": "p_partkey + 1", "L2": "CAST(p_size AS DOUBLE)"}


def select(columns: dict[str, str], source: str, where: str = "", extra: list[str] = ()) -> str:
    listed = ", ".join([f"{e} AS {n}" for n, e in columns.items()] + list(extra))
    return f"SELECT {listed} FROM {source}" + (f" WHERE {where}" if where else "")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def exprs(columns: dict[str, str]) -> list[str]:
    return [f"{e.replace('VARCHAR(10)', 'STRING').replace('VARCHAR(20)', 'STRING')} AS {n}" for n, e in columns.items()]


#: Rows of a task: more of them make its sorts and what it reads of a shuffle too large.
ROWS_PER_TASK = 2_000_000


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    rows, cores = table(spark, sf, "lineitem").select(*ORDER), spark.sparkContext.defaultParallelism
    # One file of one row group is one task, however large; a table whose tasks are many and small enough stays as it is. Only footers are read for this.
    held = [n for _, n in rows.groupBy(F.spark_partition_id()).count().collect()]
    if len(held) >= cores and max(held) <= ROWS_PER_TASK:
        return rows
    return rows.repartition(max(cores, -(-sum(held) // ROWS_PER_TASK)), "l_orderkey", "l_linenumber", "l_partkey")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return lineitem(spark, sf).selectExpr(*exprs(RAW), *ORDER)


def hm3(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter("p_partkey % 4 <> 0").selectExpr(*exprs(HM3))


def ldscore(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(*exprs(LDSCORE))


def ldweights(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter("p_partkey % 10 <> 0").selectExpr(*exprs(LDSCORE))


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """One row per trait found in the data, with N and prevalences from its order."""
    return table(spark, sf, "lineitem").selectExpr(
        f"{exprs({'trait': RAW['trait']})[0]}", f"{RAW['trait_order']} AS trait_order").distinct().selectExpr(
        "trait", "trait_order", "CASE WHEN trait_order % 2 = 0 THEN 'yes' ELSE 'no' END AS ref",
        "CASE WHEN trait_order = 3 THEN '40000' WHEN trait_order = 5 THEN '-1' WHEN trait_order = 6 THEN '30000' ELSE '' END AS N",
        "CASE WHEN trait_order = 3 THEN '0.3' WHEN trait_order = 6 THEN '0.5' WHEN trait_order = 7 THEN '1.5' ELSE 'NA' END AS sample_prevalence",
        "CASE WHEN trait_order = 3 THEN '0.01' WHEN trait_order = 4 THEN '0.1' WHEN trait_order = 6 THEN '.' ELSE '' END AS population_prevalence")


def variants(spark: SparkSession, sf: str, *, id_source: str = "vcf_id", require_info: bool = False) -> vq.QcResult:
    return vq.validate_variants(raw(spark, sf), order=ORDER, id_source=id_source, require_info=require_info)


def to_assoc(good: DataFrame, id_source: str = "vcf_id") -> DataFrame:
    return good.select("trait", "trait_order", vq.variant_id(id_source).alias("SNPID"), "CHR", F.col("POS").alias("BP"),
                       F.col("A1").alias("EA"), F.col("A2").alias("OA"), F.col("eaf_A1").alias("EAF"), "N", "Z", F.col("p").alias("P"))


def assoc(spark: SparkSession, sf: str) -> DataFrame:
    return to_assoc(variants(spark, sf).good)


def r6(*names: str):
    """Round the named double columns to six digits, as the comparison SQL does."""
    return {n: F.round(F.col(n), 6) for n in names}


# --- the same tables as CTE text -----------------------------------------------------------------

def q6(expression: str) -> str:
    return f"round({expression}, 6) + 0"


_FINITE = "(({c}) IS NOT NULL AND isfinite({c}))"


def finite(c: str) -> str:
    return _FINITE.format(c=c)


def reason_sql(checks: list[tuple[str, str]], sep: str = "; ") -> str:
    parts = ", ".join(f"CASE WHEN coalesce({ok}, false) THEN NULL ELSE '{text}' END" for ok, text in checks)
    return f"concat_ws('{sep}', {parts})"


def marks_sql(marks: list[tuple[str, str]], sep: str = "; ") -> str:
    parts = ", ".join(f"CASE WHEN coalesce({hit}, false) THEN '{text}' END" for hit, text in marks)
    return f"concat_ws('{sep}', {parts})"


def checks_sql(require_info: bool = False, vcf_id: bool = True) -> str:
    checks = [("CHR BETWEEN 1 AND 22", "Non-autosomal or invalid CHR"), ("POS > 0", "Invalid POS"),
              ("eaf_A1 BETWEEN 0 AND 1", "EAF outside [0,1]"), ("se > 0", "Require SE > 0"), ("N > 0", "Require NEF > 0"),
              ("LP >= 0", "Require LP >= 0"), ("A1 <> A2", "Identical REF and ALT")]
    checks += [(finite(c), f"{c}: missing, non-numeric or non-finite") for c in ("POS::DOUBLE", "eaf_A1", "beta", "se", "LP", "N", "Z")]
    checks = [(ok, text.replace("::DOUBLE", "")) for ok, text in checks]
    checks += [(f"regexp_matches({c}, '^[ACGTN]+$')", f"{c}: invalid sequence allele") for c in ("A1", "A2")]
    if require_info:
        checks.append((finite("INFO") + " AND INFO BETWEEN 0 AND 1", "INFO: missing, non-finite or outside [0,1]"))
    if vcf_id:
        checks.append(("NOT regexp_matches(SNP, '\\s') AND SNP NOT IN ('', '.')", "Invalid VCF identifier"))
    return reason_sql(checks)


def variant_ctes(require_info: bool = False, vcf_id: bool = True) -> str:
    """CTEs raw0, qc (all rows with QC_reason), passed, d1 (by coordinates), good (and by SNP)."""
    order = ", ".join(ORDER)
    ranked = f"row_number() OVER (PARTITION BY trait, {{k}} ORDER BY LP DESC, {order})"
    second = ranked.format(k="SNP") if vcf_id else "1"
    return f"""raw0 AS ({select(RAW, 'lineitem', extra=ORDER)}),
raw1 AS (SELECT *, CASE WHEN se <> 0 THEN beta / se END AS Z FROM raw0),
qc AS (SELECT *, {checks_sql(require_info, vcf_id)} AS QC_reason FROM raw1),
passed AS (SELECT *, concat_ws('_', CHR, POS, A2, A1) AS coordinate_id,
  greatest(1e-300, pow(CAST(10 AS DOUBLE), -least(LP, 300))) AS p FROM qc WHERE QC_reason = ''),
r1 AS (SELECT *, {ranked.format(k='coordinate_id')} AS k1 FROM passed), d1 AS (SELECT * FROM r1 WHERE k1 = 1),
r2 AS (SELECT *, {second} AS k2 FROM d1), good AS (SELECT * FROM r2 WHERE k2 = 1)"""


ASSOC_CTE = """assoc AS (SELECT trait, trait_order, SNP AS SNPID, CHR, POS AS BP, A1 AS EA, A2 AS OA, eaf_A1 AS EAF, N, Z, p AS P FROM good)"""
HM3_CTE = f"hm3 AS ({select(HM3, 'part', 'p_partkey % 4 <> 0')})"
LD_CTE = f"ldscore AS ({select(LDSCORE, 'part')}), ldweights AS ({select(LDSCORE, 'part', 'p_partkey % 10 <> 0')})"
MANIFEST_CTE = f"""traits0 AS (SELECT DISTINCT {RAW['trait']} AS trait, {RAW['trait_order']} AS trait_order FROM lineitem),
manifest AS (SELECT trait, trait_order, CASE WHEN trait_order % 2 = 0 THEN 'yes' ELSE 'no' END AS ref FROM traits0)"""
