"""Readers and writers over files that each query derives from the given tables, writes to the shared folder and reads back."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assocspark.operators import combine
from assocspark.session import shared_folder, stored
from assocspark.sources import layout, sinks, tables, text

from . import combine as cq
from . import pairs as pq
from . import sources as sq
from . import views as v
from .variants import _v
from .views import q6


def folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def write_lines(lines: DataFrame, header: str, path: str, by: str | None = None, files: int | None = None) -> None:
    """Lines as they are, below ``header`` in each file, a folder for each value of ``by``."""
    named = lines.select(*([by] if by else []), F.col("line").alias(header))
    writer = (named.coalesce(files) if files else named).write.option("quote", "\u0000").option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    (writer.partitionBy(by) if by else writer).csv(path, sep="\u0001", header=True)


# --- readers ---

def manifest_file(spark, sf):
    path = folder(spark)
    lines = v.manifest(spark, sf).orderBy(F.desc("trait_order")).selectExpr("concat_ws(',', CASE WHEN trait_order = 3 THEN ' T3 ' WHEN trait_order = 5 THEN 'NA' ELSE trait END, ref, N, sample_prevalence, CASE WHEN trait_order = 2 THEN '\"a,b\"' ELSE population_prevalence END) AS line")
    write_lines(lines, "traitname,ref,N,sample_prevalence,population_prevalence", path, files=1)
    return text.read_manifest(spark, path)


SUMSTATS = ("concat_ws(CASE WHEN l_suppkey % 2 = 0 THEN '\t' ELSE ' ' END, concat('rs', CAST(l_partkey AS STRING)), CASE WHEN l_linenumber = 2 THEN 'NA' ELSE 'A' END, CAST(l_quantity AS STRING), "
            "CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CASE WHEN l_linenumber = 6 THEN 'extra' END)")


def sumstats_files(spark, sf):
    """Four traits with tabs and four with blanks; every sixth line of an order has a field too many."""
    path = folder(spark)
    rows = v.lineitem(spark, sf).selectExpr("CAST(l_suppkey % 8 AS STRING) AS t", f"{SUMSTATS} AS line")
    paths = {}
    for odd, separator in ((0, "\t"), (1, " ")):
        write_lines(rows.filter(f"CAST(t AS INT) % 2 = {odd}"), separator.join(["SNP", "A1", "N", "order", "Z"]), f"{path}/{odd}", "t")
        paths |= {f"T{k}": f"{path}/{odd}/t={k}" for k in range(odd, 8, 2)}
    good, bad = text.read_sumstats(spark, paths)
    return good.select("trait", "SNP", "A1", "N", "order", "Z", F.lit(None).cast("string").alias("malformed")).unionByName(
        bad.select("trait", *[F.lit(None).cast("string").alias(c) for c in ("SNP", "A1", "N", "order", "Z")], F.col("value").alias("malformed")))


def ldscore_files(spark, sf):
    """One compressed table a chromosome, SNP names that count as missing among them, and the counts of common SNPs."""
    path = folder(spark)
    rows = v.table(spark, sf, "part").selectExpr("CAST(p_partkey % 22 + 1 AS INT) AS c", "concat_ws('\t', CAST(p_partkey % 22 + 1 AS STRING), CASE WHEN p_partkey % 50 = 0 THEN 'NA' WHEN p_partkey % 50 = 1 THEN '' ELSE concat('rs', CAST(p_partkey AS STRING)) END, "
                                                 "CAST(p_partkey + 1 AS STRING), CAST(p_size AS STRING), 'x') AS line").persist()
    for c in range(1, 23):
        own = rows.filter(F.col("c") == c)
        own.select(F.col("line").alias("CHR\tSNP\tBP\tL2\tmore")).write.option("quote", "\u0000").csv(f"{path}/{c}.l2.ldscore.gz", sep="\u0001", header=True, compression="gzip")
        own.agg(F.count("*").cast("string").alias("value")).write.text(f"{path}/{c}.l2.M_5_50")
    rows.unpersist()
    return text.read_ldscores(spark, path).withColumn("reference_snps", F.lit(text.read_reference_snp_count(spark, path)))


PAIR_COLUMNS = ("p1", "p2", "rg", "se", "z", "p", "h2_int", "h2_int_se", "gcov_int", "gcov_int_se", "h2_obs", "h2_obs_se")


def pair_files(spark, sf) -> list[str]:
    """The pair table as two files: commas and tabs, columns in another order, blanks around names."""
    path = folder(spark)
    rows = pq.clean(spark, sf).withColumn("p1", F.concat(F.lit(" "), "p1"))
    for part, columns, separator in ((0, PAIR_COLUMNS, ","), (1, PAIR_COLUMNS[::-1], "\t")):
        lines = rows.filter(F.col("row_id") % 2 == part).select(F.concat_ws(separator, *[F.col(c).cast("string") for c in columns]).alias("line"))
        write_lines(lines, separator.join(columns), f"{path}/{part}", files=1)
    return [f"{path}/0", f"{path}/1"]


def pair_results_read(spark, sf):
    rows = tables.read_pairs(spark, pair_files(spark, sf), pq.manifest(spark, sf).filter("trait_order <> 7"))
    return rows.select("source_number", *PAIR_COLUMNS[:2], *[F.round(c, 9).alias(c) for c in PAIR_COLUMNS[2:]])


def retained_export(spark, sf):
    """Rows of the first file as they were written, for four traits."""
    rows = tables.export_retained(spark, pair_files(spark, sf)[0], pq.manifest(spark, sf).filter("trait_order IN (1, 3, 4, 6)"))
    return rows.select("p1", "p2", *[F.round(F.col(c).cast("double"), 9).alias(c) for c in ("rg", "h2_obs")])


ASSOC_LINE = ("concat_ws('\t', SNPID, CAST(CHR AS STRING), CAST(BP AS STRING), EA, OA, CAST(EAF AS STRING), CAST(N AS STRING), CASE WHEN BP % 11 = 0 THEN 'NA' ELSE CAST(Z AS STRING) END, {p})")


def association_files(spark, sf):
    """A folder a trait: even traits have the older names, and a column p beside P."""
    path = folder(spark)
    rows = stored(v.assoc(spark, sf).withColumn("t", F.col("trait_order")))  # written in two layouts
    write_lines(rows.filter("t % 2 = 0").select("t", F.expr(ASSOC_LINE.format(p="'7', CAST(P AS STRING)")).alias("line")), "SNPID\tCHR\tBP\tA1\tA2\tEAF\tN\tZ\tp\tP", f"{path}/0", "t")
    write_lines(rows.filter("t % 2 = 1").select("t", F.expr(ASSOC_LINE.format(p="CAST(P AS STRING)")).alias("line")), "SNPID\tCHR\tBP\tEA\tOA\tEAF\tN\tZ\tP", f"{path}/1", "t")
    read = tables.read_assoc(spark, {f"T{k}": f"{path}/{k % 2}/t={k}" for k in range(8)})
    return read.withColumns({c: F.round(c, 6) for c in ("EAF", "N", "Z", "P")})


# --- writers ---

def association_written(spark, sf):
    """The association table written by trait and chromosome, writers in proportion to rows, and read back."""
    path = folder(spark)
    rows = v.assoc(spark, sf)
    sinks.write_assoc(rows, path, split=False)
    return spark.read.parquet(path).select("trait", "trait_order", "SNPID", "CHR", "BP", "EA", "OA", F.round("EAF", 6).alias("EAF"), F.round("Z", 6).alias("Z"))


def text_written(spark, sf):
    """Delimited text, read back as it is: doubles survive, NULL and '' are empty cells."""
    path = folder(spark)
    rows = v.lineitem(spark, sf).selectExpr("l_orderkey", "l_linenumber", "l_partkey", "CAST(l_extendedprice AS DOUBLE) / 7 AS x", "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' ELSE concat('a,', CAST(l_suppkey AS STRING), '\"') END AS t")
    sinks.write_table(rows, path)
    back = spark.read.csv(path, header=True, escape='"', schema="l_orderkey long, l_linenumber int, l_partkey long, x double, t string", emptyValue="")
    return back.select("l_orderkey", "l_linenumber", "l_partkey", F.round("x", 9).alias("x"), F.coalesce("t", F.lit("")).alias("t"))


# --- stored layout ---

def combined_stored(spark, sf):
    """The combination over a table stored by SNP: no row moves."""
    stored = layout.store_by(v.assoc(spark, sf), ["SNPID"], order=["trait_order"])
    return cq.rounded(combine.combine_traits(stored, cq.CTI, v.LOADINGS))


def ldscore_join_stored(spark, sf):
    """SNPs with LD score and weight of each trait, from three tables stored by SNP."""
    stats = layout.store_by(v.assoc(spark, sf).select("trait", F.col("SNPID").alias("SNP"), "Z", "N"), ["SNP"])
    ld = layout.store_by(v.ldscore(spark, sf).select("SNP", "L2"), ["SNP"])
    weights = layout.store_by(v.ldweights(spark, sf).select("SNP", F.col("L2").alias("W")), ["SNP"])
    return joined_by_snp(stats, ld, weights).groupBy("trait").agg(F.count("*").alias("snps"), F.round(F.sum(F.col("L2") * F.col("W")), 3).alias("load"))


def joined_by_snp(stats, ld, weights):
    return stats.join(ld.hint("merge"), "SNP").join(weights.hint("merge"), "SNP")


_COLS9 = ", ".join(f"round({c}, 9) + 0 AS {c}" for c in PAIR_COLUMNS[2:])
QUERIES = {
    "manifest_file": (manifest_file, f"""WITH {v.MANIFEST_CTE} SELECT CASE WHEN trait_order = 3 THEN ' T3 ' WHEN trait_order = 5 THEN 'NA' ELSE trait END AS traitname, ref,
  CASE WHEN trait_order = 3 THEN '40000' WHEN trait_order = 5 THEN '-1' WHEN trait_order = 6 THEN '30000' ELSE '' END AS "N", CASE WHEN trait_order = 3 THEN '0.3' WHEN trait_order = 6 THEN '0.5' WHEN trait_order = 7 THEN '1.5' ELSE 'NA' END AS sample_prevalence,
  CASE WHEN trait_order = 2 THEN 'a,b' WHEN trait_order = 3 THEN '0.01' WHEN trait_order = 4 THEN '0.1' WHEN trait_order = 6 THEN '.' ELSE '' END AS population_prevalence,
  CASE WHEN trait_order = 5 THEN 'NA' ELSE trait END AS trait, row_number() OVER (ORDER BY trait_order DESC) - 1 AS trait_order FROM manifest"""),
    "sumstats_files": (sumstats_files, f"""WITH r AS (SELECT concat('T', l_suppkey % 8) AS trait, l_linenumber = 6 AS bad, {SUMSTATS} AS line, l_partkey, l_linenumber, l_quantity, l_orderkey FROM lineitem)
  SELECT trait, CASE WHEN NOT bad THEN concat('rs', l_partkey) END AS SNP, CASE WHEN NOT bad THEN CASE WHEN l_linenumber = 2 THEN 'NA' ELSE 'A' END END AS A1, CASE WHEN NOT bad THEN CAST(l_quantity AS STRING) END AS "N",
  CASE WHEN NOT bad THEN CAST(l_orderkey AS STRING) END AS "order", CASE WHEN NOT bad THEN CAST(l_linenumber AS STRING) END AS "Z", CASE WHEN bad THEN line END AS malformed FROM r"""),
    "ldscore_files": (ldscore_files, """SELECT CAST(p_partkey % 22 + 1 AS INT) AS CHR, concat('rs', p_partkey) AS SNP, CAST(p_partkey + 1 AS BIGINT) AS BP, CAST(p_size AS DOUBLE) AS L2, (SELECT CAST(count(*) AS DOUBLE) FROM part) AS reference_snps FROM part WHERE p_partkey % 50 > 1"""),
    "pair_results_read": (pair_results_read, f"WITH {pq.CLEAN} SELECT CAST(row_id % 2 AS INT) AS source_number, p1, p2, {_COLS9} FROM clean WHERE i <> 7 AND j <> 7"),
    "retained_export": (retained_export, f"WITH {pq.CLEAN} SELECT concat(' ', p1) AS p1, p2, round(rg, 9) + 0 AS rg, round(h2_obs, 9) + 0 AS h2_obs FROM clean WHERE row_id % 2 = 0 AND i IN (1, 3, 4, 6) AND j IN (1, 3, 4, 6)"),
    "association_files": (association_files, _v(f"SELECT trait, trait_order, SNP AS SNPID, CAST(CHR AS BIGINT) AS CHR, CAST(POS AS BIGINT) AS BP, A1 AS EA, A2 AS OA, {q6('eaf_A1')} AS EAF, {q6('N')} AS \"N\", CASE WHEN POS % 11 <> 0 THEN {q6('Z')} END AS \"Z\", {q6('p')} AS \"P\" FROM good")),
    "association_written": (association_written, _v(f"SELECT trait, trait_order, SNP AS SNPID, CHR, POS AS BP, A1 AS EA, A2 AS OA, {q6('eaf_A1')} AS EAF, {q6('Z')} AS \"Z\" FROM good")),
    "text_written": (text_written, "SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(l_extendedprice AS DOUBLE) / 7, 9) + 0 AS x, CASE WHEN l_linenumber IN (1, 2) THEN '' ELSE concat('a,', l_suppkey, '\"') END AS t FROM lineitem"),
    "combined_stored": (combined_stored, cq.QUERIES["combined"][1]),
    "ldscore_join_stored": (ldscore_join_stored, f"WITH {v.variant_ctes()}, {v.ASSOC_CTE}, {v.LD_CTE} SELECT trait, count(*) AS snps, round(sum(l.L2 * w.L2), 3) + 0 AS load FROM assoc a JOIN ldscore l ON l.SNP = a.SNPID JOIN ldweights w ON w.SNP = a.SNPID GROUP BY trait"),
}
