"""The public jobs run on the given tables, checks and policies included."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assocspark.operators import filters
from assocspark.plans import jobs
from assocspark.plans.ledger import StageLedger
from assocspark.session import shared_folder

from . import combine as cq
from . import pairs as pq
from . import sources as sq
from . import views as v
from .variants import _v
from .views import q6, r6


def _metadata(spark, sf):
    """All traits, one with an N of its own and no prevalences."""
    return v.manifest(spark, sf).selectExpr("trait", "trait_order", "CASE WHEN trait_order = 3 THEN '40000' ELSE '' END AS N", "'' AS sample_prevalence", "'' AS population_prevalence")


def job_prepare_associations(spark, sf):
    made = jobs.prepare(v.raw(spark, sf), _metadata(spark, sf), order=v.ORDER, mode="assoc")
    return made.assoc.withColumns(r6("Z", "P"))


def job_prepare_regression(spark, sf):
    made = jobs.prepare(v.raw(spark, sf), _metadata(spark, sf), order=v.ORDER, mode="regression", hm3=v.hm3(spark, sf))
    return made.regression.withColumns(r6("EAF", "BETA", "SE", "P")).withColumn("N", F.col("N").cast("double"))


def job_matrix_inputs(spark, sf):
    table, _ = jobs.prepare_matrix_inputs(v.raw(spark, sf), filters.resolve_sample_metadata(_metadata(spark, sf)), order=v.ORDER)
    return table.select("trait", "SNP", "CHR", "POS", "A1", "A2", *[F.round(c, 6).alias(c) for c in ("MAF", "beta", "se")], F.col("N").cast("double").alias("N"), "INFO")


def job_extract(spark, sf):
    """Frequency, INFO, MAF and palindrome filters in one job over text records; one trait is binary and has no sample prevalence of its own."""
    records = v.lineitem(spark, sf).selectExpr(
        *[f"{e.replace('VARCHAR(10)', 'STRING').replace('VARCHAR(20)', 'STRING')} AS {n}" for n, e in EXTRACTED.items()])
    manifest = v.manifest(spark, sf).selectExpr("trait", "trait_order", "'' AS sample_prevalence", "CASE WHEN trait_order = 3 THEN '0.01' ELSE '' END AS population_prevalence")
    rows, _, _ = jobs.extract(records, manifest, settings=EXTRACT_SETTINGS)
    return rows.select("trait", "SNP", "CHR", "BP", "A1", "A2", *[F.round(c, 6).alias(c) for c in ("EZ", "P", "EAF")], F.col("N").cast("double").alias("N"))


EXTRACT_SETTINGS = filters.VariantFilters()
EXTRACTED = {
    "trait": v.RAW["trait"], "SNP": v.RAW["SNP"], "CHR": "concat(CASE WHEN l_linenumber = 1 THEN 'chr' ELSE '' END, CAST(l_partkey % 22 + 1 AS VARCHAR(10)))", "POS": "CAST(l_partkey + 1 AS VARCHAR(20))",
    "A1": "CASE WHEN l_linenumber = 2 THEN 'T' ELSE 'G' END", "A2": "'A'", "EZ": "CASE WHEN l_quantity = 41 THEN '.' ELSE CAST(l_linenumber AS VARCHAR(10)) END", "LP": "CAST(l_quantity AS VARCHAR(20))",
    "AF": "CASE WHEN l_quantity = 44 THEN NULL ELSE CAST(CAST(l_partkey % 100 AS DOUBLE) / 100 AS VARCHAR(20)) END", "NEF": "CAST(l_orderkey AS VARCHAR(20))", "SI": "CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(CAST(l_quantity AS DOUBLE) / 50 AS VARCHAR(20)) END",
    "NC": "CAST(100 + l_linenumber AS VARCHAR(20))", "NCO": "CAST(l_partkey + 1000 AS VARCHAR(20))", "INFO_AF": "CASE WHEN l_quantity = 43 THEN NULL ELSE '0.25' END", "INFO_EUR": "CASE WHEN l_quantity = 42 THEN '.' WHEN l_quantity = 40 THEN '0.75' ELSE '0.25' END"}


def job_compile_pairs(spark, sf):
    """Coverage, repeats, scales, normalisation and order of a complete pair table."""
    manifest = pq.manifest(spark, sf).select("trait", "trait_order", F.lit("yes").alias("ref"), F.lit(None).cast("double").alias("population_prevalence"))
    made = jobs.compile_pairs(pq.clean(spark, sf), manifest, action="report")
    return made.pairs.select("row_id", "p1", "p2", *[F.round(c, 6).alias(c) for c in ("rg", "se", "h2_obs")])


def job_panel_matrices(spark, sf):
    """The matrices that a panel analysis of all traits validates."""
    settings = jobs.PanelSettings(validate_only=True, negative_eigen_action="ignore")
    try:
        reports = jobs.panel_analysis(pq.clean(spark, sf), pq.manifest(spark, sf).select("trait", "trait_order"), settings).reports
    except jobs.EstimationFailure as failure:  # PC1 or CTI of these data may fail; the matrices are what is compared
        reports = failure.audits
    return reports["matrices"].select("matrix", "i", "j", F.round("value", 6).alias("value"))


def _panel():
    return jobs.PanelResult(None, None, {}, tuple(f"T{i}" for i in range(v.TRAITS)), cq.CTI, v.LOADINGS)


def job_combine(spark, sf):
    return cq.rounded(jobs.combine_snps(v.assoc(spark, sf), _panel())[0])


def job_export(spark, sf):
    """Combined associations through the export's checks, in genomic order with direction counts."""
    table, _ = jobs.export_results([jobs.combine_snps(v.assoc(spark, sf), _panel())[0]], info=0.9)
    return table.select("SNPID", "count_question", "count_plus", "count_minus")


def stage_reruns(spark, sf):
    """Two stages over the variant records, run four times: anew, again, with another parameter of the second, and with other records."""
    ledger = StageLedger(spark, f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}")
    raw = v.raw(spark, sf).select("trait", "SNP", "beta", "se", "N", *v.ORDER)
    out = []
    for run, (rows, least) in enumerate([(raw, 10_000), (raw.repartition("SNP"), 10_000), (raw, 20_000), (raw.filter("trait <> 'T1'"), 20_000)]):
        usable = ledger.stage("usable", {"raw": rows}, {}, lambda rows=rows: rows.filter("se > 0"))
        counts = ledger.stage("counts", {"usable": usable}, {"least": least}, lambda usable=usable, least=least: usable.table.filter(F.col("N") >= least).groupBy("trait").agg(F.count("*").alias("n"), F.sum("N").alias("total")))
        out += [(run, "usable", usable.reused, usable.rows), (run, "counts", counts.reused, counts.table.agg(F.sum("n")).first()[0])]
    return spark.createDataFrame(out, "run int, stage string, reused boolean, rows long")


_OWN_N = "CASE WHEN l_suppkey % 8 = 3 THEN 40000 ELSE 1000 * l_quantity END AS N"
_REGRESSION = v.variant_ctes(require_info=True).replace("1000 * l_quantity AS N", _OWN_N)

QUERIES = {
    "job_prepare_associations": (job_prepare_associations, sq.QUERIES["assoc_table"][1]),
    "job_prepare_regression": (job_prepare_regression, f"WITH {_REGRESSION}, {v.HM3_CTE} SELECT trait, SNP, CHR, POS AS BP, A1, A2, {q6('eaf_A1')} AS EAF, {q6('beta')} AS BETA, {q6('se')} AS SE, {q6('p')} AS P, CAST(N AS DOUBLE) AS N, INFO "
                               "FROM good WHERE SNP IN (SELECT SNP FROM hm3)"),
    "job_matrix_inputs": (job_matrix_inputs, f"WITH {_REGRESSION} SELECT trait, SNP, CHR, POS, A1, A2, {q6('least(eaf_A1, 1 - eaf_A1)')} AS MAF, {q6('beta')} AS beta, {q6('se')} AS se, CAST(N AS DOUBLE) AS N, INFO FROM good"),
    "job_extract": (job_extract, f"""WITH x AS ({v.select(EXTRACTED, 'lineitem', extra=['l_partkey', 'l_suppkey', 'l_linenumber', 'l_orderkey'])}) SELECT trait, SNP, CAST(l_partkey % 22 + 1 AS INT) AS CHR, l_partkey + 1 AS BP, A1, A2,
  {q6("TRY_CAST(EZ AS DOUBLE)")} AS EZ, {q6("pow(CAST(10 AS DOUBLE), -CAST(LP AS DOUBLE))")} AS P, {q6("CAST(AF AS DOUBLE)")} AS EAF, CASE WHEN l_suppkey % 8 = 3 THEN CAST(NC AS DOUBLE) + CAST(NCO AS DOUBLE) ELSE CAST(NEF AS DOUBLE) END AS N
  FROM x WHERE INFO_AF IS NOT NULL AND INFO_EUR = '0.25' AND CAST(SI AS DOUBLE) >= CAST('0.7' AS DOUBLE) AND CAST(AF AS DOUBLE) BETWEEN CAST('0.01' AS DOUBLE) AND 1 - CAST('0.01' AS DOUBLE)"""),
    "job_compile_pairs": (job_compile_pairs, f"WITH {pq.CLEAN} SELECT min(row_id) AS row_id, p1, p2, {q6('max(rg)')} AS rg, {q6('max(se)')} AS se, {q6('max(h2_obs)')} AS h2_obs FROM clean GROUP BY p1, p2"),
    "job_panel_matrices": (job_panel_matrices, pq.QUERIES["matrix_cells"][1]),
    "stage_reruns": (stage_reruns, _v("SELECT run, stage FROM x9").replace(" SELECT run, stage FROM x9", """, u AS (SELECT * FROM raw0 WHERE se > 0), k AS (SELECT count(*) AS every, count(*) FILTER (WHERE trait <> 'T1') AS fewer,
  count(*) FILTER (WHERE N >= 10000) AS low, count(*) FILTER (WHERE N >= 20000) AS high, count(*) FILTER (WHERE N >= 20000 AND trait <> 'T1') AS high_fewer FROM u)
  SELECT CAST(unnest([0, 0, 1, 1, 2, 2, 3, 3]) AS INT) AS run, unnest(['usable', 'counts', 'usable', 'counts', 'usable', 'counts', 'usable', 'counts']) AS stage, unnest([false, false, true, true, true, false, false, false]) AS reused,
  unnest([every, low, every, low, every, high, fewer, high_fewer]) AS rows FROM k""")),
    "job_combine": (job_combine, cq.QUERIES["combined"][1]),
    "job_export": (job_export, cq.QUERIES["direction_counts"][1]),
}
