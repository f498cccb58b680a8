"""Queries over the combination of all traits per SNP and the export of its results."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from assocspark.functions.tails import two_sided_p_sql
from assocspark.operators import alleles, combine, export, ordering
from assocspark.session import durable, stored

from . import views as v
from .views import q6, r6

CTI = np.full((v.TRAITS, v.TRAITS), v.CTI_OFF_DIAGONAL)
np.fill_diagonal(CTI, 1.0)
SPARSE_LOADINGS = [0.0, 0.0, 0.0, 1.0, -(0.5 ** 0.5), 0.0, 0.0, 0.0]


def rounded(df):
    return df.withColumns({**r6("EAF", "BETA", "SE", "Z", "PVAL"), "N_eff": F.round("N_eff", 3), "N_obs": F.round("N_obs", 3)})


def combined_rows(spark, sf, loadings=v.LOADINGS, **kw):
    return combine.combine_traits(v.assoc(spark, sf), CTI, loadings, **kw)


def aligned_traits(spark, sf):
    return alleles.align_traits(v.assoc(spark, sf)).select(
        "SNPID", "trait", "anchor_EA", "anchor_OA", "orientation", F.round("Z", 6).alias("Z"), F.round("EAF", 6).alias("EAF"))


def combined(spark, sf):
    return rounded(combined_rows(spark, sf))


def flagship(spark, sf):
    """Raw records to combined associations that passed QC, in genomic order."""
    result = durable(combined_rows(spark, sf))  # read by the QC and by the export
    issues, _ = combine.combined_qc(result, v.LOADINGS)
    passed = result.join(issues.select("SNPID"), "SNPID", "left_anti")
    return rounded(ordering.sort_by_position(combine.direction_counts(passed), ["SNPID"]))


def combined_custom(spark, sf):
    """User-supplied combination: unit CTI, sum of weighted Z over its own root mean square."""
    def plain(batch: pd.DataFrame, cti, loadings) -> pd.DataFrame:
        out = batch[["SNPID", "CHR", "BP", "EA", "OA"]].copy()
        lists = batch[["traits", "n", "z", "eaf"]].explode(["traits", "n", "z", "eaf"]).astype({"traits": int, "n": float, "z": float, "eaf": float})
        w = np.sqrt(lists["n"]) * np.asarray(loadings)[lists["traits"]]
        total = lists["n"].groupby(level=0).sum()
        out["EAF"] = (lists["n"] * lists["eaf"]).groupby(level=0).sum() / total
        out["N_eff"] = out["N_obs"] = total
        out["Z"] = (w * lists["z"]).groupby(level=0).sum() / np.sqrt((w * w).groupby(level=0).sum())
        out["SE"] = 1 / np.sqrt(total * 2 * out["EAF"] * (1 - out["EAF"]))
        out["BETA"] = out["Z"] * out["SE"]
        out["Direction"] = "?" * len(loadings)
        return out
    return rounded(combined_rows(spark, sf, combine=plain)).select("SNPID", "N_eff", "EAF", "SE", "Z", "PVAL")


def combined_qc_issues(spark, sf):
    assoc = stored(v.assoc(spark, sf))  # read by the combination and by its QC
    result = durable(combine.combine_traits(assoc, CTI, SPARSE_LOADINGS))
    return combine.combined_qc(result, SPARSE_LOADINGS, assoc=assoc)[0]


def combined_qc_summary(spark, sf):
    return combine.combined_qc(durable(combined_rows(spark, sf, SPARSE_LOADINGS)), SPARSE_LOADINGS)[1]


def direction_counts(spark, sf):
    return combine.direction_counts(combined_rows(spark, sf)).select("SNPID", "count_question", "count_plus", "count_minus")


RESULTS = {  # combined-looking results straight from part: text positions, sex chromosomes, bad numbers
    "SNPID": "concat('rs', CAST(p_partkey AS STRING))",
    "CHR": "CASE p_partkey % 26 WHEN 23 THEN 'X' WHEN 24 THEN 'chrY' WHEN 25 THEN 'MT' WHEN 0 THEN 'xy' ELSE concat('chr', CAST(p_partkey % 26 AS STRING)) END",
    "BP": "CASE WHEN p_partkey % 7 = 0 THEN concat(CAST(p_size AS STRING), 'e1') WHEN p_partkey % 7 = 1 THEN concat(CAST(p_size AS STRING), '.0') "
          "WHEN p_partkey % 101 = 0 THEN '-5' WHEN p_partkey % 103 = 0 THEN '2.5' ELSE CAST(p_partkey AS STRING) END",
    "SE": "CASE WHEN p_partkey % 11 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END",
    "BETA": "p_retailprice", "Z": "CASE WHEN p_partkey % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE p_retailprice / 100 END",
    "PVAL": "CASE WHEN p_partkey % 17 = 0 THEN CAST(2 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / 64 END",
    "N_eff": "CASE WHEN p_partkey % 19 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE 1000 * CAST(p_size AS DOUBLE) END",
    "source": "concat('chr', CAST(p_partkey % 5 AS STRING))"}
_RES = f"res AS ({v.select(RESULTS, 'part')})"
_CODE = "CASE upper(regexp_replace(CHR, '^chr', '')) WHEN 'X' THEN '23' WHEN 'Y' THEN '24' WHEN 'XY' THEN '25' WHEN 'MT' THEN '26' ELSE upper(regexp_replace(CHR, '^chr', '')) END"


def stored_results(spark, sf):
    return v.table(spark, sf, "part").selectExpr(*[f"{e} AS {n}" for n, e in RESULTS.items()])


def position_keys(spark, sf):
    return ordering.position_keys(stored_results(spark, sf)).select(
        "SNPID", F.col("_chr").cast("bigint").alias("chr_key"), F.col("_bp").cast("bigint").alias("bp_key"))


def position_order(spark, sf):
    """Rank of every record; an unreadable position stands below all others of its chromosome."""
    rows = ordering.position_keys(stored_results(spark, sf)).withColumns({c: F.coalesce(c, F.lit(0).cast("decimal(38,0)")) for c in ("_chr", "_bp")})
    return ordering.global_rank(rows, ["_chr", "_bp", "SNPID"]).select("SNPID", "rank")


def position_sorted(spark, sf):
    rows = stored_results(spark, sf).withColumn("k", F.substring("SNPID", 3, 20).cast("bigint"))
    return ordering.is_position_sorted(rows, ["k"])


def export_qc_issues(spark, sf):
    return combine.export_qc(stored_results(spark, sf))[0]


def export_qc_summary(spark, sf):
    return combine.export_qc(stored_results(spark, sf))[1]


def union_results(spark, sf):
    rows = stored_results(spark, sf)
    a = rows.filter("source <> 'chr0'").select("SNPID", "CHR", "BP", "Z")
    b = rows.filter("source = 'chr0'").select("SNPID", "BP", "CHR", "SE", "source")
    return export.union_results([a, b]).withColumn("Z", F.when(~F.isnan("Z"), F.col("Z")))


def merged_issues(spark, sf):
    first = v.variants(spark, sf, id_source="chr_pos_ref_alt").issues.select("trait", "l_orderkey", "l_linenumber", "QC_action", "QC_reason")
    second = stored_results(spark, sf).filter("SE = 0").select(
        F.lit("T0").alias("trait"), "SNPID", F.lit("removed").alias("QC_action"), F.lit("SE is zero").alias("QC_reason"))
    return export.merge_issues([first, second])


def export_summary(spark, sf):
    return rounded(export.export_summary(combined_rows(spark, sf).withColumn("N_obs", F.lit(0.0)), info=0.9).withColumn("N_obs", F.lit(0.0))).drop("N_obs")


_L = "CASE trait_order " + " ".join(f"WHEN {i} THEN CAST('{x}' AS DOUBLE)" for i, x in enumerate(v.LOADINGS)) + " END"
_SIGN = " || ".join(f"coalesce(max(CASE WHEN trait_order = {i} THEN CASE WHEN z1 < 0 THEN '-' ELSE '+' END END), '?')" for i in range(v.TRAITS))


def _combined_ctes(loading: str = _L) -> str:
    r = f"CAST('{v.CTI_OFF_DIAGONAL}' AS DOUBLE)"
    return f"""WITH {v.variant_ctes()}, {v.ASSOC_CTE},
anchor AS (SELECT SNPID, arg_min(EA, trait_order) AS aEA, arg_min(OA, trait_order) AS aOA, arg_min(CHR, trait_order) AS aCHR, arg_min(BP, trait_order) AS aBP FROM assoc GROUP BY SNPID),
aligned AS (SELECT a.*, aEA, aOA, aCHR, aBP, CASE WHEN EA = aEA AND OA = aOA THEN 1 WHEN EA = aOA AND OA = aEA THEN -1 END AS orientation FROM assoc a JOIN anchor n ON n.SNPID = a.SNPID),
c AS (SELECT *, CASE WHEN orientation = -1 THEN -Z ELSE Z END AS z1, CASE WHEN orientation = -1 THEN 1 - EAF ELSE EAF END AS e1, sqrt(N) * {loading} AS w FROM aligned),
s AS (SELECT SNPID, aCHR AS CHR, aBP AS BP, aEA AS EA, aOA AS OA, sum(w * z1) AS num, (1 - {r}) * sum(w * w) + {r} * sum(w) * sum(w) AS quad, sum(N) AS n, count(*) AS k,
  (sum(N) - {r} / (1 + (count(*) - 1) * {r}) * sum(sqrt(N)) * sum(sqrt(N))) / (1 - {r}) AS neff, sum(N * e1) / sum(N) AS eaf, {_SIGN} AS Direction
  FROM c WHERE orientation IS NOT NULL GROUP BY ALL),
o AS (SELECT SNPID, CHR, BP, EA, OA, eaf, neff, n, num / sqrt(CASE WHEN quad > 0 THEN quad END) AS z, 1 / sqrt(n * 2 * eaf * (1 - eaf)) AS se, Direction FROM s)"""


_OUT = (f"SNPID, CHR, BP, EA, OA, {q6('eaf')} AS EAF, round(neff, 3) AS N_eff, round(n, 3) AS N_obs, {q6('z * se')} AS BETA, {q6('se')} AS SE, "
        f"{q6('z')} AS Z, Direction, {q6(two_sided_p_sql('z'))} AS PVAL")
_COUNTS = ", ".join(f"CAST(length(Direction) - length(replace(Direction, '{s}', '')) AS BIGINT) AS count_{n}" for n, s in
                    (("question", "?"), ("plus", "+"), ("minus", "-")))
_SPARSE_OK = "(substr(Direction, 4, 1) IN ('+', '-') OR substr(Direction, 5, 1) IN ('+', '-'))"
_SPARSE_L = "CASE trait_order WHEN 3 THEN 1.0 WHEN 4 THEN -1.0 ELSE 0.0 END"
_SPARSE_ISSUES = " UNION ALL ".join(f"SELECT SNPID, '{r}' AS Reason FROM o WHERE NOT {_SPARSE_OK}" for r in
                                    ("BETA_not_finite", "Z_not_finite", "PVAL_not_finite_or_outside_0_1", "zero_available_weight"))
_CUSTOM = f"""SELECT SNPID, round(n, 3) AS N_eff, {q6('eaf')} AS EAF, {q6('se')} AS SE, {q6('z2')} AS Z, {q6(two_sided_p_sql('z2'))} AS PVAL FROM
 (SELECT o.*, t.z2 FROM o JOIN (SELECT SNPID, sum(w * z1) / sqrt(sum(w * w)) AS z2 FROM c WHERE orientation IS NOT NULL GROUP BY SNPID) t ON t.SNPID = o.SNPID) u"""
_BP = "CASE WHEN regexp_matches(BP, '^[0-9]+$') OR TRY_CAST(BP AS DOUBLE) % 1 = 0 AND TRY_CAST(BP AS DOUBLE) > 0 THEN CAST(TRY_CAST(BP AS DOUBLE) AS BIGINT) END"
_KEYED = f"{_RES}, keyed AS (SELECT *, CAST({_CODE} AS BIGINT) AS chr_key, {_BP} AS bp_key FROM res)"
_EXPORT = [("BETA", v.finite("BETA"), "BETA_not_finite"), ("SE", v.finite("SE") + " AND SE > 0", "SE_not_finite_positive"), ("Z", v.finite("Z"), "Z_not_finite"),
           ("P", v.finite("PVAL") + " AND PVAL BETWEEN 0 AND 1", "PVAL_not_finite_or_outside_0_1"), ("N", v.finite("N_eff") + " AND N_eff > 0", "N_eff_not_finite_positive")]
_EXPORTED = f"{_RES}, e AS (SELECT *, {v.reason_sql([(ok, t) for _, ok, t in _EXPORT])} AS Reason FROM res)"
_ISSUES_COORD = f"SELECT trait, l_orderkey, l_linenumber, QC_action, QC_reason, NULL AS SNPID FROM ({{}}) i"

from .variants import _issues_sql  # noqa: E402

QUERIES = {
    "aligned_traits": (aligned_traits, f"{_combined_ctes()} SELECT SNPID, trait, aEA AS anchor_EA, aOA AS anchor_OA, orientation, {q6('z1')} AS Z, {q6('e1')} AS EAF FROM c"),
    "combined": (combined, f"{_combined_ctes()} SELECT {_OUT} FROM o"),
    "flagship": (flagship, f"{_combined_ctes()} SELECT {_OUT}, {_COUNTS} FROM o"),
    "combined_custom": (combined_custom, f"{_combined_ctes()} {_CUSTOM}"),
    "combined_qc_issues": (combined_qc_issues, f"{_combined_ctes(_SPARSE_L)} {_SPARSE_ISSUES}"),
    "combined_qc_summary": (combined_qc_summary, f"{_combined_ctes(_SPARSE_L)} SELECT CASE WHEN count(*) FILTER (WHERE NOT {_SPARSE_OK}) = 0 THEN 'passed' ELSE 'failed' END AS Status, "
                            f"count(*) AS Total_Rows, count(*) FILTER (WHERE NOT {_SPARSE_OK}) AS Invalid_Rows, 4 * count(*) FILTER (WHERE NOT {_SPARSE_OK}) AS Issue_Count FROM o"),
    "direction_counts": (direction_counts, f"{_combined_ctes()} SELECT SNPID, {_COUNTS} FROM o"),
    "position_keys": (position_keys, f"WITH {_KEYED} SELECT SNPID, chr_key, bp_key FROM keyed"),
    "position_order": (position_order, f"WITH {_KEYED} SELECT SNPID, row_number() OVER (ORDER BY coalesce(chr_key, 0), coalesce(bp_key, 0), SNPID) - 1 AS rank FROM keyed"),
    "position_sorted": (position_sorted, f"WITH {_KEYED}, z AS (SELECT SNPID, coalesce(chr_key, 0) AS chr_key, coalesce(bp_key, 0) AS bp_key FROM keyed), n AS (SELECT chr_key, bp_key, lead(chr_key) OVER w AS c2, lead(bp_key) OVER w AS b2 FROM z "
                        "WINDOW w AS (ORDER BY CAST(substr(SNPID, 3) AS BIGINT))) SELECT count(*) = 0 AS is_sorted, count(*) AS order_breaks FROM n WHERE (chr_key, bp_key) > (c2, b2)"),
    "export_qc_issues": (export_qc_issues, f"WITH {_EXPORTED} SELECT source, SNPID, Reason FROM e WHERE Reason <> ''"),
    "export_qc_summary": (export_qc_summary, f"WITH {_EXPORTED} SELECT source, count(*) AS Total_Rows, count(*) FILTER (WHERE Reason <> '') AS Invalid_Rows, "
                          "CASE WHEN count(*) FILTER (WHERE Reason <> '') > 0 THEN 'failed' ELSE 'passed' END AS Status FROM e GROUP BY source"),
    "union_results": (union_results, f"WITH {_RES} SELECT SNPID, CHR, BP, CASE WHEN isnan(Z) THEN NULL ELSE Z END AS Z, 0 AS source_order, NULL AS SE, NULL AS source FROM res WHERE source <> 'chr0' "
                      "UNION ALL SELECT SNPID, CHR, BP, NULL, 1, SE, source FROM res WHERE source = 'chr0'"),
    "merged_issues": (merged_issues, f"WITH {v.variant_ctes(vcf_id=False)}, {_RES} {_ISSUES_COORD.format(_issues_sql([('coordinate_id', 'r1', 'k1')], 'trait, l_orderkey, l_linenumber'))} "
                      "UNION ALL SELECT 'T0', NULL, NULL, 'removed', 'SE is zero', SNPID FROM res WHERE SE = 0"),
    "export_summary": (export_summary, f"{_combined_ctes()} SELECT SNPID, CHR, BP, EA, OA, {q6('eaf')} AS EAF, round(neff, 3) AS N_eff, {q6('z * se')} AS BETA, {q6('se')} AS SE, {q6('z')} AS Z, "
                       f"{q6(two_sided_p_sql('z'))} AS PVAL, CAST('0.9' AS DOUBLE) AS INFO FROM o"),
}
