"""Queries over trait panels: the full set and one panel per left-out trait."""
from __future__ import annotations

from pyspark.sql import functions as F

from assocspark.operators import matrices, pairs, panels

from . import pairs as pq
from . import views as v
from .pairs import CLEAN, MANIFEST, q6
from .views import r6


def members(spark, sf):
    """Panel membership: all traits, and all but one for each trait."""
    m = pq.manifest(spark, sf).select("trait", "trait_order")
    left_out = pairs.plan_pairs(m.withColumn("ref", F.lit("yes"))).filter("o1 <> o2").select(
        F.concat(F.lit("without_"), "p1").alias("panel_id"), F.col("o2").alias("trait_order"))
    return m.select(F.lit("all").alias("panel_id"), "trait_order").unionByName(left_out)


def cells(spark, sf, name):
    rows = pq.scaled(spark, sf, pq.clean)
    whole = matrices.assemble_matrices(pairs.collapse_pairs(rows), pairs.self_pair_qc(rows, pq.manifest(spark, sf)))
    return whole.filter(F.col("matrix") == name).select("i", "j", "value")


def panel_matrix(spark, sf, name="S_Stand"):
    return matrices.subset_panels(cells(spark, sf, name), members(spark, sf)).select("panel_id", "i", "j", "value")


def panel_cells(spark, sf):
    return panel_matrix(spark, sf).withColumns(r6("value"))


def two_trait_panels(spark, sf):
    """Every pair of traits as its own panel: PC1 has a closed form there."""
    one = pairs.plan_pairs(pq.manifest(spark, sf), unordered=True).filter("o1 < o2").select(
        F.concat_ws("-", "p1", "p2").alias("panel_id"), F.explode(F.array("o1", "o2")).alias("trait_order"))
    return matrices.subset_panels(cells(spark, sf, "S_Stand"), one).select("panel_id", "i", "j", "value")


def pair_loadings(spark, sf):
    return panels.panel_loadings(two_trait_panels(spark, sf)).select("panel_id", "i", "qc_status", F.round("loading", 6).alias("loading"))


def pair_eigenvalues(spark, sf):
    return panels.panel_eigenvalues(two_trait_panels(spark, sf)).select(
        "panel_id", "PC", "negative", "substantive_negative", F.round("eigenvalue", 6).alias("eigenvalue"))


def pair_variance(spark, sf):
    return panels.variance_explained(panels.panel_eigenvalues(two_trait_panels(spark, sf))).select(
        "panel_id", "PC", "conventional_partition", *[F.round(c, 6).alias(c) for c in (
            "percent_raw", "cumulative_percent_raw", "percent_positive", "cumulative_percent_positive")])


def pair_contributions(spark, sf):
    # Both traits of a pair contribute one half exactly; rounding first makes the tie visible to the rank.
    rows = panels.panel_loadings(two_trait_panels(spark, sf)).withColumn("eigenvector", F.round("eigenvector", 9))
    return panels.contributions(rows).select("panel_id", "i", F.round("contribution_percent", 5).alias("contribution_percent"), "contribution_rank")


def pair_cti(spark, sf):
    return panels.assess_cti(two_trait_panels(spark, sf)).select(
        "panel_id", "CTI_Status", "CTI_Cholesky_Pass", "CTI_Negative_Eigenvalues", F.round("CTI_Minimum_Eigenvalue", 6).alias("CTI_Minimum_Eigenvalue"),
        F.round("CTI_Condition_Number", 4).alias("CTI_Condition_Number"))


def panel_pca(spark, sf):
    return panels.panel_loadings(panel_matrix(spark, sf)).withColumns(r6("eigenvector", "loading"))


def panel_trace(spark, sf):
    """Sum of all eigenvalues (the trace) and of squared PC1 coefficients (one) of each panel."""
    m = panel_matrix(spark, sf)
    values = panels.panel_eigenvalues(m).groupBy("panel_id").agg(F.round(F.sum("eigenvalue"), 6).alias("eigenvalue_sum"), F.count("*").alias("traits"))
    unit = panels.panel_loadings(m).groupBy("panel_id").agg(F.round(F.sum(F.col("eigenvector") * F.col("eigenvector")), 6).alias("unit_length"))
    return values.join(unit, "panel_id")


def all_pc_loadings(spark, sf):
    """Products of standardised loadings rebuild a positive definite matrix: checked entry by entry."""
    loads = panels.all_loadings(two_trait_panels(spark, sf))
    other = loads.select("panel_id", "PC", F.col("i").alias("j"), F.col("loading").alias("other"))
    return loads.join(other, ["panel_id", "PC"]).groupBy("panel_id", "i", "j").agg(F.round(F.sum(F.col("loading") * F.col("other")), 6).alias("value"))


def pc1_reports(spark, sf):
    m = panel_matrix(spark, sf)
    return panels.pc1_report(panels.panel_loadings(m), panels.panel_eigenvalues(m)).withColumns(r6("PC1_Eigenvalue", "PC1_Loading_Median_Used"))


def cti_assessment(spark, sf):
    return panels.assess_cti(panel_matrix(spark, sf, "I")).withColumns(
        r6("CTI_Minimum_Eigenvalue", "CTI_Maximum_Eigenvalue", "CTI_Condition_Number", "CTI_Eigenvalue_Threshold"))


def matrix_assessment(spark, sf):
    m = panel_matrix(spark, sf)
    values = panels.panel_eigenvalues(m)
    return panels.matrix_assessment(panels.assess_cti(panel_matrix(spark, sf, "I")), panels.pc1_report(panels.panel_loadings(m), values), values).select(
        "panel_id", "PC1_QC_Status", "CTI_Status", "Combination_Matrix_Eligible", F.round("PC1_PC2_Gap", 6).alias("PC1_PC2_Gap"))


def cti_explore_drop(spark, sf):
    """Trait 2 made a multiple of trait 1 in the CTI: it must go wherever both are present."""
    broken = panel_matrix(spark, sf, "I").withColumn("value", F.when((F.col("i") == 2) & (F.col("j") == 2), F.lit(0.25))
                                                     .when(F.col("i").isin(1, 2) & F.col("j").isin(1, 2) & (F.col("i") != F.col("j")), F.lit(0.5))
                                                     .when((F.col("i") == 1) & (F.col("j") == 1), F.lit(1.0))
                                                     .when((F.least("i", "j") <= 2) & (F.greatest("i", "j") > 2), F.lit(0.0))
                                                     .when((F.least("i", "j") == 0) & (F.greatest("i", "j") > 0), F.lit(0.0)).otherwise(F.col("value")))
    return panels.cti_explore_drop(broken, panel_matrix(spark, sf), 0.3).select("panel_id", "step", "traits", "PC1_Status", "CTI_Status", "dropped", "outcome")


def selection_sensitivity(spark, sf):
    loads = panels.panel_loadings(panel_matrix(spark, sf))
    return panels.selection_sensitivity(loads.filter("panel_id = 'all'"), loads.filter("panel_id <> 'all'"))[1].withColumns(r6("loading_rmse", "maximum_absolute_change"))


def failed_graph(spark, sf):
    """Per panel: failed pairs and trait status of the pair table with failures."""
    m = pq.manifest(spark, sf)
    validity = pairs.pair_validity(pq.scaled(spark, sf), m).filter(~F.col("Pair_Valid"))
    own = pairs.self_pair_qc(pq.scaled(spark, sf), m)
    member = members(spark, sf)
    traits = member.join(own, "trait_order").select("panel_id", "trait_order", (~F.col("Self_QC_Pass")).alias("self_failed"),
                                                    F.col("Self_QC_Failure_Reason").alias("self_reason"), "H2_Z")
    failed = validity.join(member.select("panel_id", F.col("trait_order").alias("pair_i")), "pair_i").join(
        member.select("panel_id", F.col("trait_order").alias("pair_j")), ["panel_id", "pair_j"], "left_semi")
    return failed, traits


def selected_traits(spark, sf):
    return panels.select_complete_traits(*failed_graph(spark, sf)).withColumns(r6("H2_Z"))


def bundle(spark, sf):
    """S, I and S_Stand of every panel with one missing pair and one non-positive heritability."""
    own = pairs.self_pair_qc(pq.scaled(spark, sf, pq.clean), pq.manifest(spark, sf)).select("trait_order", F.col("Self_H2").alias("h2"))
    cov = matrices.covariance_matrix(cells(spark, sf, "S_Stand").withColumn("panel_id", F.lit("x")), own).select("i", "j", "value")
    parts = cov.withColumn("matrix", F.lit("S")).unionByName(cells(spark, sf, "I").withColumn("matrix", F.lit("I"))).unionByName(
        cells(spark, sf, "S_Stand").withColumn("matrix", F.lit("S_Stand")))
    value = (F.when((F.col("matrix") == "S") & (F.col("i") == 6) & (F.col("j") == 6), F.lit(-0.1))
             .when((F.col("matrix") == "I") & (F.col("i") == 2) & (F.col("j").isin(4, 5)), F.lit(None)).otherwise(F.col("value")))
    rows = matrices.subset_panels(parts.withColumn("value", value), members(spark, sf))
    se = rows.filter("matrix = 'S'").select("panel_id", "i", "j", F.lit(0.1).alias("h_se"), F.when(F.least("i", "j") + F.greatest("i", "j") == 13, F.lit(0.0)).otherwise(F.lit(0.2)).alias("rg_se"))
    return rows.select("panel_id", "matrix", "i", "j", "value"), se


def bundle_trait_reasons(spark, sf):
    return panels.bundle_trait_reasons(*bundle(spark, sf)).select("panel_id", "i", "reason", "diagonal_inconsistent")


def bundle_pair_reasons(spark, sf):
    return panels.bundle_pair_reasons(*bundle(spark, sf))


def bundle_consistency(spark, sf):
    rows, _ = bundle(spark, sf)
    return panels.bundle_consistency(rows).select("panel_id", "consistent", "unusable", F.round("maximum_error", 6).alias("maximum_error"))


def bundle_removals(spark, sf):
    rows, se = bundle(spark, sf)
    return panels.bundle_drop_traits(panels.bundle_trait_reasons(rows, se), panels.bundle_pair_reasons(rows, se))


def sampling_covariance(spark, sf):
    """A covariance over the 36 pairs of eight traits, entry values from the lineitem statistics of both pairs."""
    grid = pairs.plan_pairs(pq.manifest(spark, sf), unordered=True).select("o1", "o2", (F.expr("o1 * 8 - o1 * (o1 - 1) div 2 + o2 - o1")).alias("p"))
    stat = pq.frame(spark, sf, pq._STATS, "pstat").select(F.col("lo").alias("o1"), F.col("hi").alias("o2"), F.col("s"))
    rows = grid.join(stat, ["o1", "o2"]).select("p", "s")
    n = F.explode(F.sequence(F.lit(0), F.lit(35))).alias("q")
    both = rows.select("p", "s", n).join(rows.select(F.col("p").alias("q"), F.col("s").alias("s2")), "q")
    return both.select(F.lit("all").alias("panel_id"), F.col("p").cast("bigint").alias("pair_a"), F.col("q").cast("bigint").alias("pair_b"),
                       (F.when(F.col("p") == F.col("q"), F.col("s") - F.when(F.col("p") == 9, 2 * F.col("s")).otherwise(0)).otherwise(F.col("s") + F.col("s2")).cast("double") / 1000).alias("value"))


def vech_subset(spark, sf):
    """Traits 5, 2 and 7, in that order."""
    order = pq.manifest(spark, sf).filter("trait_order IN (2, 5, 7)").select(
        F.lit("all").alias("panel_id"), F.col("trait_order").cast("bigint").alias("old_position"),
        F.expr("CASE trait_order WHEN 5 THEN 0 WHEN 2 THEN 1 ELSE 2 END").cast("bigint").alias("new_position"))
    return matrices.subset_vech(sampling_covariance(spark, sf), order).withColumns(r6("value"))


def vech_errors(spark, sf):
    return matrices.vech_se(sampling_covariance(spark, sf)).withColumns(r6("se"))


_ALL = pq._CLEAN_ALL
_TWO = "two AS (SELECT concat('T', i, '-T', j) AS panel_id, i, j, value AS r FROM cells WHERE matrix = 'S_Stand' AND i < j)"
_MEMBERS = "members AS (SELECT 'all' AS panel_id, trait_order AS t FROM manifest UNION ALL SELECT concat('without_', a.trait), b.trait_order FROM manifest a, manifest b WHERE a.trait <> b.trait)"
_PANELCELLS = "pc AS (SELECT a.panel_id, c.i, c.j, c.matrix, c.value FROM cells c JOIN members a ON a.t = c.i JOIN members b ON b.t = c.j AND b.panel_id = a.panel_id)"
_BUNDLE = f"""{pq._COV}, bd AS (SELECT panel_id, matrix, i, j, CASE WHEN matrix = 'S' AND i = 6 AND j = 6 THEN CAST('-0.1' AS DOUBLE) WHEN matrix = 'I' AND i = 2 AND j IN (4, 5) THEN NULL ELSE value END AS value
  FROM (SELECT a.panel_id, c.matrix, c.i, c.j, c.value FROM (SELECT matrix, i, j, value FROM cells WHERE matrix IN ('I', 'S_Stand') UNION ALL SELECT 'S', i, j, value FROM cov) c
  JOIN members a ON a.t = c.i JOIN members b ON b.t = c.j AND b.panel_id = a.panel_id))"""
_VPOS = "grid AS (SELECT lo, hi, s, lo * 8 - lo * (lo - 1) // 2 + hi - lo AS p FROM pstat), vv AS (SELECT a.lo AS al, a.hi AS ah, b.lo AS bl, b.hi AS bh, a.p AS pa, b.p AS pb, CAST(CASE WHEN a.p = b.p THEN CASE WHEN a.p = 9 THEN -a.s ELSE a.s END ELSE a.s + b.s END AS DOUBLE) / 1000 AS value FROM grid a, grid b)"
_NEW = "CASE {c} WHEN 5 THEN 0 WHEN 2 THEN 1 ELSE 2 END"


def _newpos(a, b):
    x, y = _NEW.format(c=a), _NEW.format(c=b)
    low, high = f"least({x}, {y})", f"greatest({x}, {y})"
    return f"CAST({low} * 3 - {low} * ({low} - 1) // 2 + {high} - {low} AS BIGINT)"




def _power(name: str, matrix: str, value: str = "value", rounds: int = 1500) -> str:
    """Largest eigenvalue and its vector per panel by power iteration, for matrices without negative eigenvalues."""
    return f"""{name}_it AS (SELECT panel_id, t AS i, CAST(1 AS DOUBLE) + CAST(t AS DOUBLE) / 10 AS x, 0 AS k FROM members UNION ALL
  SELECT panel_id, i, y / sqrt(sum(y * y) OVER (PARTITION BY panel_id)), k + 1 FROM (SELECT m.panel_id, m.i, sum(({value}) * t.x) AS y, max(t.k) AS k
  FROM {name}_it t JOIN {matrix} m ON m.panel_id = t.panel_id AND m.j = t.i WHERE t.k < {rounds} GROUP BY 1, 2) z),
{name}_v AS (SELECT panel_id, i, x * CASE WHEN arg_max(x, abs(x)) OVER (PARTITION BY panel_id) < 0 THEN -1 ELSE 1 END AS x FROM {name}_it WHERE k = {rounds}),
{name} AS (SELECT m.panel_id, sum(a.x * ({value}) * b.x) AS lambda FROM {matrix} m JOIN {name}_v a ON a.panel_id = m.panel_id AND a.i = m.i JOIN {name}_v b ON b.panel_id = m.panel_id AND b.i = m.j GROUP BY 1)"""


_REC = _ALL.replace("WITH ", "WITH RECURSIVE ", 1)
_SPLIT = "ms AS (SELECT panel_id, i, j, value FROM pc WHERE matrix = 'S_Stand'), mi AS (SELECT panel_id, i, j, value FROM pc WHERE matrix = 'I')"
_PC1 = f"""{_REC}, {_MEMBERS}, {_PANELCELLS}, {_SPLIT}, {_power('e1', 'ms')},
ld0 AS (SELECT v.panel_id, v.i, v.x, v.x * sqrt(e.lambda) AS l, e.lambda FROM e1_v v JOIN e1 e ON e.panel_id = v.panel_id),
ld AS (SELECT *, CASE WHEN median(l) OVER (PARTITION BY panel_id) < 0 THEN -1 ELSE 1 END AS s FROM ld0)"""
_CTI = f"""{_power('h', 'mi')}, {_power('g', 'mi', 'CASE WHEN m.i = m.j THEN 2 - value ELSE -value END', 4000)},
ct AS (SELECT h.panel_id, 2 - g.lambda AS low, h.lambda AS high FROM h JOIN g ON g.panel_id = h.panel_id)"""
_SECOND = f"""md AS (SELECT m.panel_id, m.i, m.j, m.value - e.lambda * a.x * b.x AS value FROM ms m JOIN e1 e ON e.panel_id = m.panel_id JOIN e1_v a ON a.panel_id = m.panel_id AND a.i = m.i
  JOIN e1_v b ON b.panel_id = m.panel_id AND b.i = m.j), {_power('e2', 'md', rounds=4000)}"""
_PASS = "'PC1 numerical checks passed'"

_PRE = f"{pq._D}, {pq._IDX.format(t='dirty')}, {pq._OK}, {pq._GRID}"
_LIVE = "list_filter(bp, lambda q: NOT list_contains(gone, q.a) AND NOT list_contains(gone, q.b))"
_WORST = f"list_max(list_transform(ms, lambda m: {{'d': len(list_filter({_LIVE}, lambda q: q.a = m.t OR q.b = m.t)), 's': -m.z, 'n': m.t}}))"
#: The greedy selection as a recursion: what is gone grows by the trait with most failed pairs left (then lower Z, then later position).
_SELECTED = f"""{_PRE.replace('WITH ', 'WITH RECURSIVE ', 1)}, pv AS ({pq.QUERIES['pair_validity'][1][len(_PRE):]}), {pq._SELF}, so AS ({pq._SELF_OUT}), {_MEMBERS},
mm AS (SELECT m.panel_id, m.t, NOT so.Self_QC_Pass AS sf, so.Self_QC_Failure_Reason AS why, so.H2_Z FROM members m JOIN so ON so.trait_order = m.t),
ed AS (SELECT DISTINCT a.panel_id, pair_i AS a, pair_j AS b FROM pv JOIN members a ON a.t = pair_i JOIN members b ON b.t = pair_j AND b.panel_id = a.panel_id WHERE NOT Pair_Valid),
dg AS (SELECT panel_id, t, count(*) AS k FROM (SELECT panel_id, a AS t FROM ed UNION ALL SELECT panel_id, b FROM ed WHERE a <> b) x GROUP BY 1, 2),
walk AS (SELECT p.panel_id, 0 AS step, g.gone, coalesce(e.bp, []) AS bp, p.ms, CAST(0 AS BIGINT) AS d FROM (SELECT panel_id, list({{'t': t, 'z': CASE WHEN isfinite(H2_Z) THEN H2_Z ELSE -1e300 END}}) AS ms FROM mm GROUP BY 1) p
  JOIN (SELECT panel_id, coalesce(list(t ORDER BY t) FILTER (WHERE sf), []) AS gone FROM mm GROUP BY 1) g ON g.panel_id = p.panel_id LEFT JOIN (SELECT panel_id, list({{'a': a, 'b': b}}) AS bp FROM ed WHERE a <> b GROUP BY 1) e ON e.panel_id = p.panel_id
  UNION ALL SELECT panel_id, step + 1, list_append(gone, ({_WORST}).n), bp, ms, ({_WORST}).d FROM walk WHERE len({_LIVE}) > 0)
SELECT w.panel_id, CAST(len(w.gone) AS INT) AS exclusion_step, mm.t AS trait_order, '{panels.GREEDY_REASON}' AS reason, CAST(w.d AS INT) AS failed_pairs, {q6('mm.H2_Z')} AS H2_Z FROM walk w JOIN mm ON mm.panel_id = w.panel_id AND mm.t = w.gone[len(w.gone)] WHERE w.step > 0
UNION ALL SELECT mm.panel_id, CAST(row_number() OVER (PARTITION BY mm.panel_id ORDER BY mm.t) AS INT), mm.t, mm.why, CAST(coalesce(dg.k, 0) AS INT), {q6('mm.H2_Z')} FROM mm LEFT JOIN dg ON dg.panel_id = mm.panel_id AND dg.t = mm.t WHERE mm.sf"""

QUERIES = {
    "panel_cells": (panel_cells, f"{_ALL}, {_MEMBERS}, {_PANELCELLS} SELECT panel_id, i, j, {q6('value')} AS value FROM pc WHERE matrix = 'S_Stand'"),
    "pair_loadings": (pair_loadings, f"{_ALL}, {_TWO} SELECT panel_id, k AS i, 'PASS' AS qc_status, {q6('sqrt((1 + abs(r)) / 2) * CASE WHEN r < 0 AND k = j THEN -1 ELSE 1 END')} AS loading "
                      "FROM (SELECT *, unnest([i, j]) AS k FROM two) x"),
    "pair_eigenvalues": (pair_eigenvalues, f"{_ALL}, {_TWO} SELECT panel_id, CAST(k AS INT) AS PC, false AS negative, false AS substantive_negative, {q6('CASE k WHEN 1 THEN 1 + abs(r) ELSE 1 - abs(r) END')} AS eigenvalue "
                         "FROM (SELECT *, unnest([1, 2]) AS k FROM two) x"),
    "pair_variance": (pair_variance, f"{_ALL}, {_TWO} SELECT panel_id, CAST(k AS INT) AS PC, true AS conventional_partition, {q6('50 * CASE k WHEN 1 THEN 1 + abs(r) ELSE 1 - abs(r) END')} AS percent_raw, "
                      f"{q6('CASE k WHEN 1 THEN 50 * (1 + abs(r)) ELSE 100 END')} AS cumulative_percent_raw, {q6('50 * CASE k WHEN 1 THEN 1 + abs(r) ELSE 1 - abs(r) END')} AS percent_positive, "
                      f"{q6('CASE k WHEN 1 THEN 50 * (1 + abs(r)) ELSE 100 END')} AS cumulative_percent_positive FROM (SELECT *, unnest([1, 2]) AS k FROM two) x"),
    "pair_contributions": (pair_contributions, f"{_ALL}, {_TWO} SELECT panel_id, unnest([i, j]) AS i, CAST(50 AS DOUBLE) AS contribution_percent, CAST(1 AS INT) AS contribution_rank FROM two"),
    "pair_cti": (pair_cti, f"{_ALL}, {_TWO} SELECT panel_id, 'PASS' AS CTI_Status, true AS CTI_Cholesky_Pass, CAST(0 AS INT) AS CTI_Negative_Eigenvalues, {q6('1 - abs(r)')} AS CTI_Minimum_Eigenvalue, "
                 "round((1 + abs(r)) / (1 - abs(r)), 4) AS CTI_Condition_Number FROM two"),
    "panel_pca": (panel_pca, f"{_PC1} SELECT panel_id, i, {q6('x * s')} AS eigenvector, {q6('l * s')} AS loading, CAST(s AS DOUBLE) AS sign_multiplier, 'PASS' AS qc_status, {_PASS} AS qc_reasons FROM ld"),
    "panel_trace": (panel_trace, f"{_ALL}, {_MEMBERS} SELECT panel_id, CAST(count(*) AS DOUBLE) AS eigenvalue_sum, count(*) AS traits, CAST(1 AS DOUBLE) AS unit_length FROM members GROUP BY panel_id"),
    "all_pc_loadings": (all_pc_loadings, f"{_ALL}, {_TWO} SELECT panel_id, i, j, {q6('r')} AS value FROM two UNION ALL SELECT panel_id, j, i, {q6('r')} FROM two "
                        "UNION ALL SELECT panel_id, i, i, 1 FROM two UNION ALL SELECT panel_id, j, j, 1 FROM two"),
    "pc1_reports": (pc1_reports, f"{_PC1} SELECT panel_id, count(*) AS Trait_Count, CAST(max(s) AS DOUBLE) AS PC1_Sign_Multiplier, {q6('median(l * s)')} AS PC1_Loading_Median_Used, 'PASS' AS PC1_QC_Status, "
                    f"{_PASS} AS PC1_QC_Reasons, {q6('max(ld.lambda)')} AS PC1_Eigenvalue, 0 AS Matrix_Negative_Eigenvalue_Count, 0 AS Matrix_Substantive_Negative_Eigenvalue_Count, "
                    "true AS Matrix_Policy_Allows_Analysis FROM ld GROUP BY panel_id"),
    "cti_assessment": (cti_assessment, f"{_REC}, {_MEMBERS}, {_PANELCELLS}, {_SPLIT}, {_CTI} SELECT panel_id, 'PASS' AS CTI_Status, {q6('low')} AS CTI_Minimum_Eigenvalue, {q6('high')} AS CTI_Maximum_Eigenvalue, "
                       f"0 AS CTI_Negative_Eigenvalues, {q6('high / low')} AS CTI_Condition_Number, true AS CTI_Cholesky_Pass, CAST(0 AS DOUBLE) AS CTI_Eigenvalue_Threshold, CAST(1e8 AS DOUBLE) AS CTI_Condition_Limit FROM ct"),
    "matrix_assessment": (matrix_assessment, f"{_PC1}, {_SECOND} SELECT e1.panel_id, 'PASS' AS PC1_QC_Status, 'PASS' AS CTI_Status, true AS Combination_Matrix_Eligible, "
                          f"{q6('e1.lambda - e2.lambda')} AS PC1_PC2_Gap FROM e1 JOIN e2 ON e2.panel_id = e1.panel_id"),
    "cti_explore_drop": (cti_explore_drop, f"{_ALL}, {_MEMBERS}, q AS (SELECT panel_id, count(*) AS k, count(*) FILTER (WHERE t IN (1, 2)) = 2 AS bad FROM members GROUP BY panel_id) "
                         "SELECT panel_id, 0 AS step, k AS traits, 'PASS' AS PC1_Status, CASE WHEN bad THEN 'SINGULAR_OR_ILL_CONDITIONED' ELSE 'PASS' END AS CTI_Status, CASE WHEN bad THEN 2 END AS dropped, "
                         "CASE WHEN bad THEN 'CONTINUE' ELSE 'PASS' END AS outcome FROM q UNION ALL SELECT panel_id, 1, k - 1, 'PASS', 'PASS', NULL, 'PASS' FROM q WHERE bad"),
    "selection_sensitivity": (selection_sensitivity, f"{_PC1}, d0 AS (SELECT b.panel_id, a.l * a.s AS o, b.l * b.s AS r FROM ld a JOIN ld b ON b.i = a.i WHERE a.panel_id = 'all' AND b.panel_id <> 'all'), "
                              "d1 AS (SELECT panel_id, r * CASE WHEN sum(o * r) OVER (PARTITION BY panel_id) < 0 THEN -1 ELSE 1 END - o AS d FROM d0) "
                              f"SELECT panel_id, {q6('sqrt(avg(d * d))')} AS loading_rmse, {q6('max(abs(d))')} AS maximum_absolute_change FROM d1 GROUP BY panel_id"),
    "selected_traits": (selected_traits, _SELECTED),
    "bundle_trait_reasons": (bundle_trait_reasons, f"{_ALL}, {_MEMBERS}, {_BUNDLE}, o AS (SELECT panel_id, i, max(value) FILTER (WHERE matrix = 'S') AS s, max(value) FILTER (WHERE matrix = 'I') AS c, max(value) FILTER (WHERE matrix = 'S_Stand') AS st FROM bd WHERE i = j GROUP BY 1, 2) "
                             "SELECT panel_id, i, concat_ws('; ', CASE WHEN NOT coalesce(isfinite(s) AND s > 0, false) THEN 'Non-finite or non-positive heritability' END, CASE WHEN NOT coalesce(isfinite(c) AND c > 0, false) THEN 'Non-finite or non-positive self intercept' END, "
                             "CASE WHEN NOT coalesce(isfinite(st), false) THEN 'Non-finite standardized diagonal' END) AS reason, coalesce(abs(st - 1) > 1e-8, false) AS diagonal_inconsistent FROM o"),
    "bundle_pair_reasons": (bundle_pair_reasons, f"{_ALL}, {_MEMBERS} SELECT a.panel_id, a.t AS pair_i, b.t AS pair_j, concat_ws('; ', CASE WHEN a.t = 2 AND b.t IN (4, 5) THEN 'Missing/non-finite I pair estimate' END, "
                            "CASE WHEN a.t + b.t = 13 THEN 'Non-finite or non-positive rg SE' END) AS reason FROM members a JOIN members b ON b.panel_id = a.panel_id AND a.t < b.t"),
    "bundle_consistency": (bundle_consistency, f"{_ALL}, {_MEMBERS}, {_BUNDLE}, dg AS (SELECT panel_id, i, value FROM bd WHERE matrix = 'S' AND i = j), g AS (SELECT s.panel_id, abs(CASE WHEN a.value * b.value > 0 THEN s.value / sqrt(a.value * b.value) END - r.value) AS e "
                           "FROM bd s JOIN bd r ON r.matrix = 'S_Stand' AND r.panel_id = s.panel_id AND r.i = s.i AND r.j = s.j JOIN dg a ON a.panel_id = s.panel_id AND a.i = s.i JOIN dg b ON b.panel_id = s.panel_id AND b.i = s.j WHERE s.matrix = 'S') "
                           f"SELECT panel_id, count(*) FILTER (WHERE e IS NULL) = 0 AND max(e) <= 1e-8 AS consistent, count(*) FILTER (WHERE e IS NULL) AS unusable, {q6('max(e)')} AS maximum_error FROM g GROUP BY panel_id"),
    "bundle_removals": (bundle_removals, f"{_ALL}, {_MEMBERS}, h AS (SELECT panel_id, bool_or(t = 6) AS six, bool_or(t = 2) AS two, bool_or(t = 4) AS four, bool_or(t = 5) AS five FROM members GROUP BY panel_id) "
                        "SELECT panel_id, 1 AS step, 'warning' AS Severity, 6 AS trait_order, 'Non-finite or non-positive heritability' AS Reason, 'removed' AS Action FROM h WHERE six UNION ALL "
                        "SELECT panel_id, 1 + six::INT, 'warning', 2, 'Removed to resolve invalid pairs: ' || concat_ws('; ', CASE WHEN four THEN '2: 4: Missing/non-finite I pair estimate' END, "
                        "CASE WHEN five THEN '2: 5: Missing/non-finite I pair estimate' END), 'removed' FROM h WHERE two AND (four OR five)"),
    "vech_subset": (vech_subset, f"WITH {pq._STATS}, {_VPOS} SELECT 'all' AS panel_id, {_newpos('al', 'ah')} AS pair_a, {_newpos('bl', 'bh')} AS pair_b, {q6('value')} AS value FROM vv "
                    "WHERE al IN (2, 5, 7) AND ah IN (2, 5, 7) AND bl IN (2, 5, 7) AND bh IN (2, 5, 7)"),
    "vech_errors": (vech_errors, f"WITH {pq._STATS}, {_VPOS} SELECT 'all' AS panel_id, al AS i, ah AS j, CASE WHEN value >= 0 THEN {q6('sqrt(value)')} END AS se FROM vv WHERE pa = pb "
                    f"UNION ALL SELECT 'all', ah, al, CASE WHEN value >= 0 THEN {q6('sqrt(value)')} END FROM vv WHERE pa = pb AND al < ah"),
}
