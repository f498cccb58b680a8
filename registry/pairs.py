"""Queries over trait-pair tables computed from lineitem: QC, selection, normalisation, reports."""
from __future__ import annotations

from pyspark.sql import functions as F

from assocspark.functions.tails import two_sided_p_sql
from assocspark.operators import matrices, pairs

from assocspark.session import durable

from . import views as v
from .views import q6, r6

# Base statistics of every unordered trait pair and of every trait; integers, so both engines agree exactly.
_STATS = """src AS (SELECT CAST(l_suppkey % 8 AS INT) AS i, CAST(l_orderkey % 8 AS INT) AS j, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
pstat AS (SELECT least(i, j) AS lo, greatest(i, j) AS hi, count(*) AS n, CAST(sum(q) AS BIGINT) AS s FROM src GROUP BY 1, 2),
tstat AS (SELECT i AS t, CAST(sum(q) AS BIGINT) AS ts, count(*) AS tn FROM src GROUP BY 1),
directed AS (SELECT lo AS i, hi AS j, n, s, 0 AS rep FROM pstat UNION ALL SELECT hi, lo, n, s, 0 FROM pstat WHERE lo < hi
  UNION ALL SELECT lo, hi, n, s, 1 FROM pstat WHERE (lo + hi) % 3 = 0),
base AS (SELECT d.i, d.j, n, s, rep, CAST(i * 1000 + j * 10 + rep AS INT) AS row_id, concat('T', CAST(i AS STRING)) AS p1, concat('T', CAST(j AS STRING)) AS p2,
  CAST(100 + ts % 400 AS DOUBLE) / 1000 AS h2, CAST(1 + tn % 40 AS DOUBLE) / 200 AS h2_se, CAST(950 + ts % 100 AS DOUBLE) / 1000 AS h2_int, CAST(5 + tn % 20 AS DOUBLE) / 1000 AS h2_int_se,
  CAST(s % 200 - 100 AS DOUBLE) / 1000 AS gcov_int, CAST(5 + n % 20 AS DOUBLE) / 1000 AS gcov_int_se, CAST(s % 1000 AS DOUBLE) / 1000 AS p0, CAST(10 + n % 90 AS DOUBLE) / 1000 AS se0
  FROM directed d JOIN tstat t ON t.t = d.j)"""

NAN, INF = "CAST('NaN' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)"
_BAD = "least(i, j) = 0 AND greatest(i, j) = 4 AND rep = 0"
_ZERO = "i = 3 AND j = 3"
# Failures of every kind: missing and one-sided pairs, conflicts, NaN, the zero-SE exception, a negative h2.
DIRTY = f"""{_STATS}, dirty0 AS (SELECT *, CASE WHEN {_ZERO} THEN 1 WHEN {_BAD} THEN {NAN} WHEN i = j THEN 1 + CAST(n % 7 - 3 AS DOUBLE) / 1000
    WHEN rep = 1 AND least(i, j) = 1 THEN CAST(s % 2101 - 1050 AS DOUBLE) / 1000 + CAST(10 AS DOUBLE) / 1000 ELSE CAST(s % 2101 - 1050 AS DOUBLE) / 1000 END AS rg,
  CASE WHEN {_ZERO} THEN 0 WHEN {_BAD} THEN NULL ELSE se0 END AS se FROM base WHERE NOT (i = 2 AND j = 5) AND NOT (least(i, j) = 1 AND greatest(i, j) = 6)),
dirty AS (SELECT row_id, i, j, p1, p2, rg, se, CASE WHEN {_ZERO} THEN {INF} WHEN {_BAD} THEN NULL ELSE rg / nullif(se, 0) + CASE WHEN s % 5 = 0 AND i <> j THEN 1 ELSE 0 END END AS z,
  CASE WHEN {_ZERO} THEN 0 WHEN i = 5 AND j = 7 THEN CAST(3 AS DOUBLE) / 2 WHEN {_BAD} THEN NULL ELSE p0 END AS p, h2_int, h2_int_se, gcov_int, gcov_int_se,
  CASE WHEN j = 7 AND i = 7 THEN -h2 WHEN j = 4 THEN NULL ELSE h2 END AS h2_obs, CASE WHEN j = 4 THEN NULL ELSE h2_se END AS h2_obs_se,
  CASE WHEN j IN (4, 5) THEN h2 / 2 END AS h2_liab, CASE WHEN j IN (4, 5) THEN h2_se / 2 END AS h2_liab_se FROM dirty0)"""
# Complete and consistent, with native estimates on most rows and one deviation of each kind.
_N1 = "h2a * CASE WHEN i = j THEN 1 ELSE CAST(8 + j AS DOUBLE) / 10 END"
_N2 = "h2 * CASE WHEN i = j THEN 1 ELSE CAST(8 + i AS DOUBLE) / 10 END"
CLEAN = f"""{_STATS}, clean0 AS (SELECT b.*, CAST(100 + o.ts % 400 AS DOUBLE) / 1000 AS h2a,
  CASE WHEN i = j THEN 1 ELSE CAST(s % 2001 - 1000 AS DOUBLE) / 4000 END AS rg FROM base b JOIN tstat o ON o.t = b.i),
clean AS (SELECT row_id, i, j, p1, p2, rg, se0 AS se, rg / se0 AS z, p0 AS p, h2_int, h2_int_se, gcov_int, gcov_int_se, {_N2} AS h2_obs, h2_se AS h2_obs_se,
  CAST(NULL AS DOUBLE) AS h2_liab, CAST(NULL AS DOUBLE) AS h2_liab_se FROM clean0)"""
_NATIVE_GONE = "(i + j) % 5 = 4 AND i <> j"
NATIVE = f"""{CLEAN}, native AS (SELECT c.row_id, c.i, c.j, c.p1, c.p2, c.rg, c.h2_obs, CASE WHEN c.i = 6 AND c.j = 0 THEN c.h2_obs END AS h2_liab,
  CASE WHEN {_NATIVE_GONE.replace('i ', 'c.i ').replace(' j', ' c.j').replace('(i', '(c.i')} THEN NULL ELSE c.rg * sqrt(({_N1}) * c.h2_obs) * CASE WHEN c.i = 1 AND c.j = 3 THEN 1 + CAST(1 AS DOUBLE) / 1000 ELSE 1 END END AS gcov_native_obs,
  CASE WHEN {_NATIVE_GONE.replace('i ', 'c.i ').replace(' j', ' c.j').replace('(i', '(c.i')} THEN NULL WHEN c.i = 2 AND c.j = 3 THEN -({_N1}) ELSE {_N1} END AS h2_p1_pair_obs,
  CASE WHEN {_NATIVE_GONE.replace('i ', 'c.i ').replace(' j', ' c.j').replace('(i', '(c.i')} THEN NULL ELSE c.h2_obs END AS h2_p2_pair_obs FROM clean c JOIN clean0 d ON d.row_id = c.row_id
  WHERE NOT (c.i = 7 AND c.j = 2) AND NOT (c.i = 5 AND c.j = 5))"""
NATIVE = NATIVE.replace(_N1, _N1.replace("h2a", "d.h2a").replace("i = j", "c.i = c.j").replace("8 + j", "8 + c.j"))
MANIFEST = f"""mani AS (SELECT DISTINCT concat('T', CAST(l_suppkey % 8 AS STRING)) AS trait, CAST(l_suppkey % 8 AS INT) AS trait_order FROM lineitem),
manifest AS (SELECT trait, trait_order, CASE WHEN trait_order % 2 = 0 THEN 'yes' ELSE 'no' END AS ref,
  CASE WHEN trait_order IN (4, 5) THEN CAST(1 AS DOUBLE) / 100 END AS population_prevalence FROM mani)"""


def frame(spark, sf, ctes: str, name: str):
    text = f"WITH {ctes} SELECT * FROM {name}".replace("FROM lineitem", f"FROM parquet.`{sf}/lineitem.parquet`")
    # The pair table is what later steps read many times, as from storage; at most pairs x repeats rows.
    return durable(spark.sql(text))


def dirty(spark, sf):
    return frame(spark, sf, DIRTY, "dirty").drop("i", "j")


def clean(spark, sf):
    return frame(spark, sf, CLEAN, "clean").drop("i", "j")


def native(spark, sf):
    return frame(spark, sf, NATIVE, "native").drop("i", "j")


def manifest(spark, sf):
    return frame(spark, sf, MANIFEST, "manifest")


def indexed(spark, sf, rows=dirty):
    return pairs.index_pairs(rows(spark, sf), manifest(spark, sf))


def scaled(spark, sf, rows=dirty, policy="observed"):
    """Indexed rows on one heritability scale."""
    typed, _ = pairs.select_h2_scale(rows(spark, sf), policy)
    return pairs.index_pairs(typed, manifest(spark, sf))


# --- operators -----------------------------------------------------------------------------------

def numeric_guard(spark, sf):
    text = dirty(spark, sf).withColumns({"z": F.when(F.col("p1") == "T1", "1.2x").otherwise(F.col("z").cast("string")),
                                         "p": F.when(F.col("p1") == "T2", " NA ").otherwise(F.col("p").cast("string"))})
    return pairs.coerce_numeric(text, ["z", "p"], "row_id")[1]


def planned_pairs(spark, sf):
    return pairs.plan_pairs(manifest(spark, sf))


def pair_coverage(spark, sf):
    return pairs.pair_coverage(dirty(spark, sf), pairs.plan_pairs(manifest(spark, sf)))


def trait_availability(spark, sf):
    present = dirty(spark, sf).filter("p1 <> 'T6' AND p2 <> 'T6'")
    return pairs.trait_availability(manifest(spark, sf), present).select("trait", "trait_order", "present", "reason")


def restricted_pairs(spark, sf):
    kept = manifest(spark, sf).filter("trait_order NOT IN (1, 4)")
    return pairs.sort_by_manifest(pairs.restrict(dirty(spark, sf), kept), kept, "row_id").select("row_id", "p1", "p2")


def h2_scales(spark, sf):
    return pairs.select_h2_scale(dirty(spark, sf), "mixed")[1]


def h2_scaled_rows(spark, sf):
    return pairs.select_h2_scale(dirty(spark, sf), "auto")[0].select("row_id", "H2_Scale", F.round("h2", 6).alias("h2"), F.round("h2_se", 6).alias("h2_se"))


def h2_mapped(spark, sf):
    return pairs.map_h2_scale(dirty(spark, sf), manifest(spark, sf)).select("row_id", "h2_scale", "h2_obs", "h2_obs_se", "h2_liab", "h2_liab_se")


def pair_status(spark, sf):
    return pairs.pair_status(dirty(spark, sf)).select("row_id", "p1", "p2", "Status", "Reason", "Warning")


#: A stricter self-pair and a higher warning line than the defaults; both change the outcome.
STRICT = {"self_rg_tolerance": 1e-4, "h2_z_warning": 12.0}


def pair_status_strict(spark, sf):
    return pairs.pair_status(dirty(spark, sf), **STRICT).select("row_id", "p1", "p2", "Status", "Reason", "Warning")


def duplicate_conflicts_strict(spark, sf):
    return pairs.duplicate_conflicts(indexed(spark, sf), tolerance=1e-6, z_tolerance=1e-6)


def duplicate_conflicts(spark, sf):
    return pairs.duplicate_conflicts(indexed(spark, sf))


def collapsed_pairs(spark, sf):
    return pairs.collapse_pairs(indexed(spark, sf, clean)).withColumns(r6(*pairs.DUPLICATE_COLUMNS))


def pair_validity(spark, sf):
    return pairs.pair_validity(scaled(spark, sf), manifest(spark, sf))


def self_pair_qc(spark, sf):
    out = pairs.self_pair_qc(scaled(spark, sf), manifest(spark, sf))
    return out.select("trait", "trait_order", "Self_Source_Rows", "Self_QC_Pass", "Self_QC_Failure_Reason", "Self_QC_Note", "H2_Z_Below_Warning_Threshold",
                      F.round("Self_RG", 6).alias("Self_RG"), F.round("Self_H2", 6).alias("Self_H2"), F.round("H2_Z", 6).alias("H2_Z"),
                      F.round("Self_H2_Intercept", 6).alias("Self_H2_Intercept"))


def trait_status(spark, sf):
    rows = dirty(spark, sf)
    status = pairs.pair_status(rows).select("row_id", "p1", "p2", "Status", "Reason")
    gone = pairs.pair_coverage(rows, pairs.plan_pairs(manifest(spark, sf))).filter("coverage = 'missing'").select(
        F.lit(10 ** 9).alias("row_id"), "p1", "p2", F.lit("missing_result").alias("Status"), F.lit("Missing requested comparison").alias("Reason"))
    return pairs.trait_status(rows, status.unionByName(gone), manifest(spark, sf), "row_id")


def normalized(spark, sf):
    return pairs.trait_wide_normalization(native(spark, sf), "row_id")


def trait_wide_normalization(spark, sf):
    return normalized(spark, sf).select("row_id", "p1", "p2", "normalization_status", F.round("gcov_pair", 6).alias("gcov_pair"),
                                        F.round("rg_trait_wide", 6).alias("rg_trait_wide"))


def normalization_counts(spark, sf):
    return pairs.status_counts(normalized(spark, sf))


def trait_wide_values(spark, sf):
    return pairs.trait_wide_values(pairs.index_pairs(normalized(spark, sf), manifest(spark, sf))).withColumns(r6("value", "spread"))


def selected_rg(spark, sf):
    """Trait-wide correlations of the complete table, without native fields."""
    rows = pairs.index_pairs(pairs.trait_wide_normalization(clean(spark, sf), "row_id"), manifest(spark, sf))
    return pairs.select_rg(pairs.collapse_pairs(rows), rows, "trait_wide").withColumns(r6("rg_used"))


def heritability_report(spark, sf):
    return pairs.heritability_report(pairs.self_pair_qc(scaled(spark, sf, clean), manifest(spark, sf))).withColumns(
        r6("Heritability", "Heritability_SE", "Z", "P", "h2_int", "h2_int_se"))


def rg_report(spark, sf):
    return pairs.rg_report(pairs.collapse_pairs(indexed(spark, sf)), manifest(spark, sf)).withColumns(
        r6("rg", "SE", "Z", "Z_From_RG_SE", "Z_Relative_Difference", "P", "gcov_int", "gcov_int_se")).select(
        "pair_i", "pair_j", "Trait_1", "Trait_2", F.when(~F.isnan("rg"), F.col("rg")).alias("rg"), "SE", "Z", "Z_From_RG_SE", "Z_Relative_Difference",
        "Z_Inconsistent_With_RG_SE", "P", "gcov_int", "gcov_int_se", "Source_Rows_Collapsed", "RG_Outside_Unit_Interval")


def validation_summary(spark, sf):
    m = manifest(spark, sf)
    rows = scaled(spark, sf, clean)
    collapsed = pairs.collapse_pairs(rows)
    return pairs.validation_summary(pairs.self_pair_qc(rows, m), collapsed, pairs.rg_report(collapsed, m)).withColumns(r6("Self_H2", "Self_H2_SE", "Self_H2_Z"))


def validated(spark, sf):
    m = manifest(spark, sf)
    rows = durable(scaled(spark, sf, clean))
    collapsed = pairs.collapse_pairs(rows)
    return pairs.Validated(pairs.self_pair_qc(rows, m), collapsed, pairs.rg_report(collapsed, m))


def _summary(valid, policy, **more):
    return valid.summary(policy, **more).withColumns(r6("Self_RG", "Self_RG_Deviation", "Self_H2", "Self_H2_SE", "Self_H2_Z")).drop("Minimum_Intercept_Matrix_Eigenvalue")


def validation_policy(spark, sf):
    """The summary of all traits with the tolerances and actions in force."""
    policy = pairs.PairPolicy(z_consistency_action="error", comparison_epsilon=1e-9)
    return _summary(validated(spark, sf), policy, source_rows_read=clean(spark, sf).count())


def validated_subset(spark, sf):
    """The summary after two traits were removed: every count is that of the traits left."""
    return _summary(validated(spark, sf).subset(manifest(spark, sf).filter("trait NOT IN ('T2', 'T5')")), pairs.PairPolicy())


def events(spark, sf):
    status = pairs.pair_status(dirty(spark, sf)).filter("Status <> 'valid'").select(
        F.col("row_id").alias("event"), F.when(F.col("p1") == F.col("p2"), "warning").otherwise("error").alias("Severity"), F.col("p1").alias("Trait"),
        F.col("p2").alias("Other_Trait"), "Reason", F.when(F.col("p1") == "T7", "removed").otherwise("retained").alias("Action"))
    return status


def audit_summary(spark, sf):
    return pairs.audit_summary(events(spark, sf), manifest(spark, sf), "event")


def matrix_cells(spark, sf):
    rows = scaled(spark, sf, clean)
    return matrices.assemble_matrices(pairs.collapse_pairs(rows), pairs.self_pair_qc(rows, manifest(spark, sf))).withColumns(r6("value"))


def correlation(spark, sf):
    rows = scaled(spark, sf, clean)
    cells = matrices.assemble_matrices(pairs.collapse_pairs(rows), pairs.self_pair_qc(rows, manifest(spark, sf)))
    return cells.filter("matrix = 'S_Stand'").select(F.lit("all").alias("panel_id"), "i", "j", "value")


def covariance(spark, sf):
    own = pairs.self_pair_qc(scaled(spark, sf, clean), manifest(spark, sf)).select("trait_order", F.col("Self_H2").alias("h2"))
    return matrices.covariance_matrix(correlation(spark, sf), own)


def covariance_cells(spark, sf):
    return covariance(spark, sf).select("i", "j", F.round("value", 6).alias("value"), F.round("reconstruction_error", 6).alias("reconstruction_error"))


def covariance_report(spark, sf):
    m = manifest(spark, sf)
    report = pairs.rg_report(pairs.collapse_pairs(indexed(spark, sf, clean)), m)
    return matrices.covariance_report(report, covariance(spark, sf)).select(
        "Trait_1", "Trait_2", F.round("rg", 6).alias("rg"), F.round("Heritability_1", 6).alias("Heritability_1"),
        F.round("Heritability_2", 6).alias("Heritability_2"), F.round("Genetic_Covariance_Derived", 6).alias("Genetic_Covariance_Derived"))


def symmetry(spark, sf):
    skewed = correlation(spark, sf).withColumn("value", F.when((F.col("i") == 1) & (F.col("j") == 2), F.col("value") + 1e-3)
                                               .when((F.col("i") == 0) & (F.col("j") == 5), F.lit(None)).otherwise(F.col("value")))
    return matrices.symmetry_summary(skewed).withColumns(r6("maximum_asymmetry"))


def symmetrized(spark, sf):
    skewed = correlation(spark, sf).withColumn("value", F.when((F.col("i") == 1) & (F.col("j") == 2), F.col("value") + 1e-3).otherwise(F.col("value")))
    return matrices.symmetrize(skewed).select("i", "j", "valid", F.round("value", 6).alias("value"))


# --- the same in SQL -----------------------------------------------------------------------------

def _fin(c):
    return f"({c} IS NOT NULL AND isfinite({c}))"


def _given(c):
    return f"({c} IS NOT NULL AND NOT isnan({c}))"


_IDX = "ix AS (SELECT *, least(i, j) AS pair_i, greatest(i, j) AS pair_j FROM {t})"
_ZS = "(p1 = p2 AND abs(rg - 1) <= CAST('0.01' AS DOUBLE) AND se = 0 AND z = CAST('Infinity' AS DOUBLE) AND p = 0)"


def _status_sql():
    marks = []
    unused = " AND ".join(f"NOT {_given(c)}" for c in ("h2_obs", "h2_obs_se", "h2_liab", "h2_liab_se"))
    for c in (*pairs.BASE_NUMERIC, "h2_obs", "h2_obs_se", "h2_liab", "h2_liab_se"):
        active = "true"
        if c.startswith(("h2_obs", "h2_liab")):
            stem = "h2_obs" if c.startswith("h2_obs") else "h2_liab"
            active = f"({_given(stem)} OR {_given(stem + '_se')} OR ({unused}))"
        finite = f"({_fin(c)} OR coalesce({_ZS}, false))" if c == "z" else _fin(c)
        marks.append((f"({active} AND NOT {finite})", f"Non-finite estimate {c}"))
        if c == "se":
            marks.append((f"{_given(c)} AND {c} <= 0 AND NOT coalesce({_ZS}, false)", f"Non-positive estimate {c}"))
        elif c.endswith("_se") or c in ("h2_obs", "h2_liab"):
            marks.append((f"{_given(c)} AND {c} <= 0", f"Non-positive estimate {c}"))
    marks.append((f"{_given('p')} AND NOT p BETWEEN 0 AND 1", "P value outside [0,1]"))
    marks.append((f"p1 = p2 AND {_fin('rg')} AND abs(rg - 1) > CAST('0.01' AS DOUBLE) + 1e-12", "Self-pair rg differs from 1 beyond tolerance 0.01"))
    warns = [(f"p1 <> p2 AND {_fin('rg')} AND abs(rg) > 1", "Estimated rg outside [-1,1]"), (_ZS, "Self-pair rg SE=0, Z=+Inf, P=0; diagnostic exception only")]
    warns += [(f"p1 = p2 AND {h} > 0 AND {h}_se > 0 AND {h} / {h}_se < 2", f"Low self {h}/SE (<2); diagnostic only") for h in ("h2_obs", "h2_liab")]
    return (f"st AS (SELECT *, CASE WHEN Reason = '' THEN 'valid' ELSE 'failed_estimate' END AS Status FROM (SELECT *, {v.marks_sql(marks)} AS Reason, {v.marks_sql(warns)} AS Warning FROM dirty) x)")


def _strict(sql: str) -> str:
    """The comparison under the limits of STRICT."""
    for old, new in (("CAST('0.01' AS DOUBLE)", "CAST('0.0001' AS DOUBLE)"), ("tolerance 0.01", "tolerance 0.0001"), ("_se < 2", "_se < 12"), ("(<2)", "(<12)")):
        assert old in sql
        sql = sql.replace(old, new)
    return sql


def _conflict_sql(cols, own=False):
    tests = []
    for c in cols:
        f, pos, neg = f"count(*) FILTER (WHERE {_fin(c)})", f"count(*) FILTER (WHERE {c} = CAST('Infinity' AS DOUBLE))", f"count(*) FILTER (WHERE {c} = CAST('-Infinity' AS DOUBLE))"
        tol = "CAST('0.01' AS DOUBLE)" if c == "z" else "CAST('0.001' AS DOUBLE)"
        test = f"((({f}) > 0)::INT + (({pos}) > 0)::INT + (({neg}) > 0)::INT + (({f}) + ({pos}) + ({neg}) < count(*))::INT > 1 OR " \
               f"max({c}) FILTER (WHERE {_fin(c)}) - min({c}) FILTER (WHERE {_fin(c)}) > {tol} + 1e-12)"
        tests.append((f"pair_i = pair_j AND {test}" if own else test, c))
    return tests


_CONFLICTS = v.marks_sql(_conflict_sql(pairs.DUPLICATE_COLUMNS) + _conflict_sql(("h2_obs", "h2_obs_se", "h2_liab", "h2_liab_se", "h2_int", "h2_int_se"), own=True), ",")
# Row validity on the observed scale (h2 = h2_obs); inactive scales of a self-pair do not count.
_VALID = " AND ".join(
    [_fin(c) for c in ("rg", "p", "h2_int", "h2_int_se", "gcov_int", "gcov_int_se", "h2_obs", "h2_obs_se")]
    + [f"({_fin('z')} AND {_fin('se')} AND se > 0 OR coalesce({_ZS}, false))", "h2_obs_se > 0 AND h2_int_se > 0 AND gcov_int_se > 0", "p BETWEEN 0 AND 1",
       "(p1 <> p2 OR (h2_obs > 0 AND abs(rg - 1) <= CAST('0.01' AS DOUBLE) + 1e-12))",
       "(p1 <> p2 OR (h2_liab IS NULL AND h2_liab_se IS NULL) OR (h2_liab > 0 AND h2_liab_se > 0))"])
_OK = f"ok AS (SELECT *, coalesce({_VALID}, false) AS valid FROM ix)"
_GRID = "grid AS (SELECT a.trait_order AS pair_i, b.trait_order AS pair_j FROM manifest a JOIN manifest b ON a.trait_order <= b.trait_order)"
_COVER = """wanted AS (SELECT a.trait AS p1, b.trait AS p2 FROM manifest a, manifest b WHERE a.ref = 'yes'),
cover AS (SELECT p1, p2, 'missing' AS coverage FROM (SELECT p1, p2 FROM wanted EXCEPT SELECT p1, p2 FROM dirty) a
  UNION ALL SELECT p1, p2, 'unexpected' FROM (SELECT p1, p2 FROM dirty EXCEPT SELECT p1, p2 FROM wanted) b)"""
_COLL = "coll AS (SELECT pair_i, pair_j, " + ", ".join(f"avg({c}) AS {c}" for c in pairs.DUPLICATE_COLUMNS) + ", count(*) AS source_row_count FROM ix GROUP BY 1, 2)"
_SELF = """own AS (SELECT m.trait, m.trait_order, count(x.p1) AS n, avg(rg) AS rg, avg(se) AS se, avg(h2_obs) AS h2, avg(h2_obs_se) AS h2_se, avg(h2_int) AS h2_int, avg(h2_int_se) AS h2_int_se
  FROM manifest m LEFT JOIN ix x ON x.pair_i = m.trait_order AND x.pair_j = m.trait_order GROUP BY 1, 2)"""
_SELF_FAIL = """CASE WHEN n = 0 THEN 'Missing self-pair' WHEN trait_order = 4 THEN 'Non-finite required self-pair value'
  WHEN trait_order = 7 THEN 'Non-positive self-pair heritability in a source row' ELSE '' END"""
_SELF_OUT = f"""SELECT trait, trait_order, n AS Self_Source_Rows, f = '' AS Self_QC_Pass, f AS Self_QC_Failure_Reason,
  CASE WHEN trait_order = 3 THEN 'Self-pair rg SE=0, Z=+Inf, P=0; diagnostic exception only' ELSE '' END AS Self_QC_Note, coalesce(h2 / h2_se < 2, false) AS H2_Z_Below_Warning_Threshold,
  {q6('rg')} AS Self_RG, {q6('h2')} AS Self_H2, {q6('h2 / h2_se')} AS H2_Z, {q6('h2_int')} AS Self_H2_Intercept FROM (SELECT *, {_SELF_FAIL} AS f FROM own) z"""
_TSTATUS = f"""allst AS (SELECT row_id, p1, p2, Status, Reason FROM st UNION ALL SELECT 1000000000, p1, p2, 'missing_result', 'Missing requested comparison' FROM cover WHERE coverage = 'missing'),
fails AS (SELECT t, count(*) AS k FROM (SELECT p1 AS t FROM allst WHERE Status <> 'valid' UNION ALL SELECT p2 FROM allst WHERE Status <> 'valid' AND p1 <> p2) GROUP BY t),
whys AS (SELECT t, string_agg(Reason, '; ' ORDER BY r) AS why FROM (SELECT p1 AS t, Reason, min(row_id) AS r FROM allst WHERE p1 = p2 AND Reason <> '' GROUP BY 1, 2) GROUP BY t),
selfs AS (SELECT p1 AS t, bool_and(Status = 'valid') AS ok FROM allst WHERE p1 = p2 GROUP BY 1),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p1 ORDER BY row_id) AS k FROM dirty WHERE p1 = p2) WHERE k = 1)
SELECT m.trait_order, m.trait, CASE WHEN s.ok IS NULL THEN 'not_requested' WHEN s.ok THEN 'valid' ELSE 'failed_estimate' END AS Self_Status, coalesce(w.why, '') AS Self_Reason,
  coalesce(f.k, 0) AS Failed_Pair_Rows, h2_obs, h2_obs_se, h2_liab, h2_liab_se, h2_int, h2_int_se
FROM manifest m LEFT JOIN selfs s ON s.t = m.trait LEFT JOIN fails f ON f.t = m.trait LEFT JOIN whys w ON w.t = m.trait LEFT JOIN firsts x ON x.p1 = m.trait"""


def _norm_ctes(source: str) -> str:
    """Normalisation over a table with row_id, p1, p2, rg, h2_obs, h2_liab and the native fields."""
    pos = lambda c: f"({c} IS NOT NULL AND isfinite({c}) AND {c} > 0)"
    no = lambda t: f"NOT coalesce({t}, false)"
    return f"""n0 AS (SELECT *, (gcov_native_obs IS NOT NULL OR h2_p1_pair_obs IS NOT NULL OR h2_p2_pair_obs IS NOT NULL) AS nat, coalesce(h2_obs, h2_liab) AS h,
  CASE WHEN h2_obs IS NOT NULL AND h2_liab IS NULL THEN 'observed' WHEN h2_liab IS NOT NULL AND h2_obs IS NULL THEN 'liability' END AS sc FROM {source}),
n1 AS (SELECT *, CASE WHEN nat THEN h2_p2_pair_obs ELSE h2_obs END AS nh FROM n0),
lk AS (SELECT p1, p2, count(DISTINCT concat_ws('|', coalesce(CAST(h AS STRING), '~'), coalesce(sc, '~'))) = 1 AS one,
  count(DISTINCT concat_ws('|', coalesce(CAST(gcov_native_obs AS STRING), '~'), coalesce(CAST(h2_p1_pair_obs AS STRING), '~'), coalesce(CAST(h2_p2_pair_obs AS STRING), '~'))) = 1 AS none,
  first(h ORDER BY row_id) AS h, first(sc ORDER BY row_id) AS sc, first(nh ORDER BY row_id) AS nh FROM n1 GROUP BY p1, p2),
j0 AS (SELECT r.*, l.one, l.none, CASE WHEN r.nat THEN h2_p1_pair_obs * a.h / nullif(a.nh, 0) ELSE o.h END AS oh, CASE WHEN r.nat THEN a.sc ELSE o.sc END AS osc,
  CASE WHEN r.nat THEN true ELSE o.one END AS oone, a.h AS ah, a.sc AS asc_, a.nh AS anh, a.one AS aone, a.none AS anone, b.h AS bh, b.sc AS bsc, b.nh AS bnh, b.one AS bone, b.none AS bnone
  FROM n1 r JOIN lk l ON l.p1 = r.p1 AND l.p2 = r.p2 LEFT JOIN lk o ON o.p1 = r.p2 AND o.p2 = r.p1 LEFT JOIN lk a ON a.p1 = r.p1 AND a.p2 = r.p1 LEFT JOIN lk b ON b.p1 = r.p2 AND b.p2 = r.p2),
j1 AS (SELECT *, rg * sqrt(h) * sqrt(CASE WHEN oh >= 0 THEN oh END) AS gp FROM j0),
j2 AS (SELECT *, CASE WHEN oone IS NULL THEN 'missing_reverse_pair' WHEN aone IS NULL OR bone IS NULL THEN 'missing_self_pair'
  WHEN NOT (one AND oone AND aone AND bone) THEN 'ambiguous_heritability' WHEN nat AND NOT (none AND anone AND bnone) THEN 'ambiguous_native_estimate'
  WHEN nat AND {no(' AND '.join([_fin('gcov_native_obs'), pos('h2_p1_pair_obs'), pos('h2_p2_pair_obs'), pos('anh'), pos('bnh')]))} THEN 'invalid_native_estimate'
  WHEN {no(' AND '.join([pos('h'), pos('oh'), pos('ah'), pos('bh'), _fin('rg')]))} THEN 'invalid_estimate'
  WHEN {no('sc = bsc AND osc = asc_')} THEN 'incompatible_or_ambiguous_scale'
  WHEN nat AND {no('abs(gcov_native_obs / sqrt(h2_p1_pair_obs) / sqrt(h2_p2_pair_obs) - rg) <= 1e-10 + 1e-8 * abs(rg) AND abs((h / h2_p2_pair_obs) / (bh / bnh) - 1) <= 1e-8')}
  THEN 'inconsistent_native_estimate' ELSE 'calculated' END AS normalization_status FROM j1),
norm AS (SELECT row_id, p1, p2, normalization_status, CASE WHEN normalization_status = 'calculated' THEN gp END AS gcov_pair, CASE WHEN normalization_status = 'calculated' THEN
  CASE WHEN p1 = p2 THEN CAST(1 AS DOUBLE) WHEN nat THEN gcov_native_obs / sqrt(anh) / sqrt(bnh) ELSE gp / sqrt(ah) / sqrt(bh) END END AS rg_trait_wide FROM j2)"""


_CLEAN_NORM = f"{CLEAN}, plain AS (SELECT *, CAST(NULL AS DOUBLE) AS gcov_native_obs, CAST(NULL AS DOUBLE) AS h2_p1_pair_obs, CAST(NULL AS DOUBLE) AS h2_p2_pair_obs FROM clean), {_norm_ctes('plain')}"
_IDX_NORM = "ixn AS (SELECT *, least(substr(p1, 2)::INT, substr(p2, 2)::INT) AS pair_i, greatest(substr(p1, 2)::INT, substr(p2, 2)::INT) AS pair_j FROM norm)"
_CELLS = """cells AS (SELECT matrix, i, j, value FROM (
  SELECT unnest(['S_Stand', 'I', 'rg_se', 'intercept_se']) AS matrix, pair_i AS i, pair_j AS j, unnest([rg, gcov_int, se, gcov_int_se]) AS value FROM coll WHERE pair_i < pair_j UNION ALL
  SELECT unnest(['S_Stand', 'I', 'rg_se', 'intercept_se']), pair_j, pair_i, unnest([rg, gcov_int, se, gcov_int_se]) FROM coll WHERE pair_i < pair_j UNION ALL
  SELECT unnest(['S_Stand', 'I', 'rg_se', 'intercept_se']), trait_order, trait_order, unnest([CAST(1 AS DOUBLE), h2_int, se, h2_int_se]) FROM own))"""
_CLEAN_ALL = f"WITH {CLEAN}, {MANIFEST}, {_IDX.format(t='clean')}, {_COLL}, {_SELF}, {_CELLS}"
_ZREL = "abs(z - rg / se) / greatest(1, abs(z), abs(rg / se))"
_RG_OUT = f"""SELECT pair_i, pair_j, concat('T', pair_i) AS Trait_1, concat('T', pair_j) AS Trait_2, CASE WHEN isfinite(rg) THEN {q6('rg')} END AS rg, {q6('se')} AS SE, {q6('z')} AS Z, {q6('rg / se')} AS Z_From_RG_SE,
  {q6(_ZREL)} AS Z_Relative_Difference, coalesce({_ZREL} > CAST('0.01' AS DOUBLE) + 1e-12, false) AS Z_Inconsistent_With_RG_SE, {q6('p')} AS P, {q6('gcov_int')} AS gcov_int, {q6('gcov_int_se')} AS gcov_int_se,
  source_row_count AS Source_Rows_Collapsed, coalesce(NOT isnan(rg) AND abs(rg) > 1, false) AS RG_Outside_Unit_Interval FROM coll WHERE pair_i < pair_j"""
_COV = """cov AS (SELECT c.i, c.j, c.value AS rg, a.h2 AS h2_i, b.h2 AS h2_j, CASE WHEN c.i = c.j THEN a.h2 ELSE c.value * (sqrt(a.h2) * sqrt(b.h2)) END AS value
  FROM cells c JOIN own a ON a.trait_order = c.i JOIN own b ON b.trait_order = c.j WHERE matrix = 'S_Stand')"""
_EV = "ev AS (SELECT row_id, CASE WHEN p1 = p2 THEN 'warning' ELSE 'error' END AS sev, p1, p2, Reason, p1 = 'T7' AS removed FROM st WHERE Status <> 'valid')"
_AUDIT = """ends AS (SELECT row_id, sev, p1 AS t, Reason FROM ev UNION ALL SELECT row_id, sev, p2, Reason FROM ev WHERE p1 <> p2),
f AS (SELECT t, Reason, min(row_id) AS o, min(row_id) FILTER (WHERE sev = 'warning') AS w FROM ends GROUP BY 1, 2),
g AS (SELECT t, string_agg(Reason, '; ' ORDER BY o) AS a, string_agg(Reason, '; ' ORDER BY w) FILTER (WHERE w IS NOT NULL) AS w FROM f GROUP BY t)
SELECT m.trait_order, m.trait, m.trait IN (SELECT p1 FROM ev WHERE removed) AS Removed, coalesce(g.w, '') AS Warning_Reasons, coalesce(g.a, '') AS All_QC_Reasons FROM manifest m LEFT JOIN g ON g.t = m.trait"""
_POLICY_SQL = f"""k AS (SELECT count(*) AS k FROM manifest), r AS ({_RG_OUT}), tot AS (SELECT CAST(sum(source_row_count) AS BIGINT) AS rows, count(*) AS uniq FROM coll)
SELECT trait_order, trait, n > 0 AS Self_Pair_Found, true AS Self_QC_Pass, false AS Self_RG_Zero_SE_Exception, '' AS Self_QC_Note, {q6('rg')} AS Self_RG, {q6('abs(rg - 1)')} AS Self_RG_Deviation,
  {q6('h2')} AS Self_H2, {q6('h2_se')} AS Self_H2_SE, CAST(NULL AS STRING) AS Heritability_Scale_Used, {q6('h2 / h2_se')} AS Self_H2_Z, h2 / h2_se < 2 AS Low_H2_Z_Diagnostic,
  (SELECT count(*) FROM coll WHERE trait_order IN (pair_i, pair_j)) AS Unique_Pairs_With_Selected_Traits, k.k AS Expected_Pairs_With_Selected_Traits, tot.rows AS Selected_Source_Rows,
  k.k * (k.k + 1) // 2 AS Expected_Unique_Rows, tot.uniq AS Observed_Unique_Rows, tot.rows - tot.uniq AS Duplicate_Rows_Collapsed,
  (SELECT count(*) FROM own WHERE h2 / h2_se < 2) AS Low_H2_Z_Diagnostic_Count, (SELECT count(*) FROM r WHERE Z_Inconsistent_With_RG_SE) AS Z_Inconsistent_With_RG_SE_Count,
  (SELECT count(*) FROM r WHERE RG_Outside_Unit_Interval) AS Off_Diagonal_RG_Outside_Unit_Interval, {{read}} AS Total_Source_Rows_Read, CAST('0.001' AS DOUBLE) AS Duplicate_Tolerance,
  CAST('0.01' AS DOUBLE) AS Duplicate_Z_Tolerance, CAST('0.01' AS DOUBLE) AS Self_RG_Tolerance, CAST('{{epsilon}}' AS DOUBLE) AS Comparison_Epsilon, CAST(2 AS DOUBLE) AS H2_Z_Warn_Threshold,
  CAST('0.01' AS DOUBLE) AS Z_Consistency_Tolerance, '{{z_action}}' AS Z_Consistency_Action, 'warn' AS RG_Out_Of_Range_Action FROM own, k, tot"""
_D = f"WITH {DIRTY}, {MANIFEST}"
_SKEW = "sk AS (SELECT i, j, CASE WHEN i = 1 AND j = 2 THEN value + CAST('0.001' AS DOUBLE) {e} ELSE value END AS value FROM cells WHERE matrix = 'S_Stand'), mm AS (SELECT a.*, b.value AS m FROM sk a JOIN sk b ON a.i = b.j AND a.j = b.i)"
_SKEW_E = _SKEW.format(e="WHEN i = 0 AND j = 5 THEN NULL")

QUERIES = {
    "numeric_guard": (numeric_guard, f"{_D} SELECT row_id AS row, 'z' AS \"column\", '1.2x' AS value FROM dirty WHERE i = 1"),
    "planned_pairs": (planned_pairs, f"{_D} SELECT a.trait AS p1, b.trait AS p2, a.trait_order AS o1, b.trait_order AS o2 FROM manifest a, manifest b WHERE a.ref = 'yes'"),
    "pair_coverage": (pair_coverage, f"{_D}, {_COVER} SELECT * FROM cover"),
    "trait_availability": (trait_availability, f"{_D} SELECT trait, trait_order, trait <> 'T6' AS present, CASE WHEN trait = 'T6' THEN 'Absent from pair p1/p2 columns' END AS reason FROM manifest"),
    "restricted_pairs": (restricted_pairs, f"{_D} SELECT row_id, p1, p2 FROM dirty WHERE i NOT IN (1, 4) AND j NOT IN (1, 4)"),
    "h2_scales": (h2_scales, f"{_D} SELECT trait, CASE trait_order WHEN 4 THEN 'liability' WHEN 5 THEN NULL ELSE 'observed' END AS H2_Scale, "
                  "CASE WHEN trait_order = 5 THEN 'Ambiguous heritability scale: both are populated' END AS error FROM manifest"),
    "h2_scaled_rows": (h2_scaled_rows, f"{_D} SELECT row_id, CASE j WHEN 4 THEN 'liability' WHEN 5 THEN NULL ELSE 'observed' END AS H2_Scale, "
                       f"{q6('CASE j WHEN 4 THEN h2_liab WHEN 5 THEN NULL ELSE h2_obs END')} AS h2, {q6('CASE j WHEN 4 THEN h2_liab_se WHEN 5 THEN NULL ELSE h2_obs_se END')} AS h2_se FROM dirty"),
    "h2_mapped": (h2_mapped, f"{_D} SELECT row_id, CASE WHEN j IN (4, 5) THEN 'liability' ELSE 'NEF_unconverted' END AS h2_scale, CASE WHEN j IN (4, 5) THEN h2_obs ELSE coalesce(h2_obs, h2_liab) END AS h2_obs, "
                  "CASE WHEN j IN (4, 5) THEN h2_obs_se ELSE coalesce(h2_obs_se, h2_liab_se) END AS h2_obs_se, CASE WHEN j IN (4, 5) THEN h2_liab END AS h2_liab, CASE WHEN j IN (4, 5) THEN h2_liab_se END AS h2_liab_se FROM dirty"),
    "pair_status": (pair_status, f"WITH {DIRTY}, {_status_sql()} SELECT row_id, p1, p2, Status, Reason, Warning FROM st"),
    "pair_status_strict": (pair_status_strict, _strict(f"WITH {DIRTY}, {_status_sql()} SELECT row_id, p1, p2, Status, Reason, Warning FROM st")),
    "duplicate_conflicts_strict": (duplicate_conflicts_strict, f"WITH {DIRTY}, {_IDX.format(t='dirty')} SELECT pair_i, pair_j, count(*) AS source_rows, CASE WHEN count(*) > 1 THEN "
                                   + _CONFLICTS.replace("CAST('0.01' AS DOUBLE)", "1e-6").replace("CAST('0.001' AS DOUBLE)", "1e-6") + " ELSE '' END AS conflicts FROM ix GROUP BY 1, 2"),
    "duplicate_conflicts": (duplicate_conflicts, f"WITH {DIRTY}, {_IDX.format(t='dirty')} SELECT pair_i, pair_j, count(*) AS source_rows, CASE WHEN count(*) > 1 THEN {_CONFLICTS} ELSE '' END AS conflicts FROM ix GROUP BY 1, 2"),
    "collapsed_pairs": (collapsed_pairs, f"{_CLEAN_ALL} SELECT pair_i, pair_j, source_row_count, " + ", ".join(f"{q6(c)} AS {c}" for c in pairs.DUPLICATE_COLUMNS) + " FROM coll"),
    "pair_validity": (pair_validity, f"{_D}, {_IDX.format(t='dirty')}, {_OK}, {_GRID} SELECT g.pair_i, g.pair_j, count(o.p1) AS Source_Rows, count(*) FILTER (WHERE NOT o.valid) AS Invalid_Source_Rows, "
                      "count(o.p1) > 0 AND count(*) FILTER (WHERE NOT o.valid) = 0 AS Pair_Valid FROM grid g LEFT JOIN ok o ON o.pair_i = g.pair_i AND o.pair_j = g.pair_j GROUP BY 1, 2"),
    "self_pair_qc": (self_pair_qc, f"{_D}, {_IDX.format(t='dirty')}, {_SELF} {_SELF_OUT}"),
    "trait_status": (trait_status, f"{_D}, {_status_sql()}, {_COVER}, {_TSTATUS}"),
    "trait_wide_normalization": (trait_wide_normalization, f"WITH {NATIVE}, {_norm_ctes('native')} SELECT row_id, p1, p2, normalization_status, {q6('gcov_pair')} AS gcov_pair, {q6('rg_trait_wide')} AS rg_trait_wide FROM norm"),
    "normalization_counts": (normalization_counts, f"WITH {NATIVE}, {_norm_ctes('native')} SELECT normalization_status, count(*) AS rows FROM norm GROUP BY 1"),
    "trait_wide_values": (trait_wide_values, f"WITH {NATIVE}, {_norm_ctes('native')}, {_IDX_NORM} SELECT pair_i, pair_j, {q6('avg(rg_trait_wide)')} AS value, {q6('max(rg_trait_wide) - min(rg_trait_wide)')} AS spread, "
                          "count(*) FILTER (WHERE normalization_status <> 'calculated') AS unavailable_rows FROM ixn GROUP BY 1, 2"),
    "selected_rg": (selected_rg, f"WITH {_CLEAN_NORM}, {_IDX_NORM} SELECT pair_i, pair_j, {q6('avg(rg_trait_wide)')} AS rg_used FROM ixn GROUP BY 1, 2"),
    "heritability_report": (heritability_report, f"{_CLEAN_ALL} SELECT trait_order, trait, {q6('h2')} AS Heritability, {q6('h2_se')} AS Heritability_SE, {q6('h2 / h2_se')} AS Z, "
                            f"{q6(two_sided_p_sql('(h2 / h2_se)'))} AS P, {q6('h2_int')} AS h2_int, {q6('h2_int_se')} AS h2_int_se FROM own"),
    "rg_report": (rg_report, f"{_D}, {_IDX.format(t='dirty')}, {_COLL} {_RG_OUT}"),
    "validation_summary": (validation_summary, f"""{_CLEAN_ALL}, k AS (SELECT count(*) AS k FROM manifest), r AS ({_RG_OUT}),
tot AS (SELECT CAST(sum(source_row_count) AS BIGINT) AS rows, count(*) AS uniq FROM coll)
SELECT trait_order, trait, true AS Self_QC_Pass, {q6('h2')} AS Self_H2, {q6('h2_se')} AS Self_H2_SE, {q6('h2 / h2_se')} AS Self_H2_Z, h2 / h2_se < 2 AS Low_H2_Z_Diagnostic,
  (SELECT count(*) FROM coll WHERE trait_order IN (pair_i, pair_j)) AS Unique_Pairs_With_Selected_Traits, k.k AS Expected_Pairs_With_Selected_Traits, tot.rows AS Selected_Source_Rows,
  k.k * (k.k + 1) // 2 AS Expected_Unique_Rows, tot.uniq AS Observed_Unique_Rows, tot.rows - tot.uniq AS Duplicate_Rows_Collapsed,
  (SELECT count(*) FROM own WHERE h2 / h2_se < 2) AS Low_H2_Z_Diagnostic_Count, (SELECT count(*) FROM r WHERE Z_Inconsistent_With_RG_SE) AS Z_Inconsistent_With_RG_SE_Count,
  (SELECT count(*) FROM r WHERE RG_Outside_Unit_Interval) AS Off_Diagonal_RG_Outside_Unit_Interval FROM own, k, tot"""),
    "validation_policy": (validation_policy, f"{_CLEAN_ALL}, {_POLICY_SQL.format(z_action='error', epsilon='1e-9', read='(SELECT count(*) FROM clean)')}"),
    "validated_subset": (validated_subset, f"WITH {CLEAN}, {MANIFEST.replace('manifest AS', 'everyone AS', 1)}, manifest AS (SELECT * FROM everyone WHERE trait NOT IN ('T2', 'T5')), {_IDX.format(t='clean').replace('ix AS', 'ix0 AS', 1)}, "
                         f"ix AS (SELECT * FROM ix0 WHERE pair_i NOT IN (2, 5) AND pair_j NOT IN (2, 5)), {_COLL}, {_SELF}, {_POLICY_SQL.format(z_action='warn', epsilon='1e-12', read='CAST(NULL AS BIGINT)')}"),
    "audit_summary": (audit_summary, f"{_D}, {_status_sql()}, {_EV}, {_AUDIT}"),
    "matrix_cells": (matrix_cells, f"{_CLEAN_ALL} SELECT matrix, i, j, {q6('value')} AS value FROM cells"),
    "covariance_cells": (covariance_cells, f"{_CLEAN_ALL}, {_COV} SELECT i, j, {q6('value')} AS value, CAST(0 AS DOUBLE) AS reconstruction_error FROM cov"),
    "covariance_report": (covariance_report, f"{_CLEAN_ALL}, {_COV} SELECT concat('T', i) AS Trait_1, concat('T', j) AS Trait_2, {q6('rg')} AS rg, {q6('h2_i')} AS Heritability_1, {q6('h2_j')} AS Heritability_2, "
                          f"{q6('value')} AS Genetic_Covariance_Derived FROM cov WHERE i < j"),
    "symmetry": (symmetry, f"{_CLEAN_ALL}, {_SKEW_E} SELECT 'all' AS panel_id, count(*) AS entries, count(*) FILTER (WHERE NOT coalesce(abs(value - m) <= 1e-8, false)) AS invalid_entries, {q6('max(abs(value - m))')} AS maximum_asymmetry FROM mm"),
    "symmetrized": (symmetrized, f"{_CLEAN_ALL}, {_SKEW.format(e='')} SELECT i, j, abs(value - m) <= 1e-8 AS valid, {q6('(value + m) / 2')} AS value FROM mm"),
}
