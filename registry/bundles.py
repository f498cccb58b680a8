"""Matrix bundles produced by the regression, and the events that their checks leave."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assocspark.operators import bundles, pairs
from assocspark.plans import jobs
from assocspark.session import shared_folder
from assocspark.sources import tables

from . import pairs as pq
from . import panels as pn
from . import regression as rq
from . import views as v

PREVALENCE = ("CASE WHEN trait_order = 3 THEN 0.3D END AS sample_prevalence", "CASE WHEN trait_order = 3 THEN 0.01D END AS population_prevalence")


def two_pass(spark, sf):
    ld = v.ldscore(spark, sf)
    manifest = v.manifest(spark, sf).selectExpr("trait", "trait_order", *PREVALENCE)
    return manifest, jobs.two_pass_regression(rq.sumstats(spark, sf), manifest, ld, v.ldweights(spark, sf), ld.count(), n_blocks=rq.BLOCKS)


def _rounded(rows):
    return rows.select("matrix", "i", "j", (F.round("value", 8) + F.lit(0.0)).alias("value"))


def sampling_covariance_v(spark, sf):
    """S, I, V, S_Stand, V_Stand and V_Delta of the traits with positive heritability, one of them on the liability scale."""
    return _rounded(two_pass(spark, sf)[1].bundle(delta=True))


def job_bundle_matrices(spark, sf):
    """The bundle written, read back and checked: matrices of the retained traits in reverse order, V renumbered with them."""
    manifest, passed = two_pass(spark, sf)
    path = f"{shared_folder(spark)}/bundle-{uuid.uuid4().hex}"
    passed.bundle().write.parquet(path)
    turned = manifest.withColumn("trait_order", 7 - F.col("trait_order"))
    settings = jobs.PanelSettings(allow_missing_traits=True, failed_action="drop_traits", pca_matrix="covariance", validate_only=True, negative_eigen_action="ignore")
    try:
        reports = jobs.bundle_panel(tables.read_matrix_bundle(spark, path), passed.retained, turned, settings).reports
    except jobs.EstimationFailure as failure:  # PC1 or CTI of these data may fail; the matrices are what is compared
        reports = failure.audits
    out = reports["matrices"].select("matrix", "i", "j", "value")
    for name in ("V", "V_Stand"):
        out = out.unionByName(reports[name].select(F.lit(name).alias("matrix"), F.col("pair_a").alias("i"), F.col("pair_b").alias("j"), "value"))
    return _rounded(out)


def events_of(spark, sf, action):
    rows, se = pn.bundle(spark, sf)
    rows = rows.filter("panel_id = 'all'").withColumns({c: F.col(c).cast("long") for c in "ij"})
    traits = pq.manifest(spark, sf).select("trait", "trait_order")
    asked = traits.unionByName(spark.range(1).select(F.lit("T9").alias("trait"), F.lit(8).alias("trait_order")))
    policy = bundles.BundlePolicy(allow_missing_traits=action == "drop_traits", failed_action=action, rg_out_of_range_action="warn")
    labels = traits.select("trait", F.col("trait_order").alias("position"))
    return asked, *bundles.bundle_events(rows, labels, asked, policy, se=se.filter("panel_id = 'all'").withColumns({c: F.col(c).cast("long") for c in "ij"}))


def _listed(events):
    return events.select("event_order.*", "Severity", "Scope", "Trait", "Other_Trait", "Reason", F.round("Value", 6).alias("Value"), "Action")


def bundle_events(spark, sf):
    """A missing trait, an unusable one, pairs that cost a trait, and weak heritabilities, under the policy that drops traits."""
    return _listed(events_of(spark, sf, "drop_traits")[1])


def bundle_events_strict(spark, sf):
    return _listed(events_of(spark, sf, "error")[1])


def bundle_trait_summary(spark, sf):
    asked, events, kept = events_of(spark, sf, "drop_traits")
    return pairs.audit_summary(events, asked, "event_order", retained=kept)


_V = f"""fac AS (SELECT {rq._FACTOR} AS f FROM (SELECT CAST('0.01' AS DOUBLE) AS K, CAST('0.3' AS DOUBLE) AS P)),
pos AS (SELECT ta.i AS t, row_number() OVER (ORDER BY ta.i) - 1 AS p, CAST(count(*) OVER () AS INT) AS k, CASE WHEN ta.i = 3 THEN f ELSE 1 END AS f FROM ta, fac WHERE ta.i = ta.j AND ta.s > 0),
e0 AS (SELECT x.p AS i, y.p AS j, da.block, x.p * x.k - x.p * (x.p - 1) // 2 + y.p - x.p AS v, sqrt(x.f * y.f) * CASE WHEN da.i = da.j THEN ta.s ELSE tg.s END AS s, CASE WHEN da.i = da.j THEN ta.c ELSE tg.c END AS c,
  sqrt(x.f * y.f) * CASE WHEN da.i = da.j THEN da.d_s ELSE dg.d_s END AS d FROM da JOIN dg ON dg.i = da.i AND dg.j = da.j AND dg.block = da.block JOIN ta ON ta.i = da.i AND ta.j = da.j JOIN tg ON tg.i = da.i AND tg.j = da.j
  JOIN pos x ON x.t = da.i JOIN pos y ON y.t = da.j),
e1 AS (SELECT *, d - avg(d) OVER (PARTITION BY v) AS dev FROM e0),
e2 AS (SELECT a.*, 1 / sqrt(x.s * y.s) AS r, a.dev / sqrt(x.s * y.s) - a.s / sqrt(x.s * y.s) * (x.dev / x.s + y.dev / y.s) / 2 AS delta FROM e1 a JOIN e1 x ON x.i = a.i AND x.j = a.i AND x.block = a.block
  JOIN e1 y ON y.i = a.j AND y.j = a.j AND y.block = a.block),
cell AS (SELECT i, j, max(s) AS s, max(c) AS c, CASE WHEN i = j THEN 1 ELSE max(s * r) END AS st FROM e2 GROUP BY i, j),
cells3 AS (SELECT 'S' AS matrix, i, j, s AS value FROM cell UNION ALL SELECT 'I', i, j, c FROM cell UNION ALL SELECT 'S_Stand', i, j, st FROM cell),
vs AS (SELECT a.v AS i, b.v AS j, (count(*) - 1) / count(*) * sum(a.dev * b.dev) AS v, max(a.r * b.r) AS r, (count(*) - 1) / count(*) * sum(a.delta * b.delta) AS d FROM e2 a JOIN e2 b ON b.block = a.block GROUP BY a.v, b.v),
bundle AS (SELECT matrix, i, j, value FROM cells3 UNION ALL SELECT matrix, j, i, value FROM cells3 WHERE i <> j UNION ALL SELECT 'V', i, j, v FROM vs UNION ALL SELECT 'V_Stand', i, j, v * r FROM vs UNION ALL SELECT 'V_Delta', i, j, d FROM vs)"""


_TURN = f"""place AS (SELECT x.p * x.k - x.p * (x.p - 1) // 2 + y.p - x.p AS old, (x.k - 1 - y.p) * x.k - (x.k - 1 - y.p) * (x.k - 2 - y.p) // 2 + y.p - x.p AS new FROM pos x JOIN pos y ON y.p >= x.p),
turned AS (SELECT matrix, 7 - x.t AS i, 7 - y.t AS j, value FROM bundle b JOIN pos x ON x.p = b.i JOIN pos y ON y.p = b.j WHERE matrix IN ('S', 'I', 'S_Stand')
  UNION ALL SELECT matrix, x.new, y.new, value FROM bundle b JOIN place x ON x.old = b.i JOIN place y ON y.old = b.j WHERE matrix IN ('V', 'V_Stand'))"""


def _events_sql(action: str) -> str:
    strict = action == "error"
    severity, do, pair_do = ("error", "stop", "stop") if strict else ("warning", "removed", "resolve_by_trait_removal")
    missing = ("warning", "removed") if not strict else ("error", "stop")
    left = "list_filter(bp, lambda q: NOT list_contains(gone, q.a) AND NOT list_contains(gone, q.b))"
    worst = f"list_max(list_transform(range(8), lambda x: {{'d': len(list_filter({left}, lambda q: q.a = x OR q.b = x)), 'n': -x}}))"
    return f"""{pn._REC}, {pn._MEMBERS}, {pn._BUNDLE}, b AS (SELECT matrix, i, j, value FROM bd WHERE panel_id = 'all'),
z_own AS (SELECT i AS t, max(value) FILTER (WHERE matrix = 'S') AS s, max(value) FILTER (WHERE matrix = 'I') AS c, max(value) FILTER (WHERE matrix = 'S_Stand') AS st FROM b WHERE i = j GROUP BY i),
z_tr AS (SELECT t, CASE WHEN coalesce(isfinite(s) AND s > 0, false) THEN NULL ELSE 'Non-finite or non-positive heritability' END AS r1,
  CASE WHEN coalesce(isfinite(c) AND c > 0, false) THEN NULL ELSE 'Non-finite or non-positive self intercept' END AS r2, CASE WHEN coalesce(isfinite(st), false) THEN NULL ELSE 'Non-finite standardized diagonal' END AS r3 FROM z_own),
z_reasons AS (SELECT t, list_filter([r1, r2, r3], lambda x: x IS NOT NULL) AS rs FROM z_tr), z_good AS (SELECT t FROM z_reasons WHERE len(rs) = 0),
z_pr AS (SELECT x.t AS a, y.t AS b, concat_ws('; ', {", ".join(f"CASE WHEN (SELECT count(*) FROM b WHERE matrix = '{m}' AND isfinite(value) AND least(b.i, b.j) = x.t AND greatest(b.i, b.j) = y.t) < 2 THEN 'Missing/non-finite {m} pair estimate' END" for m in ("S", "I", "S_Stand"))},
  CASE WHEN x.t + y.t = 13 THEN 'Non-finite or non-positive rg SE' END) AS reason FROM z_good x JOIN z_good y ON x.t < y.t),
z_bad AS (SELECT * FROM z_pr WHERE reason <> ''), bp0 AS (SELECT coalesce(list({{'a': a, 'b': b}}), []) AS bp FROM z_bad),
z_loop AS (SELECT 0 AS step, CAST([] AS BIGINT[]) AS gone, bp FROM bp0 UNION ALL SELECT step + 1, list_append(gone, -({worst}).n), bp FROM z_loop WHERE len({left}) > 0),
z_dropped AS (SELECT DISTINCT gone[step] AS t, step FROM z_loop WHERE step > 0 AND {not strict}),
z_lines AS (SELECT CASE WHEN coalesce(x.step, 99) <= coalesce(y.step, 99) THEN z_bad.a ELSE z_bad.b END AS t, z_bad.a, z_bad.b, concat('T', z_bad.a, ': T', z_bad.b, ': ', reason) AS line FROM z_bad LEFT JOIN z_dropped x ON x.t = z_bad.a LEFT JOIN z_dropped y ON y.t = z_bad.b),
z_kept AS (SELECT t FROM z_good WHERE t NOT IN (SELECT t FROM z_dropped)),
ev AS (SELECT 1 AS tier, CAST(8 AS BIGINT) AS k0, CAST(0 AS BIGINT) AS k1, '{missing[0]}' AS "Severity", 'trait' AS "Scope", 'T9' AS "Trait", '' AS "Other_Trait", 'Trait absent from the bundle' AS "Reason", CAST(NULL AS DOUBLE) AS "Value", '{missing[1]}' AS "Action"
 UNION ALL SELECT 2, t, n - 1, '{severity}', 'trait', concat('T', t), '', rs[n], NULL, '{do}' FROM (SELECT t, rs, unnest(range(1, len(rs) + 1)) AS n FROM z_reasons) x
 UNION ALL SELECT 3, t, 0, 'error', 'trait', concat('T', t), '', 'S_Stand diagonal differs from 1 beyond 1e-8', st, 'stop' FROM z_own WHERE t IN (SELECT t FROM z_good) AND abs(st - 1) > 1e-8
 UNION ALL SELECT 4, a, b, '{severity}', 'pair', concat('T', a), concat('T', b), reason, NULL, '{pair_do}' FROM z_bad
 UNION ALL SELECT 5, (SELECT count(*) FROM z_reasons WHERE len(rs) > 0) + max(step), 0, 'warning', 'trait', concat('T', d.t), '', 'Removed to resolve invalid pairs: ' || string_agg(line, '; ' ORDER BY a, b), NULL, 'removed' FROM z_dropped d JOIN z_lines l ON l.t = d.t GROUP BY d.t
 UNION ALL SELECT 7, t, 0, 'warning', 'trait', concat('T', t), '', 'h2/SE below 4', s / CAST('0.1' AS DOUBLE), 'retained' FROM z_own WHERE t IN (SELECT t FROM z_kept) AND s / CAST('0.1' AS DOUBLE) < 4
 UNION ALL SELECT 8, j, i, 'warning', 'pair', concat('T', i), concat('T', j), 'Genetic correlation outside [-1,1]; not clamped', value, 'retained' FROM b WHERE matrix = 'S_Stand' AND i < j AND abs(value) > 1 AND i IN (SELECT t FROM z_kept) AND j IN (SELECT t FROM z_kept))"""


_LIST = 'SELECT tier, k0, k1, CAST(0 AS BIGINT) AS k2, "Severity", "Scope", "Trait", "Other_Trait", "Reason", round("Value", 6) + 0 AS "Value", "Action" FROM ev'
_SUMMARY = """, z_ends AS (SELECT trait, "Reason", min(o) AS o, min(o) FILTER (WHERE "Severity" = 'warning') AS w FROM (SELECT unnest([ev."Trait", ev."Other_Trait"]) AS trait, "Reason", "Severity", row_number() OVER (ORDER BY tier, k0, k1) AS o FROM ev) x GROUP BY 1, 2),
z_asked AS (SELECT trait, trait_order FROM manifest UNION ALL SELECT 'T9', 8)
SELECT trait_order, a.trait, trait_order IN (SELECT t FROM z_kept) AS "Retained", a.trait IN (SELECT "Trait" FROM ev WHERE "Action" = 'removed') AS "Removed",
 coalesce((SELECT string_agg("Reason", '; ' ORDER BY w) FROM z_ends e WHERE e.trait = a.trait AND w IS NOT NULL), '') AS "Warning_Reasons", coalesce((SELECT string_agg("Reason", '; ' ORDER BY o) FROM z_ends e WHERE e.trait = a.trait), '') AS "All_QC_Reasons" FROM z_asked a"""

QUERIES = {
    "sampling_covariance_v": (sampling_covariance_v, f"{rq._FIT}, {_V} SELECT matrix, i, j, round(value, 8) + 0 AS value FROM bundle"),
    "job_bundle_matrices": (job_bundle_matrices, f"{rq._FIT}, {_V}, {_TURN} SELECT matrix, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(value, 8) + 0 AS value FROM turned"),
    "bundle_events": (bundle_events, f"{_events_sql('drop_traits')} {_LIST}"),
    "bundle_events_strict": (bundle_events_strict, f"{_events_sql('error')} {_LIST}"),
    "bundle_trait_summary": (bundle_trait_summary, f"{_events_sql('drop_traits')} {_SUMMARY}"),
}
