"""LD-score regression of all trait pairs, its block assignment, and the scale conversion."""
from __future__ import annotations

from pyspark.sql import functions as F

from assocspark.functions.tails import normal_quantile_sql
from assocspark.operators import filters, ordering, regression

from . import variants, views as v
from .views import q6

BLOCKS = 50


def sumstats(spark, sf):
    good = v.variants(spark, sf, require_info=True).good
    munged = filters.munge(variants.raw_regression_table(good), v.table(spark, sf, "part").selectExpr(*v.exprs(v.HM3)), info_min=0.5)
    return munged.withColumn("trait_order", F.substring("trait", 2, 3).cast("int"))


def estimates(spark, sf):
    ld = v.ldscore(spark, sf)
    vectors = regression.snp_vectors(sumstats(spark, sf), ld, v.ldweights(spark, sf), v.TRAITS, chunk_rows=500)
    return regression.pair_regressions(vectors, ld.count(), n_blocks=BLOCKS)


VALUES = ("rg", "se", "h2_p1_pair_obs", "h2_p2_pair_obs", "h2_p1_se", "h2_p2_se", "h2_int_1", "h2_int_se_1", "h2_int_2", "h2_int_se_2", "gcov_native_obs", "gcov_se", "gcov_int", "gcov_int_se")


def ld_regression(spark, sf):
    """All pairs, self-pairs included, to five digits."""
    return estimates(spark, sf).select("i", "j", *[F.round(c, 5).alias(c) for c in VALUES])


#: Records put on the other strand, and records of the first trait given alleles that no other trait has.
COMPLEMENTED = "trait_order % 2 = 1 AND pmod(CAST(substring(SNP, 3) AS BIGINT), 3) = 0"
FOREIGN = "trait_order = 0 AND pmod(CAST(substring(SNP, 3) AS BIGINT), 5) = 0"


def regression_strand(spark, sf):
    """Half of the traits on the other strand at every third SNP, and a first trait with foreign alleles at every fifth."""
    rows = sumstats(spark, sf)
    turned = rows.withColumns({c: F.when(F.expr(COMPLEMENTED), F.translate(c, "ACGT", "TGCA")).otherwise(F.col(c)) for c in ("A1", "A2")})
    foreign = turned.withColumns({c: F.when(F.expr(FOREIGN), F.concat(c, F.lit("A"))).otherwise(F.col(c)) for c in ("A1", "A2")})
    ld = v.ldscore(spark, sf)
    vectors = regression.snp_vectors(foreign, ld, v.ldweights(spark, sf), v.TRAITS, chunk_rows=500)
    return regression.pair_regressions(vectors, ld.count(), n_blocks=BLOCKS).select("i", "j", "snps", *[F.round(c, 5).alias(c) for c in VALUES])


def regression_small_pairs(spark, sf):
    """Every pair has a row, with more blocks asked for than some pairs have SNPs, and one trait without any."""
    rows = sumstats(spark, sf).where("trait_order <> 7 AND (trait_order <> 6 OR pmod(CAST(substring(SNP, 3) AS BIGINT), 50) = 1)")
    ld = v.ldscore(spark, sf)
    vectors = regression.snp_vectors(rows, ld, v.ldweights(spark, sf), v.TRAITS, chunk_rows=500)
    return regression.pair_regressions(vectors, ld.count(), n_blocks=BLOCKS).select("i", "j", "snps", "reason", F.round("gcov_native_obs", 5).alias("gcov_native_obs"), F.round("gcov_se", 5).alias("gcov_se"))


def regression_pair_table(spark, sf):
    manifest = v.manifest(spark, sf).selectExpr("trait", "trait_order", "CASE WHEN trait_order = 3 THEN 0.3D END AS sample_prevalence",
                                                "CASE WHEN trait_order = 3 THEN 0.01D END AS population_prevalence")
    return regression.pair_table(estimates(spark, sf), manifest).select(
        "p1", "p2", *[F.round(c, 5).alias(c) for c in ("rg", "se", "gcov_native_obs", "h2_obs", "h2_liab", "h2_int", "h2_p1_pair_obs", "h2_p2_pair_obs")])


def jackknife_blocks(spark, sf):
    """Equal blocks of the LD-score SNPs in genomic order."""
    ranked = ordering.global_rank(v.ldscore(spark, sf), ["CHR", "BP", "SNP"])
    n = v.ldscore(spark, sf).agg(F.count("*")).scalar()
    return ranked.withColumn("n", n).select("SNP", "rank", F.expr(f"((rank + 1) * {BLOCKS} - 1) div n").alias("block"))


def liability_scale(spark, sf):
    rows = v.table(spark, sf, "part").selectExpr("p_partkey", "CAST(p_size AS DOUBLE) / 100 AS population_prevalence",
                                                 "CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS DOUBLE) / 60 END AS sample_prevalence")
    return rows.select("p_partkey", F.round(regression.liability_factor(), 6).alias("factor"))


_MUNGE = f"""WITH {v.variant_ctes(require_info=True)}, {v.LD_CTE}, allele AS ({v.select(v.HM3, 'part')}),
u AS (SELECT *, p AS P0 FROM good WHERE INFO >= CAST('0.5' AS DOUBLE) AND least(eaf_A1, 1 - eaf_A1) > CAST('0.01' AS DOUBLE) AND A1 || A2 NOT IN ('AT', 'TA', 'CG', 'GC')),
ss0 AS (SELECT trait_order AS t, u.SNP, u.A1, u.A2, N, CASE WHEN beta < 0 THEN -1 ELSE 1 END * abs({normal_quantile_sql('(P / 2)')}) AS Z FROM u JOIN allele h ON h.SNP = u.SNP
  WHERE (u.A1, u.A2) IN ((h.A1, h.A2), (h.A2, h.A1), (translate(h.A1, 'ACGT', 'TGCA'), translate(h.A2, 'ACGT', 'TGCA')), (translate(h.A2, 'ACGT', 'TGCA'), translate(h.A1, 'ACGT', 'TGCA')))),
anc AS (SELECT SNP, arg_min(A1, t) AS r1, arg_min(A2, t) AS r2 FROM ss0 GROUP BY SNP),
ss AS (SELECT t, s.SNP, N, CASE WHEN A1 = r1 THEN Z ELSE -Z END AS Z FROM ss0 s JOIN anc ON anc.SNP = s.SNP WHERE (A1 = r1 AND A2 = r2) OR (A1 = r2 AND A2 = r1)),
pr0 AS (SELECT a.t AS i, b.t AS j, a.Z AS z1, b.Z AS z2, a.N AS n1, b.N AS n2, l.L2 AS l2, w.L2 AS wl, row_number() OVER (PARTITION BY a.t, b.t ORDER BY l.CHR, l.BP, l.SNP) AS r,
  count(*) OVER (PARTITION BY a.t, b.t) AS n FROM ss a JOIN ss b ON a.SNP = b.SNP AND a.t <= b.t JOIN ldscore l ON l.SNP = a.SNP JOIN ldweights w ON w.SNP = a.SNP),
pr AS (SELECT *, (r * {BLOCKS} - 1) // n AS block, greatest(l2, 1) AS lx, greatest(wl, 1) AS wx, (SELECT CAST(count(*) AS DOUBLE) FROM ldscore) AS m FROM pr0)"""


def _clip(x, low, high):
    return f"least(greatest({x}, {low}), {high})"


_MODELS = {
    "a": ("z1 * z1", "n1", 1, "1 / (2 * pow(f.c + " + _clip("f.s", 0, 1) + " * n1 / m * lx, 2)) / wx", ""),
    "b": ("z2 * z2", "n2", 1, "1 / (2 * pow(f.c + " + _clip("f.s", 0, 1) + " * n2 / m * lx, 2)) / wx", ""),
    "g": ("z1 * z2", "sqrt(n1 * n2)", 0,
          f"1 / ((n1 * {_clip('ta.s', 0, 1)} * lx / m + ta.c) * (n2 * {_clip('tb.s', 0, 1)} * lx / m + tb.c) + pow(sqrt(n1 * n2) * {_clip('f.s', -1, 1)} * lx / m + f.c, 2)) / wx",
          "JOIN ta ON ta.i = pr.i AND ta.j = pr.j JOIN tb ON tb.i = pr.i AND tb.j = pr.j"),
}
_EST = "m * ({p}w * {p}wxy - {p}wx * {p}wy) / ({p}w * {p}wxx - {p}wx * {p}wx) / sc AS {p}s, ({p}wxx * {p}wy - {p}wx * {p}wxy) / ({p}w * {p}wxx - {p}wx * {p}wx) AS {p}c"
_S = ("w", "wx", "wxx", "wy", "wxy")


def _model_ctes(name: str) -> str:
    y, n, null, weight, join = _MODELS[name]
    parts = [f"{name}0 AS (SELECT i, j, max(m) * (avg({y}) - {null}) / avg(l2 * {n}) AS s, CAST({null} AS DOUBLE) AS c, avg({n}) AS sc FROM pr GROUP BY i, j)"]

    def weighted(k):
        return (f"(SELECT pr.i, pr.j, block, m, sc, w, w * x AS wx, w * x * x AS wxx, w * y AS wy, w * x * y AS wxy FROM (SELECT pr.i, pr.j, block, m, f.sc, {weight} AS w, "
                f"{n} * l2 / f.sc AS x, {y} AS y FROM pr JOIN {name}{k} f ON f.i = pr.i AND f.j = pr.j {join}) pr)")
    sums = ", ".join(f"sum({c}) AS {c}" for c in _S)
    for k in (0, 1):
        parts.append(f"{name}{k + 1} AS (SELECT i, j, sc, {_EST.format(p='')} FROM (SELECT i, j, max(m) AS m, max(sc) AS sc, {sums} FROM {weighted(k)} GROUP BY i, j))")
    parts.append(f"k{name} AS (SELECT i, j, block, max(m) AS m, max(sc) AS sc, {sums} FROM {weighted(2)} GROUP BY i, j, block)")
    parts.append(f"t{name} AS (SELECT i, j, {_EST.format(p='')} FROM (SELECT i, j, max(m) AS m, max(sc) AS sc, {sums} FROM k{name} GROUP BY i, j))")
    deleted = ", ".join(f"sum({c}) OVER (PARTITION BY i, j) - {c} AS d_{c}" for c in _S)
    parts.append(f"d{name} AS (SELECT i, j, block, {_EST.format(p='d_')} FROM (SELECT i, j, block, m, sc, {deleted} FROM k{name}))")
    return ", ".join(parts)


_SE = "sqrt((count(*) - 1) * var_pop({c}))"
_FIT = f"""{_MUNGE}, {_model_ctes('a')}, {_model_ctes('b')}, {_model_ctes('g')},
jj AS (SELECT da.i, da.j, ta.s AS h1, tb.s AS h2, tg.s AS g, ta.c AS c1, tb.c AS c2, tg.c AS cg, da.d_s AS d1, da.d_c AS e1, db.d_s AS d2, db.d_c AS e2, dg.d_s AS dg, dg.d_c AS eg,
  CASE WHEN ta.s > 0 AND tb.s > 0 THEN tg.s / sqrt(ta.s * tb.s) END AS rg, CASE WHEN ta.s > 0 AND tb.s > 0 AND da.d_s * db.d_s > 0 THEN dg.d_s / sqrt(da.d_s * db.d_s) END AS drg
  FROM da JOIN db ON db.i = da.i AND db.j = da.j AND db.block = da.block JOIN dg ON dg.i = da.i AND dg.j = da.j AND dg.block = da.block
  JOIN ta ON ta.i = da.i AND ta.j = da.j JOIN tb ON tb.i = da.i AND tb.j = da.j JOIN tg ON tg.i = da.i AND tg.j = da.j),
fit AS (SELECT i, j, max(rg) AS rg, CASE WHEN count(drg) = count(*) THEN {_SE.format(c='drg')} END AS se, max(h1) AS h2_p1_pair_obs, max(h2) AS h2_p2_pair_obs, {_SE.format(c='d1')} AS h2_p1_se,
  {_SE.format(c='d2')} AS h2_p2_se, max(c1) AS h2_int_1, {_SE.format(c='e1')} AS h2_int_se_1, max(c2) AS h2_int_2, {_SE.format(c='e2')} AS h2_int_se_2, max(g) AS gcov_native_obs,
  {_SE.format(c='dg')} AS gcov_se, max(cg) AS gcov_int, {_SE.format(c='eg')} AS gcov_int_se FROM jj GROUP BY i, j)"""
#: As _FIT, with records of foreign alleles meeting only their like.
_STRAND = _FIT.replace("SELECT t, s.SNP, N,", "SELECT t, s.SNP, t = 0 AND CAST(substr(s.SNP, 3) AS BIGINT) % 5 = 0 AS f, N,").replace("ON a.SNP = b.SNP AND a.t <= b.t", "ON a.SNP = b.SNP AND a.f = b.f AND a.t <= b.t")
_SMALL = _FIT.replace(f"(r * {BLOCKS} - 1) // n AS block", f"(r * least({BLOCKS}, n) - 1) // n AS block").replace(
    "WHERE (A1 = r1 AND A2 = r2) OR (A1 = r2 AND A2 = r1))", "WHERE ((A1 = r1 AND A2 = r2) OR (A1 = r2 AND A2 = r1)) AND t <> 7 AND (t <> 6 OR CAST(substr(s.SNP, 3) AS BIGINT) % 50 = 1))")
_SMALL_OUT = """, cnt AS (SELECT i, j, count(*) AS snps FROM pr0 GROUP BY i, j), grid AS (SELECT a.x AS i, b.x AS j FROM range(8) a(x), range(8) b(x) WHERE a.x <= b.x)
SELECT CAST(g.i AS INT) AS i, CAST(g.j AS INT) AS j, coalesce(snps, 0) AS snps, CASE WHEN snps IS NULL THEN 'no shared SNPs' WHEN snps < 50 THEN 'fewer shared SNPs than blocks' END AS reason,
 CASE WHEN isfinite(gcov_native_obs) THEN round(gcov_native_obs, 5) + 0 END AS gcov_native_obs, CASE WHEN isfinite(gcov_se) THEN round(gcov_se, 5) + 0 END AS gcov_se
FROM grid g LEFT JOIN cnt ON cnt.i = g.i AND cnt.j = g.j LEFT JOIN fit ON fit.i = g.i AND fit.j = g.j"""
_Q5 = ", ".join(f"round({c}, 5) + 0 AS {c}" for c in VALUES)
_NQ = normal_quantile_sql("K")
_FACTOR = f"pow(K * (1 - K), 2) / (P * (1 - P) * pow(exp(-({_NQ}) * ({_NQ}) / 2) / sqrt(2 * pi()), 2))"
_PT = f"""fac AS (SELECT {_FACTOR} AS f FROM (SELECT CAST('0.01' AS DOUBLE) AS K, CAST('0.3' AS DOUBLE) AS P)),
o AS (SELECT i AS a, j AS b, rg, se, gcov_native_obs, h2_p2_pair_obs AS h2, h2_int_2 AS h2_int, h2_p1_pair_obs, h2_p2_pair_obs FROM fit
  UNION ALL SELECT j, i, rg, se, gcov_native_obs, h2_p1_pair_obs, h2_int_1, h2_p2_pair_obs, h2_p1_pair_obs FROM fit WHERE i < j)
SELECT concat('T', a) AS p1, concat('T', b) AS p2, round(rg, 5) + 0 AS rg, round(se, 5) + 0 AS se, round(gcov_native_obs, 5) + 0 AS gcov_native_obs, CASE WHEN b <> 3 THEN round(h2, 5) + 0 END AS h2_obs,
  CASE WHEN b = 3 THEN round(h2 * f, 5) + 0 END AS h2_liab, round(h2_int, 5) + 0 AS h2_int, round(h2_p1_pair_obs, 5) + 0 AS h2_p1_pair_obs, round(h2_p2_pair_obs, 5) + 0 AS h2_p2_pair_obs FROM o, fac"""

QUERIES = {
    "ld_regression": (ld_regression, f"{_FIT} SELECT i, j, {_Q5} FROM fit"),
    "regression_strand": (regression_strand, f"{_STRAND}, cnt AS (SELECT i, j, count(*) AS snps FROM pr0 GROUP BY i, j) SELECT fit.i, fit.j, snps, {_Q5} FROM fit JOIN cnt ON cnt.i = fit.i AND cnt.j = fit.j"),
    "regression_small_pairs": (regression_small_pairs, _SMALL + _SMALL_OUT),
    "regression_pair_table": (regression_pair_table, f"{_FIT}, {_PT}"),
    "jackknife_blocks": (jackknife_blocks, f"WITH {v.LD_CTE} SELECT SNP, row_number() OVER (ORDER BY CHR, BP, SNP) - 1 AS rank, "
                         f"(row_number() OVER (ORDER BY CHR, BP, SNP) * {BLOCKS} - 1) // count(*) OVER () AS block FROM ldscore"),
    "liability_scale": (liability_scale, f"SELECT p_partkey, {q6(f'CASE WHEN P IS NULL THEN 1 ELSE {_FACTOR} END')} AS factor FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) / 100 AS K, "
                        "CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS DOUBLE) / 60 END AS P FROM part) x"),
}
