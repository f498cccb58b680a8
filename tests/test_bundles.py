"""Regression in tiles over stored tables, and the bundles built from its jackknife values."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from assocspark.operators import bundles, panels, regression
from assocspark.sources import layout

TRAITS, SNPS, BLOCKS = 5, 300, 10


@pytest.fixture(scope="module")
def inputs(spark):
    rng = np.random.default_rng(4)
    l2 = rng.uniform(1, 50, SNPS)
    effects = rng.multivariate_normal(np.zeros(TRAITS), .4 + .6 * np.eye(TRAITS), SNPS) * np.sqrt(l2 / 10)[:, None]
    z = effects + rng.standard_normal((SNPS, TRAITS))
    rows = [(t, f"rs{s}", "A", "G", 30_000.0 + 1000 * t, float(z[s, t])) for s in range(SNPS) for t in range(TRAITS) if (s * 7 + t) % 9]
    stats = spark.createDataFrame(rows, "trait_order int, SNP string, A1 string, A2 string, N double, Z double")
    ld = spark.createDataFrame([(f"rs{s}", 1 + s * 22 // SNPS, s, float(l2[s])) for s in range(SNPS)], "SNP string, CHR int, BP long, L2 double")
    return stats, ld


@pytest.fixture(scope="module")
def fit(spark, inputs):
    stats, ld = inputs
    return regression.fit_pairs(regression.snp_vectors(stats, ld, ld, TRAITS, chunk_rows=64), 6000.0, n_blocks=BLOCKS)


def table(df):
    return df.toPandas().sort_values(["i", "j"], ignore_index=True)


@pytest.mark.parametrize(("tile", "chunk_rows"), [(1, 1000), (2, 41)])
def test_tiles_change_nothing(spark, inputs, fit, tile, chunk_rows):
    stats, ld = inputs
    vectors = regression.snp_vectors(stats, ld, ld, TRAITS, chunk_rows=chunk_rows, tile=tile)
    assert vectors.table.select("a", "b").distinct().count() == {1: 15, 2: 6}[tile]
    got, want = table(regression.pair_regressions(vectors, 6000.0, n_blocks=BLOCKS)), table(regression.summarise_pairs(fit))
    assert len(got) == 15
    for c in want.columns:
        if want[c].dtype.kind == "f":
            assert np.allclose(got[c], want[c], rtol=1e-9, equal_nan=True), c
        else:
            assert got[c].fillna("").tolist() == want[c].fillna("").tolist(), c


def test_passes_move_no_snp(spark, inputs):
    """The stored table meets the coefficients of its chunk and tile without an exchange of its own."""
    stats, ld = inputs
    vectors = regression.snp_vectors(stats, ld, ld, TRAITS, chunk_rows=64)
    asked = vectors.table.select("chunk", "a", "b").distinct()
    meeting = vectors.table.groupBy("chunk", "a", "b").cogroup(asked.groupBy("chunk", "a", "b")).applyInArrow(lambda key, x, y: x.select(["position"]), "position long")
    plan = meeting._jdf.queryExecution().executedPlan().toString()
    left = plan[:plan.index("HashAggregate")] if "HashAggregate" in plan else plan
    assert "Bucketed: true" in left and "Exchange" not in left


def test_bundle_against_numpy(spark, fit):
    factors = [1.0, 1.0, 0.5, 1.0, 2.0]
    traits = spark.createDataFrame([(t, p, factors[t]) for p, t in enumerate((0, 2, 4))], "trait_order int, position long, factor double")
    got = bundles.sampling_bundle(fit, traits, delta=True).toPandas()
    assert got.equals(got.dropna())
    cells = {(m, i, j): x for _, m, i, j, x in got.itertuples(index=False)}
    d = regression.deleted_estimates(fit).toPandas().set_index(["i", "j", "block"])
    order = [(a, b) for a in range(3) for b in range(a, 3)]
    names = (0, 2, 4)
    value, deleted = [], []
    for a, b in order:
        i, j = names[a], names[b]
        rows = d.loc[(i, j)].sort_index()
        model = "h2_1" if i == j else "gcov"
        f = np.sqrt(factors[i] * factors[j])
        value.append(f * rows[f"{model}_slope"].iloc[0])
        deleted.append(f * rows[f"{model}_d_slope"].to_numpy())
        assert cells["I", a, b] == cells["I", b, a] == pytest.approx(rows[f"{model}_intercept"].iloc[0])
    value, dev = np.array(value), np.array(deleted)
    dev = dev - dev.mean(1, keepdims=True)
    v = dev @ dev.T * (BLOCKS - 1) / BLOCKS
    own = {a: value[order.index((a, a))] for a in range(3)}
    ratio = np.array([1 / np.sqrt(own[a] * own[b]) for a, b in order])
    delta = np.array([dev[n] * ratio[n] - value[n] * ratio[n] * (dev[order.index((a, a))] / own[a] + dev[order.index((b, b))] / own[b]) / 2 for n, (a, b) in enumerate(order)])
    w = delta @ delta.T * (BLOCKS - 1) / BLOCKS
    for n, (a, b) in enumerate(order):
        assert cells["S", a, b] == cells["S", b, a] == pytest.approx(value[n])
        assert cells["S_Stand", a, b] == pytest.approx(value[n] * ratio[n])
        for k in range(6):
            assert np.allclose([cells["V", n, k], cells["V_Stand", n, k], cells["V_Delta", n, k]], [v[n, k], v[n, k] * ratio[n] * ratio[k], w[n, k]], rtol=1e-8, atol=1e-14)
    tiled = bundles.sampling_bundle(fit, traits, delta=True, tile=2).toPandas()
    assert all(np.isclose(x, cells[m, i, j], rtol=1e-9, atol=1e-15) for _, m, i, j, x in tiled.itertuples(index=False)) and len(tiled) == len(got)


def test_pairs_without_all_blocks_have_no_covariance(spark, inputs):
    stats, ld = inputs
    few = stats.where("trait_order < 2 OR CAST(substring(SNP, 3) AS INT) < 7")
    fit = regression.fit_pairs(regression.snp_vectors(few, ld, ld, 3), 6000.0, n_blocks=BLOCKS)
    traits = spark.createDataFrame([(t, t, 1.0) for t in range(3)], "trait_order int, position long, factor double")
    got = bundles.sampling_bundle(fit, traits).groupBy("matrix").agg(F.count("*").alias("n"), F.count("value").alias("known")).collect()
    assert {r.matrix: r.n for r in got} == {"S": 9, "I": 9, "S_Stand": 9, "V": 36, "V_Stand": 36}
    assert {r.matrix: r.known for r in got if r.matrix == "V"} == {"V": 9}  # the pairs of the two full traits


LABELS = ["elbe", "main", "isar"]


def hand_bundle(spark, change=()):
    cells = {(m, i, j): x for m in ("S", "I", "S_Stand") for i in range(3) for j in range(3) for x in [{"S": .2, "I": 1.0, "S_Stand": 1.0}[m] if i == j else {"S": .1, "I": .05, "S_Stand": .5}[m]]}
    for m, k in (("V", 6), ("V_Stand", 6)):
        cells |= {(m, i, j): 1e-4 if i == j else 0.0 for i in range(k) for j in range(k)}
    cells |= dict(change)
    return spark.createDataFrame([("all", m, i, j, x) for (m, i, j), x in cells.items()], bundles.BUNDLE)


@pytest.mark.parametrize(("change", "strict", "want", "kept"), [
    ({}, True, [], LABELS),
    ({("S", 1, 1): -.1}, True, [("main", "", "Non-finite or non-positive heritability", "stop")], None),
    ({("S", 1, 1): -.1}, False, [("main", "", "Non-finite or non-positive heritability", "removed")], ["elbe", "isar"]),
    ({("V", 0, 0): None}, False, [("elbe", "", "Non-finite or non-positive heritability SE", "removed")], ["main", "isar"]),
    ({("S_Stand", 2, 2): 1.1}, False, [("isar", "", "S_Stand diagonal differs from 1 beyond 1e-8", "stop"), ("", "", "S_Stand is inconsistent with standardized S", "stop")], LABELS),
    ({("I", 0, 2): None}, False, [("elbe", "isar", "Missing/non-finite I pair estimate", "resolve_by_trait_removal"), ("elbe", "", "Removed to resolve invalid pairs: elbe: isar: Missing/non-finite I pair estimate", "removed")], ["main", "isar"]),
    ({("S", 0, 1): .3, ("S", 1, 0): .3, ("S_Stand", 0, 1): 1.5, ("S_Stand", 1, 0): 1.5}, True, [("elbe", "main", "Genetic correlation outside [-1,1]; not clamped", "retained")], LABELS),
    ({("S", 0, 1): .15, ("S", 1, 0): .15}, True, [("", "", "S_Stand is inconsistent with standardized S", "stop")], LABELS),
    ({("V", 3, 3): .01}, True, [("main", "", "h2/SE below 4", "retained")], LABELS),
])
def test_events(spark, change, strict, want, kept):
    labels = spark.createDataFrame([(t, i) for i, t in enumerate(LABELS)], "trait string, position long")
    manifest = spark.createDataFrame([(t, i) for i, t in enumerate(LABELS)], "trait string, trait_order int")
    events, retained = bundles.bundle_events(hand_bundle(spark, change), labels, manifest, bundles.BundlePolicy(failed_action="error" if strict else "drop_traits"))
    assert [(r.Trait, r.Other_Trait, r.Reason, r.Action) for r in events.orderBy("event_order").collect()] == want
    if kept is not None:
        assert [r.trait for r in retained.orderBy("trait_order").collect()] == kept


def test_no_removal_is_an_empty_table(spark):
    nodes = spark.createDataFrame([("p", i, "") for i in range(3)], "panel_id string, i int, reason string")
    assert panels.bundle_drop_traits(nodes, spark.createDataFrame([], "panel_id string, pair_i int, pair_j int, reason string")).collect() == []


def test_stored_tables_join_and_group_without_exchange(spark):
    a = layout.store_by(spark.range(500).selectExpr("id % 97 AS k", "id AS x"), ["k"], buckets=4)
    b = layout.store_by(spark.range(97).selectExpr("id AS k", "id * 2 AS y"), ["k"], buckets=4)
    both = a.hint("merge").join(b, "k").groupBy("k").agg(F.sum("x").alias("x"), F.max("y").alias("y"))
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert both.where("y <> 2 * k").count() == 0 and both.agg(F.sum("x")).first()[0] == 499 * 250
