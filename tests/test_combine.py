"""The signed-weight formula, computed independently, on partial, swapped and extreme records."""
import math

import numpy as np
import pandas as pd
import pytest

from assocspark.operators import alleles, combine, export, ordering

SCHEMA = "trait string, trait_order int, SNPID string, CHR long, BP long, EA string, OA string, EAF double, N double, Z double"
FREQUENCY = .35
#: Trait: (N, Z by SNP); a SNP in ``TURNED`` is recorded with the other allele as effect.
STUDY = {
    "gait": (4100, {"v1": -1.4, "v2": .7, "v3": 2.6, "v4": 38.5}),
    "mood": (900, {"v1": 2.2, "v3": -.4, "v4": 38.5}),
    "pain": (2700, {"v1": .3, "v2": -3.3, "v4": 38.5, "v5": 1.9}),
}
TURNED = {("mood", "v3")}
CTI = np.array([[1, .2, -.05], [.2, 1, .15], [-.05, .15, 1]])
LOADINGS = [.5, -.75, .4]


def records(trait, order, n, scores, turned=TURNED):
    for position, (snp, z) in enumerate(scores.items(), 50):
        alleles = ("T", "C", 1 - FREQUENCY) if (trait, snp) in turned else ("C", "T", FREQUENCY)
        yield (trait, order, snp, 7, position, *alleles, float(n), z)


@pytest.fixture
def assoc(spark):
    return spark.createDataFrame([r for order, (trait, (n, scores)) in enumerate(STUDY.items()) for r in records(trait, order, n, scores)], SCHEMA)


def by_hand(snp):
    """Z, effective N and standard error of one SNP from the definition, trait by trait."""
    have = [i for i, (_, scores) in enumerate(STUDY.values()) if snp in scores]
    names = list(STUDY)
    weight = {i: math.sqrt(STUDY[names[i]][0]) * LOADINGS[i] for i in have}
    score = {i: STUDY[names[i]][1][snp] * (-1 if (names[i], snp) in TURNED else 1) for i in have}
    variance = sum(weight[i] * weight[j] * CTI[i, j] for i in have for j in have)
    sizes = [math.sqrt(STUDY[names[i]][0]) for i in have]
    error = (2 * sum(s * s for s in sizes) * FREQUENCY * (1 - FREQUENCY)) ** -.5
    return sum(weight[i] * score[i] for i in have) / math.sqrt(variance), float(np.dot(sizes, np.linalg.solve(CTI[np.ix_(have, have)], sizes))), error


def test_formula(assoc):
    out = combine.combine_traits(assoc, CTI, LOADINGS).toPandas().set_index("SNPID")
    assert sorted(out.index) == ["v1", "v2", "v3", "v4", "v5"]
    for snp in out.index:
        z, size, error = by_hand(snp)
        assert out.loc[snp, ["Z", "N_eff", "SE", "BETA"]].tolist() == pytest.approx([z, size, error, z * error], rel=1e-9)
        assert out.PVAL[snp] == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-12)
    assert out.Direction.to_dict() == {"v1": "-++", "v2": "+?-", "v3": "++?", "v4": "+++", "v5": "??+"}


def test_incompatible_allele_loses_only_its_trait(spark, assoc):
    odd = [r[:5] + ("C", "G") + r[7:] for r in records("mood", 1, 900, {"v2": 4.0})]
    both = assoc.unionByName(spark.createDataFrame(odd, SCHEMA))
    assert combine.combine_traits(both, CTI, LOADINGS).filter("SNPID = 'v2'").first().Direction == "+?-"
    aligned = {r.trait: r.orientation for r in alleles.align_traits(both).filter("SNPID = 'v2'").collect()}
    assert aligned["mood"] is None and aligned["gait"] is not None and aligned["pain"] is not None


def test_zero_weight_is_reported_and_cancelling_weights_are_not(assoc):
    loadings = [1.0, -math.sqrt(4100 / 900), 0.0]  # the weights of gait and mood add up to nothing
    out = combine.combine_traits(assoc, CTI, loadings)
    issues, summary = combine.combined_qc(out, loadings, assoc=assoc)
    assert {(r.SNPID, r.Reason) for r in issues.collect()} == {
        ("v5", reason) for reason in ("BETA_not_finite", "Z_not_finite", "PVAL_not_finite_or_outside_0_1", "zero_available_weight")}
    row = out.filter("SNPID = 'v5'").first()
    assert row.Z is None and row.N_eff == pytest.approx(2700)
    assert summary.first().asDict() == {"Status": "failed", "Total_Rows": 5, "Invalid_Rows": 1, "Issue_Count": 4}


@pytest.mark.parametrize("column,values", [("Z", [None, math.inf]), ("SE", [None, 0.0, -1.0]), ("N_eff", [math.inf, 0.0]), ("PVAL", [None, -.1, 1.1]), ("Direction", ["", "++", "+?x"])])
def test_every_field_is_checked(spark, assoc, column, values):
    good = combine.combine_traits(assoc, CTI, LOADINGS).toPandas()
    for value in values:
        bad = good.copy()
        bad[column] = bad[column].astype(object)
        bad.loc[0, column] = value
        schema = ", ".join(f"{c} {'string' if c in ('SNPID', 'EA', 'OA', 'Direction') else 'bigint' if c in ('CHR', 'BP') else 'double'}" for c in bad.columns)
        rows = [tuple(None if x is None else x for x in r) for r in bad.itertuples(index=False)]
        issues, _ = combine.combined_qc(spark.createDataFrame(rows, schema), LOADINGS)
        assert {r.SNPID for r in issues.collect()} == {good.SNPID[0]}


def test_metamorphic(spark, assoc):
    base = combine.combine_traits(assoc, CTI, LOADINGS).toPandas().set_index("SNPID").sort_index()
    shuffled = combine.combine_traits(assoc.repartition(7), CTI, LOADINGS).toPandas().set_index("SNPID").sort_index()
    pd.testing.assert_frame_equal(base, shuffled)
    # A fourth trait with zero loading leaves Z alone.
    wide = np.eye(4)
    wide[:3, :3] = CTI
    fourth = spark.createDataFrame(list(records("sleep", 3, 60, {"v1": 5.5})), SCHEMA)
    more = combine.combine_traits(assoc.unionByName(fourth), wide, [*LOADINGS, 0]).toPandas().set_index("SNPID").sort_index()
    assert np.allclose(more.Z, base.Z) and more.loc["v1", "Direction"] == base.loc["v1", "Direction"] + "+"
    # Swapping every allele of all traits flips all signs.
    flipped = combine.combine_traits(assoc.selectExpr("trait", "trait_order", "SNPID", "CHR", "BP", "OA AS EA", "EA AS OA", "1 - EAF AS EAF", "N", "-Z AS Z"), CTI, LOADINGS)
    assert np.allclose(flipped.toPandas().set_index("SNPID").sort_index().Z, -base.Z)


def test_custom_kernel(assoc):
    def kernel(batch, cti, loadings):
        out = batch[["SNPID", "CHR", "BP", "EA", "OA"]].copy()
        for c in ("EAF", "N_eff", "N_obs", "BETA", "SE"):
            out[c] = .5
        out["Z"], out["Direction"] = 1.96, "+++"
        return out
    out = combine.combine_traits(assoc, CTI, LOADINGS, combine=kernel).toPandas()
    assert len(out) == 5 and np.allclose(out.PVAL, .04999579)


def test_positions_and_union(spark):
    a = spark.createDataFrame([("s1", "chrX", "2e1"), ("s2", "MT", "3"), ("s3", "2", "10.0"), ("s4", "10", "9007199254740993")], "SNPID string, CHR string, BP string")
    b = spark.createDataFrame([("s5", "1", "5", "q")], "SNPID string, CHR string, BP string, Extra string")
    both = export.union_results([a, b])
    assert [r.SNPID for r in ordering.sort_by_position(both, ["source_order"]).collect()] == ["s5", "s3", "s4", "s1", "s2"]
    bad = spark.createDataFrame([("s", "1", "2.5"), ("t", "1", "0"), ("u", "1", "x"), ("v", "1", "4")], "SNPID string, CHR string, BP string")
    assert {r.SNPID for r in ordering.invalid_positions(bad).collect()} == {"s", "t", "u"}
    with pytest.raises(ValueError, match="missing columns"):
        export.export_summary(both)
    with pytest.raises(ValueError, match="info"):
        export.export_summary(both, info=2)


def test_global_rank_and_medians(spark):
    import random
    values = [(random.choice("ab"), random.random() if i % 3 else .5, i) for i in range(2000)]
    df = spark.createDataFrame(values, "g string, v double, id int").repartition(6)
    ranked = ordering.global_rank(df, ["g", "v", "id"], partitions=5).toPandas().sort_values(["g", "v", "id"])
    assert ranked["rank"].tolist() == list(range(2000))
    medians = {r.g: r["median"] for r in ordering.exact_medians(df, ["g"], "v").collect()}
    frame = pd.DataFrame(values, columns=["g", "v", "id"])
    assert medians == frame.groupby("g").v.median().to_dict()


def test_pattern_factors_meet_their_rows_either_way(spark, monkeypatch):
    rng = np.random.default_rng(3)
    traits, snps = 5, 120
    root = rng.standard_normal((traits, traits))
    cti, loadings = root @ root.T / traits + np.eye(traits), rng.uniform(.2, 1, traits)
    rows = [(t, f"rs{s}", "A", "G", 1, s, .3, 1000.0 * (t + 1), float(rng.standard_normal())) for s in range(snps) for t in range(traits) if rng.random() < .6]
    assoc = spark.createDataFrame(rows, "trait_order int, SNPID string, EA string, OA string, CHR bigint, BP bigint, EAF double, N double, Z double")
    patterns = combine.availability_patterns(combine.snp_contributions(assoc), cti).collect()
    assert len({tuple(p.traits) for p in patterns}) == len(patterns) and sum(p.rows for p in patterns) == len({r[1] for r in rows})
    for p in patterns:
        factor = np.frombuffer(p.factor).reshape(len(p.traits), -1)
        assert p.definite and np.allclose(factor @ factor.T, cti[np.ix_(p.traits, p.traits)])
    want = {r.SNPID: r for r in combine.combine_traits(assoc, cti, loadings).collect()}
    monkeypatch.setattr(combine, "PATTERN_BYTES", 0)
    monkeypatch.setattr(combine, "PATTERN_ROWS", 3)
    got = combine.combine_traits(assoc, cti, loadings).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.Direction == want[r.SNPID].Direction and np.allclose([r.Z, r.N_eff, r.BETA], [want[r.SNPID].Z, want[r.SNPID].N_eff, want[r.SNPID].BETA])
    some = got[0]
    mine = [(t, n, z) for t, s, _, _, _, _, _, n, z in rows if s == some.SNPID]
    index, s = [m[0] for m in mine], np.sqrt([m[1] for m in mine])
    part, w = cti[np.ix_(index, index)], s * loadings[index]
    assert some.N_eff == pytest.approx(s @ np.linalg.solve(part, s)) and some.Z == pytest.approx(w @ [m[2] for m in mine] / np.sqrt(w @ part @ w))
