"""All stages on simulated variant files, and the policies of the pair and panel jobs."""
import gzip
import itertools
from math import erfc, log10

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from assocspark.operators import filters, pairs
from assocspark.plans import jobs
from assocspark.sources import tables, text

TRAITS = ("A", "001", "NA")
PER_CHROMOSOME = 60


@pytest.fixture(scope="module")
def simulated(spark, tmp_path_factory):
    """Three correlated traits whose effects follow the LD-score model, one variant file per trait."""
    folder = tmp_path_factory.mktemp("sim")
    rng = np.random.default_rng(7)
    snps = 22 * PER_CHROMOSOME
    l2 = rng.uniform(1, 60, snps)
    n, h2, rg = 50_000, .4, np.array([[1, .6, .5], [.6, 1, .7], [.5, .7, 1]])
    effects = rng.multivariate_normal(np.zeros(3), rg * h2, snps) * np.sqrt(n * l2 / snps / 20)[:, None]
    z = effects + rng.standard_normal((snps, 3))
    chrom = np.repeat(np.arange(1, 23), PER_CHROMOSOME)
    manifest = ["traitname,vcf_files,ref,N,sample_prevalence,population_prevalence"]
    for t, name in enumerate(TRAITS):
        lines = ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tx"]
        for k in range(snps):
            a, b, sign, eaf = ("A", "G", 1, .3) if (k + t) % 5 else ("G", "A", -1, .7)
            se = .01
            lp = -log10(max(erfc(abs(z[k, t]) / 2 ** .5), 1e-290))
            lines.append(f"{chrom[k]}\t{100 + k}\trs{k}\t{a}\t{b}\t.\tPASS\t.\tAF:ES:SE:LP:NEF:SI\t{eaf}:{float(sign * z[k, t] * se)!r}:{se}:{lp!r}:{n}:0.99")
        lines.append(f"X\t5\trsX\tA\tG\t.\tPASS\t.\tAF:ES:SE:LP:NEF:SI\t.3:.1:.1:1:100:.9")
        path = folder / f"{name}.vcf.gz"
        path.write_bytes(gzip.compress(("\n".join(lines) + "\n").encode()))
        manifest.append(f"{name},{path},yes,,,")
    (folder / "m.csv").write_text("\n".join(manifest) + "\n")
    reference = spark.createDataFrame([(f"rs{k}", int(chrom[k]), 100 + k, float(l2[k]), "G", "A") for k in range(snps)],
                                      "SNP string, CHR int, BP long, L2 double, A1 string, A2 string")
    return str(folder / "m.csv"), reference, float(snps * 20)


def test_pipeline(spark, simulated):
    path, reference, m = simulated
    manifest = text.read_manifest(spark, path, ("traitname", "vcf_files"))
    files = {r.trait: r.vcf_files for r in manifest.collect()}
    raw = text.read_gwas_vcf(spark, files, {**text.PREPARE_FIELDS, "SI": "INFO"})
    out = jobs.run_pipeline(raw, manifest, reference.select("SNP", "A1", "A2"), reference, reference, m, order=text.ROW_ORDER,
                            info=1.0, n_blocks=20, chisq_max="auto", assoc_id_source="vcf_id")
    assert out.panel.names == TRAITS
    assert (out.panel.weights > .5).all()
    summary = {r.trait: r for r in out.prepared.assoc_qc.summary.collect()}
    assert summary["NA"].input_rows == 22 * PER_CHROMOSOME + 1 and summary["NA"].excluded_non_autosomal_rows == 1
    table = out.compiled.pairs.toPandas().set_index(["p1", "p2"])
    assert len(table) == 9 and out.compiled.status == "compiled"
    assert abs(table.loc[("A", "A"), "rg"] - 1) < .01
    assert set(table.normalization_status) == {"calculated"}
    assert out.combined.count() == 22 * PER_CHROMOSOME
    first = out.summary.first()
    assert first.CHR == 1 and first.INFO == 1.0
    assert {r.Direction[0] for r in out.combined.select("Direction").distinct().collect()} == {"+", "-"}


RIVERS = ("oder", "rhein", "saale", "trave", "unstrut")
ALIKE, OWN_H2 = .25, .3  # every correlation and heritability of the sound grid


def grid(*, failing=(), absent=(), h2=None):
    """Both directions of every pair of rivers; ``failing`` and ``absent`` name directed rows, ``h2`` overrides a river's heritability."""
    values = {name: OWN_H2 for name in RIVERS} | (h2 or {})
    for number, (a, b) in enumerate(itertools.product(RIVERS, repeat=2)):
        if (a, b) not in absent:
            rg, error = (1.0, .04) if a == b else (ALIKE, .05)
            estimate = dict.fromkeys(("rg", "se", "z", "p")) if (a, b) in failing else dict(rg=rg, se=error, z=rg / error, p=two_sided(rg / error))
            yield dict(p1=a, p2=b, **estimate, h2_int=1.0, h2_int_se=.02, gcov_int=.03, gcov_int_se=.02, h2_obs=values[b], h2_obs_se=.05, row_id=number)


def two_sided(z):
    return erfc(abs(z) / 2 ** .5)


def both(a, b):
    return {(a, b), (b, a)}


def compiled(spark, rows, action="drop_traits", **limits):
    schema = "p1 string, p2 string, rg double, se double, z double, p double, h2_int double, h2_int_se double, gcov_int double, gcov_int_se double, h2_obs double, h2_obs_se double, row_id int"
    table = spark.createDataFrame([Row(**r) for r in rows], schema)
    manifest = spark.createDataFrame([(n, i, "yes", None) for i, n in enumerate(RIVERS)], "trait string, trait_order int, ref string, population_prevalence double")
    return jobs.compile_pairs(table, manifest, action=action, **limits)


SELECTION = {
    "a sound grid keeps all": ({}, []),
    "equal cases lose the later trait": (dict(failing=both("rhein", "trave")), ["trave"]),
    "the weaker heritability goes first": (dict(failing=both("rhein", "trave"), h2={"rhein": .002}), ["rhein"]),
    "the trait of most failures goes first": (dict(failing=both("unstrut", "oder") | both("unstrut", "saale")), ["unstrut"]),
    "a pair without rows counts as failed": (dict(absent=both("oder", "saale")), ["saale"]),
    "one direction is enough": (dict(absent={("saale", "rhein")}), []),
    "no self-pair": (dict(absent={("oder", "oder")}), ["oder"]),
    "a negative heritability fails with its pairs": (dict(failing=set().union(*(both("rhein", n) for n in RIVERS)), h2={"rhein": -.01}), ["rhein"]),
    "two separate failures": (dict(failing=both("oder", "rhein") | both("saale", "trave")), ["rhein", "trave"]),
}


@pytest.mark.parametrize("case", SELECTION)
def test_trait_selection(spark, case):
    change, dropped = SELECTION[case]
    out = compiled(spark, grid(**change))
    assert sorted(r.trait for r in out.excluded.collect()) == dropped
    kept = [n for n in RIVERS if n not in dropped]
    assert sorted(r.trait for r in out.retained.collect()) == kept
    order = [(r.p1, r.p2) for r in out.pairs.collect()]
    assert order == sorted(order) and {p for p, _ in order} == set(kept)
    assert out.status == ("compiled_with_trait_exclusions" if dropped else "compiled")


def test_failure_policies(spark):
    broken = list(grid(failing=both("rhein", "trave")))
    with pytest.raises(jobs.EstimationFailure, match="pair rows failed") as error:
        compiled(spark, broken, "error")
    assert error.value.audits["pair_status"].filter("Status <> 'valid'").count() == 2
    assert compiled(spark, broken, "report").status == "estimation_failures"
    with pytest.raises(jobs.EstimationFailure, match="at least two") as error:
        compiled(spark, grid(failing=set(itertools.product(RIVERS, repeat=2)), h2=dict.fromkeys(RIVERS, -.01)))
    assert error.value.status == "insufficient_traits"
    with pytest.raises(ValueError, match="mismatch") as error:
        compiled(spark, grid(absent=both("oder", "saale")), "report")
    assert error.value.status == "structural_failure" and error.value.audits["coverage"].filter("coverage <> 'present'").count() >= 2
    rows = list(grid())
    again = next(r for r in rows if (r["p1"], r["p2"]) == ("saale", "oder"))
    with pytest.raises(ValueError, match="conflicting"):
        compiled(spark, [*rows, {**again, "rg": ALIKE + .02, "row_id": 1000}])
    assert compiled(spark, [*rows, {**again, "row_id": 1000}]).pairs.count() == len(RIVERS) ** 2


def test_warnings_of_valid_rows(spark):
    change = {("oder", "oder"): dict(se=0.0, z=float("inf"), p=0.0, rg=1 - 2e-7), ("rhein", "oder"): dict(rg=-1.1), ("oder", "rhein"): dict(rg=-1.1), ("trave", "trave"): dict(h2_obs=.06)}
    status = {(r.p1, r.p2): r for r in compiled(spark, [{**r, **change.get((r["p1"], r["p2"]), {})} for r in grid()], "report").pair_status.collect()}
    assert status["oder", "oder"].Status == "valid" and "exception" in status["oder", "oder"].Warning
    assert status["oder", "rhein"].Warning == "Estimated rg outside [-1,1]"
    assert status["trave", "trave"].Warning == "Low self h2_obs/SE (<2); diagnostic only"


def rivers(spark, *more):
    return spark.createDataFrame([(n, i) for i, n in enumerate((*RIVERS, *more))], "trait string, trait_order int")


@pytest.mark.parametrize("matrix", ["correlation", "covariance"])
def test_panel(spark, matrix):
    panel = jobs.panel_analysis(compiled(spark, grid()).pairs, rivers(spark), jobs.PanelSettings(pca_matrix=matrix, rg_normalization="trait_wide"))
    first = 1 + (len(RIVERS) - 1) * ALIKE  # largest eigenvalue of equal correlations
    assert np.allclose(panel.weights, np.sqrt(first / len(RIVERS) * (OWN_H2 if matrix == "covariance" else 1)))
    assert np.allclose(np.diag(panel.cti), 1) and panel.names == RIVERS
    report = panel.reports["eigenvalues"].toPandas().sort_values("PC")
    assert np.isclose(report.cumulative_percent_raw.iloc[-1], 100)
    summary = panel.reports["validation"].toPandas()
    assert np.allclose(summary.Minimum_Intercept_Matrix_Eigenvalue, np.linalg.eigvalsh(panel.cti)[0])
    assert set(summary.Heritability_Scale_Used) == {"observed"} and set(summary.Total_Source_Rows_Read) == {len(RIVERS) ** 2}
    assert set(summary.Comparison_Epsilon) == {pairs.COMPARISON_EPSILON} and set(summary.RG_Out_Of_Range_Action) == {"warn"}


def test_panel_policies(spark):
    table = compiled(spark, grid(failing=both("unstrut", "oder") | both("unstrut", "saale")), "report").pairs
    manifest = rivers(spark, "warnow")
    with pytest.raises(jobs.EstimationFailure, match="absent"):
        jobs.panel_analysis(table, manifest)
    with pytest.raises(jobs.EstimationFailure, match="missing or invalid"):
        jobs.panel_analysis(table, manifest, jobs.PanelSettings(allow_missing_traits=True))
    panel = jobs.panel_analysis(table, manifest, jobs.PanelSettings(allow_missing_traits=True, failed_action="drop_traits"))
    assert panel.names == RIVERS[:4]
    for settings in (jobs.PanelSettings(cti_action="explore_drop"), jobs.PanelSettings(max_cti_drop_fraction=.5)):
        with pytest.raises(ValueError):
            settings.check()


@pytest.mark.parametrize("limit", [jobs.MAX_PANEL_TRAITS, 4])
def test_panel_explores_a_singular_cti(spark, limit, monkeypatch):
    """A panel that fits after the exclusion loses no other trait, whatever the limit was before it."""
    monkeypatch.setattr(jobs, "MAX_PANEL_TRAITS", limit)
    same = both("rhein", "trave")
    rows = [{**r, "gcov_int": 1.0 if (r["p1"], r["p2"]) in same else 0.0} for r in grid()]
    table = compiled(spark, rows).pairs
    with pytest.raises(jobs.EstimationFailure, match="CTI"):
        jobs.panel_analysis(table, rivers(spark))
    assert jobs.panel_analysis(table, rivers(spark), jobs.PanelSettings(pc1_only=True)).cti is None
    panel = jobs.panel_analysis(table, rivers(spark), jobs.PanelSettings(cti_action="explore_drop", max_cti_drop_fraction=.3))
    assert len(panel.names) == 4 and {"oder", "saale", "unstrut"} < set(panel.names) and panel.cti.shape == (4, 4)
    summary = panel.reports["validation"].toPandas()
    assert set(summary.trait) == set(panel.names) and set(summary.Unique_Pairs_With_Selected_Traits) == {4}
    assert set(summary.Expected_Unique_Rows) == set(summary.Observed_Unique_Rows) == {10} and set(summary.Selected_Source_Rows) == {16}
    assert panel.reports["correlations"].count() == 6 and panel.reports["matrices"].filter("matrix = 'I'").count() == 16


def test_epsilon_decides_at_the_limit(spark):
    """A self-pair that misses its tolerance by a little fails, unless the comparison allows for it; the same in every check of a panel."""
    rows = [{**r, "rg": 1 - 1.0001e-2} if r["p1"] == r["p2"] == "oder" else r for r in grid()]
    with pytest.raises(jobs.EstimationFailure):
        compiled(spark, rows, "error")
    table = compiled(spark, rows, "error", comparison_epsilon=1e-5).pairs
    with pytest.raises(jobs.EstimationFailure, match="missing or invalid"):
        jobs.panel_analysis(table, rivers(spark))
    panel = jobs.panel_analysis(table, rivers(spark), jobs.PanelSettings(comparison_epsilon=1e-5))
    assert panel.names == RIVERS and set(panel.reports["validation"].toPandas().Comparison_Epsilon) == {1e-5}
    with pytest.raises(ValueError, match="comparison_epsilon"):
        jobs.PanelSettings(comparison_epsilon=-1.0).check()


def test_reuse(spark):
    reference = spark.createDataFrame([("rs1", "A", "G"), ("rs2", "C", "T"), ("rs3", "A", "T")], "SNP string, A1 string, A2 string")
    munged = spark.createDataFrame([("ok", 1, "rs1", "A", "G", 5.0, 1.0), ("ok", 2, "rs2", "C", "T", 5.0, 1.0), ("swap", 1, "rs1", "A", "G", 5.0, 1.0),
                                    ("swap", 2, "rs2", "T", "C", 5.0, 1.0), ("flip", 1, "rs1", "T", "C", 5.0, 1.0), ("twice", 1, "rs1", "A", "G", 5.0, 1.0),
                                    ("twice", 2, "rs1", "A", "G", 5.0, 1.0), ("n", 1, "rs1", "A", "G", 6.0, 1.0), ("at", 1, "rs3", "T", "A", 5.0, 1.0)],
                                   "trait string, row int, SNP string, A1 string, A2 string, N double, Z double")
    from assocspark.operators import provenance
    prints = provenance.table_fingerprint(munged, ["SNP", "A1", "A2", "N", "Z"])
    ref = provenance.table_fingerprint(reference.withColumn("trait", F.lit("r")), ["SNP", "A1", "A2"]).first().fingerprint
    recorded = prints.select("trait", "fingerprint", F.lit(ref).alias("reference_fingerprint"), F.lit(5.0).alias("N_override"),
                             F.lit(None).cast("double").alias("sample_prevalence"), F.lit(None).cast("double").alias("population_prevalence"))
    names = ["ok", "swap", "flip", "twice", "n", "at"]
    manifest = spark.createDataFrame([(t, i, "", "", "") for i, t in enumerate(names)], "trait string, trait_order int, N string, sample_prevalence string, population_prevalence string")
    out = {r.trait: r for r in jobs.reuse_validation(munged, reference, manifest, recorded, order=["row"]).collect()}
    assert {t: out[t].reason for t in names} == {
        "ok": "exact reference allele order; no edits", "swap": "swapped allele order", "flip": "strand-complemented allele pair",
        "twice": "duplicate SNP ID", "n": "N differs from preparation override", "at": "swapped allele order"}
    changed = jobs.reuse_validation(munged.withColumn("Z", F.col("Z") + 1), reference, manifest, recorded, order=["row"])
    assert {r.reason for r in changed.collect()} == {"munged checksum mismatch"}


def test_two_pass(spark, simulated):
    _, reference, m = simulated
    rng = np.random.default_rng(1)
    frame = reference.toPandas()
    base = rng.standard_normal(len(frame)) * np.sqrt(.4 * 50_000 * frame.L2 / m + 1)
    rows = [(t, s, "G", "A", 50_000.0, float(z)) for t, f in enumerate((1, .9, 0)) for s, z in zip(frame.SNP, f * base + (1 - f) * (.02 if f == 0 else 1) * rng.standard_normal(len(frame)) * (50 / frame.L2 if f == 0 else 1))]
    munged = spark.createDataFrame(rows, "trait_order int, SNP string, A1 string, A2 string, N double, Z double")
    manifest = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "trait string, trait_order int")
    passed = jobs.two_pass_regression(munged, manifest, reference, reference, m, n_blocks=20)
    actions = {r.trait: r.QC_action for r in passed.trait_qc.collect()}
    assert actions == {"a": "retained", "b": "retained", "c": "removed"}
    assert passed.estimates.count() == 3
    bundle = passed.bundle()
    tables.check_bundle(bundle)
    panel = jobs.bundle_panel(bundle, passed.retained, manifest, jobs.PanelSettings(allow_missing_traits=True, failed_action="drop_traits"))
    assert panel.names == ("a", "b") and panel.cti.shape == (2, 2)
    absent = panel.reports["removed_traits"].first()
    assert (absent.Trait, absent.Reason, absent.Scope) == ("c", "Trait absent from the bundle", "trait")
    summary = {r.trait: (r.Retained, r.Removed) for r in panel.reports["trait_summary"].collect()}
    assert summary == {"a": (True, False), "b": (True, False), "c": (False, True)}
    with pytest.raises(jobs.EstimationFailure, match="absent"):
        jobs.bundle_panel(bundle, passed.retained, manifest)
    with pytest.raises(jobs.EstimationFailure, match="invalid heritability"):
        jobs.two_pass_regression(munged, manifest, reference, reference, m, n_blocks=20, invalid_h2_action="error")


def test_chisq_job(spark):
    munged = spark.createDataFrame([("T", f"rs{i}", z) for i, z in enumerate(["0", "8", "-8", "8.01", "", "NA", "nan", "NaN", "."])], "trait string, SNP string, Z string")
    kept, excluded, summary = jobs.chisq_filtered(munged, 64)
    s = summary.first()
    assert (s.variants_before, s.variants_removed, s.variants_after, s.variants_missing_z) == (9, 1, 8, 5)
    assert kept.count() == 8 and [r.SNP for r in excluded.collect()] == ["rs3"]
    for bad in (["x"], ["inf"], ["1e200"], ["NA"], ["100"]):
        with pytest.raises(ValueError):
            jobs.chisq_filtered(spark.createDataFrame([("T", "rs1", z) for z in bad], "trait string, SNP string, Z string"), 64)
    assert filters.MINIMUM_CHISQ_CUTOFF == 80 and pairs.SELF_RG_TOLERANCE == .01
