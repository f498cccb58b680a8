"""Public jobs, from per-trait records to exported combined associations.

Operators return failures as data. A job runs the small checks its policy needs (counts per trait or pair),
keeps the audits beside the result, and raises only after they exist.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, fields

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_finite
from ..operators import alleles, bundles, combine, export, filters, matrices, ordering, pairs, panels, provenance, regression
from ..operators import variant_qc as vq
from ..session import counted, durable, small, stored
from ..sources import sinks

MAX_PANEL_TRAITS = 4096


class EstimationFailure(RuntimeError):
    """A reportable numerical failure; ``status`` names it and ``audits`` holds the tables that explain it."""

    def __init__(self, message: str, status: str = "estimation_failures", **audits: DataFrame):
        super().__init__(message)
        self.status, self.audits = status, audits


class StructuralFailure(ValueError):
    """A table that does not hold the requested pairs; ``audits`` holds its coverage."""

    status = "structural_failure"

    def __init__(self, message: str, **audits: DataFrame):
        super().__init__(message)
        self.audits = audits


# --- preparation ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class Prepared:
    assoc: DataFrame | None = None
    assoc_qc: vq.QcResult | None = None
    regression: DataFrame | None = None
    regression_qc: vq.QcResult | None = None


def _require_rows(table: DataFrame, manifest: DataFrame, what: str) -> None:
    empty = manifest.select("trait").join(table.select("trait").distinct(), "trait", "left_anti").take(1)
    if empty:
        raise ValueError(f"{empty[0]['trait']}: no usable {what}; see the issue report")


def regression_variants(raw: DataFrame, metadata: DataFrame, hm3: DataFrame, *, order: Sequence[str], p_min: float = vq.P_MIN,
                        id_source: str = "vcf_id") -> vq.QcResult:
    """Regression-side QC: manifest N where given, INFO required, then the reference SNP list."""
    order = list(order)
    found = vq.validate_variants(filters.override_n(raw, metadata).drop("N_source"), order=order, p_min=p_min,
                                 id_source=id_source, require_info=True)
    named = found.good.withColumn("SNP", vq.variant_id(id_source))
    kept, removed = filters.hm3_select(named, hm3, keys=order)

    def issues():
        return vq.replace_issues(found.issues, removed, ["trait", *order])

    def summary():
        lost = removed.groupBy("trait").agg(F.count("*").alias("hapmap_removed_rows"))
        adjusted = kept.groupBy("trait").agg(F.count_if(F.col("LP") > vq.lp_ceiling(p_min)).alias("_adjusted"))
        return (found.summary.join(lost, "trait", "left").join(adjusted, "trait", "left")
                .withColumn("hapmap_removed_rows", F.coalesce("hapmap_removed_rows", F.lit(0)))
                .withColumns({"retained_rows": F.col("retained_rows") - F.col("hapmap_removed_rows"),
                              "removed_rows": F.col("removed_rows") + F.col("hapmap_removed_rows"),
                              "p_adjusted_rows": F.coalesce("_adjusted", F.lit(0))}).drop("_adjusted"))
    return vq.QcResult(kept, issues, summary)


def prepare(raw: DataFrame, manifest: DataFrame, *, order: Sequence[str], mode: str = "assoc", hm3: DataFrame | None = None,
            p_min: float = vq.P_MIN, assoc_id_source: str = "chr_pos_ref_alt", munge_id_source: str = "vcf_id", check: bool = True) -> Prepared:
    """Association tables, regression tables, or both from one parsed scan; the two QC paths are independent.

    ``raw`` is read once: it is checkpointed when both paths need it. The association path always keeps the
    record's own N. ``check`` runs the per-trait jobs that turn empty or ill-named results into errors.
    """
    if mode not in ("assoc", "regression", "both"):
        raise ValueError("mode must be assoc, regression or both")
    if (mode != "assoc") != (hm3 is not None):
        raise ValueError("a reference SNP list is required for regression tables, and only there")
    if mode == "both" or check:
        raw = durable(raw)
    out = {}
    if mode != "regression":
        qc = vq.validate_variants(raw, order=order, p_min=p_min, id_source=assoc_id_source)
        assoc = sinks.assoc_table(qc.good.join(manifest.select("trait", "trait_order"), "trait") if "trait_order" not in raw.columns else qc.good, assoc_id_source)
        if check:
            assoc = stored(assoc)
        out.update(assoc=assoc, assoc_qc=qc)
        if check:
            _require_rows(assoc, manifest, "association records")
            vq.assert_ids(assoc, "SNPID")
    if mode != "assoc":
        metadata = filters.resolve_sample_metadata(manifest)
        if check:
            bad = metadata.filter(F.col("reason") != "").take(1)
            if bad:
                raise ValueError(f"{bad[0]['trait']}: {bad[0]['reason']}")
        qc = regression_variants(raw, metadata, hm3, order=order, p_min=p_min, id_source=munge_id_source)
        table = sinks.munge_input(qc.good, "shared", "vcf_id")
        if check:
            table = stored(table)
        out.update(regression=table, regression_qc=qc)
        if check:
            _require_rows(table, manifest, "records on the reference SNP list")
            vq.assert_ids(table, "SNP")
    return Prepared(**out)


def prepare_matrix_inputs(raw: DataFrame, metadata: DataFrame, *, order: Sequence[str], p_min: float = vq.P_MIN) -> tuple[DataFrame, vq.QcResult]:
    """Third layout: own IDs, INFO required, folded frequency, manifest N where given; no reference list."""
    qc = vq.validate_variants(filters.override_n(raw, metadata).drop("N_source"), order=order, p_min=p_min, id_source="vcf_id", require_info=True)
    return sinks.munge_input(qc.good, "folded_maf"), qc


def extract(records: DataFrame, manifest: DataFrame, *, settings: filters.VariantFilters = filters.VariantFilters()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Filtered regression inputs, the missing-frequency audit, and prevalences with their source.

    ``records``: ``trait, SNP, CHR, POS, A1 (ALT), A2 (REF), EZ, LP, AF, NEF, SI[, NC, NCO], INFO_AF, INFO_EUR`` as
    text. Traits with a population prevalence use N = cases + controls; every count must be positive.
    """
    numeric = [c for c in ("EZ", "LP", "AF", "NEF", "SI", "NC", "NCO") if c in records.columns]
    rows = records.withColumns({c: F.col(c).try_cast("double") for c in numeric}).withColumns(
        {"CHR": F.regexp_replace("CHR", "(?i)^chr", "").try_cast("int"), "POS": F.col("POS").try_cast("bigint")})
    if settings.exclude_mhc:
        rows = filters.exclude_region(rows, settings.mhc_chr, settings.mhc_start, settings.mhc_end)
    audit = filters.af_audit(rows)
    kept = filters.info_maf_filter(filters.af_difference_filter(rows, settings.max_af_difference), settings.info_min, settings.maf_min)
    if settings.remove_palindrome:
        kept = filters.palindrome_filter(kept, settings.pal_lower, settings.pal_upper, ref="A2", alt="A1")
    resolved = filters.resolve_sample_metadata(manifest.withColumn("N", F.lit("1")))
    impossible = resolved.filter(F.col("reason").contains("strictly between 0 and 1")).take(1)  # a missing sample prevalence is inferred below
    if impossible:
        raise ValueError(f"{impossible[0]['trait']}: {impossible[0]['reason']}")
    metadata = counted(resolved.select("trait", "sample_prevalence", "population_prevalence"))
    joined = kept.join(metadata, "trait")
    binary = F.col("population_prevalence").isNotNull()
    n = F.when(binary, F.col("NC") + F.col("NCO")).otherwise(F.col("NEF")) if "NC" in kept.columns else F.col("NEF")
    table = joined.select("trait", "SNP", "CHR", F.col("POS").alias("BP"), "A1", "A2", F.col("EZ").alias("EZ"),
                          vq.lp_to_p("LP", None).alias("P"), F.col("AF").alias("EAF"), n.alias("N"))
    prevalence = metadata
    if "NC" in kept.columns:
        counts = filters.infer_prevalence(joined.filter(binary))
        bad = counts.filter("invalid_counts > 0").take(1)
        if bad:
            raise ValueError(f"{bad[0]['trait']}: case and control counts must be positive and finite for every variant")
        prevalence = metadata.join(counts.select("trait", "case_fraction"), "trait", "left").select(
            "trait", F.when(binary, F.coalesce("sample_prevalence", "case_fraction")).alias("sample_prevalence"), "population_prevalence",
            F.when(binary, F.when(F.col("sample_prevalence").isNull(), "median_case_fraction").otherwise("provided")).alias("sample_prevalence_source"))
    return table, audit, prevalence


# --- regression ----------------------------------------------------------------------------------

def chisq_filtered(munged: DataFrame, cutoff: float | str, *, reference: DataFrame | None = None, weights: DataFrame | None = None,
                   keys: Sequence[str] = ("trait", "trait_order", "file_block", "file_row", "row_id")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fixed or automatic chi-square filter, checked: (kept, excluded, summary).

    A row sets its trait's automatic cutoff only if all its columns but ``keys`` are filled in. The summary names the mode and, in the
    automatic one, the largest matched N and the number of complete matched rows.
    """
    mode, limits = "fixed", None
    if cutoff == "auto":
        mode = "auto"
        if reference is None:
            raise ValueError("the automatic cutoff needs LD-score reference SNPs")
        matched = filters.matched_snps(reference, reference if weights is None else weights)
        limits = durable(filters.auto_chisq_cutoff(munged, matched, [c for c in munged.columns if c not in keys]))
        bad = limits.filter("invalid_n > 0").take(1)
        if bad:
            raise ValueError(f"{bad[0]['trait']}: matched N must be finite and positive")
        absent = munged.select("trait").distinct().join(limits, "trait", "left_anti").take(1)
        if absent:
            raise ValueError(f"{absent[0]['trait']}: no complete rows match both LD-score tables")
        cutoff = small(limits, limits.count())
    kept, excluded, summary = filters.chisq_filter(munged, cutoff)
    filters.check_chisq_summary(summary)
    summary = summary.withColumn("threshold_mode", F.lit(mode))
    if limits is not None:
        return kept, excluded, summary.join(limits.select("trait", "maximum_matched_n", "complete_ld_matched_rows"), "trait", "left")
    return kept, excluded, summary.withColumns({"maximum_matched_n": F.lit(None).cast("double"), "complete_ld_matched_rows": F.lit(None).cast("long")})


def regress_pairs(munged: DataFrame, manifest: DataFrame, ldscores: DataFrame, weights: DataFrame, m: float, *, n_blocks: int = regression.N_BLOCKS) -> DataFrame:
    """Directed pair table of all requested comparisons."""
    traits = manifest.count()
    rows = munged.join(manifest.select("trait", "trait_order"), "trait") if "trait_order" not in munged.columns else munged
    vectors = regression.snp_vectors(rows, ldscores, weights, traits)
    return regression.pair_table(regression.pair_regressions(vectors, m, n_blocks=n_blocks), manifest)


@dataclass(frozen=True)
class TwoPass:
    """Estimates of the pairs of retained traits, QC of all traits, and what a bundle is built from."""

    estimates: DataFrame
    trait_qc: DataFrame
    fit: regression.PairFit
    retained: DataFrame          # trait, trait_order, position (in the bundle), factor (to the liability scale)

    def bundle(self, *, delta: bool = False) -> DataFrame:
        """S, I, V, S_Stand and V_Stand of the retained traits in long form."""
        return bundles.sampling_bundle(self.fit, self.retained, delta=delta)


def two_pass_regression(munged: DataFrame, manifest: DataFrame, ldscores: DataFrame, weights: DataFrame, m: float, *, n_blocks: int = regression.N_BLOCKS,
                        invalid_h2_action: str = "drop") -> TwoPass:
    """Estimate all traits, drop (or reject) those without positive heritability, and keep the estimates of the rest.

    A pair's estimate does not depend on other traits, so the second pass is a selection from the first and no further scan. Where ``manifest`` has
    ``sample_prevalence`` and ``population_prevalence``, the bundle is on the liability scale.
    """
    if invalid_h2_action not in ("drop", "error"):
        raise ValueError("invalid_h2_action must be drop or error")
    rows = munged.join(manifest.select("trait", "trait_order"), "trait") if "trait_order" not in munged.columns else munged
    traits = manifest.count()
    fit = regression.fit_pairs(regression.snp_vectors(rows, ldscores, weights, traits), m, n_blocks=n_blocks)
    first = durable(regression.summarise_pairs(fit))
    own = manifest.select("trait", "trait_order").join(first.filter("i = j").select(F.col("i").alias("trait_order"), F.col("h2_p1_pair_obs").alias("h2_estimate")), "trait_order", "left")
    reason = F.when(~is_finite("h2_estimate"), "Non-finite h2").when(F.col("h2_estimate") <= 0, "Non-positive h2").otherwise("")
    qc = durable(own.withColumn("QC_reason", reason).withColumn(
        "QC_action", F.when(F.col("QC_reason") == "", "retained").otherwise("removed" if invalid_h2_action == "drop" else "error")))
    known = {"sample_prevalence", "population_prevalence"} <= set(manifest.columns)
    factor = regression.liability_factor() if known else F.lit(1.0)
    kept = manifest.withColumn("factor", factor).join(qc.filter("QC_reason = ''").select("trait"), "trait", "left_semi")
    position = F.row_number().over(Window.orderBy("trait_order")) - 1  # one row a trait
    retained = durable(kept.select("trait", F.col("trait_order").cast("int").alias("trait_order"), position.cast("long").alias("position"), "factor"))
    left = retained.count()
    if left < traits and invalid_h2_action == "error":
        raise EstimationFailure("invalid heritability; see the trait QC table", trait_qc=qc)
    if left < 2:
        raise EstimationFailure("fewer than two traits remain after heritability QC", trait_qc=qc)
    numbers = retained.select("trait_order")
    second = first.join(numbers.withColumnRenamed("trait_order", "i"), "i", "left_semi").join(numbers.withColumnRenamed("trait_order", "j"), "j", "left_semi")
    return TwoPass(second, qc, fit, retained)


# --- pair table ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class CompiledPairs:
    status: str
    pairs: DataFrame
    pair_status: DataFrame
    trait_status: DataFrame
    excluded: DataFrame | None = None
    retained: DataFrame | None = None


def compile_pairs(table: DataFrame, manifest: DataFrame, *, action: str = "error", row: str = "row_id", duplicate_tolerance: float = pairs.DUPLICATE_TOLERANCE,
                  duplicate_z_tolerance: float = pairs.DUPLICATE_Z_TOLERANCE, self_rg_tolerance: float = pairs.SELF_RG_TOLERANCE,
                  h2_z_warn_threshold: float = pairs.H2_Z_WARNING, comparison_epsilon: float = pairs.COMPARISON_EPSILON) -> CompiledPairs:
    """Validated, ordered and normalised pair table under one failure policy.

    ``error`` raises on any failed estimate, ``report`` keeps it, ``drop_traits`` selects a complete subset
    (and then needs every trait as reference). Conflicting repeats and unrequested pairs are always fatal.
    ``manifest``: ``trait, trait_order, ref, population_prevalence`` (numeric or NULL).
    """
    if action not in ("error", "report", "drop_traits"):
        raise ValueError("action must be error, report or drop_traits")
    dropping = action == "drop_traits"
    if dropping and manifest.filter(F.coalesce(F.col("ref"), F.lit("")) != "yes").take(1):
        raise ValueError("drop_traits requires ref=yes for every trait")
    table = durable(table)
    pairs.raise_on_conflicts(pairs.duplicate_conflicts(pairs.index_pairs(table, manifest), tolerance=duplicate_tolerance, z_tolerance=duplicate_z_tolerance, epsilon=comparison_epsilon))
    coverage = durable(pairs.pair_coverage(table, pairs.plan_pairs(manifest)))
    bad = coverage.filter((F.col("coverage") == "unexpected") | F.lit(not dropping)).take(1)
    if bad:
        raise StructuralFailure(f"pair comparison mismatch: {bad[0]['coverage']} {bad[0]['p1']}, {bad[0]['p2']}", coverage=coverage)
    status = pairs.pair_status(table, self_rg_tolerance=self_rg_tolerance, h2_z_warning=h2_z_warn_threshold,
                               comparison_epsilon=comparison_epsilon).select(row, "p1", "p2", "Status", "Reason", "Warning")
    missing = coverage.select(F.lit(None).cast(table.schema[row].dataType).alias(row), "p1", "p2", F.lit("missing_result").alias("Status"),
                              F.lit("Missing requested comparison").alias("Reason"), F.lit("").alias("Warning"))
    status = durable(pairs.sort_by_manifest(status.unionByName(missing), manifest, row))
    # Exact repeats collapse to their first row.
    source = {row, "source_file", "source_number", "source_row"}
    values = [c for c in table.columns if c not in source]
    once = table.groupBy(*values).agg(F.min(row).alias(row))
    scaled = pairs.map_h2_scale(pairs.with_h2_columns(once), manifest)
    ordered = durable(pairs.sort_by_manifest(pairs.trait_wide_normalization(scaled, row), manifest, row))
    traits = pairs.trait_status(ordered, status, manifest, row)
    failed = status.filter("Status <> 'valid'").count()
    if not dropping:
        if failed and action == "error":
            raise EstimationFailure(f"{failed} pair rows failed QC", pairs=ordered, pair_status=status, trait_status=traits)
        return CompiledPairs("estimation_failures" if failed else "compiled", ordered, status, traits)
    index = pairs.index_pairs(status, manifest)
    broken = index.filter("Status = 'failed_estimate'").select("pair_i", "pair_j").unionByName(
        pairs.plan_pairs(manifest, unordered=True).select(F.col("o1").alias("pair_i"), F.col("o2").alias("pair_j")).join(
            index.filter("Status <> 'missing_result'").select("pair_i", "pair_j"), ["pair_i", "pair_j"], "left_anti")).distinct()
    own = broken.filter("pair_i = pair_j").select(F.col("pair_i").alias("trait_order"), F.lit(True).alias("_bad"))
    # The mean of a trait's self-pairs, which agree or would have been fatal; a negative heritability gives a negative ratio.
    means = ordered.filter("p1 = p2").groupBy(F.col("p1").alias("trait")).agg(
        F.avg(F.coalesce("h2_liab", "h2_obs")).alias("_h2"), F.avg(F.coalesce("h2_liab_se", "h2_obs_se")).alias("_h2_se"))
    z = F.when(F.col("_h2_se") > 0, F.col("_h2") / F.col("_h2_se"))
    nodes = traits.join(own, "trait_order", "left").join(means, "trait", "left").select(
        F.lit("all").alias("panel_id"), "trait_order", F.coalesce("_bad", F.lit(False)).alias("self_failed"),
        F.when(F.col("Self_Reason") != "", F.col("Self_Reason")).otherwise("Missing self-pair").alias("self_reason"), z.alias("H2_Z"))
    excluded = durable(panels.select_complete_traits(broken.withColumn("panel_id", F.lit("all")), nodes).join(manifest.select("trait", "trait_order"), "trait_order"))
    retained = manifest.join(excluded.select("trait"), "trait", "left_anti")
    traits = traits.join(excluded.select("trait", F.col("reason").alias("Exclusion_Reason")), "trait", "left").withColumn(
        "Retained", F.col("Exclusion_Reason").isNull())
    left = retained.count()
    if left < 2:
        raise EstimationFailure(f"trait removal leaves {left} trait(s); at least two are required", "insufficient_traits", excluded=excluded, pair_status=status, trait_status=traits)
    kept = pairs.sort_by_manifest(pairs.restrict(ordered, retained), manifest, row)
    return CompiledPairs("compiled_with_trait_exclusions" if excluded.take(1) else "compiled", kept, status, traits, excluded, retained)


# --- panel ---------------------------------------------------------------------------------------

@dataclass(frozen=True)
class PanelSettings:
    """Policies and tolerances of a panel. Tolerances are absolute, but those of Z (relative) and of eigenvalues (see ``panels``)."""

    duplicate_tolerance: float = pairs.DUPLICATE_TOLERANCE
    duplicate_z_tolerance: float = pairs.DUPLICATE_Z_TOLERANCE
    self_rg_tolerance: float = pairs.SELF_RG_TOLERANCE
    comparison_epsilon: float = pairs.COMPARISON_EPSILON
    h2_z_warn_threshold: float = pairs.H2_Z_WARNING
    z_consistency_tolerance: float = pairs.Z_CONSISTENCY_TOLERANCE
    matrix_eigen_tolerance: float = panels.MATRIX_EIGEN_TOLERANCE
    allow_missing_traits: bool = False
    failed_action: str = "error"
    heritability_scale: str = "auto"
    rg_normalization: str = "pair"
    pca_matrix: str = "correlation"
    pc1_orientation: str = "tutorial"
    negative_eigen_action: str = "warn"
    rg_out_of_range_action: str = "warn"
    z_consistency_action: str = "warn"
    cti_action: str = "error"
    max_cti_drop_fraction: float = 0.0
    pc1_only: bool = False
    validate_only: bool = False

    def check(self) -> None:
        limits = {name: value for name, value in vars(self).items() if name.endswith(("_tolerance", "_threshold", "_epsilon"))}
        if bad := [name for name, value in limits.items() if not (np.isfinite(value) and value >= 0)]:
            raise ValueError(f"{', '.join(bad)} must be finite and not negative")
        if self.pc1_only and self.validate_only:
            raise ValueError("choose pc1_only or validate_only, not both")
        if not 0 <= self.max_cti_drop_fraction < 1:
            raise ValueError("max_cti_drop_fraction must be in [0,1)")
        if self.cti_action == "explore_drop" and (self.max_cti_drop_fraction <= 0 or self.pc1_only):
            raise ValueError("explore_drop needs a positive max_cti_drop_fraction and excludes pc1_only")
        if self.cti_action == "error" and self.max_cti_drop_fraction:
            raise ValueError("max_cti_drop_fraction requires explore_drop")

    def policy(self) -> pairs.PairPolicy:
        return pairs.PairPolicy(**{f.name: getattr(self, f.name) for f in fields(pairs.PairPolicy)})


@dataclass(frozen=True)
class PanelResult:
    traits: DataFrame            # trait, trait_order (original), position in the panel
    loadings: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)
    names: tuple[str, ...] = ()
    cti: np.ndarray | None = None
    weights: np.ndarray | None = None


def panel_matrix(cells: DataFrame, positions: Sequence[int]) -> np.ndarray:
    """One trait-by-trait matrix on the driver; its size is checked, and it is the model, not the data."""
    if len(positions) > MAX_PANEL_TRAITS:
        raise ValueError(f"a panel has at most {MAX_PANEL_TRAITS} traits")
    frame = cells.select("i", "j", "value").toPandas()
    frame = frame[frame["i"].isin(positions) & frame["j"].isin(positions)]
    return panels.symmetric(panels.dense(frame, np.asarray(positions))[1])


def panel_analysis(table: DataFrame, manifest: DataFrame, settings: PanelSettings = PanelSettings(), *, row: str = "row_id") -> PanelResult:
    """Validated matrices, PC1 and CTI of one trait set, with every policy applied and audited."""
    settings.check()
    reports: dict[str, DataFrame] = {}
    typed = durable(pairs.with_h2_columns(pairs.restrict(table, manifest)))
    present = pairs.trait_availability(manifest, typed)
    reports["missing_traits"] = present.filter("NOT present").select("trait", "trait_order", "reason")
    gone = reports["missing_traits"].take(1)
    if gone and not settings.allow_missing_traits:
        raise EstimationFailure(f"trait absent from the pair table: {gone[0]['trait']}", **reports)
    traits = present.filter("present").select("trait", "trait_order")
    dropping = settings.failed_action == "drop_traits"
    scaled, choice = pairs.select_h2_scale(typed, settings.heritability_scale, "correlation" if dropping else settings.pca_matrix)
    reports["heritability_scales"] = choice
    bad = choice.filter(F.col("error").isNotNull()).take(1)
    if bad:
        raise EstimationFailure(f"{bad[0]['trait']}: {bad[0]['error']}", **reports)
    rows = durable(pairs.index_pairs(scaled, traits))
    pairs.raise_on_conflicts(pairs.duplicate_conflicts(rows, tolerance=settings.duplicate_tolerance, z_tolerance=settings.duplicate_z_tolerance, epsilon=settings.comparison_epsilon))
    own = durable(pairs.self_pair_qc(rows, traits, tolerance=settings.self_rg_tolerance, h2_z_warning=settings.h2_z_warn_threshold, epsilon=settings.comparison_epsilon))
    validity = durable(pairs.pair_validity(rows, traits, settings.self_rg_tolerance, settings.comparison_epsilon))
    reports.update(self_pair_qc=own, failed_pairs=validity.filter(~F.col("Pair_Valid")))
    if validity.filter(~F.col("Pair_Valid")).take(1) or own.filter(~F.col("Self_QC_Pass")).take(1):
        if not dropping:
            raise EstimationFailure("the selected set has missing or invalid pair estimates", **reports)
        nodes = own.select(F.lit("all").alias("panel_id"), "trait_order", (~F.col("Self_QC_Pass")).alias("self_failed"),
                           F.col("Self_QC_Failure_Reason").alias("self_reason"), "H2_Z")
        excluded = durable(panels.select_complete_traits(reports["failed_pairs"].withColumn("panel_id", F.lit("all")), nodes))
        reports["dropped_traits"] = excluded
        traits = traits.join(excluded.select("trait_order"), "trait_order", "left_anti")
        own = own.join(traits.select("trait"), "trait", "left_semi")
        rows = durable(pairs.index_pairs(pairs.restrict(scaled, traits), traits))
    positions = [r[0] for r in traits.select("trait_order").orderBy("trait_order").collect()]
    if len(positions) < 2:
        raise EstimationFailure("fewer than two traits remain", **reports)
    collapsed = durable(pairs.collapse_pairs(rows))
    report = pairs.rg_report(collapsed, traits, z_tolerance=settings.z_consistency_tolerance, epsilon=settings.comparison_epsilon)
    for flag, policy, what in (("RG_Outside_Unit_Interval", settings.rg_out_of_range_action, "correlation outside [-1,1]"),
                               ("Z_Inconsistent_With_RG_SE", settings.z_consistency_action, "Z differs from rg / SE")):
        if policy == "error" and report.filter(flag).take(1):
            raise EstimationFailure(what, **reports)
    rg = pairs.select_rg(collapsed, rows, settings.rg_normalization, tolerance=settings.duplicate_tolerance, out_of_range_action=settings.rg_out_of_range_action,
                         epsilon=settings.comparison_epsilon)
    cells = durable(matrices.assemble_matrices(collapsed, own, rg=rg))
    correlation = cells.filter("matrix = 'S_Stand'").select(F.lit("all").alias("panel_id"), "i", "j", "value")
    cti = cells.filter("matrix = 'I'").select(F.lit("all").alias("panel_id"), "i", "j", "value")
    validated = pairs.Validated(own, collapsed, report, cells)
    total = table.count()

    def describe(valid: pairs.Validated, intercepts: DataFrame) -> None:
        reports.update(matrices=valid.cells, heritability=pairs.heritability_report(valid.self_qc), correlations=valid.report, validation=valid.summary(
            settings.policy(), source_rows_read=total, scales=choice, intercept_eigenvalues=panels.panel_eigenvalues(intercepts, settings.matrix_eigen_tolerance)))
    describe(validated, cti)
    pca = correlation
    if settings.pca_matrix == "covariance":
        covariance = durable(matrices.covariance_matrix(correlation, own.select("trait_order", F.col("Self_H2").alias("h2"))))
        matrices.check_covariance(covariance)
        reports["covariances"] = matrices.covariance_report(report, covariance)
        pca = covariance.select("panel_id", "i", "j", "value")
    if settings.cti_action == "explore_drop":
        history = durable(panels.cti_explore_drop(cti, pca, settings.max_cti_drop_fraction, settings.pc1_orientation))
        reports["cti_history"] = history
        steps = history.orderBy("step").collect()  # at most one row per trait
        if steps[-1]["outcome"] != "PASS":
            raise EstimationFailure("CTI still fails within the permitted exclusion limit", **reports)
        removed = [s["dropped"] for s in steps if s["dropped"] is not None]
        positions = [p for p in positions if p not in removed]
        traits = traits.filter(F.col("trait_order").isin(positions))
        baseline = panels.panel_loadings(pca, settings.pc1_orientation)
        keep = F.col("i").isin(positions) & F.col("j").isin(positions)
        pca, cti = pca.filter(keep), cti.filter(keep)
        reports["selection_sensitivity"] = panels.selection_sensitivity(baseline, panels.panel_loadings(pca, settings.pc1_orientation))[1]
        describe(validated.subset(traits), cti)
    return _assessed(pca, cti, traits, positions, settings, reports)


def _assessed(pca: DataFrame, cti: DataFrame, traits: DataFrame, positions: Sequence[int], settings: PanelSettings, reports: dict[str, DataFrame]) -> PanelResult:
    """PC1 and CTI of the matrices used, with the policies on them."""
    loadings = durable(panels.panel_loadings(pca, settings.pc1_orientation))
    values = durable(panels.panel_eigenvalues(pca, settings.matrix_eigen_tolerance))
    pc1 = panels.pc1_report(loadings, values, negative_action=settings.negative_eigen_action)
    assessed = panels.assess_cti(cti)
    reports.update(eigenvalues=panels.variance_explained(values), pc1=pc1, contributions=panels.contributions(loadings),
                   assessment=panels.matrix_assessment(assessed, pc1, values))
    verdict = reports["assessment"].first()
    if verdict["PC1_QC_Status"] != "PASS" or not verdict["Matrix_Policy_Allows_Analysis"]:
        raise EstimationFailure(f"PC1 is not usable: {verdict['PC1_QC_Reasons']}", **reports)
    if verdict["CTI_Status"] != "PASS" and not settings.pc1_only:
        raise EstimationFailure(f"CTI assessment: {verdict['CTI_Status']}", **reports)
    names = tuple(r["trait"] for r in traits.orderBy("trait_order").collect())
    vector = loadings.orderBy("i").toPandas()["loading"].to_numpy()
    full = not (settings.pc1_only or settings.validate_only)
    return PanelResult(traits, loadings, reports, names, panel_matrix(cti, positions) if full else None, vector)


def bundle_panel(bundle: DataFrame, labels: DataFrame, manifest: DataFrame, settings: PanelSettings = PanelSettings()) -> PanelResult:
    """PC1 and CTI from a matrix bundle (``sources.read_matrix_bundle``) whose rows ``labels`` (``trait, position``) name.

    Checks leave events (``reports["events"]``, with a summary per trait); one with the action ``stop`` ends the job. The matrices are those of the traits
    retained, in manifest order; V keeps every genuine covariance of their pairs.
    """
    settings.check()
    policy = bundles.BundlePolicy(settings.allow_missing_traits, settings.failed_action, settings.rg_out_of_range_action, settings.h2_z_warn_threshold)
    events, kept = bundles.bundle_events(bundle, labels, manifest, policy)
    events = durable(events)
    reports: dict[str, DataFrame] = {"events": events, "warnings": events.filter("Severity = 'warning'"), "removed_traits": events.filter("Action = 'removed'"),
                                     "trait_summary": pairs.audit_summary(events, manifest, "event_order", retained=kept)}
    stops = events.filter("Action = 'stop'").orderBy("event_order").take(1)
    if stops:
        raise EstimationFailure(f"{stops[0]['Trait']}: {stops[0]['Reason']}" if stops[0]["Trait"] else stops[0]["Reason"], **reports)
    kept = durable(kept)
    positions = [r[0] for r in kept.select("trait_order").orderBy("trait_order").collect()]  # one number a trait
    if len(positions) < 2:
        raise EstimationFailure("fewer than two traits remain", **reports)
    by_manifest = bundle.join(kept.select(F.col("position").alias("i"), F.col("trait_order").alias("_i")), "i").join(kept.select(F.col("position").alias("j"), F.col("trait_order").alias("_j")), "j")
    cells = durable(by_manifest.filter(F.col("matrix").isin("S", "I", "S_Stand")).select("panel_id", "matrix", F.col("_i").alias("i"), F.col("_j").alias("j"), "value"))
    new = kept.select(F.lit("all").alias("panel_id"), F.col("position").alias("old_position"), (F.row_number().over(Window.orderBy("trait_order")) - 1).cast("long").alias("new_position"))
    reports["matrices"] = cells
    for name in ("V", "V_Stand"):
        part = bundle.filter(F.col("matrix") == name).select(F.lit("all").alias("panel_id"), F.col("i").alias("pair_a"), F.col("j").alias("pair_b"), "value")
        reports[name] = matrices.subset_vech(part, new)
    used = "S_Stand" if settings.pca_matrix == "correlation" else "S"

    def pick(name):
        return cells.filter(F.col("matrix") == name).select(F.lit("all").alias("panel_id"), "i", "j", "value")
    return _assessed(pick(used), pick("I"), kept.select("trait", "trait_order"), positions, settings, reports)


# --- combination and export ----------------------------------------------------------------------

def combine_snps(assoc: DataFrame, panel: PanelResult, *, kernel=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Combined associations of a panel's traits, with their QC (issues, summary). Raises if any SNP fails."""
    order = assoc.sparkSession.createDataFrame(list(enumerate(panel.names)), "trait_order int, trait string")
    rows = stored(assoc.drop("trait_order").join(small(order, len(panel.names)), "trait"))  # read by the checks, the combination and its QC
    vq.assert_ids(rows, "SNPID")
    absent = order.join(rows.select("trait").distinct(), "trait", "left_anti").take(1)
    if absent:
        raise ValueError(f"{absent[0]['trait']}: no association table")
    result = durable(combine.combine_traits(rows, panel.cti, panel.weights, combine=kernel))
    issues, summary = combine.combined_qc(result, panel.weights, assoc=rows)
    state = summary.first()
    if state["Status"] != "passed":
        raise EstimationFailure(f"combined associations failed QC for {state['Invalid_Rows']} SNPs", result=result, issues=issues, summary=summary)
    return result, issues, summary


def export_results(tables: Sequence[DataFrame], *, n_eff: float | None = None, info: float | None = None) -> tuple[DataFrame, DataFrame]:
    """One table in genomic order with direction counts, and its 12-column summary. Validates before it sorts."""
    combined = combine.direction_counts(export.union_results(tables))
    if combine.invalid_directions(combined).take(1):
        raise ValueError("Direction must contain only +, - and ? and be non-empty")
    _, summary = combine.export_qc(combined, "source_order")
    bad = summary.filter("Invalid_Rows > 0").take(1)
    if bad:
        raise EstimationFailure(f"table {bad[0]['source_order']}: {bad[0]['Invalid_Rows']} rows failed QC", summary=summary)
    vq.assert_ids(combined, "SNPID", group=None)
    if ordering.invalid_positions(combined).take(1):
        raise ValueError("CHR/BP must provide valid positive integer positions (X/Y/XY/MT also accepted)")
    ordered = ordering.sort_by_position(combined, ["source_order", "SNPID"])
    return ordered, export.export_summary(ordered, n_eff=n_eff, info=info)


def reuse_validation(munged: DataFrame, reference: DataFrame, manifest: DataFrame, recorded: DataFrame, *, order: Sequence[str]) -> DataFrame:
    """Per trait: may prepared tables be reused? Alleles, fingerprints, common reference, N and prevalences.

    ``recorded``: ``trait, fingerprint, reference_fingerprint, N_override, sample_prevalence,
    population_prevalence`` as stored with the prepared tables.
    """
    bad_reference = alleles.allele_reference_failures(reference).take(1)
    if bad_reference:
        raise ValueError(f"allele reference: {bad_reference[0]['reason']}: {bad_reference[0]['SNP']!r}")
    expected = recorded.select("trait", F.col("N_override").alias("_n"))
    classified = alleles.classify_alleles(munged.join(expected, "trait", "left"), reference, order, n_override="_n")
    audit = alleles.allele_audit(classified, order)
    current = provenance.table_fingerprint(munged, ["SNP", "A1", "A2", "N", "Z"]).select("trait", F.col("fingerprint").alias("_current"))
    ref = provenance.table_fingerprint(reference.withColumn("trait", F.lit("reference")), ["SNP", "A1", "A2"]).select(F.col("fingerprint").alias("_f")).first()["_f"]
    metadata = filters.resolve_sample_metadata(manifest).select("trait", F.col("N").alias("_mn"), F.col("sample_prevalence").alias("_sp"), F.col("population_prevalence").alias("_pp"))
    rows = audit.join(recorded, "trait", "left").join(current, "trait", "left").join(metadata, "trait", "left")
    problem = (F.when(F.col("fingerprint").isNull(), "missing preparation record")
               .when(F.col("reference_fingerprint") != ref, "traits were prepared against different allele references")
               .when(F.col("fingerprint") != F.col("_current"), "munged checksum mismatch")
               .when(~F.col("_sp").eqNullSafe(F.col("sample_prevalence")) | ~F.col("_pp").eqNullSafe(F.col("population_prevalence")), "prevalence differs from preparation")
               .when(F.col("_mn").isNotNull() & ~F.col("_mn").eqNullSafe(F.col("N_override")), "manifest N differs from preparation N_override")
               .when(F.col("status") == "error", F.col("reason")))
    return rows.select("trait", F.when(problem.isNull(), "accepted").otherwise("error").alias("status"),
                       F.coalesce(problem, F.col("reason")).alias("reason"), "n_snps", "SNP")


@dataclass(frozen=True)
class PipelineResult:
    prepared: Prepared
    compiled: CompiledPairs
    panel: PanelResult
    combined: DataFrame
    summary: DataFrame


def run_pipeline(raw: DataFrame, manifest: DataFrame, alleles_reference: DataFrame, ldscores: DataFrame, weights: DataFrame, m: float, *, order: Sequence[str],
                 info: float, chisq_max: float | str | None = None, n_blocks: int = regression.N_BLOCKS, info_min: float = 0.9, maf_min: float = 0.01,
                 failure_action: str = "error", settings: PanelSettings = PanelSettings(), n_eff: float | None = None,
                 assoc_id_source: str = "chr_pos_ref_alt") -> PipelineResult:
    """All stages in one application: records to exported combined associations.

    ``info`` fills the INFO column of the summary: combined associations have none of their own.
    """
    prepared = prepare(raw, manifest, order=order, mode="both", hm3=alleles_reference, assoc_id_source=assoc_id_source)
    munged = durable(filters.munge(prepared.regression, alleles_reference, info_min=info_min, maf_min=maf_min))
    if chisq_max is not None:
        munged = chisq_filtered(munged, chisq_max, reference=ldscores, weights=weights)[0]
    metadata = filters.resolve_sample_metadata(manifest).drop("reason", "N")
    traits = manifest.select("trait", "trait_order", "ref").join(metadata.drop("trait_order"), "trait")
    table = regress_pairs(munged, traits, ldscores, weights, m, n_blocks=n_blocks).withColumn("row_id", F.struct("o1", "o2")).drop("o1", "o2")
    compiled = compile_pairs(table, traits, action=failure_action)
    kept = compiled.retained if compiled.retained is not None else traits
    panel = panel_analysis(compiled.pairs, kept.select("trait", "trait_order"), settings)
    combined, _, _ = combine_snps(prepared.assoc, panel)
    table, summary = export_results([combined], n_eff=n_eff, info=info)
    return PipelineResult(prepared, compiled, panel, table, summary)
