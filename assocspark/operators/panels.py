"""Linear algebra and trait selection per panel, many panels in parallel.

A panel is one set of traits: a small matrix, never the data behind it. Panels
are independent groups of a long matrix, so one task solves one small matrix and Spark spreads the panels.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = float(np.finfo(float).eps)
SYMMETRY_TOLERANCE = 1e-8
MATRIX_EIGEN_TOLERANCE = 1e-8
CTI_TOLERANCE = 1e-8
CTI_CONDITION_LIMIT = 1e8
EXPLORE_REASON = "Exploratory CTI eigenvector participation; not evidence of an erroneous trait"
GREEDY_REASON = "Removal to resolve failed/missing pair estimates (failed-pair degree, self-h2 Z, manifest-order tie-break)"


def dense(frame: pd.DataFrame, traits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(sorted trait positions, square matrix with NaN where an entry is absent)."""
    traits = np.unique(frame["i"].to_numpy()) if traits is None else traits
    matrix = np.full((len(traits), len(traits)), np.nan)
    index = {t: k for k, t in enumerate(traits.tolist())}
    matrix[frame["i"].map(index).to_numpy(), frame["j"].map(index).to_numpy()] = frame["value"].astype(float).to_numpy()
    return traits, matrix


def symmetric(matrix: np.ndarray) -> np.ndarray:
    if not np.isfinite(matrix).all():
        raise ValueError("matrix contains missing or non-finite values")
    if np.abs(matrix - matrix.T).max(initial=0) > SYMMETRY_TOLERANCE:
        raise ValueError("matrix is asymmetric")
    return (matrix + matrix.T) / 2


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in descending order; each vector's largest entry is positive, so results are repeatable."""
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    lead = np.abs(vectors).argmax(axis=0)
    signs = np.where(vectors[lead, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return values, vectors * signs


def first_component(matrix: np.ndarray, orientation: str = "tutorial") -> dict:
    """PC1 with its numerical checks; the loading vector as a whole is flipped if its median is negative."""
    values, vectors = eigen(matrix)
    coefficient = vectors[:, 0]
    positive = bool(np.isfinite(values[0]) and values[0] > 0)
    loading = coefficient * np.sqrt(values[0]) if positive else np.full(len(coefficient), np.nan)
    finite = bool(np.isfinite(loading).all())
    nonzero = finite and bool((np.abs(loading) > np.sqrt(EPS)).any())
    multiplier = -1.0 if finite and orientation == "tutorial" and np.median(loading) < 0 else 1.0
    reasons = [text for failed, text in (
        (not positive, "PC1 eigenvalue is not finite and positive"), (not finite, "PC1 loadings are non-finite"),
        (finite and not nonzero, "PC1 loadings are effectively zero")) if failed]
    return dict(values=values, vectors=vectors, coefficient=coefficient * multiplier, loading=loading * multiplier,
                multiplier=multiplier, reasons="; ".join(reasons))


PCA_LOADINGS = ("panel_id string, i int, eigenvector double, loading double, sign_multiplier double, "
                "qc_status string, qc_reasons string")
PCA_EIGENVALUES = ("panel_id string, PC int, eigenvalue double, eigenvalue_after_floor double, negative boolean, "
                   "substantive_negative boolean, negative_threshold double")


def _guarded(frame: pd.DataFrame):
    """Symmetrised matrix of a group, or the reason it has none."""
    traits, matrix = dense(frame)
    try:
        return traits, symmetric(matrix), ""
    except ValueError as error:
        return traits, None, str(error)


def panel_loadings(matrix: DataFrame, orientation: str = "tutorial") -> DataFrame:
    """PC1 coefficient and loading per trait and panel, with the panel's PC1 status."""
    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        traits, square, error = _guarded(frame)
        out = pd.DataFrame({"panel_id": frame["panel_id"].iloc[0], "i": traits.astype("int32")})
        if square is None:
            return out.assign(eigenvector=np.nan, loading=np.nan, sign_multiplier=1.0, qc_status="FAIL", qc_reasons=error)
        pc = first_component(square, orientation)
        return out.assign(eigenvector=pc["coefficient"], loading=pc["loading"], sign_multiplier=pc["multiplier"],
                          qc_status="FAIL" if pc["reasons"] else "PASS",
                          qc_reasons=pc["reasons"] or "PC1 numerical checks passed")
    return matrix.groupBy("panel_id").applyInPandas(solve, PCA_LOADINGS)


def panel_eigenvalues(matrix: DataFrame, tolerance: float = MATRIX_EIGEN_TOLERANCE) -> DataFrame:
    """All eigenvalues per panel, with negative ones flagged; the matrix itself is never repaired."""
    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        traits, square, _ = _guarded(frame)
        values = np.full(len(traits), np.nan) if square is None else eigen(square)[0]
        threshold = tolerance * max(1.0, float(np.nan_to_num(np.abs(values)).max()))
        return pd.DataFrame({"panel_id": frame["panel_id"].iloc[0], "PC": np.arange(1, len(values) + 1, dtype="int32"),
                             "eigenvalue": values, "eigenvalue_after_floor": np.maximum(values, 0), "negative": values < 0,
                             "substantive_negative": values < -threshold, "negative_threshold": threshold})
    return matrix.groupBy("panel_id").applyInPandas(solve, PCA_EIGENVALUES)


def all_loadings(matrix: DataFrame) -> DataFrame:
    """Standardised loadings of every component: vectors times the root of the floored eigenvalues."""
    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        traits, square, _ = _guarded(frame)
        if square is None:
            return pd.DataFrame({"panel_id": [], "i": [], "PC": [], "loading": []})
        values, vectors = eigen(square)
        scaled = vectors * np.sqrt(np.maximum(values, 0))
        k = len(traits)
        return pd.DataFrame({"panel_id": frame["panel_id"].iloc[0], "i": np.repeat(traits, k).astype("int32"),
                             "PC": np.tile(np.arange(1, k + 1, dtype="int32"), k), "loading": scaled.ravel()})
    return matrix.groupBy("panel_id").applyInPandas(solve, "panel_id string, i int, PC int, loading double")


def variance_explained(eigenvalues: DataFrame) -> DataFrame:
    """Raw and positive-normalised percentages with their running sums per panel (a panel has few components)."""
    panel = Window.partitionBy("panel_id")
    running = panel.orderBy("PC").rowsBetween(Window.unboundedPreceding, 0)

    def percent(column) -> Column:
        total = F.sum(column).over(panel)
        return F.when(~F.isnan(total) & (total > 0), 100 * F.col(column) / total)
    negative = F.max(F.col("negative").cast("int")).over(panel) == 1
    total = F.sum("eigenvalue").over(panel)
    return (eigenvalues.withColumns({"percent_raw": percent("eigenvalue"), "percent_positive": percent("eigenvalue_after_floor"),
                                     "conventional_partition": ~negative & (total > 0)})
            .withColumns({"cumulative_percent_raw": F.sum("percent_raw").over(running),
                          "cumulative_percent_positive": F.sum("percent_positive").over(running)}))


def contributions(loadings: DataFrame) -> DataFrame:
    """Contribution of each trait to PC1 in percent and its rank within the panel (ties share the best rank)."""
    share = F.when(F.col("qc_status") == "PASS", 100 * F.col("eigenvector") * F.col("eigenvector"))
    rank = F.rank().over(Window.partitionBy("panel_id").orderBy(F.desc("contribution_percent")))
    return loadings.withColumn("contribution_percent", share).withColumn(
        "contribution_rank", F.when(F.col("qc_status") == "PASS", rank))


def pc1_report(loadings: DataFrame, eigenvalues: DataFrame, *, negative_action: str = "warn") -> DataFrame:
    """One row per panel: PC1 status, median loading and whether policy allows the analysis."""
    values = eigenvalues.groupBy("panel_id").agg(
        F.max(F.when(F.col("PC") == 1, F.col("eigenvalue"))).alias("PC1_Eigenvalue"),
        F.count_if("negative").alias("Matrix_Negative_Eigenvalue_Count"),
        F.count_if("substantive_negative").alias("Matrix_Substantive_Negative_Eigenvalue_Count"))
    return (loadings.groupBy("panel_id").agg(
        F.count("*").alias("Trait_Count"), F.first("sign_multiplier").alias("PC1_Sign_Multiplier"),
        F.percentile("loading", F.lit(0.5)).alias("PC1_Loading_Median_Used"),
        F.first("qc_status").alias("PC1_QC_Status"), F.first("qc_reasons").alias("PC1_QC_Reasons"))
        .join(values, "panel_id")
        .withColumn("Matrix_Policy_Allows_Analysis", F.lit(negative_action != "error")
                    | (F.col("Matrix_Substantive_Negative_Eigenvalue_Count") == 0)))


# --- CTI ----------------------------------------------------------------------------------------

CTI_SCHEMA = ("panel_id string, CTI_Status string, CTI_Minimum_Eigenvalue double, CTI_Maximum_Eigenvalue double, "
              "CTI_Negative_Eigenvalues int, CTI_Condition_Number double, CTI_Cholesky_Pass boolean, "
              "CTI_Eigenvalue_Threshold double, CTI_Condition_Limit double")
HISTORY_SCHEMA = ("panel_id string, step int, traits int, PC1_Status string, PC1_Eigenvalue double, PC2_Eigenvalue double, "
                  "CTI_Status string, CTI_Minimum_Eigenvalue double, dropped int, score double, "
                  "minimum_after double, reason string, outcome string")


def cti_metrics(square: np.ndarray) -> dict:
    values = np.linalg.eigvalsh(square)[::-1]
    tolerance = max(CTI_TOLERANCE, 100 * len(values) * EPS * np.abs(values).max())
    low, high = float(values.min()), float(values.max())
    condition = high / low if low > 0 else np.nan
    try:
        np.linalg.cholesky(square)
        factored = True
    except np.linalg.LinAlgError:
        factored = False
    passed = factored and low > tolerance and np.isfinite(condition) and condition <= CTI_CONDITION_LIMIT
    status = "PASS" if passed else "INDEFINITE" if low < -tolerance else "SINGULAR_OR_ILL_CONDITIONED"
    return dict(CTI_Status=status, CTI_Minimum_Eigenvalue=low, CTI_Maximum_Eigenvalue=high,
                CTI_Negative_Eigenvalues=int((values < 0).sum()), CTI_Condition_Number=condition,
                CTI_Cholesky_Pass=factored, CTI_Eigenvalue_Threshold=tolerance, CTI_Condition_Limit=CTI_CONDITION_LIMIT)


def assess_cti(matrix: DataFrame) -> DataFrame:
    """Is each panel's intercept matrix positive definite and well conditioned?"""
    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        _, square, error = _guarded(frame)
        metrics = cti_metrics(square) if square is not None else dict(
            CTI_Status=f"INVALID: {error}", CTI_Minimum_Eigenvalue=np.nan, CTI_Maximum_Eigenvalue=np.nan,
            CTI_Negative_Eigenvalues=0, CTI_Condition_Number=np.nan, CTI_Cholesky_Pass=False,
            CTI_Eigenvalue_Threshold=np.nan, CTI_Condition_Limit=CTI_CONDITION_LIMIT)
        return pd.DataFrame([{"panel_id": frame["panel_id"].iloc[0], **metrics}])
    return matrix.groupBy("panel_id").applyInPandas(solve, CTI_SCHEMA)


def matrix_assessment(cti: DataFrame, report: DataFrame, eigenvalues: DataFrame) -> DataFrame:
    """PC1 and CTI of each panel side by side, with the gap between the first eigenvalues and eligibility."""
    second = eigenvalues.groupBy("panel_id").agg(F.max(F.when(F.col("PC") == 2, F.col("eigenvalue"))).alias("PC2_Eigenvalue"))
    return (report.join(second, "panel_id").join(cti, "panel_id")
            .withColumns({"PC1_PC2_Gap": F.col("PC1_Eigenvalue") - F.col("PC2_Eigenvalue"),
                          "Combination_Matrix_Eligible": (F.col("PC1_QC_Status") == "PASS") & F.col("Matrix_Policy_Allows_Analysis")
                          & (F.col("CTI_Status") == "PASS")}))


def cti_explore_drop(cti: DataFrame, pca: DataFrame, max_fraction: float, orientation: str = "tutorial") -> DataFrame:
    """Drop traits that carry the failing CTI eigenvectors, re-assessing both matrices after each drop.

    Returns the step history per panel; ``dropped`` is the trait removed after that step. Stops with outcome
    PASS, or FAIL when the limit ``floor(k * max_fraction)`` or two traits are reached.
    """
    if not (np.isfinite(max_fraction) and 0 < max_fraction < 1):
        raise ValueError("max_fraction must be in (0,1)")

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        panel = frame["panel_id"].iloc[0]
        traits, c = dense(frame[frame["matrix"] == "cti"])
        _, p = dense(frame[frame["matrix"] == "pca"], traits)
        limit = int(np.floor(len(traits) * max_fraction))
        steps, names = [], [x.strip().split(" ")[0] for x in HISTORY_SCHEMA.split(",")]
        try:
            c, p = symmetric(c), symmetric(p)
        except ValueError as error:
            return pd.DataFrame([[panel, 0, len(traits), "FAIL", np.nan, np.nan, f"INVALID: {error}", np.nan, None, np.nan,
                                  np.nan, None, "FAIL"]], columns=names)
        while True:
            metrics, pc = cti_metrics(c), first_component(p, orientation)
            lead = pc["values"][:2] if not pc["reasons"] else np.array([np.nan, np.nan])
            if steps:
                steps[-1][10] = metrics["CTI_Minimum_Eigenvalue"]
            row = [panel, len(steps), len(traits), "FAIL" if pc["reasons"] else "PASS", lead[0],
                   lead[1] if len(lead) > 1 else np.nan, metrics["CTI_Status"], metrics["CTI_Minimum_Eigenvalue"],
                   None, np.nan, np.nan, None, "CONTINUE"]
            steps.append(row)
            if pc["reasons"] or metrics["CTI_Status"] == "PASS" or len(steps) - 1 >= limit or len(traits) <= 2:
                row[12] = "PASS" if metrics["CTI_Status"] == "PASS" and not pc["reasons"] else "FAIL"
                return pd.DataFrame(steps, columns=names).astype({"dropped": "Int32"})
            values, vectors = eigen(c)
            target = max(metrics["CTI_Eigenvalue_Threshold"], values.max() / CTI_CONDITION_LIMIT)
            bad = values <= target
            score = (vectors[:, bad] ** 2) @ np.maximum(target - values[bad], EPS)
            drop = int(score.argmax())
            row[8], row[9], row[11] = int(traits[drop]), float(score[drop]), EXPLORE_REASON
            keep = np.arange(len(traits)) != drop
            traits, c, p = traits[keep], c[np.ix_(keep, keep)], p[np.ix_(keep, keep)]
    both = cti.select("panel_id", "i", "j", "value", F.lit("cti").alias("matrix")).unionByName(
        pca.select("panel_id", "i", "j", "value", F.lit("pca").alias("matrix")))
    return both.groupBy("panel_id").applyInPandas(solve, HISTORY_SCHEMA)


def selection_sensitivity(baseline: DataFrame, final: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(per-trait change, per-panel summary) of loadings after selection, sign-aligned to the baseline's.

    ``baseline`` has ``i, loading`` of the full set; ``final`` is :func:`panel_loadings` of the selected sets.
    """
    both = final.select("panel_id", "i", F.col("loading").alias("retained")).join(
        baseline.select("i", F.col("loading").alias("original")), "i")
    sign = both.groupBy("panel_id").agg(
        F.when(F.sum(F.col("original") * F.col("retained")) < 0, -1.0).otherwise(1.0).alias("s"))
    rows = both.join(sign, "panel_id").withColumn("retained_aligned", F.col("retained") * F.col("s")).withColumn(
        "change", F.col("retained_aligned") - F.col("original")).select("panel_id", "i", "original", "retained_aligned", "change")
    summary = rows.groupBy("panel_id").agg(F.sqrt(F.avg(F.col("change") * F.col("change"))).alias("loading_rmse"),
                                           F.max(F.abs("change")).alias("maximum_absolute_change"))
    return rows, summary


# --- trait selection ----------------------------------------------------------------------------

def failure_graph(traits, edges: pd.DataFrame) -> np.ndarray:
    """Symmetric boolean matrix of failed pairs (``a, b``) among ``traits``, in their given order."""
    place = {int(t): k for k, t in enumerate(traits)}
    graph = np.zeros((len(place), len(place)), bool)
    for a, b in edges[["a", "b"]].astype(int).to_numpy():
        if a in place and b in place:
            graph[place[a], place[b]] = graph[place[b], place[a]] = True
    return graph


SELECTION_SCHEMA = "panel_id string, exclusion_step int, trait_order int, reason string, failed_pairs int, H2_Z double"


def select_complete_traits(failed: DataFrame, traits: DataFrame) -> DataFrame:
    """Exclusion steps that leave a panel without failed pairs; greedy, and not always the largest subset.

    ``traits``: ``panel_id, trait_order, self_failed, self_reason, H2_Z``; ``failed``: ``panel_id, pair_i,
    pair_j`` of invalid or missing pairs. First traits with a failed self-pair in manifest order, then the
    trait with most failed pairs left; ties take the lower heritability Z, then the later manifest position.
    """
    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame[frame["kind"] == "trait"].sort_values("a")
        failing = failure_graph(members["a"], frame[frame["kind"] == "edge"])
        h2_z = members["h2_z"].astype(float).to_numpy()
        strength = np.where(np.isfinite(h2_z), h2_z, -np.inf)
        self_failed = members["self_failed"].to_numpy(bool)
        # Step 1, at once: traits whose own estimate failed, with their degree in the full graph.
        dropped = list(np.flatnonzero(self_failed))
        degrees = list(failing.sum(axis=0)[dropped])
        failing[dropped] = failing[:, dropped] = False
        np.fill_diagonal(failing, False)
        # Step 2: break the graph up from its busiest vertex; lexsort puts the vertex to drop last.
        while failing.any():
            degree = failing.sum(axis=0)
            worst = np.lexsort((np.arange(len(degree)), -strength, degree))[-1]
            dropped.append(worst)
            degrees.append(degree[worst])
            failing[worst] = failing[:, worst] = False
        reasons = members["reason"].to_numpy()[dropped]
        reasons[self_failed.sum():] = GREEDY_REASON
        return pd.DataFrame({"panel_id": frame["panel_id"].iloc[0], "exclusion_step": np.arange(1, len(dropped) + 1),
                             "trait_order": members["a"].to_numpy()[dropped], "reason": reasons,
                             "failed_pairs": degrees, "H2_Z": h2_z[dropped]})
    nodes = traits.select("panel_id", F.lit("trait").alias("kind"), F.col("trait_order").alias("a"), F.lit(None).cast("int").alias("b"),
                          "self_failed", F.col("self_reason").alias("reason"), F.col("H2_Z").alias("h2_z"))
    edges = failed.select("panel_id", F.lit("edge").alias("kind"), F.col("pair_i").alias("a"), F.col("pair_j").alias("b"),
                          F.lit(False).alias("self_failed"), F.lit("").alias("reason"), F.lit(None).cast("double").alias("h2_z")).distinct()
    return nodes.unionByName(edges).groupBy("panel_id").applyInPandas(solve, SELECTION_SCHEMA)


BUNDLE_SCHEMA = "panel_id string, step int, Severity string, trait_order int, Reason string, Action string"


def bundle_trait_reasons(bundle: DataFrame, se: DataFrame) -> DataFrame:
    """Traits of a matrix bundle with an unusable heritability, SE, intercept or standardised diagonal.

    ``bundle`` is long ``(panel_id, matrix, i, j, value)``; ``se`` is ``(panel_id, i, j, h_se, rg_se)``.
    """
    from ..functions import is_finite, list_reasons
    own = bundle.filter(F.col("i") == F.col("j")).groupBy("panel_id", "i").agg(
        *[F.max(F.when(F.col("matrix") == m, F.col("value"))).alias(f"own_{m}") for m in ("S", "I", "S_Stand")])
    rows = own.join(se.filter(F.col("i") == F.col("j")).select("panel_id", "i", "h_se"), ["panel_id", "i"], "left")

    def positive(c):
        return is_finite(c) & (F.col(c) > 0)
    return rows.withColumns({
        "reason": list_reasons([
            (~positive("own_S"), "Non-finite or non-positive heritability"),
            (~positive("h_se"), "Non-finite or non-positive heritability SE"),
            (~positive("own_I"), "Non-finite or non-positive self intercept"),
            (~is_finite("own_S_Stand"), "Non-finite standardized diagonal")]),
        "diagonal_inconsistent": F.coalesce(F.abs(F.col("own_S_Stand") - 1) > SYMMETRY_TOLERANCE, F.lit(False))})


def bundle_pair_reasons(bundle: DataFrame, se: DataFrame) -> DataFrame:
    """Off-diagonal pairs of a bundle with a missing estimate in either orientation or an unusable SE."""
    from ..functions import is_finite, list_reasons
    entries = bundle.filter(F.col("i") != F.col("j")).withColumns({"a": F.least("i", "j"), "b": F.greatest("i", "j")})
    matrices = ("S", "I", "S_Stand")
    found = entries.groupBy("panel_id", "a", "b").agg(
        *[F.count_if((F.col("matrix") == m) & is_finite("value")).alias(f"n_{m}") for m in matrices])
    errors = se.filter(F.col("i") < F.col("j")).select("panel_id", F.col("i").alias("a"), F.col("j").alias("b"), "h_se", "rg_se")

    def positive(c):
        return is_finite(c) & (F.col(c) > 0)
    marks = [(F.col(f"n_{m}") < 2, f"Missing/non-finite {m} pair estimate") for m in matrices]
    marks += [(~positive("rg_se"), "Non-finite or non-positive rg SE"),
              (~positive("h_se"), "Non-finite or non-positive genetic covariance SE")]
    return found.join(errors, ["panel_id", "a", "b"], "left").select(
        "panel_id", F.col("a").alias("pair_i"), F.col("b").alias("pair_j"), list_reasons(marks).alias("reason"))


def bundle_consistency(bundle: DataFrame) -> DataFrame:
    """Per panel: largest gap between ``S_Stand`` and ``S / sqrt(diag diag)``, entries that cannot be compared, and whether there are none and the gap is within tolerance."""
    from ..functions import is_finite

    def pick(name):
        return bundle.filter(F.col("matrix") == name)
    own = pick("S").filter(F.col("i") == F.col("j"))
    s = (pick("S").select("panel_id", "i", "j", F.col("value").alias("s"))
         .join(own.select("panel_id", "i", F.col("value").alias("d_i")), ["panel_id", "i"])
         .join(own.select("panel_id", "j", F.col("value").alias("d_j")), ["panel_id", "j"])
         .join(pick("S_Stand").select("panel_id", "i", "j", F.col("value").alias("r")), ["panel_id", "i", "j"]))
    expected = F.try_divide(F.col("s"), F.sqrt(F.col("d_i") * F.col("d_j")))
    error = F.abs(F.col("expected") - F.col("r"))
    return s.withColumn("expected", expected).withColumns({"error": F.when(is_finite(error), error), "size": F.when(is_finite("expected"), F.abs("expected"))}).groupBy("panel_id").agg(
        F.max("error").alias("maximum_error"), F.greatest(F.lit(1.0), F.max("size")).alias("scale"), F.count_if(F.col("error").isNull()).alias("unusable")).withColumn(
        "consistent", (F.col("unusable") == 0) & F.coalesce(F.col("maximum_error") <= SYMMETRY_TOLERANCE * F.col("scale"), F.lit(False)))


def bundle_drop_traits(trait_reasons: DataFrame, pair_reasons: DataFrame) -> DataFrame:
    """Removal events of a bundle: invalid traits first, then the trait in most bad pairs (ties: first in manifest)."""
    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame[frame["b"].isna()].sort_values("a")
        pairs = frame[frame["b"].notna() & (frame["reason"] != "")].sort_values(["a", "b"])
        traits = members["a"].astype(int).to_numpy()
        failing = failure_graph(traits, pairs)
        invalid = members["reason"].to_numpy() != ""
        failing[invalid] = failing[:, invalid] = False
        events = members[invalid].assign(text=lambda m: m["reason"].str.split("; ")).explode("text")
        dropped, texts = list(events["a"].astype(int)), list(events["text"])
        while failing.any():
            worst = int(failing.sum(axis=0).argmax())
            touching = [(traits[x], traits[y]) for x, y in np.argwhere(np.triu(failing)) if worst in (x, y)]
            why = pairs[[pair in touching for pair in zip(pairs["a"].astype(int), pairs["b"].astype(int))]]
            texts.append("Removed to resolve invalid pairs: " + "; ".join(
                f"{int(a)}: {int(b)}: {r}" for a, b, r in zip(why["a"], why["b"], why["reason"])))
            dropped.append(traits[worst])
            failing[worst] = failing[:, worst] = False
        found = pd.DataFrame({"panel_id": frame["panel_id"].iloc[0], "step": np.arange(1, len(dropped) + 1), "Severity": "warning",
                              "trait_order": dropped, "Reason": texts, "Action": "removed"})
        return found.astype({c: object for c in ("panel_id", "Severity", "Reason", "Action")})  # a table without removals has no strings to tell a type from
    nodes = trait_reasons.select("panel_id", F.col("i").cast("int").alias("a"), F.lit(None).cast("int").alias("b"), "reason")
    edges = pair_reasons.select("panel_id", F.col("pair_i").cast("int").alias("a"), F.col("pair_j").cast("int").alias("b"), "reason")
    return nodes.unionByName(edges).groupBy("panel_id").applyInPandas(solve, BUNDLE_SCHEMA)
