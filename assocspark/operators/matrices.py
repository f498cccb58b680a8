"""Trait-by-trait matrices in long form ``(panel_id, i, j, value)`` with 0-based manifest positions."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, safe_div

SYMMETRY_TOLERANCE = 1e-8
RECONSTRUCTION_TOLERANCE = 1e-10


def assemble_matrices(collapsed: DataFrame, self_qc: DataFrame, *, rg: DataFrame | None = None) -> DataFrame:
    """Long ``(matrix, i, j, value)``: correlation, intercept (CTI), and the standard errors of both.

    The diagonals come from the self-pairs (1, h2 intercept, and their errors), the rest from the collapsed
    pairs, each written to both triangles. ``rg`` replaces the correlations, as from ``select_rg``.
    """
    off = collapsed.filter(F.col("pair_i") < F.col("pair_j"))
    if rg is not None:
        off = off.drop("rg").join(rg.withColumnRenamed("rg_used", "rg"), ["pair_i", "pair_j"])
    values = {"S_Stand": "rg", "I": "gcov_int", "rg_se": "se", "intercept_se": "gcov_int_se"}
    cells = F.array(*[F.struct(F.lit(m).alias("matrix"), a.alias("i"), b.alias("j"), F.col(c).alias("value"))
                      for m, c in values.items() for a, b in ((F.col("pair_i"), F.col("pair_j")), (F.col("pair_j"), F.col("pair_i")))])
    own = {"S_Stand": F.lit(1.0), "I": F.col("Self_H2_Intercept"), "rg_se": F.col("Self_RG_SE"), "intercept_se": F.col("Self_H2_Intercept_SE")}
    diagonal = F.array(*[F.struct(F.lit(m).alias("matrix"), F.col("trait_order").alias("i"), F.col("trait_order").alias("j"), v.alias("value"))
                         for m, v in own.items()])
    return off.select(F.inline(cells)).unionByName(self_qc.select(F.inline(diagonal)))


def covariance_matrix(correlation: DataFrame, heritability: DataFrame) -> DataFrame:
    """``rg * sqrt(h2_i h2_j)`` with heritabilities on the diagonal, and the correlation rebuilt from it.

    ``correlation`` is long ``(panel_id, i, j, value)``, ``heritability`` has ``trait_order, h2``.
    """
    def side(name):
        return heritability.select(F.col("trait_order").alias(name), F.col("h2").alias(f"h2_{name}"))
    root = F.sqrt("h2_i") * F.sqrt("h2_j")
    rows = correlation.withColumnRenamed("value", "rg").join(side("i"), "i").join(side("j"), "j")
    value = F.when(F.col("i") == F.col("j"), F.col("h2_i")).otherwise(F.col("rg") * root)
    rebuilt = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(safe_div("value", root))
    return rows.withColumn("value", value).withColumn("reconstruction_error", F.abs(rebuilt - F.col("rg")))


def check_covariance(covariance: DataFrame) -> None:
    bad = covariance.filter(~is_finite("value") | ~(F.col("h2_i") > 0) | ~(F.col("reconstruction_error") <= RECONSTRUCTION_TOLERANCE)).take(1)
    if bad:
        raise ValueError(f"covariance needs finite positive heritabilities and an exact reconstruction: {bad[0].asDict()}")


def covariance_report(report: DataFrame, covariance: DataFrame) -> DataFrame:
    """The correlation report with both heritabilities and the derived covariance of each pair."""
    cells = covariance.select(F.col("i").alias("pair_i"), F.col("j").alias("pair_j"), F.col("h2_i").alias("Heritability_1"),
                              F.col("h2_j").alias("Heritability_2"), F.col("value").alias("Genetic_Covariance_Derived"))
    return report.select("pair_i", "pair_j", "Trait_1", "Trait_2", "rg", "SE", "Z", "P").join(cells, ["pair_i", "pair_j"])


def symmetrize(matrix: DataFrame, keys: Sequence[str] = ("panel_id",)) -> DataFrame:
    """Mean of each entry and its mirror, with ``asymmetry`` and a ``valid`` flag per entry."""
    keys = list(keys)
    mirror = matrix.select(*keys, F.col("j").alias("i"), F.col("i").alias("j"), F.col("value").alias("_mirror"))
    difference = F.abs(F.col("value") - F.col("_mirror"))
    return (matrix.join(mirror, [*keys, "i", "j"], "left")
            .withColumns({"asymmetry": difference,
                          "valid": is_finite("value") & is_finite("_mirror") & F.coalesce(difference <= SYMMETRY_TOLERANCE, F.lit(False)),
                          "value": (F.col("value") + F.col("_mirror")) / 2}).drop("_mirror"))


def symmetry_summary(matrix: DataFrame, keys: Sequence[str] = ("panel_id",)) -> DataFrame:
    return symmetrize(matrix, keys).groupBy(*keys).agg(
        F.count("*").alias("entries"), F.count_if(~F.col("valid")).alias("invalid_entries"),
        F.max("asymmetry").alias("maximum_asymmetry"))


def subset_panels(matrix: DataFrame, members: DataFrame) -> DataFrame:
    """Matrix entries of every panel: ``members`` lists ``panel_id, trait_order``; positions keep manifest numbers."""
    def side(name):
        return members.select("panel_id", F.col("trait_order").alias(name))
    return matrix.join(side("i"), "i").join(side("j"), ["panel_id", "j"], "left_semi")


def vech_pairs(matrix_v: DataFrame) -> DataFrame:
    """Decode vech positions of a sampling covariance into the trait pairs they stand for.

    ``pair_a``/``pair_b`` count the lower triangle by columns, starting at 0; the number of traits per
    panel follows from the number of diagonal entries.
    """
    k = F.floor((F.sqrt(8.0 * F.col("_m") + 1) - 1) / 2).cast("bigint")
    sizes = matrix_v.filter(F.col("pair_a") == F.col("pair_b")).groupBy("panel_id").agg(F.count("*").alias("_m")).withColumn("k", k).drop("_m")

    def decode(p):
        # Column c starts at c*k - c*(c-1)/2; solve for the last column that starts at or before p.
        b = 2.0 * F.col("k") + 1
        c = F.floor((b - F.sqrt(b * b - 8.0 * F.col(p) - 1e-6)) / 2).cast("bigint")
        start = c * F.col("k") - (c * (c - 1) / 2).cast("bigint")
        return c, c + F.col(p) - start
    rows = matrix_v.join(sizes, "panel_id")
    ca, ra = decode("pair_a")
    cb, rb = decode("pair_b")
    return rows.withColumns({"a_col": ca, "a_row": ra, "b_col": cb, "b_row": rb})


def subset_vech(matrix_v: DataFrame, order: DataFrame) -> DataFrame:
    """Sampling covariance of selected and reordered traits: every genuine cross-covariance is kept.

    ``order``: ``panel_id, old_position, new_position``. Pairs are renamed to the new lower triangle.
    """
    rows = vech_pairs(matrix_v)
    for end in ("a_col", "a_row", "b_col", "b_row"):
        rows = rows.join(order.select("panel_id", F.col("old_position").alias(end), F.col("new_position").alias(f"n_{end}")), ["panel_id", end])
    size = order.groupBy("panel_id").agg(F.count("*").alias("new_k"))
    rows = rows.join(size, "panel_id")

    def position(side):
        low, high = F.least(f"n_{side}_col", f"n_{side}_row"), F.greatest(f"n_{side}_col", f"n_{side}_row")
        return low * F.col("new_k") - (low * (low - 1) / 2).cast("bigint") + high - low
    return rows.select("panel_id", position("a").cast("bigint").alias("pair_a"), position("b").cast("bigint").alias("pair_b"), "value")


def vech_se(matrix_v: DataFrame) -> DataFrame:
    """Standard errors of the trait-pair estimates, both triangles; negative or non-finite variances give NULL."""
    rows = vech_pairs(matrix_v.withColumn("_d", F.col("pair_a") == F.col("pair_b"))).filter("_d")
    se = F.when(is_finite("value") & (F.col("value") >= 0), F.sqrt("value"))
    low, high = F.col("a_col"), F.col("a_row")
    both = F.when(low == high, F.array(F.struct(low.alias("i"), high.alias("j")))).otherwise(
        F.array(F.struct(low.alias("i"), high.alias("j")), F.struct(high.alias("i"), low.alias("j"))))
    return rows.select("panel_id", F.inline(both), se.alias("se"))
