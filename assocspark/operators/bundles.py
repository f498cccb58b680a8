"""Matrix bundles (S, I, V, S_Stand, V_Stand in long form): built from jackknife values, and checked under a policy that leaves events.

V is the sampling covariance of all trait-pair estimates. Pair p has one delete-one value per block; with B blocks, V of pairs p and q is
(B - 1) / B times the sum over blocks of the products of their deviations. Pairs are kept as one row with an array of deviations, cut into ranges
of ``PAIRS_PER_TILE``, and every two ranges are one group of bounded size whose outer product is a matrix product.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, safe_div
from . import matrices, panels, regression

PAIRS_PER_TILE = 512
BUNDLE = "panel_id string, matrix string, i long, j long, value double"


def vech_position(i: Column, j: Column, k: Column) -> Column:
    """Place of pair ``i <= j`` of ``k`` traits in the lower triangle counted by columns."""
    return (i * k - (i * (i - 1) / 2).cast("long") + j - i).cast("long")


def outer_sums(deviations: DataFrame, n: int, *, tile: int = PAIRS_PER_TILE) -> DataFrame:
    """(p, q, value): sums of products of two rows' arrays, for all p and q. ``deviations``: ``p long`` below ``n``, ``d array<double>``, arrays of equal length."""
    tiles = max(1, -(-n // tile))
    own = F.expr(f"p div {tile}")
    dealt = deviations.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    dealt = dealt.select(F.least("own", F.col("other").cast("long")).alias("x"), F.greatest("own", F.col("other").cast("long")).alias("y"), "own", "p", "d")

    def product(key, rows):
        x, y = (k.as_py() for k in key)
        rows = rows.sort_by("p").combine_chunks()
        own, p = np.asarray(rows.column("own")), np.asarray(rows.column("p"))
        lists = rows.column("d").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        values = np.asarray(lists.flatten()).reshape(len(p), -1)
        left, right = own == x, own == y
        out = values[left] @ values[right].T
        a, b = np.repeat(p[left], right.sum()), np.tile(p[right], left.sum())
        if x != y:
            a, b, out = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([out.ravel(), out.ravel()])
        return pa.table({"p": a, "q": b, "value": out.ravel()})
    return dealt.groupBy("x", "y").applyInArrow(product, "p long, q long, value double")


def sampling_bundle(fit: regression.PairFit, traits: DataFrame, *, panel: str = "all", delta: bool = False, tile: int = PAIRS_PER_TILE) -> DataFrame:
    """Long bundle of the traits of ``traits`` (``trait_order, position, factor``: number in the fit, number in the bundle, liability factor).

    S holds heritabilities on its diagonal and covariances beside it, times sqrt(factor_i factor_j); I the intercepts. S_Stand divides by the root of
    the two heritabilities, and V_Stand scales V alike, as the published tool does. ``delta`` adds V_Delta, the covariance of the correlations by the
    delta method from the same deviations (its diagonal pairs do not vary). Where a pair has fewer blocks than asked for, or no value, entries are NULL.
    """
    ends = [traits.select(F.col("trait_order").alias(x), F.col("position").cast("long").alias(f"p{x}"), F.col("factor").cast("double").alias(f"f{x}")) for x in ("i", "j")]
    k = traits.count()
    n_pairs = k * (k + 1) // 2
    own = F.col("i") == F.col("j")

    def of(name):
        return F.when(own, F.col(f"h2_1_{name}")).otherwise(F.col(f"gcov_{name}"))

    scale = F.sqrt(F.col("fi") * F.col("fj"))
    rows = regression.deleted_estimates(fit).join(ends[0], "i").join(ends[1], "j")
    low, high = F.least("pi", "pj"), F.greatest("pi", "pj")
    rows = rows.select(low.alias("i"), high.alias("j"), vech_position(low, high, F.lit(k)).alias("p"), "block", "blocks",
                       (of("slope") * scale).alias("s"), of("intercept").alias("c"), (of("d_slope") * scale).alias("d"))
    values = F.transform(F.array_sort(F.collect_list(F.struct("block", "d"))), lambda x: x.d)
    per_pair = rows.groupBy("i", "j", "p").agg(F.max("s").alias("s"), F.max("c").alias("c"), F.max("blocks").alias("blocks"), values.alias("d"))
    mean = F.aggregate("d", F.lit(0.0), lambda a, x: a + x) / F.size("d")
    per_pair = per_pair.withColumn("mean", mean).withColumn("d", F.expr("transform(d, x -> x - mean)")).drop("mean")
    whole = (F.col("blocks") == fit.blocks) & (F.size("d") == fit.blocks) & F.expr("forall(d, x -> x IS NOT NULL AND NOT isnan(x))")
    per_pair = regression.durable(per_pair.withColumn("whole", F.coalesce(whole, F.lit(False))))
    grid = regression.all_pairs(per_pair.sparkSession, k).select(F.col("i").cast("long"), F.col("j").cast("long"))
    grid = grid.withColumn("p", vech_position(F.col("i"), F.col("j"), F.lit(k)))
    pairs = grid.join(per_pair.drop("p"), ["i", "j"], "left")
    diagonal = per_pair.filter("i = j").select(F.col("i").alias("t"), F.when(F.col("s") > 0, F.col("s")).alias("h"), F.when(F.col("s") > 0, F.transform("d", lambda x: x / F.col("s"))).alias("e"), F.col("whole").alias("w"))
    sides = [diagonal.select(F.col("t").alias(x), F.col("h").alias(f"h{x}"), F.col("e").alias(f"e{x}"), F.col("w").alias(f"w{x}")) for x in ("i", "j")]
    pairs = regression.durable(pairs.join(sides[0], "i", "left").join(sides[1], "j", "left").withColumn("ratio", safe_div(F.lit(1.0), F.sqrt(F.col("hi") * F.col("hj")))))
    cells = pairs.select("i", "j", F.explode(F.create_map(F.lit("S"), F.col("s"), F.lit("I"), F.col("c"), F.lit("S_Stand"), F.when(F.col("i") == F.col("j"), F.when(F.col("hi") > 0, 1.0)).otherwise(F.col("s") * F.col("ratio"))))
                         .alias("matrix", "value"))
    both = cells.select("matrix", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))).alias("at"), "value")
    out = [both.select("matrix", "at.i", "at.j", "value")]
    places = grid.select("p")
    size = F.lit((fit.blocks - 1) / fit.blocks)

    def covariance(name: str, deviations: DataFrame) -> DataFrame:
        sums = outer_sums(deviations, n_pairs, tile=tile).select(F.col("p").alias("i"), F.col("q").alias("j"), (F.col("value") * size).alias("value"))
        return sums.select(F.lit(name).alias("matrix"), "i", "j", "value")

    known = pairs.filter("whole")
    out.append(covariance("V", known.select("p", "d")))
    out.append(covariance("V_Stand", known.filter("ratio IS NOT NULL").select("p", F.transform("d", lambda x: x * F.col("ratio")).alias("d"))))
    if delta:
        shift = F.expr("transform(arrays_zip(d, ei, ej), x -> x.d * ratio - s * ratio * (x.ei + x.ej) / 2)")
        out.append(covariance("V_Delta", known.filter("ratio IS NOT NULL AND wi AND wj").select("p", shift.alias("d"))))
    merged = out[0]
    for more in out[1:]:
        merged = merged.unionByName(more)
    every = [places.select(F.lit(name).alias("matrix"), F.col("p").alias("i")) for name in ("V", "V_Stand", *(["V_Delta"] if delta else []))]
    wanted = every[0]
    for more in every[1:]:
        wanted = wanted.unionByName(more)
    # Entries of pairs without a covariance are there, and NULL.
    cells_v = wanted.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_pairs - 1).cast("long"))))
    full = cells_v.join(merged, ["matrix", "i", "j"], "left").unionByName(merged.filter(~F.col("matrix").startswith("V")))
    return full.select(F.lit(panel).alias("panel_id"), "matrix", "i", "j", F.when(is_finite("value"), F.col("value")).alias("value"))


@dataclass(frozen=True)
class BundlePolicy:
    """What a faulty bundle leads to: ``failed_action`` error or drop_traits, ``rg_out_of_range_action`` error or warn."""

    allow_missing_traits: bool = False
    failed_action: str = "error"
    rg_out_of_range_action: str = "warn"
    h2_z_warn_threshold: float = 4.0

    def check(self) -> None:
        if self.failed_action not in ("error", "drop_traits") or self.rg_out_of_range_action not in ("error", "warn"):
            raise ValueError("failed_action is error or drop_traits, rg_out_of_range_action error or warn")
        if not (np.isfinite(self.h2_z_warn_threshold) and self.h2_z_warn_threshold >= 0):
            raise ValueError("h2_z_warn_threshold must be finite and not negative")


EVENT_COLUMNS = ("event_order", "Severity", "Scope", "Trait", "Other_Trait", "Reason", "Value", "Action")


def bundle_errors(bundle: DataFrame) -> DataFrame:
    """``panel_id, i, j, h_se, rg_se`` from the diagonals of V and V_Stand."""
    se = [matrices.vech_se(bundle.filter(F.col("matrix") == m).select("panel_id", F.col("i").alias("pair_a"), F.col("j").alias("pair_b"), "value")).withColumnRenamed("se", name)
          for m, name in (("V", "h_se"), ("V_Stand", "rg_se"))]
    return se[0].join(se[1], ["panel_id", "i", "j"], "full")


def bundle_events(bundle: DataFrame, labels: DataFrame, manifest: DataFrame, policy: BundlePolicy = BundlePolicy(), *, se: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(events in order, retained traits) of one bundle under a policy. Nothing is repaired: a trait goes, or the run stops.

    ``labels``: ``trait, position`` of the bundle's rows; ``manifest``: ``trait, trait_order`` asked for. ``se``: ``panel_id, i, j, h_se, rg_se`` where
    V is not in the bundle. An event with the action ``stop`` ends the run; later checks are made on what is left all the same. Each kind is a join
    over the long matrices; only the order in which traits of invalid pairs go is sequential (``panels.bundle_drop_traits``).
    """
    policy.check()
    strict = policy.failed_action == "error"
    severity, trait_action, pair_action = ("error", "stop", "stop") if strict else ("warning", "removed", "resolve_by_trait_removal")
    se = bundle_errors(bundle) if se is None else se
    placed = manifest.select("trait", "trait_order").join(labels.select("trait", F.col("position").cast("long").alias("position")), "trait", "left")
    # Positions follow the manifest, so that ties go to its first trait.
    chosen = placed.filter("position IS NOT NULL").select("position", "trait", F.col("trait_order").cast("long").alias("o"))

    def renamed(table: DataFrame) -> DataFrame:
        for end in ("i", "j"):
            table = table.join(chosen.select(F.col("position").alias(end), F.col("o").alias(f"_{end}")), end).drop(end).withColumnRenamed(f"_{end}", end)
        return table

    cells = regression.durable(renamed(bundle.filter(F.col("matrix").isin("S", "I", "S_Stand"))))
    errors = regression.durable(renamed(se))
    name = manifest.select(F.col("trait_order").cast("long").alias("o"), "trait")

    def event(rows: DataFrame, tier: int, order: Sequence[str], severity_: str, action: str, reason, value=None, pair: bool = False) -> DataFrame:
        rows = rows.join(name.select(F.col("o").alias("i"), F.col("trait").alias("Trait")), "i", "left")
        rows = rows.join(name.select(F.col("o").alias("j"), F.col("trait").alias("Other_Trait")), "j", "left") if pair else rows.withColumn("Other_Trait", F.lit(""))
        keys = [F.col(c).cast("long") for c in order] + [F.lit(0).cast("long")] * (3 - len(order))
        return rows.select(F.struct(F.lit(tier).alias("tier"), *[c.alias(f"k{n}") for n, c in enumerate(keys)]).alias("event_order"), F.lit(severity_).alias("Severity"), F.lit("pair" if pair else "trait").alias("Scope"),
                           F.coalesce("Trait", F.lit("")).alias("Trait"), "Other_Trait", (F.lit(reason) if isinstance(reason, str) else reason).alias("Reason"),
                           (F.lit(None) if value is None else value).cast("double").alias("Value"), F.lit(action).alias("Action"))

    absent = placed.filter("position IS NULL").select(F.col("trait_order").cast("long").alias("i"))
    missing_ok = policy.allow_missing_traits
    events = [event(absent, 1, ["i"], "warning" if missing_ok else "error", "removed" if missing_ok else "stop", "Trait absent from the bundle")]
    own = regression.durable(panels.bundle_trait_reasons(cells, errors))
    bad = own.filter("reason <> ''")
    events.append(event(bad.select("i", F.posexplode(F.split("reason", "; ")).alias("n", "text")), 2, ["i", "n"], severity, trait_action, F.col("text")))
    valid = own.filter("reason = ''")
    diagonal = cells.filter("matrix = 'S_Stand' AND i = j").select("i", "value")
    events.append(event(valid.filter("diagonal_inconsistent").join(diagonal, "i"), 3, ["i"], "error", "stop", "S_Stand diagonal differs from 1 beyond 1e-8", F.col("value")))
    sound = valid.select(F.col("i").alias("pair_i"))
    pair_reasons = panels.bundle_pair_reasons(cells, errors).join(sound, "pair_i").join(sound.withColumnRenamed("pair_i", "pair_j"), "pair_j").filter("reason <> ''")
    pair_reasons = regression.durable(pair_reasons.select("panel_id", F.col("pair_i").alias("i"), F.col("pair_j").alias("j"), "reason"))
    events.append(event(pair_reasons, 4, ["i", "j"], severity, pair_action, F.col("reason"), pair=True))
    dropped = panels.bundle_drop_traits(own, pair_reasons.select("panel_id", F.col("i").alias("pair_i"), F.col("j").alias("pair_j"), "reason")).groupBy(
        F.col("trait_order").cast("long").alias("i")).agg(F.min("step").alias("step"))
    dropped = regression.durable(dropped.join(bad.select("i", F.lit(True).alias("own")), "i", "left"))
    if not strict:
        steps = dropped.filter("own IS NULL").select(F.col("i").alias("t"), "step")
        touched = pair_reasons.join(steps.select(F.col("t").alias("i"), F.col("step").alias("si")), "i", "left").join(steps.select(F.col("t").alias("j"), F.col("step").alias("sj")), "j", "left")
        ends = [name.select(F.col("o").alias(e), F.col("trait").alias(f"n{e}")) for e in ("i", "j")]
        lines = touched.join(ends[0], "i").join(ends[1], "j").select(F.when(F.coalesce(F.col("si") <= F.col("sj"), F.col("sj").isNull()), F.col("i")).otherwise(F.col("j")).alias("gone"),
                                                                     F.struct("i", "j", F.concat_ws(": ", "ni", "nj", "reason").alias("line")).alias("entry"))
        why = lines.groupBy("gone").agg(F.array_join(F.transform(F.array_sort(F.collect_list("entry")), lambda x: x.line), "; ").alias("text"))
        removals = steps.join(why, F.col("t") == F.col("gone")).select(F.col("t").alias("i"), "step", "text")
        events.append(event(removals, 5, ["step"], "warning", "removed", F.concat(F.lit("Removed to resolve invalid pairs: "), "text")))
    gone = bad.select("i") if strict else dropped.select("i")
    retained = regression.durable(own.select("i").join(gone, "i", "left_anti"))
    left = cells.join(retained, "i", "left_semi").join(retained.withColumnRenamed("i", "j"), "j", "left_semi")
    gap = panels.bundle_consistency(left).filter(~F.col("consistent")).select(F.lit(None).cast("long").alias("i"), "maximum_error")
    events.append(event(gap, 6, [], "error", "stop", "S_Stand is inconsistent with standardized S", F.col("maximum_error")).withColumn("Scope", F.lit("run")))
    z = left.filter("matrix = 'S' AND i = j").join(errors.filter("i = j").select("i", "h_se"), "i").select("i", safe_div("value", "h_se").alias("z"))
    low = z.filter((F.col("z") < policy.h2_z_warn_threshold) & F.lit(policy.h2_z_warn_threshold > 0))
    events.append(event(low, 7, ["i"], "warning", "retained", f"h2/SE below {policy.h2_z_warn_threshold:g}", F.col("z")))
    outside = left.filter("matrix = 'S_Stand' AND i < j AND abs(value) > 1")
    hard = policy.rg_out_of_range_action == "error"
    events.append(event(outside, 8, ["j", "i"], "error" if hard else "warning", "stop" if hard else "retained", "Genetic correlation outside [-1,1]; not clamped", F.col("value"), pair=True))
    out = events[0]
    for more in events[1:]:
        out = out.unionByName(more)
    kept = retained.join(name, retained["i"] == name["o"]).join(chosen.select("position", "o"), "o").select("trait", F.col("o").alias("trait_order"), "position")
    return out, kept
