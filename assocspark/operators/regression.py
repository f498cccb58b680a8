"""LD-score regression of all trait pairs with block-jackknife errors.

The published estimator (Bulik-Sullivan et al. 2015, single-trait and cross-trait): per pair, regress
``z1 * z2`` on ``sqrt(N1 N2) * l`` with a free intercept, weights re-estimated twice, and 200 delete-one blocks
of SNPs in genomic order. A pair uses the SNPs its two traits share, also for the heritabilities that enter
its correlation.

Layout. Work is tiled in two dimensions: SNPs by ``chunk`` of genomic order, trait pairs by tile (a, b) of two groups of
``tile`` traits. A row holds the records of one SNP in the traits of one tile; pairs are formed inside a task by array
arithmetic and never as rows, and only sums leave a task. The table is stored by (chunk, a, b) once (``layout``), so no
pass over it moves a SNP. Coefficients, and the number of shared SNPs before each chunk, are tables of pairs: they are
joined to their chunk and tile by a cogroup, solved as columns, and never pass through the driver. Nothing bounds the
number of traits, SNPs or chunks.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_finite, safe_div, two_sided_p
from ..session import durable
from ..sources.layout import default_buckets, store_by
from .ordering import global_rank

N_BLOCKS = 200
TILE = 32  # traits on each side of a tile
CELLS_PER_STEP = 50_000  # SNPs x pairs held at once by a task; arrays of this size stay in the processor's cache
CHUNKS_PER_TASK = 4  # chunks of more SNPs come before more chunks
CHUNK_ROWS = 20_000  # SNPs that a chunk may grow to
_KEY = ["chunk", "a", "b"]
_PAIR = ["i", "j"]


@dataclass(frozen=True)
class TraitVectors:
    """SNPs in genomic order, stored by chunk and tile: ``chunk, a, b, position, l2, wl, r`` (records of the tile's traits)."""

    table: DataFrame
    traits: int
    tile: int


def oriented_alleles(a1: str, a2: str) -> tuple[Column, Column]:
    """Name of an allele pair that is equal on both strands and in both orders, and the sign that turns an effect of ``a1`` to it.

    Alleles other than single bases have no strand here.
    """
    def ordered(x, y):
        return F.concat(F.least(x, y), F.lit("/"), F.greatest(x, y)), F.when(x <= y, F.lit(1.0)).otherwise(F.lit(-1.0))

    first, second = F.col(a1), F.col(a2)
    here, sign = ordered(first, second)
    there, other = ordered(F.translate(first, "ACGT", "TGCA"), F.translate(second, "ACGT", "TGCA"))
    flipped = F.concat(first, second).rlike("^[ACGT]{2}$") & (there < here)
    return F.when(flipped, there).otherwise(here), F.when(flipped, other).otherwise(sign)


def snp_vectors(sumstats: DataFrame, ldscores: DataFrame, weights: DataFrame, traits: int, *, chunk_rows: int = 20_000, tile: int = TILE) -> TraitVectors:
    """Join Z and N of all traits with LD scores and weights. (trait, SNP) must be unique.

    ``sumstats``: ``trait_order, SNP, A1, A2, N, Z``; rows without finite Z and N are left out. Records of a SNP meet if their
    alleles are the same on either strand; Z is turned to one orientation. Records with other alleles stand in a row of their own, so
    they take nothing from the others. ``ldscores``: ``SNP, CHR, BP, L2``; ``weights``: ``SNP, L2``. A chunk has ``chunk_rows`` SNPs, or as many
    more (``CHUNK_ROWS`` at most) as leave a task ``CHUNKS_PER_TASK`` of them: every pass pays for each chunk.
    """
    if traits < 1:
        raise ValueError("no traits to regress")
    alleles, sign = oriented_alleles("A1", "A2")
    usable = sumstats.filter(is_finite("Z") & is_finite("N") & (F.col("N") > 0)).select(
        "SNP", alleles.alias("alleles"), F.struct(F.col("trait_order").cast("int").alias("t"), F.col("N").cast("double").alias("n"), (F.col("Z").cast("double") * sign).alias("z")).alias("record"))
    grouped = usable.groupBy("SNP", "alleles").agg(F.array_sort(F.collect_list("record")).alias("r"))
    panel = ldscores.select("SNP", "CHR", "BP", F.col("L2").cast("double").alias("l2")).join(
        weights.select("SNP", F.col("L2").cast("double").alias("wl")), "SNP")
    ranked = global_rank(grouped.join(panel, "SNP"), ["CHR", "BP", "SNP", "alleles"], rank="position")
    chunk_rows = _chunk_rows(chunk_rows, ranked.count(), default_buckets(ranked.sparkSession))
    placed = ranked.select(F.expr(f"cast(position div {chunk_rows} as int)").alias("chunk"), "position", "l2", "wl", "r")
    if traits <= tile:
        tiled = placed.select("chunk", F.lit(0).alias("a"), F.lit(0).alias("b"), "position", "l2", "wl", "r")
    else:
        group = F.expr(f"array_distinct(transform(r, x -> x.t div {tile}))")
        corners = F.expr("flatten(transform(g, a -> transform(filter(g, b -> b >= a), b -> struct(cast(a as int) as a, cast(b as int) as b))))")
        tiled = placed.withColumn("g", group).withColumn("corner", F.explode(corners)).select(
            "chunk", "corner.a", "corner.b", "position", "l2", "wl", F.expr(f"filter(r, x -> x.t div {tile} in (corner.a, corner.b))").alias("r"))
    stored = store_by(tiled, _KEY, order=["position"])
    if stored.isEmpty():
        raise ValueError("no SNP has both summary statistics and LD scores")
    return TraitVectors(stored, traits, tile)


def _chunk_rows(least: int, snps: int, tasks: int) -> int:
    return max(int(least), min(CHUNK_ROWS, -(-snps // (CHUNKS_PER_TASK * tasks))))


def _steps(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    """The SNPs of one chunk and tile in genomic order, a few at a time, as SNPs x pairs."""
    rows = rows.sort_by("position").combine_chunks()
    limit = max(1, CELLS_PER_STEP // max(len(i), 1))
    traits, column = np.unique(np.concatenate([i, j]), return_inverse=True)
    left, right = column[:len(i)], column[len(i):]
    for low in range(0, rows.num_rows, limit):
        part = rows.slice(low, limit).combine_chunks()
        lists = part.column("r").chunk(0)
        row, records = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths())), lists.flatten()
        t = np.asarray(records.field("t"))
        at = np.minimum(np.searchsorted(traits, t), len(traits) - 1)
        known = traits[at] == t
        z, n = np.full((part.num_rows, len(traits)), np.nan), np.full((part.num_rows, len(traits)), np.nan)
        z[row[known], at[known]] = np.asarray(records.field("z"))[known]
        n[row[known], at[known]] = np.asarray(records.field("n"))[known]
        both = np.isfinite(z[:, left]) & np.isfinite(z[:, right])
        yield dict(both=both, z1=np.where(both, z[:, left], 0), z2=np.where(both, z[:, right], 0), n1=np.where(both, n[:, left], 1), n2=np.where(both, n[:, right], 1),
                   l2=np.asarray(part.column("l2"))[:, None], wl=np.asarray(part.column("wl"))[:, None])


@dataclass(frozen=True)
class Model:
    """One regression per pair: outcome, sample size and weights as functions of a step and fixed coefficients."""

    outcome: Callable[[dict], np.ndarray]
    size: Callable[[dict], np.ndarray]
    weight: Callable[[dict, np.ndarray, np.ndarray], np.ndarray]
    null_intercept: float


def _heritability_model(which: int, m: float) -> Model:
    z, n = f"z{which}", f"n{which}"

    def weight(s, slope, intercept):
        l2, wl = np.maximum(s["l2"], 1), np.maximum(s["wl"], 1)
        expected = intercept + np.clip(slope, 0, 1) * s[n] / m * l2
        return 1 / (2 * expected ** 2) / wl
    return Model(lambda s: s[z] ** 2, lambda s: s[n], weight, 1.0)


def _covariance_model(m: float, h1, int1, h2, int2) -> Model:
    h1, h2 = np.clip(h1, 0, 1), np.clip(h2, 0, 1)

    def weight(s, slope, intercept):
        l2, wl = np.maximum(s["l2"], 1), np.maximum(s["wl"], 1)
        a = s["n1"] * h1 * l2 / m + int1
        b = s["n2"] * h2 * l2 / m + int2
        c = np.sqrt(s["n1"] * s["n2"]) * np.clip(slope, -1, 1) * l2 / m + intercept
        return 1 / (a * b + c ** 2) / wl
    return Model(lambda s: s["z1"] * s["z2"], lambda s: np.sqrt(s["n1"] * s["n2"]), weight, 0.0)


_SUMS = ("w", "wx", "wxx", "wy", "wxy")


def _estimates(prefix: str):
    """Slope per unit of x, and intercept, from weighted sums."""
    w, wx, wxx, wy, wxy = [F.col(f"{prefix}{c}") for c in _SUMS]
    det = w * wxx - wx * wx
    return safe_div(w * wxy - wx * wy, det), safe_div(wxx * wy - wx * wxy, det)


def delete_one(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Total and delete-one slope and intercept per block: the group's sums minus the block's.

    ``moments`` has ``keys, block, w, wx, wxx, wy, wxy``, a row per block.
    """
    totals = moments.groupBy(*keys).agg(F.count("*").alias("blocks"), *[F.sum(c).alias(f"t_{c}") for c in _SUMS])
    rows = moments.join(totals, keys).withColumns({f"d_{c}": F.col(f"t_{c}") - F.col(c) for c in _SUMS})
    slope, intercept = _estimates("t_")
    d_slope, d_intercept = _estimates("d_")
    return rows.select(*keys, "block", "blocks", slope.alias("slope"), intercept.alias("intercept"),
                       d_slope.alias("d_slope"), d_intercept.alias("d_intercept"))


def jackknife_se(deleted: str, blocks: str = "blocks"):
    """Aggregate: standard error from delete-one values."""
    b = F.max(blocks)
    return F.sqrt((b - 1) * F.var_pop(deleted))


def _moments(model: Model, slope, intercept, scale: np.ndarray, s: dict) -> list[np.ndarray]:
    """Weighted sums ``w, wx, wxx, wy, wxy`` with ``x = N l / scale`` (scale keeps the normal equations tame)."""
    w = np.where(s["both"], model.weight(s, slope, intercept), 0)
    x, y = model.size(s) * s["l2"] / scale, model.outcome(s)
    wx, wy = w * x, w * y
    return [w, wx, wx * x, wy, wx * y]


def _models(names: list[str], m: float, pairs: dict[str, np.ndarray]) -> dict[str, Model]:
    """The regressions of a tile's pairs; the covariance is weighted by the heritabilities and intercepts found for the two traits."""
    every = {"h2_1": lambda: _heritability_model(1, m), "h2_2": lambda: _heritability_model(2, m),
             "gcov": lambda: _covariance_model(m, *(pairs[c] for c in ("own_h2_1", "own_int_1", "own_h2_2", "own_int_2")))}
    return {name: every[name]() for name in names}


def _tile_pairs(a: int, b: int, tile: int, traits: int) -> tuple[np.ndarray, np.ndarray]:
    """All unordered pairs of a tile, self-pairs included."""
    i, j = np.meshgrid(np.arange(a * tile, min((a + 1) * tile, traits)), np.arange(b * tile, min((b + 1) * tile, traits)), indexing="ij")
    return i[i <= j], j[i <= j]


def _start(vectors: TraitVectors, m: float) -> DataFrame:
    """chunk, a, b, i, j: shared SNPs and sums of outcome, load and size of every model, for pairs that share a SNP there."""
    tile, traits = vectors.tile, vectors.traits
    none = np.zeros(1)
    models = {"h2_1": _heritability_model(1, m), "h2_2": _heritability_model(2, m), "gcov": _covariance_model(m, none, 1, none, 1)}
    names = [f"{c}_{name}" for name in models for c in ("y", "x", "k")]

    def run(key, rows):
        chunk, a, b = (k.as_py() for k in key)
        i, j = _tile_pairs(a, b, tile, traits)
        sums, n = np.zeros((len(names), len(i))), np.zeros(len(i), np.int64)
        for s in _steps(rows, i, j):
            n += s["both"].sum(0)
            values = [v for model in models.values() for v in (model.outcome(s), s["l2"] * model.size(s), model.size(s) + 0 * s["l2"])]
            sums += np.stack([np.where(s["both"], v, 0).sum(0) for v in values])
        met = n > 0
        return pa.table({"chunk": pa.array(np.full(met.sum(), chunk, np.int32)), "a": pa.array(np.full(met.sum(), a, np.int32)), "b": pa.array(np.full(met.sum(), b, np.int32)),
                         "i": pa.array(i[met].astype(np.int32)), "j": pa.array(j[met].astype(np.int32)), "n": pa.array(n[met]), **{c: pa.array(v[met]) for c, v in zip(names, sums, strict=True)}})
    schema = "chunk int, a int, b int, i int, j int, n long, " + ", ".join(f"{c} double" for c in names)
    return durable(vectors.table.groupBy(*_KEY).applyInArrow(run, schema))


def _pass(vectors: TraitVectors, places: DataFrame, fits: DataFrame, names: list[str], m: float, *, blocks: int = 0) -> DataFrame:
    """Weighted sums of the named models with the weights that ``fits`` (one row per pair) gives: per pair, and per jackknife block if ``blocks``.

    ``places`` has, per chunk and pair, the shared SNPs before the chunk. The block of a SNP follows from its rank among the pair's shared SNPs;
    a pair with fewer SNPs than blocks has a block for each SNP.
    """
    stats = ("w", "wx", "wxx", "wy", "wxy")
    keys = ["model", *_PAIR, *(["block"] if blocks else [])]

    def run(key, rows, asked):
        pairs = {c: np.asarray(asked.column(c)) for c in asked.column_names}
        i, j = pairs["i"], pairs["j"]
        models = _models(names, m, pairs)
        seen, total = pairs["before"].copy(), np.maximum(pairs["total"], 1)
        own = np.minimum(blocks, total)
        found: dict[str, list] = {name: [] for name in names}
        for s in _steps(rows, i, j) if len(i) else ():
            both = s["both"]
            if blocks:
                rank = seen + both.cumsum(0) - 1
                seen = seen + both.sum(0)
                row, pair = np.nonzero(both)
                member = pair * blocks + (((rank + 1) * own - 1) // total)[row, pair]
                cells, member = np.unique(member, return_inverse=True)
            for name, model in models.items():
                parts = _moments(model, pairs[f"slope_{name}"], pairs[f"intercept_{name}"], pairs[f"scale_{name}"], s)
                if blocks:
                    found[name].append((cells, np.stack([np.bincount(member, v, len(cells)) for v in (np.ones(len(row)), *(p[row, pair] for p in parts))])))
                else:
                    found[name].append((np.arange(len(i)), np.stack([both.sum(0).astype(float), *(p.sum(0) for p in parts)])))
        out = []
        for name, steps in found.items():
            if not steps:
                continue
            cells, member = np.unique(np.concatenate([c for c, _ in steps]), return_inverse=True)
            sums = np.stack([np.bincount(member, v, len(cells)) for v in np.concatenate([v for _, v in steps], axis=1)])
            pair, block = (cells // blocks, cells % blocks) if blocks else (cells, cells * 0)
            out.append(pa.table({"model": pa.array([name] * len(cells)), "i": pa.array(i[pair]), "j": pa.array(j[pair]), "block": pa.array(block.astype(np.int32)), "snps": pa.array(sums[0]),
                                 **{c: pa.array(v) for c, v in zip(stats, sums[1:], strict=True)}}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], t) for c, t in zip(names_out, types, strict=True)})

    names_out = ["model", "i", "j", "block", "snps", *stats]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), *[pa.float64()] * 6]
    schema = "model string, i int, j int, block int, snps double, " + ", ".join(f"{c} double" for c in stats)
    asked = places.join(fits, _PAIR)
    rows = vectors.table.groupBy(*_KEY).cogroup(asked.groupBy(*_KEY)).applyInArrow(run, schema)
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("snps", *stats)])


def _by_model(sums: DataFrame, names: list[str], fits: DataFrame, m: float) -> DataFrame:
    """New slopes and intercepts of the named models, one row per pair; the other columns of ``fits`` stay."""
    slope, intercept = _estimates("")
    solved = sums.select("model", *_PAIR, slope.alias("slope"), intercept.alias("intercept"))
    wide = solved.groupBy(*_PAIR).agg(*[F.max(F.when(F.col("model") == name, F.col(c))).alias(f"_{c}_{name}") for name in names for c in ("slope", "intercept")])
    joined = fits.join(wide, _PAIR)
    new = {f"slope_{n}": F.col(f"_slope_{n}") * F.lit(float(m)) / F.col(f"scale_{n}") for n in names} | {f"intercept_{n}": F.col(f"_intercept_{n}") for n in names}
    return joined.withColumns(new).drop(*[f"_{c}_{n}" for n in names for c in ("slope", "intercept")])


@dataclass(frozen=True)
class PairFit:
    """Block sums of every pair (``model, i, j, block, snps`` and sums) and its final weights; ``snps`` of all pairs that share any."""

    moments: DataFrame
    fits: DataFrame
    shared: DataFrame
    traits: int
    m: float
    blocks: int


def fit_pairs(vectors: TraitVectors, m: float, *, n_blocks: int = N_BLOCKS) -> PairFit:
    """The coefficient passes and the block sums of all pairs. ``m`` is the number of reference SNPs behind the LD scores."""
    single, joint = ["h2_1", "h2_2"], ["gcov"]
    start = _start(vectors, m)
    before = Window.partitionBy(*_PAIR).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    places = durable(start.select(*_KEY, *_PAIR, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    columns = [c for c in start.columns if c[:2] in ("y_", "x_", "k_")]
    totals = start.groupBy(*_PAIR).agg(F.sum("n").alias("total"), *[F.sum(c).alias(c) for c in columns])
    null = {"h2_1": 1.0, "h2_2": 1.0, "gcov": 0.0}
    begin = [c for n in single + joint for c in (safe_div(float(m) * (F.col(f"y_{n}") / F.col("total") - null[n]), F.col(f"x_{n}") / F.col("total")).alias(f"slope_{n}"),
                                                 F.lit(null[n]).alias(f"intercept_{n}"), (F.col(f"k_{n}") / F.col("total")).alias(f"scale_{n}"))]
    fits = durable(totals.select(*_PAIR, "total", *begin))
    for _ in range(2):
        fits = durable(_by_model(_pass(vectors, places, fits, single, m), single, fits, m))
    first = durable(_pass(vectors, places, fits, single, m, blocks=n_blocks))
    own = _by_model(first.groupBy("model", *_PAIR).agg(*[F.sum(c).alias(c) for c in _SUMS]), single, fits, m)
    own = own.select(*_PAIR, *[F.col(f"{c}_{n}").alias(f"own_{short}_{n[-1]}") for n in single for c, short in (("slope", "h2"), ("intercept", "int"))])
    fits = durable(fits.join(own, _PAIR).fillna(float("nan"), [c for c in own.columns if c not in _PAIR]))
    for _ in range(2):
        fits = durable(_by_model(_pass(vectors, places, fits, joint, m), joint, fits, m))
    second = durable(_pass(vectors, places, fits, joint, m, blocks=n_blocks))
    return PairFit(first.unionByName(second), fits, totals.select(*_PAIR, F.col("total").alias("snps")), vectors.traits, m, n_blocks)


def deleted_estimates(fit: PairFit) -> DataFrame:
    """Per pair and block, whole and delete-one slopes (on the scale of estimates) and intercepts of every model: ``<model>_slope`` and so on."""
    scale = F.coalesce(*[F.when(F.col("model") == n, F.col(f"scale_{n}")) for n in ("h2_1", "h2_2", "gcov")])
    factors = fit.fits.select(*_PAIR, *[f"scale_{n}" for n in ("h2_1", "h2_2", "gcov")])
    d = delete_one(fit.moments, ["model", *_PAIR]).join(factors, _PAIR).withColumn("factor", F.lit(float(fit.m)) / scale).where(is_finite("factor"))
    return d.groupBy(*_PAIR, "block").agg(
        F.max("blocks").alias("blocks"),
        *[F.max(F.when(F.col("model") == name, F.col(c) * F.col("factor") if "slope" in c else F.col(c))).alias(f"{name}_{c}")
          for name in ("h2_1", "h2_2", "gcov") for c in ("slope", "intercept", "d_slope", "d_intercept")])


def all_pairs(spark, traits: int) -> DataFrame:
    """Every unordered pair ``i <= j`` of trait numbers, made where it is used."""
    return spark.range(traits).select(F.col("id").cast("int").alias("i"), F.explode(F.sequence(F.col("id").cast("int"), F.lit(traits - 1))).alias("j"))


def pair_regressions(vectors: TraitVectors, m: float, *, n_blocks: int = N_BLOCKS) -> DataFrame:
    """One row per unordered pair with ``i <= j``: heritabilities, covariance, correlation, errors, intercepts.

    Every pair has a row: ``snps`` counts its shared SNPs, and where they are fewer than the blocks ``reason`` says so; what cannot be
    estimated from them is NULL. Runs the passes; the jackknife over the block sums stays a lazy DataFrame.
    """
    return summarise_pairs(fit_pairs(vectors, m, n_blocks=n_blocks))


def summarise_pairs(fit: PairFit) -> DataFrame:
    """Jackknife of the block sums as column arithmetic: one row per pair. Estimates that are not numbers become NULL."""
    asked = all_pairs(fit.moments.sparkSession, fit.traits).join(fit.shared, _PAIR, "left").fillna(0, ["snps"])
    reason = F.when(F.col("snps") == 0, "no shared SNPs").when(F.col("snps") < fit.blocks, "fewer shared SNPs than blocks")
    return asked.join(_jackknife(deleted_estimates(fit)), _PAIR, "left").withColumn("reason", reason)


def _jackknife(per_block: DataFrame) -> DataFrame:
    positive = (F.col("h2_1_slope") > 0) & (F.col("h2_2_slope") > 0)
    rg = F.when(positive, safe_div("gcov_slope", F.sqrt(F.col("h2_1_slope") * F.col("h2_2_slope"))))
    d_product = F.col("h2_1_d_slope") * F.col("h2_2_d_slope")
    d_rg = F.when(positive & (d_product > 0), safe_div("gcov_d_slope", F.sqrt(d_product)))
    rows = per_block.withColumns({"rg": rg, "d_rg": d_rg})
    out = rows.groupBy("i", "j").agg(
        F.max("rg").alias("rg"), F.when(F.count("d_rg") == F.max("blocks"), jackknife_se("d_rg")).alias("se"),
        F.max("h2_1_slope").alias("h2_p1_pair_obs"), F.max("h2_2_slope").alias("h2_p2_pair_obs"),
        jackknife_se("h2_1_d_slope").alias("h2_p1_se"), jackknife_se("h2_2_d_slope").alias("h2_p2_se"),
        F.max("h2_1_intercept").alias("h2_int_1"), jackknife_se("h2_1_d_intercept").alias("h2_int_se_1"),
        F.max("h2_2_intercept").alias("h2_int_2"), jackknife_se("h2_2_d_intercept").alias("h2_int_se_2"),
        F.max("gcov_slope").alias("gcov_native_obs"), jackknife_se("gcov_d_slope").alias("gcov_se"),
        F.max("gcov_intercept").alias("gcov_int"), jackknife_se("gcov_d_intercept").alias("gcov_int_se"))
    z = F.when((F.col("se") == 0) & (F.col("rg") != 0), F.signum("rg") * float("inf")).otherwise(safe_div("rg", "se"))
    numbers = {c: F.when(~F.isnan(c), F.col(c)) for c, t in out.dtypes if t == "double"}
    return out.withColumns(numbers).withColumn("z", z).withColumn("p", two_sided_p("z"))


def liability_factor(sample: str = "sample_prevalence", population: str = "population_prevalence"):
    """Observed-to-liability factor ``K^2 (1-K)^2 / (P (1-P) phi^2)``; 1 without both prevalences (Lee et al. 2011)."""
    from ..functions import normal_quantile
    k, p = F.col(population), F.col(sample)
    q = normal_quantile(k)
    density = F.exp(-(q * q) / 2.0) / float(np.sqrt(2 * np.pi))
    factor = F.pow(k * (1 - k), F.lit(2.0)) / (p * (1 - p) * density * density)
    return F.when(k.isNotNull() & p.isNotNull(), factor).otherwise(F.lit(1.0))


def pair_table(estimates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Directed pair rows of the pair-table contract: each unordered estimate once per requested orientation.

    Heritability fields of row (p1, p2) belong to p2, on the liability scale where p2 has prevalences.
    """
    traits = manifest.select("trait", "trait_order", "sample_prevalence", "population_prevalence")
    common = ("rg", "se", "z", "p", "gcov_int", "gcov_int_se", "gcov_native_obs")

    def oriented(a, b, i, j):
        return F.struct(F.col(i).alias("o1"), F.col(j).alias("o2"), *common,
                        F.col(f"h2_p{b}_pair_obs").alias("h2_obs"), F.col(f"h2_p{b}_se").alias("h2_obs_se"), F.col(f"h2_int_{b}").alias("h2_int"),
                        F.col(f"h2_int_se_{b}").alias("h2_int_se"), F.col(f"h2_p{a}_pair_obs").alias("h2_p1_pair_obs"), F.col(f"h2_p{b}_pair_obs").alias("h2_p2_pair_obs"))
    forward, backward = oriented(1, 2, "i", "j"), oriented(2, 1, "j", "i")
    rows = estimates.select(F.inline(F.when(F.col("i") == F.col("j"), F.array(forward)).otherwise(F.array(forward, backward))))
    first = manifest.filter(F.col("ref") == "yes") if "ref" in manifest.columns else manifest
    rows = rows.join(first.select(F.col("trait").alias("p1"), F.col("trait_order").alias("o1")), "o1").join(
        traits.select(F.col("trait").alias("p2"), F.col("trait_order").alias("o2"), "sample_prevalence", "population_prevalence"), "o2")
    binary = F.col("sample_prevalence").isNotNull() & F.col("population_prevalence").isNotNull()
    factor = liability_factor()
    return rows.withColumns({
        "h2_liab": F.when(binary, F.col("h2_obs") * factor), "h2_liab_se": F.when(binary, F.col("h2_obs_se") * factor),
        "h2_obs": F.when(~binary, F.col("h2_obs")), "h2_obs_se": F.when(~binary, F.col("h2_obs_se"))}).drop(
        "sample_prevalence", "population_prevalence")
