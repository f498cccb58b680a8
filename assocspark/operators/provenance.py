"""Content fingerprints, and which requested pairs still have to be computed."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import evaluate_once
from ..session import durable

WORDS = 4  # of 64 bits: a whole SHA-256


def row_digest(df: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> tuple[DataFrame, list[Column]]:
    """``keep`` and the SHA-256 of each row as four 64-bit numbers, and their columns; NULL and '' differ, and column borders are kept.

    Hash and numbers are fixed as attributes: inside a decimal sum each of them would be made anew wherever the sum names its argument.
    """
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns])
    hashed = evaluate_once(df.select(*keep, F.sha2(text, 256).alias("_sha")))
    words = [F.conv(F.substring("_sha", 16 * k + 1, 16), 16, 10).cast("decimal(20,0)").alias(f"_word{k}") for k in range(WORDS)]
    return evaluate_once(hashed.select(*keep, *words)), [F.col(f"_word{k}") for k in range(WORDS)]


def table_fingerprint(df: DataFrame, columns: Sequence[str], *, group: Sequence[str] = ("trait",)) -> DataFrame:
    """Rows and sums of the digest's words per group: equal for equal contents in any order, and computed by partial sums.

    Include a rank column (see ``global_rank``) among ``columns`` to make the fingerprint order-aware.
    """
    hashed, words = row_digest(df, group, columns)
    sums = F.concat_ws("-", *[F.sum(word).cast("string") for word in words])
    return hashed.groupBy(*group).agg(F.count("*").alias("rows"), sums.alias("fingerprint"))


def pairs_to_compute(plan: DataFrame, completed: DataFrame) -> DataFrame:
    """Requested pairs with the ``reason`` each must be computed, or NULL if a completed result can be reused.

    ``plan``: ``p1, p2, input_fingerprint, parameters``. ``completed``: the same plus ``status``, the recorded
    ``result_fingerprint`` and the ``current_fingerprint`` of the stored result.
    """
    done = completed.select("p1", "p2", F.col("status").alias("_status"), F.col("input_fingerprint").alias("_input"),
                            F.col("parameters").alias("_parameters"), F.col("result_fingerprint").alias("_result"), F.col("current_fingerprint").alias("_current"))
    reason = (F.when(F.col("_status").isNull(), "result_or_checkpoint_missing")
              .when(F.col("_status") != "completed", "completion_not_verified")
              .when(~F.col("_input").eqNullSafe(F.col("input_fingerprint")) | ~F.col("_parameters").eqNullSafe(F.col("parameters")), "inputs_or_parameters_changed")
              .when(F.col("_current").isNull(), "result_or_checkpoint_missing")
              .when(~F.col("_result").eqNullSafe(F.col("_current")), "result_changed"))
    return plan.join(done, ["p1", "p2"], "left").select(*plan.columns, reason.alias("reason"))


def settings_differences(saved: DataFrame, current: DataFrame) -> DataFrame:
    """Filter settings (``trait, name, value``) that changed between a saved run and this one."""
    both = current.select("trait", "name", F.col("value").alias("current")).join(
        saved.select("trait", "name", F.col("value").alias("saved")), ["trait", "name"], "full")
    return both.filter(~F.col("current").eqNullSafe(F.col("saved")))


FANOUT_BITS = 4  # children of a node of the digest tree, as a power of two


def digest_tree(df: DataFrame, columns: Sequence[str], *, group: str, key: Column, levels: int = 6) -> DataFrame:
    """Digests of ranges of a table, and of ranges of ranges up to a root per ``group``: ``group, level, node, rows, digest``.

    ``key`` is a non-negative number that rows are ordered by; a leaf (level 0) is one value of it, and a node of level k covers ``2 ** (FANOUT_BITS * k)``
    of them. A leaf's digest adds up the SHA-256 words of its rows (the key is part of them, so order counts, and equal rows count as often as
    they occur); a node's is the SHA-256 of its children's, in order. No leaf is gathered, and a node has sixteen children at most.
    """
    keyed = df.select(F.col(group).alias("group"), key.cast("long").alias("node"), *[F.col(c).alias(f"_{n}") for n, c in enumerate(columns)])
    hashed, words = row_digest(keyed, ["group", "node"], ["node", *[f"_{n}" for n in range(len(columns))]])
    leaf = hashed.groupBy("group", "node").agg(F.count("*").alias("rows"), F.sha2(F.concat_ws("-", *[F.sum(word).cast("string") for word in words], F.count("*").cast("string")), 256).alias("digest"))
    tree = [durable(leaf.withColumn("level", F.lit(0)))]
    for level in range(1, levels + 1):
        below = tree[-1].withColumn("up", F.shiftright("node", FANOUT_BITS))
        children = F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda x: F.concat_ws(":", x.node.cast("string"), x.digest))
        tree.append(durable(below.groupBy("group", "up").agg(F.sum("rows").alias("rows"), F.sha2(F.array_join(children, ";"), 256).alias("digest")).withColumnRenamed("up", "node").withColumn("level", F.lit(level))))
    out = tree[0]
    for part in tree[1:]:
        out = out.unionByName(part)
    return out.select("group", "level", "node", "rows", "digest")


def changed_ranges(old: DataFrame, new: DataFrame, levels: int = 6) -> DataFrame:
    """Leaves that differ between two digest trees: ``group, node, change`` (added, removed or changed).

    Trees are compared from the top: a level's nodes are looked at only below nodes that differ, so equal parts of a table cost one row.
    """
    differ = None
    for level in range(levels, -1, -1):
        sides = [t.filter(F.col("level") == level).select("group", "node", F.col("digest").alias(name)) for t, name in ((old, "before"), (new, "after"))]
        if differ is not None:
            above = differ.select("group", F.col("node").alias("_up"))
            sides = [s.withColumn("_up", F.shiftright("node", FANOUT_BITS)).join(above, ["group", "_up"], "left_semi").drop("_up") for s in sides]
        differ = durable(sides[0].join(sides[1], ["group", "node"], "full").filter(~F.col("before").eqNullSafe(F.col("after"))))
        if differ.isEmpty():
            break
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return differ.select("group", "node", change.alias("change"))


def pairs_of_changes(changes: DataFrame, plan: DataFrame) -> DataFrame:
    """Pairs of ``plan`` (``p1, p2``) that have a trait (``group``) with a changed range, and how many ranges that is."""
    touched = changes.groupBy("group").agg(F.count("*").alias("ranges"))
    sides = [touched.select(F.col("group").alias(p), F.col("ranges").alias(f"_{p}")) for p in ("p1", "p2")]
    rows = plan.select("p1", "p2").join(sides[0], "p1", "left").join(sides[1], "p2", "left")
    total = F.coalesce("_p1", F.lit(0)) + F.when(F.col("p1") != F.col("p2"), F.coalesce("_p2", F.lit(0))).otherwise(0)
    return rows.select("p1", "p2", total.alias("ranges")).filter("ranges > 0")
