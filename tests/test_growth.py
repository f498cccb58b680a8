"""What keeps jobs in proportion to their tables: tasks by rows, lookups of known size, and one pass where several results need it."""
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from assocspark.operators import filters, provenance, regression, variant_qc as vq
from assocspark.plans import jobs
from assocspark.plans.ledger import digest_of
from registry import views


def test_tasks_follow_rows(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select(*[F.col("id").alias(c) for c in views.ORDER])
    rows.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(views, "ROWS_PER_TASK", 10, raising=False)
    made = views.lineitem(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() == 100 and made.count() == 1000
    rows.repartition(200).write.parquet(f"{tmp_path}/many/lineitem.parquet")
    monkeypatch.setattr(views, "ROWS_PER_TASK", 1000, raising=False)
    assert "Exchange" not in views.lineitem(spark, f"{tmp_path}/many")._jdf.queryExecution().executedPlan().toString() or spark.sparkContext.defaultParallelism > 8


def test_large_rows_are_not_dealt_by_trait(spark):
    rows = spark.range(100).select((F.col("id") % 2).cast("string").alias("trait"), F.col("id").cast("double").alias("N"), F.lit("1").alias("Z"), F.lit("rs").alias("SNP"))
    lookup = rows.groupBy("trait").agg(F.max("N").alias("N"), F.lit(80.0).alias("chisq_max"))
    for joined in (filters.override_n(rows, lookup), filters.with_cutoff(rows, lookup)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and joined.count() == 100


RECORD = dict(trait="T0", SNP="rs1", CHR=1, POS=5, A1="A", A2="G", eaf_A1=0.5, beta=0.1, se=0.1, LP=2.0, N=10.0)


def test_equal_records_are_reported_as_lost(spark):
    raw = spark.createDataFrame([{**RECORD, "row": 1}, {**RECORD, "row": 1}, {**RECORD, "row": 2, "LP": 400.0}, {**RECORD, "row": 3, "se": 0.0}, {**RECORD, "row": 4, "POS": 6}])
    found = vq.validate_variants(raw, order=["row"], id_source="vcf_id")
    assert sorted((r["row"], r["QC_action"]) for r in found.issues.collect()) == [
        (1, "duplicate_removed"), (1, "duplicate_removed"), (2, "p_adjusted"), (3, "removed"), (4, "duplicate_removed")]
    assert found.good.count() == 1


def test_chromosomes_that_are_numbers_stay_numbers(spark):
    for kind in ("int", "string"):
        typed = vq.typed_variants(spark.createDataFrame([RECORD]).withColumn("CHR", F.col("CHR").cast(kind)))
        assert typed.schema["CHR"].dataType.simpleString() == "bigint" and typed.first()["CHR"] == 1
        assert ("regexp_replace" in typed._jdf.queryExecution().optimizedPlan().toString()) == (kind == "string")


def test_combination_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    rows = [(f"T{t}", f"s{s}", 1, s + 1, "A", "G", 0.3, 100.0, 1.0, 0.3) for t in range(2) for s in range(50)]
    schema = "trait string, SNPID string, CHR long, BP long, EA string, OA string, EAF double, N double, Z double, P double"
    assoc = spark.createDataFrame(rows, schema).mapInArrow(count, schema).withColumn("trait_order", F.lit(0))
    out, _, _ = jobs.combine_snps(assoc, jobs.PanelResult(None, None, {}, ("T0", "T1"), np.eye(2), [0.6, 0.8]))
    assert out.count() == 50 and seen.value == 100


def test_a_record_is_hashed_once(spark):
    rows = spark.createDataFrame([("T0", "a"), ("T0", "b")], "trait string, x string")
    plan = provenance.table_fingerprint(rows, ["x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sha2(") == 1


def test_digest_of_plain_columns_needs_no_json(spark):
    pair = [spark.createDataFrame([r], "a string, b string") for r in (("x|=y", "z"), ("x", "y|=z"), ("1:x", None), ("1:x", ""))]
    assert len({digest_of(p)[0] for p in pair}) == 4
    from assocspark.plans import ledger
    for kind in ("bigint", "double", "string", "date", "boolean"):
        value = spark.range(1).select(F.lit(None).cast(kind).alias("v"))
        assert "json" not in str(ledger._text(value.schema["v"].dataType, F.col("v")))


def test_chisq_reads_a_number_once(spark):
    rows = spark.range(3).select(F.lit("T0").alias("trait"), F.lit("rs").alias("SNP"), F.col("id").cast("string").alias("Z"))
    kept = filters.chisq_filter(rows, 2.0)[0]
    assert kept.count() == 2 and "inline" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_best_records_are_sorted_by_key_once(spark):
    rows = spark.createDataFrame([RECORD | dict(INFO=0.9, P=0.5, row=1)]).withColumnsRenamed({"eaf_A1": "EAF", "beta": "BETA"})
    alleles = spark.createDataFrame([("rs1", "A", "G")], "SNP string, A1 string, A2 string")
    best = vq.dedup_best(rows, "SNP", ["row"])
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(SNP#\d+, trait#\d+", plan) and re.search(r"Sort \[SNP#\d+ ASC NULLS FIRST, trait#", plan)
    both = filters.munge(best, F.broadcast(alleles))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 2 and both.count() == 1  # one on each side of the shuffle


def _chain(spark, snps):
    ld = spark.range(snps).select(F.concat(F.lit("rs"), "id").alias("SNP"), F.lit(1).alias("CHR"), F.col("id").alias("BP"), (1 + F.col("id") % 37).cast("double").alias("L2"))
    stats = ld.crossJoin(spark.range(2).select(F.col("id").cast("int").alias("trait_order"))).select(
        "trait_order", "SNP", F.lit("A").alias("A1"), F.lit("C").alias("A2"), F.lit(1000.0).alias("N"), (F.sin(F.col("BP") * (F.col("trait_order") + 3)) * F.sqrt("L2")).alias("Z"))
    return stats, ld


def test_chunks_follow_tasks_not_rows(spark):
    assert regression._chunk_rows(500, 10_000, 200) == 500 and regression._chunk_rows(500, 6_480_000, 200) == 8_100
    assert regression._chunk_rows(500, 10**9, 200) == regression.CHUNK_ROWS and regression._chunk_rows(30_000, 10**9, 200) == 30_000
    stats, ld = _chain(spark, 640)
    made = regression.snp_vectors(stats, ld, ld, 2, chunk_rows=1)
    assert made.table.select("chunk").distinct().count() == regression.CHUNKS_PER_TASK * 4 and made.table.count() == 640


def test_estimates_do_not_depend_on_chunks_and_steps(spark, monkeypatch):
    stats, ld = _chain(spark, 640)
    found = []
    for chunk_rows, cells in ((40, 50), (640, 10**6)):
        monkeypatch.setattr(regression, "CELLS_PER_STEP", cells)
        found.append(regression.pair_regressions(regression.snp_vectors(stats, ld, ld, 2, chunk_rows=chunk_rows), 640.0, n_blocks=20).orderBy("i", "j").toPandas())
    numbers = [c for c in found[0].select_dtypes("number").columns if c not in ("z", "p")]  # of a pair of one trait, a quotient of rounding errors
    assert len(found[0]) == 3 and (found[0].snps == 640).all()
    np.testing.assert_allclose(found[0][numbers].astype(float), found[1][numbers].astype(float), rtol=1e-6, atol=1e-6)
