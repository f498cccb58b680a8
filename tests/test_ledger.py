"""Stages are reused for equal inputs and parameters only, and a stage without a record is made again."""
import pytest
from pyspark.sql import functions as F

from assocspark.plans.ledger import StageLedger, digest_of


def test_reuse_and_change(spark, tmp_path):
    made = []

    def run(rows, factor=2):
        ledger = StageLedger(spark, str(tmp_path / "stages"))
        first = ledger.stage("double", {"rows": rows}, {"factor": factor}, lambda: made.append("double") or rows.select((F.col("id") * factor).alias("x")))
        second = ledger.stage("count", {"doubled": first}, {}, lambda: made.append("count") or first.table.agg(F.count("*").alias("n"), F.sum("x").alias("s")))
        return first.reused, second.reused, tuple(second.table.first())

    rows = spark.range(100)
    assert run(rows) == (False, False, (100, 9900))
    assert run(rows.repartition(7)) == (True, True, (100, 9900)) and made == ["double", "count"]
    assert run(rows, factor=3) == (False, False, (100, 14850))
    assert run(spark.range(99)) == (False, False, (99, 9702))
    assert run(rows) == (True, True, (100, 9900))
    ledger = StageLedger(spark, str(tmp_path / "stages"))
    assert ledger.clear_old() == 4 and ledger.clear_old() == 0
    assert run(rows) == (False, False, (100, 9900))


def test_a_failed_stage_leaves_no_record(spark, tmp_path):
    ledger = StageLedger(spark, str(tmp_path / "s"))
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("int").alias("x"))
    with pytest.raises(Exception, match="lost"):
        ledger.stage("a", {}, {}, lambda: broken)
    assert ledger.records().count() == 0
    assert not ledger.stage("a", {}, {}, lambda: spark.range(3).toDF("x")).reused


def test_digest_follows_contents(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, 1.5), (2, None, 1.5)], "a int, b string, c double")
    same = a.select("c", "a", "b").repartition(3)
    assert digest_of(a) == digest_of(same) and digest_of(a)[1] == 3
    others = [a.distinct(), a.withColumn("b", F.coalesce("b", F.lit(""))), a.withColumn("a", F.col("a").cast("long")), a.withColumnRenamed("a", "z"), a.limit(0)]
    assert len({digest_of(x)[0] for x in [a, *others]}) == 6
