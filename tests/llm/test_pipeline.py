import corpus_pipeline
from pyspark.sql import functions as F

from assocspark.llm import text

from .conftest import prose

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def write(spark, docs):
    path = text.work_folder(spark)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, int(d % 10 == 0)) for d in range(100, 200)], "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(900, 30))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_takes_effect(spark):
    rows = [(d, prose(d, 80) + (" idiot scum moron" if d % 10 == 0 else "")) for d in range(100, 200)]
    rows += [(300, prose(101, 80)), (301, prose(301, 30) + " " + prose(103, 60) + " " + prose(302, 30)), (302, prose(303, 20) + " " + prose(900, 30) + " " + prose(304, 20)),
             (303, "v w " + prose(305, 33)), (304, prose(305, 33) + " v w"), (305, None), (306, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}).select(NAMES)
    sf, ids, got = write(spark, docs), {}, {}
    table = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        table = text.stage(stage(spark, table, sf))
        ids[name], got[name] = {r[0] for r in table.select("doc_id").collect()}, table
        if name != "pack":
            assert table.columns == NAMES
    assert {d for d in range(100, 200)} - ids["toxicity"] == set(range(100, 200, 10))
    assert ids["toxicity"] - ids["line_dedup"] == {300}
    cut = got["line_dedup"].where("doc_id = 301").first()
    assert cut["text"].split() == (prose(301, 30) + " " + prose(302, 30)).split() and cut["n_chars"] == len(cut["text"])
    assert ids["line_dedup"] - ids["near_dedup"] == {304}
    assert ids["near_dedup"] - ids["decontaminate"] == {302}
    assert ids["pack"] == ids["decontaminate"] and {305, 306} <= ids["pack"]
    assert corpus_pipeline.run(spark, sf).count() == got["pack"].count()


def test_stages_of_odd_rows(spark, odd, nothing):
    for docs, left in ((odd, 9), (nothing, 0)):
        sf = write(spark, docs.select(NAMES))
        table = spark.read.parquet(f"{sf}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            table = text.stage(stage(spark, table, sf))
        assert table.select("doc_id").distinct().count() == (left + 1 if left else 0)  # 1, 2, 3, 4, 7 to 11 and null
