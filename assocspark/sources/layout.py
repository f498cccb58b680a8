"""Tables stored by key: bucketed and sorted, so that later joins and groupings on the key move no rows of them."""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_folder


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store_by(df: DataFrame, keys: Sequence[str], *, order: Sequence[str] = (), buckets: int | None = None, name: str | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` files hashed by ``keys``, each sorted by keys and ``order``, in the shared folder.

    Tables that are to meet must have equal keys and numbers of buckets. Rows are dealt by the same hash before they are written, so a bucket is one file.
    A key that holds most rows makes one large bucket: store by keys that split it.
    """
    spark = df.sparkSession
    buckets = buckets or default_buckets(spark)
    name = name or f"stored_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *order)
       .option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name))
    return spark.table(name)


def forget(df_name: str, spark: SparkSession) -> None:
    """Drop a stored table's entry; its files stay in the shared folder until that is cleared."""
    spark.sql(f"DROP TABLE IF EXISTS `{df_name}`")
