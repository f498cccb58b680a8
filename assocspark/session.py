"""Session settings the operators rely on, and the one way this package cuts lineage."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which every executor reaches; a local master may do without and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's checkpoint folder, so later passes survive lost executors.

    The folder is read from ``spark.checkpoint.dir``. Only a local master may fall back to a folder of
    its own; on a cluster a machine-local path would lose data with its machine, so that is refused.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder: for wide tables that several passes read, as it is compressed and read by column, which ``durable`` is not."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows up to which a lookup of known size is sent to every task.
BROADCAST_ROWS = 100_000


def small(lookup: DataFrame, rows: int) -> DataFrame:
    """``lookup``, to be broadcast if its ``rows`` are few. Spark's own estimate is useless for local lists and aggregates."""
    return F.broadcast(lookup) if rows <= BROADCAST_ROWS else lookup


def counted(lookup: DataFrame) -> DataFrame:
    """``lookup`` (a row a trait, say) stored and counted, so that a large table meets it where it lies and is not dealt by a key of few values."""
    stored = durable(lookup)
    return small(stored, stored.count())


def local_session(cores: int | str = 8, *, app: str = "assocspark", shuffle_partitions: int | None = None,
                  memory: str = "12g") -> SparkSession:
    """Session for tests and the benchmark; cluster jobs bring their own."""
    partitions = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    return (SparkSession.builder.master(f"local[{cores}]").appName(app)
            .config("spark.sql.shuffle.partitions", str(partitions))
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.driver.memory", memory)
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .getOrCreate())
