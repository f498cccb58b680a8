"""A ledger of finished stages: a rerun with equal inputs and parameters reads what an earlier run wrote, anything else is computed again."""
from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, NumericType, StringType

from ..operators.provenance import table_fingerprint

_RECORD = "at long, name string, key string, path string, rows long, digest string, columns string, cleared boolean"


@dataclass(frozen=True)
class Stage:
    """A stage's table as it is stored, the digest of its contents, and whether an earlier run had made it."""

    table: DataFrame
    digest: str
    rows: int
    reused: bool


def _text(kind: DataType, value: Column) -> Column:
    """One text for each value. Numbers and dates hold none of the digest's signs, texts tell their length; all else is JSON."""
    if isinstance(kind, NumericType | BooleanType | DateType):
        return value.cast("string")
    if isinstance(kind, StringType):
        return F.concat(F.length(value).cast("string"), F.lit(":"), value)
    return F.to_json(F.struct(value.alias("v")))


def digest_of(table: DataFrame) -> tuple[str, int]:
    """Digest of a table's columns and rows, whatever their order, and its number of rows; one pass of partial sums."""
    names = sorted(table.columns)
    texts = table.select([_text(table.schema[c].dataType, F.col(f"`{c}`")).alias(f"c{n}") for n, c in enumerate(names)])
    row = table_fingerprint(texts.withColumn("trait", F.lit("all")), [f"c{n}" for n in range(len(names))]).first()
    described = json.dumps([names, [dict(table.dtypes)[c] for c in names], row["fingerprint"] if row else "", row["rows"] if row else 0])
    return hashlib.sha256(described.encode()).hexdigest(), row["rows"] if row else 0


@dataclass(frozen=True)
class StageLedger:
    """Stages below ``folder``, which every executor and later runs must reach.

    A stage is named by its name, the digests of its inputs and its parameters. Its table is written first and recorded after, so a run that dies in
    between leaves no record and the stage is made again. Records are rows of a small table that is only appended to.
    """

    spark: SparkSession
    folder: str

    def records(self) -> DataFrame:
        """The last record of every stage that was finished."""
        try:
            found = self.spark.read.schema(_RECORD).parquet(f"{self.folder}/ledger")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], _RECORD)
        last = found.groupBy("key").agg(F.max_by(F.struct(*found.columns), F.struct("at", "cleared")).alias("r"))
        return last.select("r.*")

    def _append(self, *values) -> None:
        self.spark.createDataFrame([values], _RECORD).coalesce(1).write.mode("append").parquet(f"{self.folder}/ledger")

    def stage(self, name: str, inputs: Mapping[str, DataFrame | Stage], parameters: Mapping[str, object], build: Callable[[], DataFrame]) -> Stage:
        """The table that ``build`` makes, or the stored one if name, inputs and parameters are those of a finished stage.

        ``inputs`` are tables, read once for their digest, or earlier stages, whose digest is known. ``parameters`` must be plain values.
        """
        digests = {k: x.digest if isinstance(x, Stage) else digest_of(x)[0] for k, x in sorted(inputs.items())}
        key = hashlib.sha256(json.dumps([name, digests, parameters], sort_keys=True).encode()).hexdigest()
        known = self.records()
        done = known.filter((F.col("key") == key) & ~F.col("cleared")).first()
        if done:
            return Stage(self.spark.read.schema(done["columns"]).parquet(done["path"]), done["digest"], done["rows"], True)
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        made = build()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
        made.write.parquet(path)
        table = self.spark.read.schema(columns).parquet(path)
        digest, rows = digest_of(table)
        self._append((known.agg(F.max("at")).first()[0] or 0) + 1, name, key, path, rows, digest, columns, False)
        return Stage(table, digest, rows, False)

    def clear_old(self) -> int:
        """Empty the tables of stages that a later one of their name has replaced; how many there were."""
        live = self.records().filter(~F.col("cleared"))
        newest = live.groupBy("name").agg(F.max("at").alias("newest"))
        old = live.join(newest, "name").filter("at < newest").select(*live.columns).collect()  # a row a stage
        for r in old:
            self.spark.createDataFrame([], r["columns"]).write.mode("overwrite").parquet(r["path"])
            self._append(r["at"], r["name"], r["key"], r["path"], 0, r["digest"], r["columns"], True)
        return len(old)
