"""A stored collection of points: upserts append, the newest row of an id wins at read, buckets are compacted on their own.

Layout under one folder: `points/bucket=<b>/batch=<n>/part=<subject>` holds rows, `keys/bucket=<b>/batch=<n>` their ids alone,
`state` which (bucket, batch) pairs are live. An upsert writes one batch and appends one state; a batch whose state was not
written doesn't exist, so a repeated or broken job leaves nothing behind that a reader sees. A read scans the live folders,
pruned by subject, and drops rows whose id stands in the keys of a later batch of their bucket: those keys are narrow and only
of batches after the bucket's first, so a compacted collection is read without a join. One writer at a time.
"""

from __future__ import annotations

import json
import secrets
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 8
SLOT = "__slot"
STATE = "version long, bucket int, batch long, rows long, schema string"


def part_of(subject: Column) -> Column:
    """Folder name of a subject; null and empty text stay apart."""
    return F.when(subject.isNull(), F.lit("none")).otherwise(F.concat(F.lit("s-"), subject))


@dataclass
class Collection:
    spark: SparkSession
    path: str
    key: str = "point_id"
    buckets: int = BUCKETS

    def state(self) -> tuple[int, dict[int, dict[int, int]], T.StructType | None]:
        """(version, rows per live batch of each bucket, columns): one small row per live (bucket, batch)."""
        try:
            rows = self.spark.read.schema(STATE).parquet(f"{self.path}/state")
            version = rows.agg(F.max("version")).first()[0]
        except AnalysisException:
            version = None
        if version is None:
            return 0, {}, None
        live: dict[int, dict[int, int]] = {}
        schema = None
        for r in rows.where(F.col("version") == version).collect():
            live.setdefault(r["bucket"], {})[r["batch"]] = r["rows"]
            schema = r["schema"] or schema
        return version, live, T.StructType.fromJson(json.loads(schema))

    def _record(self, version: int, live: dict[int, dict[int, int]], schema: T.StructType) -> None:
        rows = [(version, b, n, count, schema.json()) for b, batches in live.items() for n, count in batches.items()]
        self.spark.createDataFrame(rows, STATE).coalesce(1).write.mode("append").parquet(f"{self.path}/state")

    def _write(self, rows: DataFrame, batch: int, one_per_id: Callable[[DataFrame, list[str]], DataFrame] | None = None) -> dict[int, int]:
        """Write a batch; rows per bucket. A bucket goes to as many tasks as there are shuffle partitions for it, so a batch adds few files.

        Rows are shuffled once: those of one id meet in one task, where `one_per_id(rows, columns that tell ids apart)` picks among them.
        """
        slots = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        slot = F.pmod(F.xxhash64(F.lit("slot"), F.col(self.key).cast("string")), F.lit(slots)).cast("int")
        dealt = rows.withColumns({"bucket": self._bucket(), SLOT: slot}).repartition("bucket", SLOT)
        if one_per_id is not None:
            dealt = one_per_id(dealt, ["bucket", SLOT, self.key])
        marked = dealt.drop(SLOT).withColumns({"batch": F.lit(batch), "part": part_of(F.col("subject"))})
        marked.write.partitionBy("bucket", "batch", "part").mode("append").option("compression", "zstd").parquet(f"{self.path}/points")
        written = self.spark.read.schema(T.StructType([*marked.schema.fields])).parquet(f"{self.path}/points").where(F.col("batch") == batch)
        written.select(self.key, "bucket", "batch").write.partitionBy("bucket", "batch").mode("append").option("compression", "zstd").parquet(f"{self.path}/keys")
        return {r["bucket"]: r["count"] for r in written.groupBy("bucket").count().collect()}

    @staticmethod
    def _number(version: int) -> int:
        """Ascends with the version; what a broken job left under the same version has another number."""
        return version * 1_000_000 + secrets.randbelow(1_000_000)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def upsert(self, new: DataFrame, order: str | None = None) -> int:
        """Append the rows as one batch and return its version; of several rows with one id the last by `order` stays."""
        version, live, schema = self.state()
        if schema is None:
            schema = new.drop(order).schema if order else new.schema
        new = new.select(*schema.names, *([order] if order and order not in schema.names else []))

        def last(rows: DataFrame, ids: list[str]) -> DataFrame:
            if order is None:
                return rows.dropDuplicates(ids)
            place = F.row_number().over(Window.partitionBy(*ids).orderBy(F.col(order).desc()))
            rows = rows.withColumn("__last", place).where(F.col("__last") == 1).drop("__last")
            return rows if order in schema.names else rows.drop(order)

        batch = self._number(version + 1)
        counts = self._write(new, batch, last)
        for bucket, n in counts.items():
            live.setdefault(bucket, {})[batch] = n
        if live:
            self._record(version + 1, live, schema)
        return version + 1

    def _folders(self, kind: str, live: dict[int, dict[int, int]], later: bool = False) -> list[str]:
        return [f"{self.path}/{kind}/bucket={b}/batch={n}" for b, batches in live.items() for n in batches if not later or n > min(batches)]

    def _rows(self, live: dict[int, dict[int, int]], schema: T.StructType) -> DataFrame:
        """Rows of the live folders, superseded ones too, with their folder names."""
        inner = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType()), T.StructField("part", T.StringType())])
        return self.spark.read.option("basePath", f"{self.path}/points").schema(inner).parquet(*self._folders("points", live))

    def read(self, subject: str | None = None, among: DataFrame | None = None) -> DataFrame:
        """Live rows: all, of one subject (folders of others aren't listed), or of the subjects of a table `among`.

        `among` is joined on the folder name, so the scan is pruned by its values when the query runs.
        """
        _, live, schema = self.state()
        if schema is None:
            raise ValueError(f"no collection in {self.path}")
        rows = self._rows(live, schema)
        if subject is not None:
            rows = rows.where(F.col("part") == part_of(F.lit(subject)))
        if among is not None:
            rows = rows.join(F.broadcast(among.select(part_of(F.col("subject")).alias("part")).distinct()), "part", "left_semi")
        later = self._folders("keys", live, later=True)
        if later:
            fields = [schema[self.key], rows.schema["bucket"], rows.schema["batch"]]
            keys = self.spark.read.option("basePath", f"{self.path}/keys").schema(T.StructType(fields)).parquet(*later)
            newest = keys.groupBy("bucket", self.key).agg(F.max("batch").alias("newest"))
            old, top = rows.alias("old"), newest.alias("top")
            same = (F.col(f"old.{self.key}") == F.col(f"top.{self.key}")) & (F.col("old.bucket") == F.col("top.bucket"))
            rows = old.join(top, same & (F.col("top.newest") > F.col("old.batch")), "left_anti")
        return rows.select(*schema.names)

    def compact(self, share: float = 0.2) -> list[int]:
        """Rewrite the buckets whose later batches hold more than `share` of their rows; returns them. Other buckets keep their files."""
        version, live, schema = self.state()
        worn = [b for b, batches in live.items() if sum(batches.values()) - batches[min(batches)] > share * sum(batches.values())]
        if worn:
            batch = self._number(version + 1)

            def newest(rows: DataFrame, ids: list[str]) -> DataFrame:
                # as at read, rows without an id supersede nothing
                place = F.row_number().over(Window.partitionBy(*ids).orderBy(F.col("batch").desc()))
                rows = rows.withColumn("__place", place).where((F.col("__place") == 1) | F.col(self.key).isNull())
                return rows.drop("__place", "batch")

            counts = self._write(self._rows({b: live[b] for b in worn}, schema).drop("part", "bucket"), batch, newest)
            for b in worn:
                live[b] = {batch: counts[b]}
            self._record(version + 1, live, schema)
        return worn
