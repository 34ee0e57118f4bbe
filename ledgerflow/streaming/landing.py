"""Landed payloads into keyed tables, folder by folder, each file once.

``feed`` runs over whatever has landed since its last run and ends; its checkpoint says
what was read. Each batch is an upsert into a ``KeyedTable``, whose rows lie in buckets of
their keys: a batch rewrites the buckets it touches and no others, as a new version. A batch that
is replayed after a failure starts from the versions before it and writes the same again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.upsert import upsert


class KeyedTable:
    """A table with a row a key under ``path``: bucket=B/version=V folders of Parquet, and a marker for each whole version."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = 16):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, list(keys), buckets
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._at = lambda *p: hadoop("/".join([self.path, *p]))
        self._fs = hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, *p: str) -> list[str]:
        at = self._at(*p)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self._names("_whole"))

    def read(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest whole version of each bucket, or of the given ones; with ``before`` only older versions."""
        whole = {v for v in self.versions() if before is None or v < before}
        paths = []
        for name in self._names():
            if name.startswith("bucket=") and (buckets is None or int(name[7:]) in buckets):
                if mine := [v for v in (int(n[8:]) for n in self._names(name) if n.startswith("version=")) if v in whole]:
                    paths.append(f"{self.path}/{name}/version={max(mine)}")
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, version: int, policy: str = "update", rules: dict[str, str] | None = None, ordinal: str = "_ord") -> None:
        """Upsert ``rows`` as ``version``; the same version again gives the same table."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket")
        touched = [r["bucket"] for r in rows.select(bucket).distinct().collect()]  # numbers of buckets, few by choice
        if touched:
            old = self.read(version, touched)
            out = upsert(old, rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema), ordinal), self.keys, policy, rules, ordinal)
            out = out.select(*self.schema.names, bucket, F.lit(version).alias("version")).repartition(self.buckets, "bucket")
            for b in touched:
                self._fs.delete(self._at(f"bucket={b}", f"version={version}"), True)
            out.write.mode("append").partitionBy("bucket", "version").parquet(self.path)
        self._fs.create(self._at("_whole", str(version)), True).close()

    def compact(self, keep: int = 1) -> None:
        """Delete versions of buckets that newer whole ones replace, but for the last ``keep``."""
        whole = set(self.versions())
        for name in self._names():
            if name.startswith("bucket="):
                mine = sorted(v for v in (int(n[8:]) for n in self._names(name) if n.startswith("version=")) if v in whole)
                for v in mine[:-keep]:
                    self._fs.delete(self._at(name, f"version={v}"), True)


def feed(landed: DataFrame, table: KeyedTable, checkpoint: str, parse: Callable[[DataFrame], DataFrame] | None = None, policy: str = "update", rules: dict[str, str] | None = None, ordinal: str = "_ord") -> int:
    """Write all that ``landed``, a stream of payloads, has new into ``table``; the number of batches of this run.

    ``parse`` makes the table's rows with their ordinal from a batch of payloads.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(parse(batch) if parse else batch, batch_id + 1, policy, rules, ordinal)

    run = landed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(1 for p in run.recentProgress if p["numInputRows"])
