"""The current state of a table, kept up batch by batch.

    <path>/data/v=<version>/bucket=<n>    rows of a bucket of keys, deleted ones among them
    <path>/pointers/v=<version>           which folder each bucket is in, and the last TRUNCATE; `_COMMITTED` is written last

A batch reads and rewrites the buckets that its keys fall into and no other. Readers follow the last committed pointer,
so a batch that dies on the way has changed nothing, and one that is repeated writes the same folders again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.functions.types import SPARK_TYPES, Field
from changelake.operators.state import EVENT_COLUMNS, PLACE, after_truncate, current_state, place
from changelake.session import shared_folder, small_frame
from changelake.sinks import folders

POINTER_SCHEMA = "bucket int, version bigint, position bigint, seq bigint"
KEPT_VERSIONS = 3
EVENT_TYPES = {
    "_stream": "string", "_seq": "bigint", "_position": "bigint", "_op": "string", "_key": "array<string>", "_from": "array<string>",
    "_unchanged": "array<string>", "_since": f"map<string,{PLACE}>",
}


class CurrentTable:
    """One table's state. `buckets` is fixed when the state begins: so many that a bucket is a few GB at most; one job at a time applies batches."""

    def __init__(self, path: str, fields: list[Field], buckets: int = 64):
        self.path, self.fields, self.buckets = path.rstrip("/"), fields, buckets
        types = EVENT_TYPES | {f.name: SPARK_TYPES[f.type] for f in fields}
        self.schema = T.StructType([T.StructField(n, t if isinstance(t, T.DataType) else T.DataType.fromDDL(t)) for n, t in types.items()])

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _versions(self, spark: SparkSession) -> list[int]:
        found = folders.numbered(spark, f"{self.path}/pointers", "v=")
        return [v for v in found if folders.exists(spark, f"{self.path}/pointers/v={v}/_COMMITTED")]

    def version(self, spark: SparkSession) -> int:
        """The last batch applied, counted from 0; -1 before the first."""
        return self._pointer(spark)[0]

    def _pointer(self, spark: SparkSession) -> tuple[int, dict[int, int], tuple[int, int] | None]:
        """Current version, the version that each bucket was last written in, and the place of the last TRUNCATE."""
        versions = self._versions(spark)
        if not versions:
            return -1, {}, None
        rows = spark.read.schema(POINTER_SCHEMA).parquet(f"{self.path}/pointers/v={versions[-1]}").collect()
        at = next(((r.position, r.seq) for r in rows if r.bucket == -1 and r.seq is not None), None)
        return versions[-1], {r.bucket: r.version for r in rows if r.bucket >= 0}, at

    def _rows(self, spark: SparkSession, pointer: dict[int, int]) -> DataFrame:
        paths = [f"{self.path}/data/v={v}/bucket={b}" for b, v in sorted(pointer.items())]
        if not paths:
            return small_frame(spark, [], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def apply(self, events: DataFrame) -> int:
        """Apply a batch of events (see `operators.state`), in any order of batches; returns the new version.

        An event older than what its key has already seen changes nothing but columns not known since. Only a change of key that leaves values unchanged takes what is
        known by then.
        """
        spark = events.sparkSession
        version, pointer, truncated = self._pointer(spark)
        version += 1
        batch = shared_folder(spark, "state-batch")
        events.select(*EVENT_COLUMNS, *[f"`{f.name}`" for f in self.fields]).write.parquet(batch)
        events = spark.read.schema(self.schema).parquet(batch)
        keys = events.select(F.explode(F.array_compact(F.array("_key", "_from"))).alias("k"))
        touched = [r.b for r in keys.select(self._bucket("k").alias("b")).distinct().collect()]
        last = events.filter(F.col("_op") == "T").agg(F.max(place()).alias("at")).first().at
        truncated = max((t for t in (truncated, last and tuple(last)) if t is not None), default=None)
        known = self._rows(spark, {b: pointer[b] for b in touched if b in pointer})
        state = current_state(known.unionByName(events), self.fields, self._place(truncated), keep_deleted=True)
        out = state.withColumn("bucket", self._bucket("_key")).hint("rebalance", "bucket")
        data = f"{self.path}/data/v={version}"
        out.write.mode("overwrite").partitionBy("bucket").parquet(data)
        written = folders.numbered(spark, data, "bucket=")
        pointer = {b: v for b, v in pointer.items() if b not in touched} | {b: version for b in written}
        self._swap(spark, version, pointer, truncated)
        folders.remove(spark, batch)
        return version

    def _place(self, at: tuple[int, int] | None) -> Column | None:
        return None if at is None else F.struct(F.lit(at[0]).cast("bigint").alias("position"), F.lit(at[1]).cast("bigint").alias("seq"))

    def _swap(self, spark: SparkSession, version: int, pointer: dict[int, int], truncated: tuple[int, int] | None) -> None:
        at = f"{self.path}/pointers/v={version}"
        rows = [(b, v, None, None) for b, v in sorted(pointer.items())] + [(-1, version, *(truncated or (None, None)))]
        small_frame(spark, rows, POINTER_SCHEMA).coalesce(1).write.mode("overwrite").parquet(at)
        folders.touch(spark, f"{at}/_COMMITTED")
        self._retire(spark)

    def _retire(self, spark: SparkSession) -> None:
        """Drop pointers that are long replaced, and the data that no kept pointer leads to."""
        versions = self._versions(spark)
        kept = versions[-KEPT_VERSIONS:]
        needed = {v for k in kept for v in self._needed(spark, k)}
        for v in versions[:-KEPT_VERSIONS]:
            folders.remove(spark, f"{self.path}/pointers/v={v}")
        for v in folders.numbered(spark, f"{self.path}/data", "v="):
            if v <= kept[-1] and v not in needed:
                folders.remove(spark, f"{self.path}/data/v={v}")

    def _needed(self, spark: SparkSession, version: int) -> set[int]:
        rows = spark.read.schema(POINTER_SCHEMA).parquet(f"{self.path}/pointers/v={version}").filter("bucket >= 0").select("version").distinct()
        return {r.version for r in rows.collect()}

    def events(self, spark: SparkSession) -> DataFrame:
        """All kept rows as events, deleted keys as D; truncated ones are left out."""
        _, pointer, truncated = self._pointer(spark)
        return after_truncate(self._rows(spark, pointer), self._place(truncated))

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as it is: its columns, `_cdc_position` (the place of a row's last change; null for one as loaded) and nothing of deleted rows."""
        rows = self.events(spark).filter(F.col("_op") != "D")
        position = F.when(F.col("_seq") < F.lit((1 << 63) - 1), F.col("_seq"))
        return rows.select(*[f"`{f.name}`" for f in self.fields], position.alias("_cdc_position"))

    def forget_deleted(self, spark: SparkSession, before: int) -> int:
        """Drop deleted keys whose deletion was committed before a position: no older event is expected any more. Rewrites all buckets."""
        version, pointer, truncated = self._pointer(spark)
        version += 1
        rows = self.events(spark).filter((F.col("_op") != "D") | (F.col("_position") >= before))
        data = f"{self.path}/data/v={version}"
        rows.withColumn("bucket", self._bucket("_key")).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
        self._swap(spark, version, {b: version for b in folders.numbered(spark, data, "bucket=")}, truncated)
        return version
