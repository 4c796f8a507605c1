"""Table scans and sinks on Parquet and JSON."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.functions.numbers import finite_frame
from tidemark.session import scratch_path
from tidemark.sources.files import drop_path, path_exists, read_small, write_small


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_table_if_exists(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet") -> DataFrame:
    """The table, or no rows of the declared schema when it is missing or empty."""
    if path_exists(spark, path):
        return spark.read.schema(schema).format(kind).load(path)
    return spark.createDataFrame([], schema)


def scan_merged(spark: SparkSession, path: str) -> DataFrame:
    """Scan a table whose appended batches differ in columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_sink(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_sink(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace table and schema."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_merge_schema(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both frames; a column only one of them has is null in the other's rows."""
    return left.unionByName(right, allowMissingColumns=True)


class SchemaConflictError(ValueError):
    pass


_SCHEMA_LOCK = threading.Lock()


class EvolvingTable:
    """A table of appended batches whose columns may differ.

    The columns seen so far stand in a small document beside the batches, so neither a write nor a read opens the
    footers of older files. A column keeps its first type: a batch that disagrees is refused before it is written.
    Each batch has a folder of its own, so a replayed batch replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def schema(self) -> T.StructType:
        text = read_small(self.spark, f"{self.path}/_schema.json")
        return T.StructType([]) if text is None else T.StructType.fromJson(json.loads(text))

    def append(self, batch: DataFrame, name: str) -> None:
        with _SCHEMA_LOCK:  # streams that run side by side share a table
            self._widen(batch)
        batch.write.mode("overwrite").parquet(f"{self.path}/batch={name}")

    def _widen(self, batch: DataFrame) -> None:
        seen = self.schema()
        types = {f.name.lower(): f.dataType for f in seen}
        wrong = [f for f in batch.schema if types.get(f.name.lower(), f.dataType) != f.dataType]
        if wrong:
            raise SchemaConflictError(
                "; ".join(f"{f.name} is {types[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}" for f in wrong)
            )
        fresh = [T.StructField(f.name, f.dataType) for f in batch.schema if f.name.lower() not in types]
        if fresh:  # before the rows: a column without rows does no harm
            write_small(self.spark, f"{self.path}/_schema.json", json.dumps(T.StructType([*seen.fields, *fresh]).jsonValue()))

    def read(self) -> DataFrame:
        """Rows of every batch; a column that a batch did not have is null in its rows."""
        schema = self.schema()
        if not schema.fields:
            return self.spark.createDataFrame([], T.StructType([T.StructField("batch", T.StringType())]))
        with_batch = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
        return scan_table_if_exists(self.spark, self.path, with_batch)


def literal_relation(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A relation of literal rows, planned as a local relation so its exact size is known."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays(
        [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow)], schema=arrow
    )
    return spark.createDataFrame(table, schema=schema)


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """``view``: a lazy temp view. ``table``: store at ``path`` and view the stored rows."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind == "table":
        overwrite_sink(df, path)
        stored = spark.read.schema(df.schema).parquet(path)
        stored.createOrReplaceTempView(name)
        return stored
    raise ValueError(f"unknown kind {kind!r}")


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder and read back, dropped at the end.

    For frames used by several jobs: the stored rows outlive any executor, are
    read column by column, and their size is known to the planner.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_path(spark, path)


def snapshot_frame(df: DataFrame) -> DataFrame:
    """Export shape: dates as ISO strings, no NaN or infinity."""
    finite = finite_frame(df)
    return finite.select(
        [
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
            else F.col(f"`{f.name}`")
            for f in finite.schema.fields
        ]
    )


def export_snapshot_json(df: DataFrame, path: str, order_by: Sequence[str | Column]) -> None:
    """Ordered JSON records, nulls written out.

    The global sort range-partitions, so part files are in order and a large
    export still writes in parallel; AQE merges a small one into a single file.
    """
    snapshot_frame(df.orderBy(*order_by)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_prior_snapshot(
    spark: SparkSession, candidates: Sequence[str], schema: T.StructType, required: str
) -> DataFrame:
    """Rows of the first candidate that exists and holds ``required``; else no rows."""
    for path in candidates:
        if not path_exists(spark, path):
            continue
        try:
            df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).filter(F.col(required).isNotNull())
            if not df.isEmpty():
                return df
        except AnalysisException:
            continue
    return spark.createDataFrame([], schema)
