"""Scratch tables, input cleaning and connected components shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.session import scratch_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: later jobs, and replays after a lost executor, start from these files. The write's own shuffle
    files go as soon as it is done, not when the driver next happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, partitionBy=list(partition_by) or None)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame made by ``stored`` that nothing will read again."""
    folders = {file.rsplit("/llm-", 1)[0] + "/llm-" + file.rsplit("/llm-", 1)[1].split("/")[0] for file in df.inputFiles() if "/llm-" in file}
    jvm = df.sparkSession._jvm
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``id`` (long) and ``text`` (null becomes empty), whatever else the input holds.

    Rows without an id cannot be named in a result and are left out; of rows that share an id the
    operators treat each as a document of its own.
    """
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    ).filter("id IS NOT NULL")


def rows_and_text(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, int | None]:
    """Every row of ``docs`` as struct ``row``, and the place of its text there, so that workers get it once.

    A text of another type is cast into a column ``text`` beside the row, and the place is None.
    """
    text = docs.select(F.col(f"`{text_col}`"))
    row = F.struct("*").alias("row")
    if text_col in docs.columns and isinstance(text.schema[0].dataType, StringType):
        return docs.select(row), docs.columns.index(text_col)
    return docs.select(row, F.col(f"`{text_col}`").cast("string").alias("text")), None


#: Rows of ids up to which a measured table may be broadcast (about 16 MB).
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(ids: DataFrame) -> DataFrame:
    """``ids``, a stored table of one or two numbers a row, marked for broadcast if its measured size allows it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges``: (node, component), component the smallest node.

    Alternates large-star and small-star steps, so the rounds grow with the logarithm of the longest
    path. A hub's neighbours are never gathered: each step is a ``min`` aggregate and a join. Every
    round is written to the shared folder.
    """
    spark = edges.sparkSession
    pairs = stored(
        edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
        .filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    for _ in range(max_rounds):
        if _settled(pairs):
            nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour of u points to the smallest node around u
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: every neighbour that is not larger, and u itself, points to the smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low2, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("p"))
            .select(F.col("p.v").alias("u"), F.col("p.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        pairs = stored(small, "stars")
    raise RuntimeError(f"components did not settle within {max_rounds} rounds")


def _settled(pairs: DataFrame) -> bool:
    """Whether every node points to one smaller node that points nowhere: each component is a star around its smallest."""
    ends = pairs.select(F.col("u").alias("v")).distinct()
    return pairs.groupBy("u").count().filter("count > 1").isEmpty() and pairs.join(ends, "v", "left_semi").isEmpty()
