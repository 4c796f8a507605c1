"""Raw layer: whole-file JSON documents to typed rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.labels import payload_checksum
from tidemark.functions.schemas import struct_of

CORRUPT = "_corrupt_record"


def document_schema(measures: Sequence[str]) -> T.StructType:
    """One JSON document: parallel hourly arrays and a metadata struct.

    Every measure is read as double, so ``1`` and ``1.0`` parse alike; Silver
    casts to the final type.
    """
    hourly = T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()))]
        + [T.StructField(m, T.ArrayType(T.DoubleType())) for m in measures]
    )
    metadata = T.StructType(
        [
            T.StructField(name, T.StringType())
            for name in ("city", "city_name", "target_date", "source", "ingested_at")
        ]
    )
    return T.StructType(
        [
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("timezone", T.StringType()),
            T.StructField("hourly", hourly),
            T.StructField("_metadata", metadata),
        ]
    )


DAY_FOLDER = "target_date="


def _path_parts(path: str | Column) -> Column:
    """Path elements, percent escapes undone (a literal plus sign is kept)."""
    c = F.col(path) if isinstance(path, str) else path
    return F.split(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "/")


def _has_day_folder(parts: Column) -> Column:
    return F.startswith(F.element_at(parts, -2), F.lit(DAY_FOLDER))


def _has_city_and_day(parts: Column) -> Column:
    return _has_day_folder(parts) & F.contains(F.element_at(parts, -3), F.lit("="))


def folder_key(path: str | Column) -> Column:
    """City folder of ``<city>/<file>`` or ``city=<city>/target_date=<day>/<file>``; ``target_date=<day>/<file>`` has none."""
    parts = _path_parts(path)
    named = F.when(_has_city_and_day(parts), F.element_at(parts, -3))
    folder = named.when(~_has_day_folder(parts), F.element_at(parts, -2))
    return F.regexp_replace(folder, "^[^=]+=", "")


def relative_file(path: str | Column) -> Column:
    """File name from the stream's folder on."""
    parts = _path_parts(path)
    tail = F.when(_has_city_and_day(parts), F.slice(parts, -4, 4)).otherwise(F.slice(parts, -3, 3))
    return F.concat_ws("/", tail)


def default_key_from_path(metadata_key: str | Column, path: str | Column) -> Column:
    """Key named in the document, else the name of the file's city folder."""
    key = F.col(metadata_key) if isinstance(metadata_key, str) else metadata_key
    return F.coalesce(key, folder_key(path))


def parse_documents(files: DataFrame, schema: T.StructType) -> DataFrame:
    """``(path, payload)`` to ``(path, payload, doc, is_malformed)``.

    A payload that is no JSON object, that goes on after it, or whose fields do
    not fit the schema, is marked instead of failing the batch. Spark's parser
    stops after the first value, so the payload is read as the only field of an
    object, which shows most tails, and counted as the only item of an array,
    which shows one that begins with a closing brace.

    Both columns come out of a generator: a filter on one would otherwise be pushed below and parse the text again
    for each mention of it.
    """
    only = T.StructType([T.StructField("x", schema), T.StructField(CORRUPT, T.StringType())])
    whole = F.concat(F.lit('{"x":'), F.col("payload"), F.lit("}"))
    items = F.json_array_length(F.concat(F.lit("["), F.col("payload"), F.lit("]")))

    def judged(parsed: Column) -> Column:
        bad = (
            parsed["x"].isNull()
            | parsed[CORRUPT].isNotNull()
            | ~F.startswith(F.ltrim(F.col("payload")), F.lit("{"))
            | (F.coalesce(items, F.lit(0)) != 1)
        )
        return F.struct(parsed["x"].alias("doc"), F.coalesce(bad, F.lit(True)).alias("is_malformed"))

    parsed = F.array(F.from_json(whole, only, {"columnNameOfCorruptRecord": CORRUPT}))
    return files.select(*files.columns, F.inline(F.transform(parsed, judged)))


def whole_files(reader, root: str, file_glob: str) -> DataFrame:
    """``(path, payload)`` of every file below ``root``; works for batch and stream readers.

    Folders are listed in parallel by Spark instead of expanding a glob on the
    driver, and a ``key=value`` folder name is no column.
    """
    files = (
        reader.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_glob)
        .load(root)
    )
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


#: A landed line: the document's key and its text as it came.
ENVELOPE = struct_of({"city": "string", "target_date": "string", "payload": "string"})


def _enveloped_lines(reader, root: str, file_glob: str, envelope: T.StructType) -> DataFrame:
    """``(path, value, e)`` of every line that is not blank, ``e`` what the line holds of the envelope, parsed once."""
    lines = (
        reader.format("text").option("recursiveFileLookup", "true").option("pathGlobFilter", file_glob).load(root)
    ).filter(F.trim("value") != "")
    named = lines.select(F.col("_metadata.file_path").alias("path"), "value")
    return named.select("path", "value", F.explode(F.array(F.from_json("value", envelope))).alias("e"))


def document_lines(reader, root: str, file_glob: str) -> DataFrame:
    """``(path, payload, city, target_date)`` of every line of the files below ``root``; works for batch and stream readers.

    A file holds any number of documents, so tasks split the input by bytes. A line is a document, or an envelope that
    holds one with its key; blank lines are none.
    """
    return _enveloped_lines(reader, root, file_glob, ENVELOPE).select(
        "path", F.coalesce("e.payload", "value").alias("payload"), "e.city", F.col("e.target_date").try_cast("date").alias("target_date")
    )


def enveloped() -> Column:
    """The line of a ``(city, target_date, payload)`` document, whatever line breaks the payload holds."""
    return F.to_json(F.struct("city", F.col("target_date").cast("string").alias("target_date"), "payload"))


#: A file packed with others: its percent-escaped name from the stream's folder on, and its text as it came.
PACKED = struct_of({"path": "string", "payload": "string"})


def packed_files(reader, root: str, file_glob: str) -> DataFrame:
    """``(path, payload)`` of whole files that were packed as lines of a few files; works for batch and stream readers.

    Opening a file costs more than parsing the document in it, so many small ones are kept this way. A line that
    holds no packed file is a document by itself.
    """
    lines = _enveloped_lines(reader, root, file_glob, PACKED)
    return lines.select(F.coalesce("e.path", "path").alias("path"), F.coalesce("e.payload", "value").alias("payload"))


def packed() -> Column:
    """The line of a ``(path, payload)`` file, whatever line breaks the payload holds."""
    return F.to_json(F.struct("path", "payload"))


def file_day(path: str | Column) -> Column:
    """Day named by a file or its folder, if any."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})[^/]*(/[^/]*)?$", 1).try_cast("date")


def keyed_files(reader, root: str, file_glob: str) -> DataFrame:
    """Whole files in the shape of ``document_lines``: city and day from the path."""
    return whole_files(reader, root, file_glob).select("path", "payload", folder_key("path").alias("city"), file_day("path").alias("target_date"))


def scan_raw_json(
    spark: SparkSession, root: str, schema: T.StructType, file_glob: str = "*.json", layout: str = "files"
) -> DataFrame:
    """Every document below ``root``, parsed: one per file (``files``), per packed file (``packed``) or per line (``lines``)."""
    found = {"files": whole_files, "packed": packed_files, "lines": document_lines}[layout](spark.read, root, file_glob)
    return parse_documents(found, schema)


def tolerate_malformed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good documents, rejected paths with the city that they landed with, if any)."""
    good = docs.filter(~F.col("is_malformed")).drop("is_malformed")
    landed_with = [c for c in ("city",) if c in docs.columns]
    rejects = docs.filter("is_malformed").select("path", payload_checksum("payload").alias("payload_hash"), *landed_with)
    return good, rejects


def stamp_lineage(docs: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """City, relative file name, payload checksum and one ingestion timestamp per run.

    The city is the document's own, else the one it landed with (a ``city`` column), else the folder's.
    """
    stamp = F.to_timestamp(F.lit(str(run_ts))).cast("timestamp_ntz")
    own = F.col("doc._metadata.city")
    key = F.coalesce(own, F.col("city")) if "city" in docs.columns else own
    return docs.withColumns(
        {
            "city": default_key_from_path(key, "path"),
            "source_file": relative_file("path"),
            "payload_hash": payload_checksum("payload"),
            "ingestion_timestamp": stamp,
        }
    )


def explode_parallel_arrays(
    docs: DataFrame,
    hourly: str,
    measures: Sequence[str],
    keep: Sequence[str],
    time_field: str = "time",
    position: str | None = None,
    outer: bool = False,
) -> DataFrame:
    """One row per index of the time array; a shorter measure array gives nulls.

    The arrays are zipped inside the row before the explode, so each output row
    carries its own values only and not a copy of every array. ``outer`` keeps a
    document without any time as one row of nulls.
    """
    arrays = F.col(hourly)

    def element(time: Column, i: Column) -> Column:
        fields = [time.alias(time_field)] + [F.get(arrays.getField(m), i).alias(m) for m in measures]
        if position:
            fields.insert(0, i.alias(position))
        return F.struct(*fields)

    inline = F.inline_outer if outer else F.inline
    return docs.select(*keep, inline(F.transform(arrays.getField(time_field), element)))


def parse_json_column(df: DataFrame, column: str, schema: T.StructType, into: str) -> DataFrame:
    return df.withColumn(into, F.from_json(F.col(column), schema))
