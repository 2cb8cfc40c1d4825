"""File and table sources. ``stream=True`` gives the unbounded form of the same scan.

A micro-batch of a stream is bounded by ``max_files`` or by ``max_bytes``, whichever is given. The
bound belongs to the reader and does not depend on how much there is to read: twice the input
makes twice the batches. A file is never split between batches, so one that is larger than
``max_bytes`` makes a batch of its own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from millrace.schemas import INVOICE, SENTENCE_SEPARATOR
from millrace.session import run_dir


def reader(
    spark: SparkSession,
    stream: bool = False,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrameReader | DataStreamReader:
    """Batch or stream reader; a batch reads all there is, whatever the bounds."""
    if max_files is not None and max_bytes is not None:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    if not stream:
        return spark.read
    source = spark.readStream
    if max_files is not None:
        source = source.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        source = source.option("maxBytesPerTrigger", max_bytes)
    return source


def sentences(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    separator: str = SENTENCE_SEPARATOR,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Text files cut at ``separator``, one ``value`` row per piece."""
    source = reader(spark, stream, max_files, max_bytes).option("lineSep", separator)
    return source.format("text").load(path).select("value")


def invoices(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    schema: T.StructType | str = INVOICE,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """JSON-lines invoices under a fixed schema; no inference pass over the data."""
    return reader(spark, stream, max_files, max_bytes).schema(schema).json(path)


def json_inferred(spark: SparkSession, path: str, sampling: float = 1.0) -> DataFrame:
    """JSON lines with the schema found in the data, from one read and one parse of the files.

    The lines are parsed to variants, which are kept in the shared folder; the schema is an
    aggregate over the variants (over a share of them, if ``sampling`` is below 1), and the columns
    are taken out of them. Numbers with a fraction become doubles, fields that are only ever null
    strings, and fields of several types strings that hold their JSON. A line that is no JSON
    object has nulls in all columns.
    """
    parsed = spark.read.option("singleVariantColumn", "line").json(path)
    stored = run_dir(spark, "variants")
    parsed.write.parquet(stored)
    lines = spark.read.parquet(stored)
    objects = lines.where(F.schema_of_variant("line").startswith("OBJECT"))
    seen = objects.sample(fraction=sampling, seed=0) if sampling < 1 else objects
    found = seen.agg(F.schema_of_variant_agg("line")).first()[0]
    if found is None or not found.startswith("OBJECT<"):
        return lines.select()
    schema = T.StructType.fromDDL(variant_ddl(found)[len("STRUCT<") : -1])
    return lines.select(*[variant_field(field) for field in schema])


def variant_ddl(found: str) -> str:
    """The DDL of a schema as ``schema_of_variant_agg`` writes it, with the types of inference."""
    # Types are followed by a comma, a bracket or the end; names are followed by a colon.
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", found)
    ddl = re.sub(r"\bDECIMAL\(\d+,\s*[1-9]\d*\)", "DOUBLE", ddl)
    ddl = re.sub(r"\bFLOAT(?=[,>]|$)", "DOUBLE", ddl)
    return re.sub(r"\b(OBJECT|VOID|VARIANT)(?=[,>]|$)", "STRING", ddl)


def variant_field(field: T.StructField) -> Column:
    """A field of the variant ``line`` as a column; a value of another type gives null."""
    if "'" in field.name and '"' in field.name:  # no path can quote it
        value = F.col("line").try_cast("map<string,variant>")[field.name]
    else:
        quote = '"' if "'" in field.name else "'"
        value = F.try_variant_get("line", f"$[{quote}{field.name}{quote}]", "variant")
    return value.try_cast(field.dataType).alias(field.name)


def csv_rows(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header line; without a schema every column is a string."""
    source = spark.read.option("header", True)
    return (source.schema(schema) if schema else source).csv(path)


def table(
    spark: SparkSession,
    name: str,
    stream: bool = False,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Catalog table, whole or as a stream of the rows added to it."""
    return reader(spark, stream, max_files, max_bytes).table(name)


def with_input_file(df: DataFrame, name: str = "InputFile") -> DataFrame:
    """Add the path of the file each row was read from; ``df`` must be a file scan."""
    return df.withColumn(name, F.col("_metadata.file_path"))
