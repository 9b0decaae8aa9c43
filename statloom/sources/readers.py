"""Sources: nested JSON families, CSV and Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.coerce import quoted


def read_json_family(
    spark: SparkSession,
    folder: str,
    prefix: str,
    schema: T.StructType | str | None = None,
    lines: bool = False,
    suffix: str = ".json",
) -> DataFrame:
    """All JSON files of a folder whose name starts with ``prefix``, one row per record.

    A file holds one array (or one object); Spark reads such a file in one task,
    so big inputs should be JSON lines (``lines=True``), which split. Without a
    schema the columns are the union over the files, missing ones null. Objects
    are flattened one level; see :func:`flatten_objects`.
    """
    reader = spark.read.option("multiLine", not lines).option("encoding", "UTF-8")
    if schema is not None:
        reader = reader.schema(schema)
    return flatten_objects(reader.json(f"{folder.rstrip('/')}/{prefix}*{suffix}"))


def flatten_objects(df: DataFrame, separator: str = ".") -> DataFrame:
    """Replace each top-level struct by one column per child, named parent.child."""
    selected = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            selected += [
                F.col(f"{quoted(field.name)}.{quoted(child)}").alias(
                    f"{field.name}{separator}{child}"
                )
                for child in field.dataType.names
            ]
        else:
            selected.append(F.col(quoted(field.name)))
    return df.select(*selected)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack tables by column name; a column missing from one becomes null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header line. Give a schema at scale: inferring costs one more scan."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
