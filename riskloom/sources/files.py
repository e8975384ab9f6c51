"""CSV inputs with a declared schema, and table metadata as DataFrames."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riskloom.sources.scratch import local_table

# Warehouse type names used by JSON schema files.
SPARK_TYPES = {
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(),
}


def _whole_text(path: str) -> str:
    """A small file by any path that Spark reads; it needs a session."""
    return SparkSession.active().read.text(path, wholetext=True).first().value


def schema_from_json(path: str) -> T.StructType:
    """Read a list of {"name", "type"} objects as a StructType."""
    fields = json.loads(_whole_text(path))
    return T.StructType([T.StructField(f["name"], SPARK_TYPES[f["type"].upper()]) for f in fields])


def schema_from_text(path: str) -> T.StructType:
    """Read the one-line form ``name:TYPE,name:TYPE`` as a StructType."""
    pairs = [item.split(":") for item in _whole_text(path).strip().split(",")]
    return T.StructType([T.StructField(name.strip(), SPARK_TYPES[kind.strip().upper()]) for name, kind in pairs])


def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Load a CSV with one header row. Types are never guessed and a bad row stops the load.

    ``enforceSchema=False`` compares header names with the schema, so a reordered file is
    refused instead of being read into the wrong columns.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def column_table(df: DataFrame, table_name: str) -> DataFrame:
    """Column metadata as rows: table_name, column_name, data_type, position."""
    return local_table(
        df.sparkSession,
        {
            "table_name": pa.array([table_name] * len(df.schema), pa.string()),
            "column_name": pa.array([f.name for f in df.schema], pa.string()),
            "data_type": pa.array([f.dataType.simpleString() for f in df.schema], pa.string()),
            "position": pa.array(list(range(1, len(df.schema) + 1)), pa.int64()),
        },
    )
