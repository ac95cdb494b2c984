"""Contract type names and the Spark types they stand for."""

from __future__ import annotations

from pyspark.sql import types as T

# The type names a contract may use.
SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "bytes": T.BinaryType(),
}


def spark_type(name: str) -> T.DataType:
    try:
        return SPARK_TYPES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown contract type {name!r}; use one of {sorted(SPARK_TYPES)}") from None
