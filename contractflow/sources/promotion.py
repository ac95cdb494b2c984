"""Schemas that change type: the least common type of stored and new columns, and unknown fields that become columns.

A table keeps the types it was made with, and a load of another type raises. Where the change loses nothing, the rows
of both generations can be read under the least common schema, or rewritten once into a table that has it. A
field that older rows hold in their map of unknown fields is lifted out of it, as far as its text fits the new type.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.operators.routing import DRIFT
from contractflow.plans import ContractError
from contractflow.sources.tables import BUCKET, LOAD_ID, append, stored_dates, table_ddl

WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def least_common(one: T.DataType, two: T.DataType, where: str = "") -> T.DataType:
    """The narrowest type that holds every value of both, exactly; ContractError where there is none.

    Whole numbers widen to the longer, float to double, and whole numbers to double as long as it holds them all (so not
    long). Dates become timestamps. Structs get the fields of both, arrays and maps the common types of their parts.
    """
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if one in WHOLE and two in WHOLE:
        return max(one, two, key=WHOLE.index)
    if {type(one), type(two)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for whole, real in ((one, two), (two, one)):
        if whole in WHOLE[:3] and isinstance(real, (T.FloatType, T.DoubleType)):
            return T.FloatType() if whole in WHOLE[:2] and isinstance(real, T.FloatType) else T.DoubleType()
        if isinstance(whole, T.DateType) and isinstance(real, (T.TimestampType, T.TimestampNTZType)):
            return real
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        return common_schema([one, two], f"{where}.")
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(least_common(one.elementType, two.elementType, f"{where}[]"))
    if isinstance(one, T.MapType) and isinstance(two, T.MapType):
        return T.MapType(least_common(one.keyType, two.keyType, f"{where}{{}}"), least_common(one.valueType, two.valueType, f"{where}{{}}"))
    raise ContractError(f"column {where!r} is {one.simpleString()} in one schema and {two.simpleString()} in the other: no type holds both")


def common_schema(schemas: Sequence[T.StructType], where: str = "") -> T.StructType:
    """The columns of all schemas, first come first, in their least common types; names match in any case."""
    out: dict[str, T.StructField] = {}
    for f in (f for schema in schemas for f in schema):
        known = out.get(f.name.lower())
        kind = f.dataType if known is None else least_common(known.dataType, f.dataType, f"{where}{f.name}")
        out[f.name.lower()] = T.StructField(f.name if known is None else known.name, kind)
    return T.StructType(list(out.values()))


def fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in a wider type; structs are put together field by field, missing ones are null."""
    if have == want:
        return value
    if isinstance(want, T.StructType):
        known = {f.name.lower(): f for f in have}
        parts = []
        for f in want:
            mine = known.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if mine is None else fitted(value.getField(mine.name), mine.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, have.elementType, want.elementType))
    return value.cast(want)


def promoted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df under a wider schema. A column that it lacks is looked for in its map of unknown fields, by name, where
    a text that does not fit gives null and stays in the map; what was lifted leaves the map."""
    known = {f.name.lower(): f for f in df.schema}
    drift = known.get(DRIFT) if isinstance(getattr(known.get(DRIFT), "dataType", None), T.MapType) else None
    out, lifted = [], {}
    for f in schema:
        mine = known.get(f.name.lower())
        if mine is not None:
            continue
        if drift is not None and isinstance(f.dataType, T.AtomicType):
            lifted[f.name] = F.try_element_at(F.col(DRIFT), F.lit(f.name)).try_cast(f.dataType)
    for f in schema:
        mine = known.get(f.name.lower())
        if mine is None:
            out.append(lifted.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name))
        elif mine is drift and lifted:
            gone = F.filter(F.array(*[F.when(value.isNotNull(), F.lit(name)) for name, value in lifted.items()]), lambda x: x.isNotNull())
            left = F.map_filter(F.col(DRIFT), lambda k, _: ~F.array_contains(gone, k))
            out.append(F.when(F.size(left) > 0, left).alias(f.name))
        else:
            out.append(fitted(F.col(f"`{mine.name}`"), mine.dataType, f.dataType).alias(f.name))
    return df.select(*out)


def union_promoted(generations: Sequence[DataFrame]) -> DataFrame:
    """The rows of tables of several generations under their common schema."""
    schema = common_schema([g.schema for g in generations])
    return reduce(DataFrame.unionByName, [promoted(g, schema) for g in generations])


def rewrite_promoted(spark: SparkSession, tables: Sequence[str], into: str, partitioning: Sequence[str] = (), provider: str = "parquet") -> T.StructType:
    """Create the table ``into`` under the common schema of ``tables`` and load it with their rows, once; returns the schema.

    The tables themselves stay as they are. Columns of the layout (load ids, buckets, derived dates) are made anew.
    """
    frames = []
    for name in tables:
        rows = spark.table(name)
        derived = {LOAD_ID, BUCKET, *[n for n, _ in stored_dates(rows.schema, partitioning, provider)]}
        frames.append(rows.drop(*derived))
    whole = union_promoted(frames)
    spark.sql(table_ddl(into, whole.schema, partitioning, provider))
    append(whole, into, partitioning, provider)
    return whole.schema
