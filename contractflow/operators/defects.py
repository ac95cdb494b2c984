"""Known defects written into a table, so that detection can be measured.

Rows are chosen by arithmetic on a key instead of a random draw: the same rows are hit on every
run and on every executor, without a shuffle and without a global row number.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import instant, require_utc
from contractflow.operators.metrics import INJECTED
from contractflow.operators.project import iso_text


@dataclass(frozen=True)
class Defect:
    """Replace ``column`` in the buckets ``first .. first + pct - 1`` of one hundred."""

    name: str
    column: str
    pct: int
    replace: Callable[[Column, Column], Column]
    """New value from the old value and the row's integer key."""
    multiplier: int = 1
    offset: int = 0
    first: int = 0
    contiguous: bool = False
    """Whether the replacement reckons with keys that follow each other."""


def bucket(key: Column, multiplier: int = 1, offset: int = 0) -> Column:
    """``(key * multiplier + offset) mod 100``, reduced first so that no key overflows."""
    return F.pmod(F.pmod(key, F.lit(100)) * multiplier + offset, F.lit(100))


def inject(df: DataFrame, key: str, defects: Sequence[Defect]) -> DataFrame:
    """Apply the defects in order and list them per row in ``injected_defects``.

    Buckets are taken from the key as it was before any defect; a text key is hashed first.
    """
    if any(d.contiguous for d in defects) and not isinstance(df.schema[key].dataType, T.IntegralType):
        raise ValueError(f"{key!r} is no integer: use inject_duplicates, which takes ids from rows that exist")
    number = F.xxhash64(key) if isinstance(df.schema[key].dataType, T.StringType) else F.col(key)
    changed: dict[str, Column] = {}
    hits: list[Column] = []
    for defect in defects:
        at = bucket(number, defect.multiplier, defect.offset)
        hit = (at >= defect.first) & (at < defect.first + defect.pct)
        value = changed.get(defect.column, F.col(defect.column))
        changed[defect.column] = F.when(hit, defect.replace(value, number)).otherwise(value)
        hits.append(F.when(hit, F.lit(defect.name)))
    return df.withColumns({**changed, INJECTED: F.array_compact(F.array(*hits))})


def blank(column: str, pct: int, name: str = "blank", **where: int) -> Defect:
    return Defect(name, column, pct, lambda value, key: F.lit(""), **where)


def whitespace(column: str, pct: int, name: str = "whitespace", **where: int) -> Defect:
    return Defect(name, column, pct, lambda value, key: F.lit("   "), **where)


def null_out(column: str, pct: int, name: str = "null", **where: int) -> Defect:
    return Defect(name, column, pct, lambda value, key: F.lit(None), **where)


def constant(column: str, pct: int, value: object, name: str, **where: int) -> Defect:
    """A fixed bad value: a negative measure, a coordinate out of range."""
    return Defect(name, column, pct, lambda old, key: F.lit(value), **where)


def unknown_value(column: str, pct: int, values: Sequence[str], name: str = "unknown_value", **where: int) -> Defect:
    """A value outside the enumeration, taken in turn from ``values``."""

    def pick(value: Column, key: Column) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(key, F.lit(len(values))).cast("int"))

    return Defect(name, column, pct, pick, **where)


def future_time(
    column: str, pct: int, as_of: datetime | Column, hours: int = 3, name: str = "future", **where: int
) -> Defect:
    """ISO text ``hours`` after the clock, or after the event where that is later."""

    def shift(value: Column, key: Column) -> Column:
        require_utc()
        return iso_text(F.greatest(F.try_to_timestamp(value), instant(as_of)) + F.expr(f"INTERVAL {int(hours)} HOURS"))

    return Defect(name, column, pct, shift, **where)


def duplicate_key(column: str, pct: int, name: str = "duplicate", make: Callable[[Column], Column] | None = None) -> Defect:
    """Give the last ``pct`` of every hundred keys the id of the row ``pct`` before it.

    Source rows lie outside the hit set and no two hits share a source, for any contiguous
    integer key and ``pct`` up to 50; :func:`inject_duplicates` serves any other key. ``make`` builds
    the id from a key; by default the key is the id.
    """
    if not 0 < pct <= 50:
        raise ValueError("pct must lie in 1..50: every duplicate needs a source of its own")
    # the source is found by arithmetic, so inject() refuses keys that are no integers
    build = make or (lambda key: key)
    return Defect(name, column, pct, lambda value, key: build(key - pct), first=100 - pct, contiguous=True)


def inject_duplicates(
    df: DataFrame, key: str, column: str, pct: int, number: Column | None = None, name: str = "duplicate", groups: int = 1024
) -> DataFrame:
    """Give the hit rows the ``column`` of rows that exist and are not hit, each source to one hit at most.

    Hit are the rows whose key number mod 100 is among the last ``pct``; the number is an integer key
    itself, the hash of any other key, or ``number``. Rows are dealt into ``groups`` by their hundred, and in each
    group the n-th hit row takes from the n-th other row; hits that are left over take the sources that other groups
    have left over. A row without a key or a number is no hit and no source. Only a hit for which the whole table has
    no source is left as it is and is not listed in ``injected_defects``, which goes on from one that is there.

    Rows are numbered by counts of small cells (one key and 1,024th of the row hashes), so one key in all rows
    meets in no task; only full copies of one row do. ``df`` is read several times and must give the same rows each time.
    """
    if not 0 < pct <= 50:
        raise ValueError("pct must lie in 1..50: every duplicate needs a source of its own")
    if number is None:
        number = F.col(key) if isinstance(df.schema[key].dataType, T.IntegralType) else F.xxhash64(key)
    hashed = [f"`{f.name}`" for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    whole = df.withColumns({
        "__number": number,
        "__hit": F.pmod(number, F.lit(100)) >= 100 - pct,
        "__group": F.floor(F.pmod(number, F.lit(100 * groups)) / 100),  # the division is exact below 2**53
        "__key": F.col(key),
        "__salt": F.pmod(F.xxhash64(*hashed), F.lit(1024)),
    })
    keyed = F.col("__key").isNotNull() & F.col("__number").isNotNull()
    ranked, rest = whole.where(keyed), whole.where(~keyed)
    cell, side = ["__number", "__key", "__salt"], ["__group", "__hit"]
    cells = ranked.groupBy(*side, *cell).agg(F.count("*").alias("__held")).withColumn("__hundred", F.floor(F.col("__number") / 100))

    def before(order: list[str], *within: str) -> Column:
        return F.coalesce(F.sum("__held").over(Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    hundreds = cells.groupBy(*side, "__hundred").agg(F.sum("__held").alias("__held"))
    hundreds = hundreds.select(*side, "__hundred", before(["__hundred"], *side).alias("__first"))
    cells = cells.withColumn("__in", before(cell, *side, "__hundred")).join(hundreds, [*side, "__hundred"])
    cells = cells.select(*cell, (F.col("__first") + F.col("__in")).alias("__before"))
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("__key"))
    ranked = ranked.withColumn("__place", place).join(cells, cell).withColumn("__rank", F.col("__before") + F.col("__place"))

    # what one side of a group has beyond the other is numbered on through all groups
    sums = whole.where(keyed).groupBy("__group").agg(F.count_if("__hit").alias("__hits"), F.count_if(~F.col("__hit")).alias("__others"))
    over = [(True, F.col("__hits") - F.col("__others"), F.col("__others")), (False, F.col("__others") - F.col("__hits"), F.col("__hits"))]
    sides = [sums.select("__group", F.lit(h).alias("__hit"), F.greatest(n, F.lit(0)).alias("__held"), met.alias("__met")) for h, n, met in over]
    sides = sides[0].union(sides[1])
    sides = sides.select(*side, "__met", before(["__group"], "__hit").alias("__past"))
    ranked = ranked.join(sides, side)
    own = F.col("__rank") <= F.col("__met")
    ranked = ranked.withColumns({"__slot": F.when(own, F.col("__group")).otherwise(-1), "__rank": F.when(own, F.col("__rank")).otherwise(F.col("__past") + F.col("__rank") - F.col("__met"))})
    sources = ranked.where(~F.col("__hit")).select("__slot", "__rank", F.lit(True).alias("__hit"), F.col(column).alias("__source"), F.lit(True).alias("__found"))
    joined = ranked.join(sources, ["__slot", "__rank", "__hit"], "left").unionByName(rest, allowMissingColumns=True)
    done = F.coalesce("__found", F.lit(False))
    before = F.col(INJECTED) if INJECTED in df.columns else F.array().cast("array<string>")
    changed = {column: F.when(done, F.col("__source")).otherwise(F.col(column)), INJECTED: F.concat(before, F.when(done, F.array(F.lit(name))).otherwise(F.array().cast("array<string>")))}
    return joined.withColumns(changed).select(*df.columns, *([] if INJECTED in df.columns else [INJECTED]))
