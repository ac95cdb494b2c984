"""Injected defects: exact rates, stated truth, untouched rows."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contractflow.operators import iso_text

from contractflow.operators.defects import (
    blank,
    bucket,
    constant,
    duplicate_key,
    future_time,
    inject,
    inject_duplicates,
    null_out,
    unknown_value,
    whitespace,
)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(2000).select(
        F.col("id").alias("k"),
        F.col("id").alias("dup"),
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"),
        F.col("id").cast("double").alias("n"),
        F.lit("2024-01-01T00:00:00.000000+00:00").alias("at"),
    )


@pytest.mark.parametrize("multiplier", [1, 3, 7, 37, 53, 71, 99])
def test_every_hundred_keys_are_hit_alike(spark, rows, multiplier):
    got = inject(rows, "k", [blank("v", 10, multiplier=multiplier, offset=11)]).filter("v = ''")
    per_hundred = got.groupBy((F.col("k") / 100).cast("int").alias("h")).count().collect()
    assert len(per_hundred) == 20 and {r["count"] for r in per_hundred} == {10}


def test_truth_names_exactly_the_changed_rows(spark, rows):
    defects = [
        blank("v", 10, multiplier=37),
        null_out("n", 20, multiplier=53),
        whitespace("at", 5, multiplier=3),
        duplicate_key("dup", 15),
    ]
    got = inject(rows, "k", defects).alias("g").join(rows.alias("r"), F.col("g.k") == F.col("r.k"))
    for name, column in (("blank", "v"), ("null", "n"), ("whitespace", "at"), ("duplicate", "dup")):
        changed = ~F.col(f"g.{column}").eqNullSafe(F.col(f"r.{column}"))
        assert got.filter(changed != F.array_contains("injected_defects", name)).isEmpty()


def test_duplicates_have_distinct_sources_outside_the_hits(spark, rows):
    got = inject(rows, "k", [duplicate_key("dup", 15)])
    counts = {r.dup: r["count"] for r in got.groupBy("dup").count().collect()}
    assert sum(n == 2 for n in counts.values()) == 300 and max(counts.values()) == 2
    assert got.select("dup").distinct().count() == 1700
    with pytest.raises(ValueError, match="1..50"):
        duplicate_key("dup", 51)


def test_future_is_always_ahead_of_the_clock(spark, rows):
    clock = datetime(2024, 1, 25)
    late = rows.withColumn("at", F.when(F.col("k") < 1000, F.col("at")).otherwise("2024-02-01T00:00:00Z"))
    got = inject(late, "k", [future_time("at", 10, clock, hours=3)]).filter(F.size("injected_defects") > 0)
    assert {r["at"] for r in got.select("at").distinct().collect()} == {
        "2024-01-25T03:00:00.000000+00:00",
        "2024-02-01T03:00:00.000000+00:00",
    }


def test_values_and_constants(spark, rows):
    got = inject(
        rows, "k", [unknown_value("v", 5, ["BAD", "ODD"]), constant("n", 8, -50.0, "negative", first=50)]
    ).filter(F.size("injected_defects") > 0)
    assert {r.v for r in got.filter("array_contains(injected_defects, 'unknown_value')").collect()} == {"BAD", "ODD"}
    assert {r.n for r in got.filter("array_contains(injected_defects, 'negative')").collect()} == {-50.0}


def test_later_defects_see_earlier_ones(spark, rows):
    got = inject(rows, "k", [constant("v", 10, "one", "first"), constant("v", 5, "two", "second")])
    counts = {r.v: r["count"] for r in got.filter("size(injected_defects) > 0").groupBy("v").count().collect()}
    assert counts == {"one": 100, "two": 100}


def test_huge_and_negative_keys_do_not_overflow(spark):
    df = spark.createDataFrame([(2**63 - 1,), (-(2**63),), (-1,), (0,)], "k long")
    got = [r[0] for r in df.select(bucket(F.col("k"), 99, 99)).collect()]
    assert got == [((k % 100) * 99 + 99) % 100 for k in (2**63 - 1, -(2**63), -1, 0)]


def test_text_keys_are_hashed(spark, rows):
    got = inject(rows.withColumn("s", F.col("v")), "s", [blank("v", 10)]).filter("v = ''").count()
    assert 100 < got < 300


def test_duplicates_on_sparse_and_text_keys_exist(spark):
    for key in (F.col("id") * 7, F.concat(F.lit("K"), F.col("id").cast("string")), F.lit("same")):
        df = spark.range(3000).withColumn("key", key).withColumn("dup", F.col("id").cast("string"))
        got = inject_duplicates(df, "key", "dup", 15, groups=8)
        hit = got.filter("array_contains(injected_defects, 'duplicate')")
        left = got.filter("NOT array_contains(injected_defects, 'duplicate')").select("dup")
        assert hit.count() == hit.join(left, "dup", "left_semi").count() == hit.select("dup").distinct().count()
        assert got.count() == 3000
        assert str(key) == str(F.lit("same")) or hit.count() > 300


def test_hits_of_a_hot_key_take_sources_of_other_groups(spark):
    key = F.when(F.col("id") < 300, 99).when(F.col("id") < 600, None).otherwise(F.col("id") * 100)
    df = spark.range(3000).withColumn("key", key).withColumn("dup", F.col("id"))
    got = inject_duplicates(df, "key", "dup", 15, groups=8)
    hit = got.filter("array_contains(injected_defects, 'duplicate')")
    assert got.count() == 3000 and sorted(r["id"] for r in hit.collect()) == list(range(300))
    assert hit.select("dup").distinct().count() == 300
    assert hit.where("dup < 600").count() == 0
    assert got.where("key IS NULL AND dup = id AND size(injected_defects) = 0").count() == 300


def test_null_text_keys_are_no_sources(spark):
    df = spark.range(400).withColumn("key", F.when(F.col("id") >= 200, F.col("id").cast("string"))).withColumn("dup", F.col("id"))
    got = inject_duplicates(df, "key", "dup", 40)
    assert got.count() == 400 and got.where("dup < 200 AND id >= 200").count() == 0
    assert got.where("size(injected_defects) > 0").count() > 40


def test_arithmetic_duplicates_refuse_other_keys(spark, rows):
    with pytest.raises(ValueError, match="no integer"):
        inject(rows.withColumn("s", F.col("v")), "s", [duplicate_key("dup", 15)])


def test_times_are_utc_in_any_session(spark):
    at = spark.createDataFrame([(0,), (1706140800123456,), (-1,)], "m long").select(F.timestamp_micros("m").alias("t"))
    wanted = ["1970-01-01T00:00:00.000000+00:00", "2024-01-25T00:00:00.123456+00:00", "1969-12-31T23:59:59.999999+00:00"]
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert [r[0] for r in at.select(iso_text(F.col("t"))).collect()] == wanted
            if zone != "UTC":
                with pytest.raises(RuntimeError, match="contractflow.pin"):
                    future_time("at", 10, datetime(2024, 1, 1)).replace(F.lit("2024-01-01"), F.lit(1))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
