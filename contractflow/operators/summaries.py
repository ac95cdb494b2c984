"""Mergeable summaries of loads: distinct keys, lags, and the heaviest keys, without reading old loads again.

Each load is summarised once, into a row of sketches of fixed size. A report merges the rows it wants, of any
days or loads, at a cost that depends on the number of loads and not on their rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractflow.functions import epoch_seconds
from contractflow.operators.metrics import percent, top_duplicates

LOG_CELLS = 14  # of a distinct sketch
SKETCH_ERROR = 1.04 / 2 ** (LOG_CELLS / 2)  # relative standard deviation of a distinct count
QUANTILE_K = 800
RANK_ERROR = 0.006  # by which the rank of a quantile may be off, in 99 cases of 100
COUNTERS = 1_000  # keys that a task keeps in view
MOST_LIKELY = 10_000  # keys that are counted again


def summarised(
    df: DataFrame, by: Sequence[str], keys: Sequence[str] = (), ingested: str | None = None, event: str | None = None
) -> DataFrame:
    """One row for each load (or whatever ``by`` names): records, a distinct sketch of each key, a sketch of lags.

    ``distinct_<key>`` counts values by hash in ``2 ** LOG_CELLS`` cells, and ``nulls_<key>`` null keys; ``lags`` holds
    the seconds from ``event`` to ``ingested``, of rows that have both. Tasks sketch their own rows first.
    """
    made: list[Column] = [F.count("*").alias("records")]
    for key in keys:
        made.append(F.hll_sketch_agg(F.col(key).cast("string"), LOG_CELLS).alias(f"distinct_{key}"))
        made.append(F.count_if(F.col(key).isNull()).alias(f"nulls_{key}"))
    if ingested and event:
        lag = epoch_seconds(F.col(ingested), df.schema[ingested].dataType) - epoch_seconds(F.col(event), df.schema[event].dataType)
        made += [F.count(lag).alias("timed"), F.kll_sketch_agg_bigint(lag.cast("long"), QUANTILE_K).alias("lags")]
    return df.groupBy(*by).agg(*made)


def uniqueness_merged(summaries: DataFrame, key: str) -> DataFrame:
    """Records, distinct keys and their share over all summaries, as ``uniqueness`` gives them but for the sketch's error.

    The relative standard deviation is ``SKETCH_ERROR``; all null keys are one value.
    """
    some = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{key}")), F.lit(0).cast("long"))
    nulls = F.coalesce((F.sum(f"nulls_{key}") > 0).cast("long"), F.lit(0).cast("long"))
    merged = summaries.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"), (some + nulls).alias("distinct_ids"))
    return merged.withColumn("uniqueness_pct", F.round(percent(F.least("distinct_ids", "records"), F.col("records")), 2))


def latency_quantiles(summaries: DataFrame, ranks: Sequence[float] = (0.5, 0.9, 0.99, 1.0)) -> DataFrame:
    """``rank`` and ``seconds``: the lag that the share ``rank`` of all records does not exceed, over all summaries.

    The rank is true to within ``RANK_ERROR``; the last one, 1, is the largest lag itself. No records give nulls.
    """
    held = summaries.where("timed > 0").agg(F.kll_merge_agg_bigint("lags", QUANTILE_K).alias("lags"))
    lines = [F.struct(F.lit(float(r)).alias("rank"), F.when(F.col("lags").isNotNull(), F.kll_sketch_get_quantile_bigint("lags", F.lit(float(r)))).alias("seconds")) for r in ranks]
    sketched = F.when(F.kll_sketch_get_n_bigint("lags") > 0, F.array(*lines))
    empty = F.array(*[F.struct(F.lit(float(r)).alias("rank"), F.lit(None).cast("long").alias("seconds")) for r in ranks])
    return held.select(F.inline(F.coalesce(sketched, empty)))


def latency_verdict(summaries: DataFrame, target_seconds: float, rank: float = 0.99) -> DataFrame:
    """Whether the lag of the given share of records keeps a target, which one late record cannot break."""
    row = latency_quantiles(summaries, (rank,))
    return row.select("rank", F.lit(float(target_seconds)).alias("target"), F.col("seconds").alias("actual"), (F.col("seconds") <= target_seconds).alias("pass"))


def key_summaries(df: DataFrame, keys: Sequence[str], counters: int = COUNTERS) -> DataFrame:
    """(part, keys, at_least, missed): each task's summary of its keys, of at most ``counters`` rows.

    A key occurs at least ``at_least`` times in the task's rows and at most ``missed`` times more; a key without a
    row at most ``missed`` times. Whenever there are too many keys, the count of the first one too many is taken off all
    (the mergeable form of Misra and Gries), so ``missed`` is no more than rows divided by counters.
    """
    names = [f"k{i}" for i in range(len(keys))]
    chosen = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    out = T.StructType([*chosen.schema.fields, T.StructField("at_least", T.LongType()), T.StructField("missed", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, missed = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch]).append_column("at_least", pa.array([1] * batch.num_rows, pa.int64()))
            whole = new if held is None else pa.concat_tables([held, new])
            held = whole.group_by(names).aggregate([("at_least", "sum")]).rename_columns([*names, "at_least"])
            if held.num_rows > counters:
                cut = pc.sort_indices(held["at_least"], sort_keys=[("", "descending")])[counters].as_py()
                off = held["at_least"][cut].as_py()
                missed += off
                left = pc.subtract(held["at_least"], off)
                held = held.set_column(len(names), "at_least", left).filter(pc.greater(left, 0))
        if held is None:
            return
        if not held.num_rows and missed:  # nothing stands out; the bound still counts
            held = pa.Table.from_batches([batch.slice(0, 1)]).append_column("at_least", pa.array([0], pa.int64()))
        for b in held.append_column("missed", pa.array([missed] * held.num_rows, pa.int64())).to_batches():
            yield pa.RecordBatch.from_arrays(b.columns, list(out.names))

    return chosen.mapInArrow(run, out).withColumn("part", F.spark_partition_id())


def heavy_hitters(df: DataFrame, keys: Sequence[str], limit: int = 10, counters: int = COUNTERS) -> DataFrame:
    """The same rows as ``top_duplicates``: the most repeated keys, exactly, ties broken by the key.

    Tasks send summaries of at most ``counters`` keys. Keys that can be among the first ``limit`` by their bounds
    are counted again, exactly, and nothing else is. Where the bounds cannot keep every other key out of the result,
    because too many keys are about as frequent, all keys are counted as ``top_duplicates`` does.
    """
    spark = df.sparkSession
    names = [f"k{i}" for i in range(len(keys))]
    parts = key_summaries(df, keys, counters).persist()
    try:
        missed = parts.groupBy("part").agg(F.max("missed").alias("missed")).agg(F.coalesce(F.sum("missed"), F.lit(0))).first()[0]
        merged = parts.groupBy(*names).agg(F.sum("at_least").alias("at_least"))
        first = [r["at_least"] for r in merged.select("at_least").orderBy(F.desc("at_least")).limit(limit).collect()]
        least = max(first[-1] if len(first) == limit else 0, 2)
        likely = merged.where(F.col("at_least") + missed >= least).limit(MOST_LIKELY + 1).collect()
    finally:
        parts.unpersist()
    if missed >= least or len(likely) > MOST_LIKELY:
        return top_duplicates(df, keys, limit)
    schema = T.StructType([df.schema[k] for k in keys])
    chosen = spark.createDataFrame([tuple(r[n] for n in names) for r in likely], T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)]))
    same = [F.col(k).eqNullSafe(F.col(f"c{i}")) for i, k in enumerate(keys)]
    return top_duplicates(df.join(F.broadcast(chosen), same, "left_semi"), keys, limit)
