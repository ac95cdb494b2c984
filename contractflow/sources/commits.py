"""One version number for both tables of a contract: an append-only log of loads and compactions.

A load writes its rows to either side under an id of its own and then one small file, the commit, whose name is the
next version. Rows without a commit are in no snapshot, so a crash between the sides leaves nothing to see, and a
replay writes again under another id instead of deleting files that a reader may have open. A reader names a version
(or takes the latest) and gets both sides as they were then, whatever is written meanwhile.

Days that are closed can be compacted: their small loads are packed into files of a given size, under new ids, and
a commit says which ids a day consists of up to a version. Later loads of that day still count. Every so many
versions the state is folded into a table, so that a reader opens few files however long the log is.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow.operators.decode import PAYLOAD, RAW
from contractflow.operators.upgrade import message_of, rejudged_certified, rejudged_refused, rule_changes
from contractflow.operators.validate import ERRORS
from contractflow.plans import Contract
from contractflow.sources.tables import BUCKET, LOAD_BUCKETS, LOAD_ID, Tables, date_column, drop_files, replace_load

FOLD = 200  # versions from one folded state to the next
BLOCK = 1_000  # commits in a folder
TARGET_BYTES = 128 << 20
SENT_ROWS = 500_000  # of about eighty bytes each
GRACE_SECONDS = 24 * 3600

LOADS = "id string, load string, version long, valid long, invalid long, at timestamp"
DAYS = "side string, day string, upto long, version long, held array<string>"
ENTRY = f"version long, kind string, load string, ids array<string>, valid long, invalid long, at timestamp, days array<struct<{', '.join(f.strip().replace(' ', ': ', 1) for f in DAYS.split(', '))}>>"


class CommitConflict(RuntimeError):
    """Another compaction or upgrade of the same days was committed first."""


@dataclass
class CommitLog:
    """The log in a folder that all writers and readers share."""

    spark: SparkSession
    folder: str

    # files of the log

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder.rstrip('/')}/{name}")

    def _files(self):
        return self._path("log").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, name: str) -> list[str]:
        path, files = self._path(name), self._files()
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    @staticmethod
    def _file(version: int) -> str:
        return f"log/{version // BLOCK:09d}/{version:012d}.json"

    def latest(self) -> int:
        """The last version, 0 before the first commit."""
        blocks = self._names("log")
        if not blocks:
            return 0
        return max((int(n[:-5]) for n in self._names(f"log/{max(blocks)}") if n.endswith(".json")), default=0)

    def _create(self, name: str, text: str) -> bool:
        """Write a file whole or not at all; False if there is one of this name."""
        jvm, files = self.spark._jvm, self._files()
        target, draft = self._path(name), self._path(f"drafts/{uuid.uuid4().hex}")
        out = files.create(draft, False)
        out.write(text.encode())
        out.close()
        files.mkdirs(target.getParent())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)  # never over another file
        try:
            context.rename(draft, target, none)
        except Py4JJavaError as error:
            files.delete(draft, False)
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def _commit(self, entry: dict[str, Any], since: int | None = None) -> int:
        """Append an entry under the next free version. ``since`` is the version that a compaction has read."""
        days = {(d["side"], d["day"]) for d in entry.get("days", ())}
        while True:
            version = self.latest() + 1
            if since is not None and version - 1 > since:
                later = self.entries(since, version - 1).select(F.explode("days").alias("d")).select("d.side", "d.day")
                if days & {tuple(r) for r in later.distinct().collect()}:
                    raise CommitConflict(f"another change of the same days was committed after version {since}")
            entry = entry | {"version": version, "at": datetime.now().astimezone().isoformat()}
            entry["days"] = [d | {"version": version} for d in entry.get("days", ())]
            if self._create(self._file(version), json.dumps(entry)):
                if version % FOLD == 0:
                    self._fold(version)
                return version

    def _fold(self, version: int) -> None:
        loads, days = self.state(version)
        for name, rows in (("loads", loads), ("days", days)):
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/state/{version:012d}/{name}")
        self._create(f"folded/{version:012d}", "")

    # reading

    def entries(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """The commits with versions above ``after`` and up to ``upto``."""
        upto = self.latest() if upto is None else upto
        blocks = [b for b in self._names("log") if after // BLOCK <= int(b) <= upto // BLOCK]
        if upto <= after or not blocks:
            return self.spark.createDataFrame([], ENTRY)
        rows = self.spark.read.schema(ENTRY).json([f"{self.folder}/log/{b}" for b in blocks])
        return rows.where((F.col("version") > after) & (F.col("version") <= upto))

    def state(self, version: int | None = None) -> tuple[DataFrame, DataFrame]:
        """The ids in force at a version (``LOADS``) and the last compaction of each day (``DAYS``)."""
        version = self.latest() if version is None else version
        folded = max((int(n) for n in self._names("folded") if int(n) <= version), default=0)
        log = self.entries(folded, version)
        loads = log.select(F.explode("ids").alias("id"), "load", "version", "valid", "invalid", "at")
        days = log.select(F.explode("days").alias("d")).select("d.*")
        if folded:
            before = f"{self.folder}/state/{folded:012d}"
            loads = self.spark.read.schema(LOADS).parquet(f"{before}/loads").unionByName(loads)
            days = self.spark.read.schema(DAYS).parquet(f"{before}/days").unionByName(days)
        last = days.groupBy("side", "day").agg(F.max_by(F.struct("upto", "version", "held"), "version").alias("d"))
        return loads, last.select("side", "day", "d.*")

    def committed(self, load: str) -> bool:
        """Whether a load, whatever its attempt, has been committed."""
        return not self.state()[0].where(F.col("load") == load).isEmpty()

    def statistics(self) -> DataFrame:
        """Rows of every load by side: what a table of batch statistics would hold, without its files."""
        loads = self.state()[0].where("load IS NOT NULL")
        return loads.select("version", "load", (F.col("valid") + F.col("invalid")).alias("total"), "valid", "invalid", "at")

    # writing

    def commit_load(self, load: str, id: str, valid: int, invalid: int) -> int:
        """Make the rows written under an id visible, on both sides at once."""
        return self._commit({"kind": "load", "load": load, "ids": [id], "valid": valid, "invalid": invalid})

    def load(self, sides: dict[str, DataFrame], tables: Tables, load: str | None = None) -> int | None:
        """Write the sides (bronze, quarantine, or one of them) and commit them; a load that is committed is left alone."""
        load = load or uuid.uuid4().hex
        if self.committed(load):
            return None
        id, counts = f"{load}-{uuid.uuid4().hex[:8]}", {}
        for side, rows in sides.items():
            name, partitioning = side_of(tables, side)
            replace_load(rows, name, id, partitioning, tables.provider, fresh=True)
            counts[side] = self.spark.table(name).where(F.col(LOAD_ID) == id).count()
        return self.commit_load(load, id, counts.get("bronze", 0), counts.get("quarantine", 0))


def side_of(tables: Tables, side: str) -> tuple[str, tuple[str, ...]]:
    if side == "bronze":
        return tables.bronze, tables.partitioning
    return tables.quarantine, tables.quarantine_partitioning


def day_of(tables: Tables, side: str) -> Column:
    """The day by which a side is compacted, as text; of rows without one, and of tables without days, null."""
    partitioning = side_of(tables, side)[1]
    return F.col(date_column(partitioning[0])[0]).cast("string") if partitioning else F.lit(None).cast("string")


def _sent(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def _live(rows: DataFrame, log: CommitLog, side: str, version: int) -> DataFrame:
    """Those of rows (with __id and __day) that are in the snapshot of a version."""
    loads, days = log.state(version)
    days = days.where(F.col("side") == side)
    known = rows.join(_sent(loads.select(F.col("id").alias("__id"), F.col("version").alias("__version"))), "__id")
    if days.isEmpty():
        return known.drop("__version")
    closed = days.select(F.coalesce("day", F.lit("")).alias("__key"), F.col("upto").alias("__upto"))
    held = days.select(F.coalesce("day", F.lit("")).alias("__key"), F.explode("held").alias("__id"), F.lit(True).alias("__held"))
    keyed = known.withColumn("__key", F.coalesce("__day", F.lit("")))
    judged = keyed.join(_sent(closed), "__key", "left").join(_sent(held), ["__key", "__id"], "left")
    live = F.col("__held").isNotNull() | (F.col("__version") > F.coalesce("__upto", F.lit(-1)))
    return judged.where(live).drop("__key", "__upto", "__held", "__version")


def snapshot(log: CommitLog, tables: Tables, version: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Bronze and quarantine as of one version, the latest unless said otherwise.

    A version before the first commit, or of a log without commits, shows two empty tables; one that is not there
    yet raises. Only rows of committed loads are read; ids are looked up in a small table sent to the tasks.
    """
    last = log.latest()
    version = last if version is None else version
    if version > last:
        raise ValueError(f"version {version} is not committed; the last one is {last}")
    out = []
    for side in ("bronze", "quarantine"):
        name = side_of(tables, side)[0]
        log.spark.catalog.refreshTable(name)
        rows = log.spark.table(name)
        keyed = rows.withColumns({"__id": F.col(LOAD_ID), "__day": day_of(tables, side)})
        out.append(_live(keyed, log, side, version).select(*[F.col(f"`{c}`") for c in rows.columns]))
    return out[0], out[1]


def live_files(log: CommitLog, tables: Tables, side: str, version: int | None = None) -> DataFrame:
    """(__id, __day, file, bytes) of the files that hold the rows of a snapshot; only ids and days are read."""
    version = log.latest() if version is None else version
    name = side_of(tables, side)[0]
    log.spark.catalog.refreshTable(name)
    held = log.spark.table(name).select(F.col(LOAD_ID).alias("__id"), day_of(tables, side).alias("__day"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    return _live(held.distinct(), log, side, version)


def packed(units: pd.DataFrame, target: int) -> pd.DataFrame:
    """One day's units (__day, __id, bytes, files) with the bin each goes to and the pieces it is cut into.

    Units of three quarters of the target or more have a bin of their own, and as many pieces as they are targets long;
    the others are packed first fit by falling size into bins of at most ``target`` bytes. A unit that is alone in its
    bin and has no more files than its bytes call for stays as it is: its bin is null.
    """
    units = units.sort_values(["bytes", "__id"], ascending=[False, True])
    rooms: list[int] = []
    bins: list[int] = []
    for size in units["bytes"].tolist():
        large = 4 * size >= 3 * target
        place = None if large else next((i for i, room in enumerate(rooms) if room >= size), None)
        if place is None:
            place = len(rooms)
            rooms.append(0 if large else target)
        rooms[place] -= 0 if large else size
        bins.append(place)
    taken = pd.Series(bins, dtype="Int64", index=units.index)
    pieces = (-(-units["bytes"] // target)).clip(lower=1).astype("int64")
    settled = (taken.map(taken.value_counts()) == 1) & (units["files"] <= 2 * pieces.where(pieces > 1, 0.5))
    return units.assign(bin=taken.mask(settled), pieces=pieces)


def compact(log: CommitLog, tables: Tables, side: str, before: date, target: int = TARGET_BYTES) -> int | None:
    """Pack the small loads of the days before ``before`` into files of about ``target`` bytes; the version that
    shows them, or None where there is nothing to pack.

    Rows keep all their columns but the load id. What is there after this is the same rows in other files; the
    earlier files stay for readers of earlier versions until ``vacuum``. Loads committed meanwhile are not
    touched. A day is packed by one task from its list of loads; the rows are rewritten by a task for each file. Rows
    without a day are left alone.
    """
    spark, version = log.spark, log.latest()
    name, _ = side_of(tables, side)
    files = live_files(log, tables, side, version).where(F.col("__day") < before.isoformat())
    units = files.groupBy("__day", "__id").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("files"))
    columns = ["__day", "__id", "bin", "pieces"]
    planned = units.groupBy("__day").applyInPandas(lambda day: packed(day, target)[columns], "__day string, __id string, bin long, pieces long")
    stem = F.concat(F.lit(f"compact-{uuid.uuid4().hex[:8]}-"), "__day", F.lit("-"), F.col("bin").cast("string"), F.lit("-"))
    plan = planned.withColumn("stem", stem).cache()
    try:
        moved = plan.where("stem IS NOT NULL")
        made = moved.select("__day", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1), lambda i: F.concat("stem", i.cast("string")))).alias("new")).distinct()
        ids = [r["new"] for r in made.select("new").toLocalIterator()]
        if not ids:
            return None
        rows = spark.table(name).withColumns({"__day": day_of(tables, side), "__row": F.col("_metadata.row_index")})
        where = _sent(moved.select(F.col("__day").alias("__its"), F.col("__id").alias("__old"), "pieces", "stem"))
        rewritten = rows.join(where, (F.col("__day") == F.col("__its")) & (F.col(LOAD_ID) == F.col("__old")))
        rewritten = rewritten.withColumn("new", F.concat("stem", F.pmod("__row", F.col("pieces")).cast("string")))
        stored = {LOAD_ID: F.col("new"), BUCKET: F.pmod(F.crc32(F.col("new").cast("binary")), F.lit(LOAD_BUCKETS)).cast("int")}
        out = [stored.get(c, F.col(f"`{c}`")).alias(c) for c in spark.table(name).columns]
        rewritten.repartition(len(ids), "new").select(*out).write.insertInto(name)
        stay = plan.where("stem IS NULL").select("__day", F.col("__id").alias("new")).join(made.select("__day").distinct(), "__day", "left_semi")
        held = made.union(stay).groupBy("__day").agg(F.sort_array(F.collect_set("new")).alias("held"))
        entries = [{"side": side, "day": r["__day"], "upto": version, "held": r["held"]} for r in held.toLocalIterator()]
    finally:
        plan.unpersist()
    return log._commit({"kind": "compact", "ids": sorted(ids), "days": entries}, since=version)


def vacuum(log: CommitLog, tables: Tables, keep: int, grace_seconds: float = GRACE_SECONDS) -> int:
    """Remove the files that no snapshot from version ``keep`` on can show; returns how many.

    Files of loads that are not committed go once they are older than ``grace_seconds``: a load under way is not one of them.
    """
    removed = 0
    for side in ("bronze", "quarantine"):
        name = side_of(tables, side)[0]
        log.spark.catalog.refreshTable(name)
        held = log.spark.table(name).select(
            F.col(LOAD_ID).alias("__id"), day_of(tables, side).alias("__day"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("written")
        )
        held = held.distinct()
        live = _live(held, log, side, keep).select("file").distinct()
        loads = _sent(log.state()[0].select(F.col("id").alias("__id"), F.col("version").alias("__version")))
        old = F.lit(time.time() - grace_seconds)
        wanted = held.join(loads, "__id", "left").where((F.col("__version") > keep) | (F.col("__version").isNull() & (F.col("written").cast("double") > old)))
        dead = held.select("file").distinct().join(live.union(wanted.select("file")).distinct(), "file", "left_anti")
        removed += drop_files(log.spark, name, dead)
    return removed


def closed_days(log: CommitLog, tables: Tables, sides: Iterable[str], before: date, target: int = TARGET_BYTES) -> list[int]:
    """Compact the closed days of several sides; the versions committed."""
    return [v for v in (compact(log, tables, side, before, target) for side in sides) if v is not None]


def upgrade(log: CommitLog, tables: Tables, old: Contract, new: Contract, as_of: datetime | Column) -> int | None:
    """Bring both tables of a JSON contract to a newer version, by the rules that changed; the version that shows it,
    or None where no row changes.

    Rows move between the sides, and messages change, in one commit: a reader sees all of it or nothing. Only loads
    (of a day) with a row that changes are written again; all others stay as they are. A row keeps the time it was
    ingested and takes the new contract's version if it changed. The raw text of a row that was certified is made from
    its fields. A compaction or upgrade of the same days that is committed meanwhile raises CommitConflict.
    """
    changes, spark, version = rule_changes(old, new), log.spark, log.latest()
    if changes.none or not version:
        return None
    held = {}
    for side in ("bronze", "quarantine"):
        name = side_of(tables, side)[0]
        spark.catalog.refreshTable(name)
        rows = spark.table(name)
        held[side] = _live(rows.withColumns({"__id": F.col(LOAD_ID), "__day": day_of(tables, side)}), log, side, version)
    good = rejudged_certified(held["bronze"], changes, as_of).withColumn("__moved", F.size(ERRORS) > 0)
    before = held["quarantine"].withColumn("__before", F.col(ERRORS))
    bad = rejudged_refused(before, new, changes, as_of).withColumn("__moved", F.size(ERRORS) == 0)
    changed = {"bronze": F.col("__moved"), "quarantine": ~F.col(ERRORS).eqNullSafe(F.col("__before"))}
    id, entries, writes, counts = f"upgrade-{uuid.uuid4().hex[:8]}", [], {}, {"bronze": 0, "quarantine": 0}
    stay = {}
    for side, rows in (("bronze", good), ("quarantine", bad)):
        units = rows.groupBy("__day", "__id").agg(F.max(changed[side]).alias("hit")).cache()
        hit = units.where("hit").select(F.coalesce("__day", F.lit("")).alias("__key"), F.col("__id").alias("__unit"))
        keyed = rows.withColumn("__key", F.coalesce("__day", F.lit("")))
        stay[side] = keyed.join(_sent(hit), (keyed["__key"] == hit["__key"]) & (keyed["__id"] == hit["__unit"]), "left_semi")
        kept = F.sort_array(F.collect_set(F.when(~F.col("hit"), F.col("__id"))))
        days = units.groupBy("__day").agg(F.max("hit").alias("hit"), kept.alias("held")).where("hit")
        entries += [{"side": side, "day": r["__day"], "upto": version, "held": r["held"]} for r in days.toLocalIterator()]
        units.unpersist()
    if not entries:
        return None
    audit = ["ingested_at", "source_format"]
    now = F.lit(new.version).alias("schema_version")
    fields = list(new.field_names)
    kept_good = stay["bronze"].where("NOT __moved").select(*fields, *audit, "schema_version")
    raised = stay["quarantine"].where("__moved").select(*[F.col(f"{PAYLOAD}.{f}").alias(f) for f in fields], *audit, now)
    writes["bronze"] = kept_good.unionByName(raised)
    renewed = F.when(changed["quarantine"], F.lit(new.version)).otherwise(F.col("schema_version")).alias("schema_version")
    kept_bad = stay["quarantine"].where("NOT __moved").select(RAW, *audit, renewed, ERRORS)
    dropped = stay["bronze"].where("__moved").select(message_of(new).alias(RAW), *audit, now, ERRORS)
    writes["quarantine"] = kept_bad.unionByName(dropped)
    for side, rows in writes.items():
        name, partitioning = side_of(tables, side)
        replace_load(rows, name, id, partitioning, tables.provider, fresh=True)
        counts[side] = spark.table(name).where(F.col(LOAD_ID) == id).count()
    return log._commit({"kind": "upgrade", "ids": [id], "valid": counts["bronze"], "invalid": counts["quarantine"], "days": entries}, since=version)
