"""The engine's jobs from the command line, for ``spark-submit``.

    contractflow.app provision  --contracts DIR [--provider iceberg]
    contractflow.app contract   --contract FILE --servers HOST:PORT --checkpoints DIR [--avro-schema FILE] [--commits DIR]
    contractflow.app streams    --schemas DIR --servers HOST:PORT --checkpoints DIR
    contractflow.app report     --contract FILE [--output TABLE] [--commits DIR [--version N]]
    contractflow.app compact    --contract FILE --commits DIR [--keep N]
    contractflow.app retain     --contract FILE [--provider iceberg]
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime, timezone
from pathlib import Path

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from contractflow.operators import metrics
from contractflow.plans import DOMAINS, Contract, ContractError, load_contract, load_contracts
from contractflow.session import pin
from contractflow.sources import (
    CommitLog,
    Tables,
    closed_days,
    contract_topic_stream,
    drop_expired,
    provision,
    provision_all,
    retention_days,
    snapshot,
    vacuum,
)
from contractflow.sources.kafka import DEFAULT_TRIGGER
from contractflow.sources.tables import date_column
from contractflow.streaming import provision_stats, run_on_kafka, start_contract_stream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="contractflow.app")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("provision", help="create the tables of every contract in a folder")
    job.add_argument("--contracts", required=True)

    job = jobs.add_parser("contract", help="route one topic by its contract")
    job.add_argument("--contract", required=True)
    job.add_argument("--avro-schema")

    jobs.add_parser("streams", help="validate the nine event streams").add_argument("--schemas", required=True)

    job = jobs.add_parser("report", help="quality report and SLA verdicts")
    job.add_argument("--contract", required=True)
    job.add_argument("--output", help="table to append the report's lines to")

    job = jobs.add_parser("compact", help="pack the small loads of closed days, and remove files that no kept version shows")
    job.add_argument("--contract", required=True)
    job.add_argument("--keep", type=int, help="the oldest version that has to stay readable")

    jobs.add_parser("retain", help="remove what the contract's retention period has passed").add_argument("--contract", required=True)

    for name in ("contract", "streams"):
        jobs.choices[name].add_argument("--servers", required=True)
        jobs.choices[name].add_argument("--checkpoints", required=True)
        jobs.choices[name].add_argument("--trigger", default=DEFAULT_TRIGGER)
    for name in ("contract", "report", "compact"):
        jobs.choices[name].add_argument("--commits", required=name == "compact", help="folder of the commit log of both tables")
    jobs.choices["report"].add_argument("--version", type=int, help="the committed version to report on, else the latest")
    for name in ("provision", "contract", "retain"):
        jobs.choices[name].add_argument("--provider", default="parquet")
    return parser


def run_provision(spark: SparkSession, contracts: str, provider: str) -> int:
    loaded, skipped = load_contracts(contracts)
    done, failed = provision_all(spark, loaded, provider)
    for tables in done:
        print(f"ready: {tables.bronze}, {tables.quarantine}")
    for name, reason in {**skipped, **failed}.items():
        print(f"skipped: {name}: {reason}")
    return len(done)


def run_contract(
    spark: SparkSession,
    contract_file: str,
    servers: str,
    checkpoints: str,
    trigger: str,
    provider: str,
    avro_schema: str | None,
    commits: str | None = None,
) -> None:
    contract = active(contract_file)
    tables = provision(
        spark, contract, Tables(contract.table, contract.quarantine_table, contract.partitioning, provider)
    )
    stats = provision_stats(spark, f"{contract.table}_batches", provider)
    start_contract_stream(
        contract_topic_stream(spark, contract.topic, servers),
        contract,
        tables,
        contract.checkpoint_path(checkpoints),
        stats,
        trigger,
        avro_schema=Path(avro_schema).read_text(encoding="utf-8") if avro_schema else None,
        log=CommitLog(spark, commits) if commits else None,
    ).awaitTermination()


def active(contract_file: str) -> Contract:
    """The contract of a file, if it is active."""
    contract = load_contract(contract_file)
    if contract.status != "active":
        raise ContractError(f"contract {contract.name!r} {contract.version} is {contract.status!r}, not active")
    return contract


def tables_of(contract: Contract) -> Tables:
    return Tables(contract.table, contract.quarantine_table, contract.partitioning)


def report(spark: SparkSession, contract: Contract, commits: str | None = None, version: int | None = None) -> list[Row]:
    """The report's lines: figures, violations of every rule, and SLA verdicts as 1 or 0.

    One action with one scan of each table: a single row of counts reaches the driver, and all lines are
    made from it, so no two of them speak of different snapshots. With a commit log both tables are read as of
    one version, whatever is loaded meanwhile.
    """
    if commits:
        bronze, quarantine = snapshot(CommitLog(spark, commits), tables_of(contract), version)
    else:
        bronze, quarantine = spark.table(contract.table), spark.table(contract.quarantine_table)
    rules = list(dict.fromkeys(["decode", *[r.name for r in contract.active_rules]]))
    counted = metrics.quality_row(bronze, quarantine, metrics.completeness_rules(contract), rules=rules)
    row = spark.createDataFrame([counted.first()], counted.schema)
    lines = metrics.report_lines(row).collect()
    if contract.sla:
        lines += [Row(section="sla", metric=f"{r['sla']} {r['target']}", value=float(r["pass"])) for r in metrics.sla_verdicts(row, contract.sla).collect()]
    return lines


def run_report(spark: SparkSession, contract_file: str, output: str | None = None, commits: str | None = None, version: int | None = None) -> None:
    """Print every line of the report, and append them to a table if one is named."""
    lines = report(spark, active(contract_file), commits, version)
    for line in lines:
        value = "" if line["value"] is None else f"{line['value']:.3f}"
        print(f"{line['section']}|{line['metric']}|{value}")
    if output:
        stamped = spark.createDataFrame(lines, "section string, metric string, value double")
        stamped.withColumn("reported_at", F.current_timestamp()).write.mode("append").saveAsTable(output)


def run_compact(spark: SparkSession, contract_file: str, commits: str, keep: int | None = None, today: date | None = None) -> list[int]:
    """Pack the days before today on both sides; with ``keep``, remove the files that versions from it on do not show."""
    tables, log = tables_of(active(contract_file)), CommitLog(spark, commits)
    versions = closed_days(log, tables, ("bronze", "quarantine"), today or datetime.now(timezone.utc).date())
    removed = vacuum(log, tables, keep) if keep is not None else 0
    print(f"versions: {versions}, files removed: {removed}")
    return versions


def run_retain(spark: SparkSession, contract_file: str, provider: str, as_of: datetime | None = None) -> int:
    """Remove from both tables what the contract's retention period has passed."""
    contract = active(contract_file)
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    columns = {date_column(t)[1] for t in contract.partitioning}
    column = "ingested_at" if "ingested_at" in columns or not columns else sorted(columns)[0]
    removed = drop_expired(spark, contract.table, as_of, retention_days(contract), column, provider)
    if provider != "parquet" or "ingested_at" in columns:
        removed += drop_expired(spark, contract.quarantine_table, as_of, retention_days(contract), "ingested_at", provider)
    print(f"removed: {removed}")
    return removed


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = pin(spark or SparkSession.builder.appName(f"contractflow-{args.job}").getOrCreate())
    if args.job == "provision":
        run_provision(spark, args.contracts, args.provider)
    elif args.job == "contract":
        run_contract(
            spark, args.contract, args.servers, args.checkpoints, args.trigger, args.provider, args.avro_schema, args.commits
        )
    elif args.job == "streams":
        schemas = {name: (Path(args.schemas) / f"{name}.avsc").read_text(encoding="utf-8") for name in DOMAINS}
        run_on_kafka(spark, args.servers, schemas, args.checkpoints, args.trigger)
    elif args.job == "retain":
        run_retain(spark, args.contract, args.provider)
    elif args.job == "compact":
        run_compact(spark, args.contract, args.commits, args.keep)
    else:
        run_report(spark, args.contract, args.output, args.commits, args.version)


if __name__ == "__main__":
    main()
