"""The jobs a user starts, as far as they run without Kafka."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contractflow import app, contract_from_dict, load_contract, validate
from contractflow.operators import certified, metrics, quarantined, route
from contractflow.plans import ContractError
from contractflow.sources import append, provision
from suite.alerts import CLOCK, FIELDS, injected_alerts


@pytest.fixture
def contract_file(database, tmp_path):
    rules = [
        {"name": "sensor-id-not-empty", "expr": "has(sensor_id)"},
        {"name": "event-time-not-empty", "expr": "has(event_time)"},
    ]
    doc = {
        "info": {"title": "alerts"},
        "format": "json",
        "sla": {"completeness": ">= 99%", "latency": "< 30 seconds"},
        "storage": {"icebergTable": f"{database}.alerts", "quarantineTable": f"{database}.alerts_q"},
        "schema": {"fields": [{"name": name} for name in FIELDS]},
        "quality": {"rules": rules},
    }
    path = tmp_path / "contracts" / "alerts.json"
    path.parent.mkdir()
    path.write_text(json.dumps(doc))
    (path.parent / "broken.yaml").write_text("contract: {}")
    return path


def test_provision_and_report(spark, contract_file, capsys):
    assert app.run_provision(spark, str(contract_file.parent), "parquet") == 1
    assert "skipped: broken.yaml" in capsys.readouterr().out
    contract = load_contract(contract_file)
    tables = provision(spark, contract)
    alerts = injected_alerts(spark, "/root/testdata/sf0.001").select(F.struct(*FIELDS).alias("parsed_payload"))
    tagged = validate(alerts, contract, CLOCK, "parsed_payload").withColumn("raw_payload", F.to_json("parsed_payload"))
    bronze, quarantine = route(tagged, contract, CLOCK)
    append(bronze, tables.bronze)
    append(quarantine, tables.quarantine)
    app.main(["report", "--contract", str(contract_file)], spark)
    printed = capsys.readouterr().out
    assert "completeness|overall_completeness_pct|" in printed
    assert "violations|sensor-id-not-empty|100.000" in printed
    assert "sla|latency < 30.0|0.000" in printed
    app.main(["report", "--contract", str(contract_file), "--output", "report_lines"], spark)
    assert spark.table("report_lines").where("section = 'violations'").count() == 3
    spark.sql("DROP TABLE report_lines")


def test_the_report_is_not_cut_and_scans_each_table_once(spark, database):
    rules = [{"name": f"rule-{i:03d}", "expr": f"a > {i}"} for i in range(150)]
    doc = {
        "info": {"title": "wide"},
        "storage": {"icebergTable": f"{database}.w", "quarantineTable": f"{database}.w_q"},
        "schema": {"fields": [{"name": "a", "type": "long"}, {"name": "event_time", "type": "timestamp"}]},
        "quality": {"rules": rules},
        "format": "json",
    }
    contract = contract_from_dict(doc)
    tables = provision(spark, contract)
    rows = spark.range(200).selectExpr("id AS a", "TIMESTAMP'2024-01-01' AS event_time")
    tagged = validate(rows, contract, CLOCK).withColumn("raw_payload", F.to_json(F.struct("a")))
    bronze, quarantine = certified(tagged, contract, CLOCK, payload=None), quarantined(tagged, contract, CLOCK)
    append(bronze, tables.bronze)
    append(quarantine, tables.quarantine)
    lines = {r["metric"]: r["value"] for r in app.report(spark, contract) if r["section"] == "violations"}
    assert lines == {"decode": 0.0} | {f"rule-{i:03d}": float(i + 1) for i in range(150)}
    counted = metrics.quality_row(spark.table(tables.bronze), spark.table(tables.quarantine), {}, rules=list(lines))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 2


def test_drafts_do_not_run(spark, tmp_path):
    path = tmp_path / "draft.json"
    path.write_text(json.dumps({"info": {"title": "d", "status": "draft"}}))
    with pytest.raises(ContractError, match="'draft', not active"):
        app.main(["report", "--contract", str(path)], spark)


def test_retention_job(spark, database, tmp_path):
    doc = {
        "info": {"title": "r"},
        "format": "json",
        "sla": {"retentionPeriod": "10 days"},
        "storage": {"icebergTable": f"{database}.r", "quarantineTable": f"{database}.r_q", "partitioning": ["days(ingested_at)"]},
        "schema": {"fields": [{"name": "a", "type": "long"}]},
    }
    path = tmp_path / "r.json"
    path.write_text(json.dumps(doc))
    contract = load_contract(path)
    tables = provision(spark, contract)
    for day in (1, 20):
        clock = datetime(2024, 1, day)
        tagged = validate(spark.range(3).selectExpr(f"{day} * 10L AS a"), contract, clock)
        append(certified(tagged, contract, clock, payload=None), tables.bronze, tables.partitioning)
    assert app.run_retain(spark, str(path), "parquet", datetime(2024, 1, 25)) == 1
    assert {r.a for r in spark.table(tables.bronze).collect()} == {200}


def test_jobs_need_their_arguments():
    with pytest.raises(SystemExit):
        app.main(["contract", "--contract", "x"])
    with pytest.raises(SystemExit):
        app.main([])


def test_report_and_compaction_by_version(spark, database, tmp_path):
    from datetime import date

    from contractflow import scratch
    from contractflow.sources import CommitLog

    doc = {
        "info": {"title": "v"},
        "format": "json",
        "storage": {"icebergTable": f"{database}.v", "quarantineTable": f"{database}.v_q", "partitioning": ["days(ingested_at)"]},
        "schema": {"fields": [{"name": "a", "type": "long"}, {"name": "event_time", "type": "timestamp"}]},
        "quality": {"rules": [{"name": "small", "expr": "a < 100"}]},
    }
    path = tmp_path / "v.json"
    path.write_text(json.dumps(doc))
    contract = load_contract(path)
    tables, folder = provision(spark, contract), scratch(spark, "commits")
    for start in (0, 98):
        rows = spark.range(start, start + 4).selectExpr("id AS a", "TIMESTAMP'2024-01-01' AS event_time")
        tagged = validate(rows, contract, CLOCK).withColumn("raw_payload", F.to_json(F.struct("a")))
        sides = {"bronze": certified(tagged, contract, CLOCK, payload=None), "quarantine": quarantined(tagged, contract, CLOCK)}
        CommitLog(spark, folder).load(sides, tables)

    def totals(version=None):
        lines = {r["metric"]: r["value"] for r in app.report(spark, contract, folder, version)}
        return lines["total_valid"], lines["total_invalid"]

    assert totals(1) == (4, 0) and totals() == totals(2) == (6, 2)
    assert app.run_compact(spark, str(path), folder, today=date(2100, 1, 1)) == [3, 4]
    assert totals() == (6, 2) == totals(2)
    app.main(["compact", "--contract", str(path), "--commits", folder, "--keep", "3"], spark)
    assert totals() == (6, 2) == totals(3)
