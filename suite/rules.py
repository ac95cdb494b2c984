"""Contract rules, one query per kind, and whole contracts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow import compile_rules, load_contract, load_contracts, validate
from contractflow.operators import metrics
from contractflow.operators.defects import blank, inject, null_out, whitespace
from contractflow.plans import Rule, active_version, required_rule, rule_from_check, rule_from_text
from suite.registry import AS_OF, CONTRACTS, query, quote, reason_sql, table

EVENTS = load_contract(CONTRACTS / "events.json")


def tagged_rows(df: DataFrame, keys: list[str], rules: list[Rule], as_of=AS_OF) -> DataFrame:
    return verdicts(compile_rules(rules, df.schema, as_of).tag(df), keys)


def verdicts(tagged: DataFrame, keys: list[str]) -> DataFrame:
    return tagged.select(*keys, F.array_join("validation_errors", "|").alias("errors"), "is_valid")


def verdict_sql(source: str, keys: str, violations: list[tuple[str, str]]) -> str:
    reason = reason_sql("|", violations)
    return f"SELECT {keys}, {reason} AS errors, {reason} = '' AS is_valid FROM {source}"


def rule_query(name: str, source: str, keys: list[str], rule: Rule, condition: str, message: str, as_of=AS_OF) -> None:
    """Register one rule over one table."""

    @query(verdict_sql(source, ", ".join(keys), [(condition, message)]), name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tagged_rows(table(spark, sf_dir, source), keys, [rule], as_of)


rule_query(
    "rule_allowed_values",
    "events",
    ["event_id"],
    rule_from_text("valid-event-type", "event_type in ['click','view','purchase','signup']"),
    "event_type IS NULL OR event_type NOT IN ('click', 'view', 'purchase', 'signup')",
    "ALLOWED_VALUES_VIOLATION [valid-event-type]: 'event_type' not in ['click', 'view', 'purchase', 'signup']",
)
rule_query(
    "rule_allowed_values_check",
    "customer",
    ["c_custkey"],
    rule_from_check("c_mktsegment", {"type": "allowed_values", "values": ["BUILDING", "MACHINERY"]}),
    "c_mktsegment IS NULL OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
    "ALLOWED_VALUES_VIOLATION [c_mktsegment-allowed_values]: 'c_mktsegment' not in ['BUILDING', 'MACHINERY']",
)
rule_query(
    "rule_cmp_gt",
    "customer",
    ["c_custkey"],
    rule_from_text("balance", "c_acctbal > 0"),
    "c_acctbal <= 0",
    "RANGE_VIOLATION [balance]: 'c_acctbal' failed 'c_acctbal > 0'",
)
rule_query(
    "rule_cmp_ge",
    "supplier",
    ["s_suppkey"],
    rule_from_text("balance", "s_acctbal >= -100.5"),
    "s_acctbal < -100.5",
    "RANGE_VIOLATION [balance]: 's_acctbal' failed 's_acctbal >= -100.5'",
)
rule_query(
    "rule_cmp_lt",
    "part",
    ["p_partkey"],
    rule_from_text("size", "p_size<45"),
    "p_size >= 45",
    "RANGE_VIOLATION [size]: 'p_size' failed 'p_size<45'",
)
rule_query(
    "rule_cmp_le",
    "part",
    ["p_partkey"],
    rule_from_text("size", "p_size <= 45"),
    "p_size > 45",
    "RANGE_VIOLATION [size]: 'p_size' failed 'p_size <= 45'",
)
rule_query(
    "rule_cmp_ne",
    "lineitem",
    ["l_orderkey", "l_linenumber"],
    rule_from_text("quantity", "l_quantity != 25"),
    "l_quantity = 25",
    "RANGE_VIOLATION [quantity]: 'l_quantity' failed 'l_quantity != 25'",
)
rule_query(
    "rule_band",
    "orders",
    ["o_orderkey"],
    rule_from_text("price-band", "o_totalprice >= 5000 && o_totalprice <= 400000.5"),
    "o_totalprice < 5000 OR o_totalprice > 400000.5",
    "RANGE_VIOLATION [price-band]: 'o_totalprice' out of [5000.0, 400000.5]",
)
rule_query(
    "rule_range",
    "lineitem",
    ["l_orderkey", "l_linenumber"],
    rule_from_check("l_discount", {"type": "range", "min": 0.02, "max": 0.08}),
    "l_discount < CAST(0.02 AS DOUBLE) OR l_discount > CAST(0.08 AS DOUBLE)",
    "RANGE_VIOLATION [l_discount-range]: 'l_discount' out of [0.02, 0.08]",
)
rule_query(
    "rule_matches",
    "pages",
    ["page_id"],
    rule_from_text("https-only", "url.matches('^https://')"),
    "NOT regexp_matches(url, '^https://')",
    "REGEX_VIOLATION [https-only]: 'url' does not match pattern",
)
rule_query(
    "rule_matches_text",
    "documents",
    ["doc_id"],
    rule_from_text("has-number", "text.matches('[0-9]{3}')"),
    "NOT regexp_matches(text, '[0-9]{3}')",
    "REGEX_VIOLATION [has-number]: 'text' does not match pattern",
)
rule_query(
    "rule_regex",
    "pages",
    ["page_id"],
    rule_from_check("url", {"type": "regex", "pattern": "^https?://[a-z.]+/[a-z]{2}/[0-9]+$"}),
    "NOT regexp_matches(url, '^https?://[a-z.]+/[a-z]{2}/[0-9]+$')",
    "REGEX_VIOLATION [url-regex]: 'url' does not match pattern",
)
rule_query(
    "rule_not_future",
    "events",
    ["event_id"],
    rule_from_text("ts-not-future", "ts < now()"),
    "floor(epoch(ts)) > 1706140800",
    "NOT_FUTURE_VIOLATION [ts-not-future]: 'ts' is in the future",
)


# ── rules on derived columns ─────────────────────────────────────────────────


@query(
    verdict_sql(
        "lineitem",
        "l_orderkey, l_linenumber",
        [
            (
                "floor(epoch(l_shipdate)) > epoch(TIMESTAMP '2001-01-01') + 172800",
                "NOT_FUTURE_VIOLATION [l_shipdate-not_future]: 'l_shipdate' is in the future",
            )
        ],
    )
)
def rule_not_future_tol(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rule_from_check("l_shipdate", {"type": "not_future", "tolerance_seconds": 172800})
    return tagged_rows(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [rule], AS_OF.replace(year=2001, day=1)
    )


@query(
    verdict_sql(
        "events",
        "event_id",
        [
            (
                "event_id % 4 < 3 AND floor(epoch(ts)) > 1706140800",
                "NOT_FUTURE_VIOLATION [seen]: 'seen_at' is in the future",
            )
        ],
    )
)
def rule_not_future_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO texts with fraction, whole seconds, ``Z``, and texts that are no time (they pass)."""
    at = F.col("ts").cast("timestamp")
    seen = (
        F.when(F.col("event_id") % 4 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
        .when(F.col("event_id") % 4 == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
        .when(F.col("event_id") % 4 == 2, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.concat(F.lit("soon "), F.col("event_id")))
    )
    df = table(spark, sf_dir, "events").withColumn("seen_at", seen)
    return tagged_rows(df, ["event_id"], [rule_from_text("seen", "seen_at < now()")])


@query(
    verdict_sql(
        "events",
        "event_id",
        [
            (
                "CASE event_type WHEN 'click' THEN value < 1 OR value > 100 "
                "WHEN 'view' THEN value < 0 OR value > 50 "
                "WHEN 'purchase' THEN value < 20 OR value > 300 END",
                "RANGE_VIOLATION [value-range_by_field]: 'value' out of range for its 'event_type'",
            )
        ],
    )
)
def rule_range_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = {"click": [1, 100], "view": [0, 50], "purchase": [20, 300]}
    rule = rule_from_check("value", {"type": "range_by_field", "field": "event_type", "ranges": ranges})
    return tagged_rows(table(spark, sf_dir, "events"), ["event_id"], [rule])


@query(
    verdict_sql(
        "events",
        "event_id",
        [("event_id % 7 <> 0 AND value > 50", "RANGE_VIOLATION [cap]: 'amount' failed 'amount <= 50'")],
    )
)
def rule_numeric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number rule on text: what is no number passes instead of failing the job."""
    amount = F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    df = table(spark, sf_dir, "events").withColumn("amount", amount)
    return tagged_rows(df, ["event_id"], [rule_from_text("cap", "amount <= 50")])


# Blank in buckets 0-9, spaces in 10-19, null in 20-29 of (key * 37 + 11) mod 100.
_HOLES = {"multiplier": 37, "offset": 11}
_HOLE_SQL = "(((event_id % 100) * 37 + 11) % 100)"
_SENSOR_SQL = (
    f"(SELECT event_id, CASE WHEN {_HOLE_SQL} < 10 THEN '' WHEN {_HOLE_SQL} < 20 THEN '   ' "
    f"WHEN {_HOLE_SQL} < 30 THEN NULL ELSE 'S' || user_id END AS sensor_id FROM events)"
)


def holey_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("sensor_id")
    )
    return inject(
        df,
        "event_id",
        [
            blank("sensor_id", 10, **_HOLES),
            whitespace("sensor_id", 10, first=10, **_HOLES),
            null_out("sensor_id", 10, first=20, **_HOLES),
        ],
    )


def hole_query(name: str, rule: Rule, condition: str, message: str) -> None:
    @query(verdict_sql(_SENSOR_SQL, "event_id", [(condition, message)]), name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tagged_rows(holey_sensors(spark, sf_dir), ["event_id"], [rule])


_EMPTY = "sensor_id IS NULL OR trim(sensor_id) = ''"
hole_query(
    "rule_has",
    rule_from_text("sensor-id", "has(sensor_id)"),
    _EMPTY,
    "NOT_EMPTY_VIOLATION [sensor-id]: 'sensor_id' is null or empty",
)
hole_query(
    "rule_not_empty",
    rule_from_text("sensor-id", "sensor_id != ''"),
    _EMPTY,
    "NOT_EMPTY_VIOLATION [sensor-id]: 'sensor_id' is empty",
)
hole_query(
    "rule_not_empty_check",
    rule_from_check("sensor_id", {"type": "not_empty"}),
    _EMPTY,
    "NOT_EMPTY_VIOLATION [sensor_id-not_empty]: 'sensor_id' is null or empty",
)
hole_query(
    "rule_required",
    required_rule("sensor_id"),
    "sensor_id IS NULL",
    "NULL_VIOLATION [sensor_id-required]: 'sensor_id' is null",
)


# ── rules that let every row pass ────────────────────────────────────────────

_ALL_PASS = "SELECT event_id, '' AS errors, true AS is_valid FROM events"


@query(_ALL_PASS)
def rule_uncompiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of no known form are reported and let rows pass."""
    rules = [rule_from_text("same", "value == 3"), rule_from_text("power", "value > 1e5"), rule_from_text("odd", "value ~ 3")]
    return tagged_rows(table(spark, sf_dir, "events"), ["event_id"], rules)


_NUMBER_FORMS = {"power": ("value < 2e2", "value >= 200"), "plus": ("user_id >= +10", "user_id < 10"), "point": ("value > .5", "value <= 0.5"), "both": ("user_id >= +1e1 && user_id <= 1.39E+2", "user_id < 10 OR user_id > 139"), "unit": ("event_id <= 1e300", "event_id > 1e300")}


@query("SELECT event_id, rule FROM (" + " UNION ALL ".join(f"SELECT event_id, '{name}' AS rule FROM events WHERE {broken}" for name, (_, broken) in _NUMBER_FORMS.items()) + ")")
def rule_number_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operands with powers of ten, signs and bare points, where a contract allows them."""
    rules = [rule_from_text(name, text, any_number=True) for name, (text, _) in _NUMBER_FORMS.items()]
    tagged = tagged_rows(table(spark, sf_dir, "events"), ["event_id"], rules)
    named = F.explode(F.filter(F.split("errors", r"[\[\]]"), lambda x: x.isin(*_NUMBER_FORMS)))
    return tagged.where("NOT is_valid").select("event_id", named.alias("rule"))


@query(_ALL_PASS)
def rule_disabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_rows(table(spark, sf_dir, "events"), ["event_id"], [rule_from_text("off", "value > 1000", enabled=False)])


@query(_ALL_PASS)
def rule_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_rows(table(spark, sf_dir, "events"), ["event_id"], [])


# ── whole contracts ──────────────────────────────────────────────────────────

EVENT_VIOLATIONS = [
    (
        "event_type IS NULL OR event_type NOT IN ('click', 'view', 'purchase', 'signup')",
        "ALLOWED_VALUES_VIOLATION [valid-event-type]: 'event_type' not in ['click', 'view', 'purchase', 'signup']",
    ),
    ("value > 200", "RANGE_VIOLATION [value-cap]: 'value' failed 'value <= 200'"),
    ("floor(epoch(ts)) > 1706140800", "NOT_FUTURE_VIOLATION [ts-not-future]: 'ts' is in the future"),
    ("NOT regexp_matches(props, '[0-9]{2}')", "REGEX_VIOLATION [props-two-digits]: 'props' does not match pattern"),
    ("user_id < 0 OR user_id > 139", "RANGE_VIOLATION [user-band]: 'user_id' out of [0.0, 139.0]"),
]


@query(verdict_sql("events", "event_id, user_id, event_type, value", EVENT_VIOLATIONS))
def contract_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = validate(table(spark, sf_dir, "events"), EVENTS, AS_OF)
    return verdicts(tagged, ["event_id", "user_id", "event_type", "value"])


@query(
    verdict_sql(
        "events",
        "event_id",
        [
            ("event_id IS NULL", "NULL_VIOLATION [event_id-required]: 'event_id' is null"),
            ("event_type IS NULL", "NULL_VIOLATION [event_type-required]: 'event_type' is null"),
            EVENT_VIOLATIONS[0],
            ("value > 200", "RANGE_VIOLATION [value-cap]: 'value' out of [-inf, 200.0]"),
            ("ts IS NULL", "NULL_VIOLATION [ts-required]: 'ts' is null"),
            EVENT_VIOLATIONS[2],
            (
                "props IS NULL OR trim(props) = ''",
                "NOT_EMPTY_VIOLATION [props-filled]: 'props' is null or empty",
            ),
            EVENT_VIOLATIONS[3],
            EVENT_VIOLATIONS[4],
        ],
    )
)
def contract_yaml_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check form, in its highest active version, passes the same rows."""
    loaded, _ = load_contracts(CONTRACTS)
    contract = active_version(loaded, "events-checks")
    return verdicts(validate(table(spark, sf_dir, "events"), contract, AS_OF), ["event_id"])


ORDERS = load_contract(CONTRACTS / "orders.yaml")
ORDERS_AS_OF = datetime(2001, 1, 1)
# The orders table with some values made missing, in SQL valid for Spark and DuckDB alike.
_ORDER_COLUMNS = {
    "o_orderkey": "o_orderkey",
    "o_orderstatus": "CASE WHEN o_orderkey % 29 <> 4 THEN o_orderstatus END",
    "o_orderpriority": "CASE WHEN o_orderkey % 40 = 0 THEN NULL WHEN o_orderkey % 40 = 1 THEN '   ' ELSE o_orderpriority END",
    "o_totalprice": "CASE WHEN o_orderkey % 53 <> 0 THEN o_totalprice END",
    "o_orderdate": "o_orderdate",
}
_ORDER_SQL = f"(SELECT {', '.join(f'{e} AS {c}' for c, e in _ORDER_COLUMNS.items())} FROM orders)"


@query(
    verdict_sql(
        _ORDER_SQL,
        "o_orderkey",
        [
            ("o_orderkey IS NULL", "NULL_VIOLATION [o_orderkey-required]: 'o_orderkey' is null"),
            (
                "o_orderstatus IS NULL OR o_orderstatus NOT IN ('O', 'F')",
                "ALLOWED_VALUES_VIOLATION [o_orderstatus-allowed_values]: 'o_orderstatus' not in ['O', 'F']",
            ),
            ("o_orderpriority IS NULL", "NULL_VIOLATION [o_orderpriority-required]: 'o_orderpriority' is null"),
            (
                "o_orderpriority IS NULL OR trim(o_orderpriority) = ''",
                "NOT_EMPTY_VIOLATION [o_orderpriority-not_empty]: 'o_orderpriority' is null or empty",
            ),
            (
                "NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z ]+$')",
                "REGEX_VIOLATION [o_orderpriority-regex]: 'o_orderpriority' does not match pattern",
            ),
            ("o_totalprice IS NULL", "NULL_VIOLATION [o_totalprice-required]: 'o_totalprice' is null"),
            (
                "o_totalprice < 5000 OR o_totalprice > 480000",
                "RANGE_VIOLATION [o_totalprice-range]: 'o_totalprice' out of [5000.0, 480000.0]",
            ),
            (
                "CASE o_orderstatus WHEN 'O' THEN o_totalprice < 20000 OR o_totalprice > 400000 "
                "WHEN 'F' THEN o_totalprice < 0 OR o_totalprice > 250000 END",
                "RANGE_VIOLATION [o_totalprice-range_by_field]: 'o_totalprice' out of range for its 'o_orderstatus'",
            ),
            (
                "o_orderdate > TIMESTAMP '2001-01-02'",
                "NOT_FUTURE_VIOLATION [o_orderdate-not_future]: 'o_orderdate' is in the future",
            ),
        ],
    ),
    "contract_sensor_metrics",  # the name under which this contract with all check kinds was first registered
)
def contract_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All check types in one contract, several per field, messages in listed order."""
    df = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {c}" for c, e in _ORDER_COLUMNS.items()])
    return verdicts(validate(df, ORDERS, ORDERS_AS_OF), ["o_orderkey"])


def _rule_counts_sql() -> str:
    names = ["valid-event-type", "value-cap", "ts-not-future", "props-two-digits", "user-band"]
    return " UNION ALL ".join(
        f"SELECT {quote(name)} AS rule, count(*) AS violations FROM events WHERE {condition} HAVING count(*) > 0"
        for name, (condition, _) in zip(names, EVENT_VIOLATIONS, strict=True)
    )


@query(_rule_counts_sql())
def violations_per_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the events contract over the whole table, counted per rule in one aggregate."""
    df = table(spark, sf_dir, "events")
    return compile_rules(EVENTS.active_rules, df.schema, AS_OF).violations(df)


@query(_rule_counts_sql())
def violations_from_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same figures read back from the rows' error arrays."""
    return metrics.violations_per_rule(validate(table(spark, sf_dir, "events"), EVENTS, AS_OF))


__all__ = ["EVENTS", "EVENT_VIOLATIONS", "verdict_sql", "verdicts"]
