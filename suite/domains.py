"""The nine event streams over the given tables, and their JSON outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow import check_domain
from contractflow.functions import frame
from contractflow.operators import decode_framed, domain_messages, event_schema, flatten_event, split_domain
from contractflow.plans import DOMAINS
from suite.mappings import PRODUCED_AT, SCHEMA_ID, domain_messages_of, events_sql
from suite.registry import AS_OF, query, reason_sql, table

# stream -> its rules as SQL conditions with their messages, in order
VIOLATIONS: dict[str, list[tuple[str, str]]] = {
    "sales.transactions": [
        ("transaction_id IS NULL", "transaction_id is null"),
        ("amount <= 0", "amount must be positive"),
        ("currency NOT IN ('MAD', 'EUR', 'USD')", "currency is invalid"),
        ("payment_method NOT IN ('CARD', 'CASH', 'TRANSFER')", "payment_method is invalid"),
    ],
    "sales.customers": [
        ("customer_id IS NULL", "customer_id is null"),
        ("customer_segment NOT IN ('RETAIL', 'PREMIUM', 'ENTERPRISE')", "customer_segment is invalid"),
        ("email IS NULL", "email is null"),
    ],
    "sales.products": [
        ("product_id IS NULL", "product_id is null"),
        ("price <= 0", "price must be positive"),
        ("currency NOT IN ('MAD', 'EUR', 'USD')", "currency is invalid"),
        ("category NOT IN ('ELECTRONICS', 'ACCESSORIES', 'COMPUTING')", "category is invalid"),
    ],
    "logistics.shipments": [
        ("shipment_id IS NULL", "shipment_id is null"),
        ("vehicle_id IS NULL", "vehicle_id is null"),
        ("status NOT IN ('CREATED', 'IN_TRANSIT', 'DELIVERED', 'CANCELLED')", "status is invalid"),
        ("weight_kg <= 0", "weight_kg must be positive"),
    ],
    "logistics.vehicles": [
        ("vehicle_id IS NULL", "vehicle_id is null"),
        ("capacity_kg <= 0", "capacity_kg must be positive"),
        ("status NOT IN ('ACTIVE', 'MAINTENANCE', 'INACTIVE')", "status is invalid"),
    ],
    "logistics.locations": [
        ("location_id IS NULL", "location_id is null"),
        ("city IS NULL", "city is null"),
        ("zone_type NOT IN ('WAREHOUSE', 'STORE', 'HUB', 'CUSTOMER_ZONE')", "zone_type is invalid"),
    ],
    "sensors.readings": [
        ("reading_id IS NULL", "reading_id is null"),
        ("sensor_id IS NULL", "sensor_id is null"),
        ("machine_id IS NULL", "machine_id is null"),
        ("temperature < -20 OR temperature > 100", "temperature out of range"),
        ("vibration_level < 0 OR vibration_level > 20", "vibration_level out of range"),
    ],
    "sensors.machines": [
        ("machine_id IS NULL", "machine_id is null"),
        ("site_id IS NULL", "site_id is null"),
        ("status NOT IN ('ACTIVE', 'MAINTENANCE', 'STOPPED')", "status is invalid"),
    ],
    "sensors.alerts": [
        ("alert_id IS NULL", "alert_id is null"),
        ("sensor_id IS NULL", "sensor_id is null"),
        ("severity NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')", "severity is invalid"),
        ("alert_type NOT IN ('TEMPERATURE', 'VIBRATION', 'CONNECTIVITY', 'POWER')", "alert_type is invalid"),
    ],
}


def checked_sql(name: str) -> str:
    """The stream's events with their joined error reason."""
    return f"(SELECT *, {reason_sql('; ', VIOLATIONS[name])} AS error_reason FROM {events_sql(name)})"


def outcome_sql(name: str) -> str:
    key = DOMAINS[name].key
    return (
        f"SELECT event_id, error_reason, CASE WHEN error_reason = '' THEN {key} ELSE event_id END AS key, "
        f"CASE WHEN error_reason = '' THEN 'silver.{name}' ELSE 'dlq.{name}' END AS topic FROM {checked_sql(name)}"
    )


def _domain_query(name: str) -> None:
    domain = DOMAINS[name]

    @query(outcome_sql(name), f"domain_{name.split('.')[1]}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checked = check_domain(decoded_events(spark, sf_dir, name), domain)
        passed = F.col("error_reason") == ""
        return checked.select(
            "event_id",
            "error_reason",
            F.when(passed, F.col(domain.key)).otherwise(F.col("event_id")).alias("key"),
            F.when(passed, F.lit(domain.silver_topic)).otherwise(F.lit(domain.dlq_topic)).alias("topic"),
        )


for _name in DOMAINS:
    _domain_query(_name)


def decoded_events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stream's events after a round trip through framed messages."""
    domain = DOMAINS[name]
    return flatten_event(decode_framed(domain_messages_of(spark, sf_dir, name), event_schema(domain)), domain)


def _keys(*parts: str) -> str:
    """The field names of a JSON text in order, leaving out those that are null."""
    return f"concat_ws(',', {', '.join(parts)})"


def _json_keys(names: list[str]) -> str:
    return _keys(*[f"CASE WHEN {n} IS NOT NULL THEN '{n}' END" for n in names])


def parsed_back(df: DataFrame, columns: dict[str, str], stamp: str) -> DataFrame:
    """Message JSON as columns again, with its field names as written."""
    fields = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    return df.select(
        "key",
        F.array_join(F.json_object_keys("value"), ",").alias("json_keys"),
        F.from_json("value", f"{fields}, {stamp} timestamp").alias("body"),
    ).select(
        "key",
        "json_keys",
        *[F.col(f"body.{name}").alias(name) for name in columns],
        F.col(f"body.{stamp}").cast("long").alias(stamp),
    )


_ENVELOPE = {"event_id": "string", "domain": "string", "event_type": "string", "produced_at": "string"}
_TRANSACTION = {**_ENVELOPE, **DOMAINS["sales.transactions"].columns}
_CUSTOMER = {"kafka_key": "string", **_ENVELOPE, **DOMAINS["sales.customers"].columns, "error_reason": "string"}
_STAMP = "1706140800"


@query(
    f"SELECT transaction_id AS key, {_json_keys(list(_TRANSACTION))} || ',validated_at' AS json_keys, "
    f"{', '.join(_TRANSACTION)}, CAST({_STAMP} AS BIGINT) AS validated_at "
    f"FROM {checked_sql('sales.transactions')} WHERE error_reason = ''"
)
def silver_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certified transactions: explicit columns, no error reason."""
    domain = DOMAINS["sales.transactions"]
    silver, _ = split_domain(check_domain(decoded_events(spark, sf_dir, domain.name), domain), domain, AS_OF)
    return parsed_back(silver, _TRANSACTION, "validated_at")


@query(
    f"SELECT event_id AS key, {_json_keys([*_TRANSACTION, 'error_reason'])} || ',failed_at' AS json_keys, "
    f"{', '.join(_TRANSACTION)}, error_reason, CAST({_STAMP} AS BIGINT) AS failed_at "
    f"FROM {checked_sql('sales.transactions')} WHERE error_reason <> ''"
)
def dlq_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected transactions: the reason, keyed by event id."""
    domain = DOMAINS["sales.transactions"]
    _, dlq = split_domain(check_domain(decoded_events(spark, sf_dir, domain.name), domain), domain, AS_OF)
    return parsed_back(dlq, {**_TRANSACTION, "error_reason": "string"}, "failed_at")


@query(
    f"SELECT customer_id AS key, {_json_keys(list(_CUSTOMER))} || ',validated_at' AS json_keys, "
    f"{', '.join(_CUSTOMER)}, CAST({_STAMP} AS BIGINT) AS validated_at "
    f"FROM (SELECT *, coalesce(customer_id, event_id) AS kafka_key FROM {checked_sql('sales.customers')}) "
    "WHERE error_reason = ''"
)
def silver_json_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certified customers: every column, the message key and the empty reason."""
    domain = DOMAINS["sales.customers"]
    silver, _ = split_domain(check_domain(decoded_events(spark, sf_dir, domain.name), domain), domain, AS_OF)
    return parsed_back(silver, _CUSTOMER, "validated_at")


_SHIPMENT = {**_ENVELOPE, **DOMAINS["logistics.shipments"].columns, "error_reason": "string"}


@query(
    f"SELECT key, topic, error_reason, weight_kg, stamp FROM ("
    f"SELECT CASE WHEN error_reason = '' THEN shipment_id ELSE event_id END AS key, "
    "CASE WHEN error_reason = '' THEN 'silver.logistics.shipments' ELSE 'dlq.logistics.shipments' END AS topic, "
    "error_reason, weight_kg, CASE WHEN error_reason = '' THEN 'validated' ELSE 'failed' END AS stamp "
    f"FROM {checked_sql('logistics.shipments')})"
)
def domain_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outcomes of shipments from bytes to routed JSON in one pass."""
    domain = DOMAINS["logistics.shipments"]
    routed = domain_messages(check_domain(decoded_events(spark, sf_dir, domain.name), domain), domain, AS_OF)
    body = F.from_json("value", "error_reason string, weight_kg double, validated_at timestamp, failed_at timestamp")
    return routed.select("key", "topic", body.alias("body")).select(
        "key",
        "topic",
        "body.error_reason",
        "body.weight_kg",
        F.when(F.col("body.validated_at").isNotNull() & F.col("body.failed_at").isNull(), "validated")
        .when(F.col("body.failed_at").isNotNull() & F.col("body.validated_at").isNull(), "failed")
        .alias("stamp"),
    )


_BROKEN_SQL = (
    "CASE event_id % 4 WHEN 0 THEN encode(props) WHEN 1 THEN from_hex('0000000007') || encode('{\"event_id\": ') "
    "WHEN 2 THEN encode('') END"
)


@query(
    "SELECT 'k' || event_id AS key, 'dlq.sensors.machines' AS topic, 'payload could not be decoded' AS error_reason, "
    f"'k' || event_id AS kafka_key, to_base64({_BROKEN_SQL}) AS raw_payload_base64, true AS stamped FROM events WHERE event_id % 4 < 3 "
    "UNION ALL SELECT 'E' || event_id, 'dlq.sensors.machines', 'machine_id is null; site_id is null', NULL, NULL, true "
    "FROM events WHERE event_id % 4 = 3"
)
def dlq_undecodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unframed, broken and empty messages reach the dead-letter topic whole; a readable event with nulls does not."""
    domain, row = DOMAINS["sensors.machines"], F.col("event_id")
    good = F.to_json(F.struct(F.concat(F.lit("E"), row.cast("string")).alias("event_id"), F.lit(PRODUCED_AT).alias("produced_at")))
    value = (
        F.when(row % 4 == 0, F.col("props").cast("binary"))
        .when(row % 4 == 1, frame(F.lit('{"event_id": '), F.lit(SCHEMA_ID)))
        .when(row % 4 == 2, F.lit(b""))
        .otherwise(frame(good, F.lit(SCHEMA_ID)))
    )
    messages = table(spark, sf_dir, "events").select(F.concat(F.lit("k"), row.cast("string")).alias("key"), value.alias("value"))
    flat = flatten_event(decode_framed(messages, event_schema(domain)), domain)
    routed = domain_messages(check_domain(flat, domain), domain, AS_OF)
    body = F.from_json("value", "error_reason string, kafka_key string, raw_payload_base64 string, failed_at timestamp")
    return routed.select("key", "topic", body.alias("body")).select(
        "key",
        "topic",
        "body.error_reason",
        "body.kafka_key",
        "body.raw_payload_base64",
        F.col("body.failed_at").isNotNull().alias("stamped"),
    )


def _json_query(name: str) -> None:
    """Both outputs of a stream with the content of every field, as written and as read back."""
    domain = DOMAINS[name]
    kinds = {"string": "VARCHAR", "double": "DOUBLE"}
    columns = {**_ENVELOPE, **domain.columns}
    cast = {c: f"CAST({c} AS {kinds[k]})" for c, k in columns.items()}
    kafka_key = f"coalesce({cast[domain.key]}, {cast['event_id']})" if domain.keeps_kafka_key else "CAST(NULL AS VARCHAR)"
    reason = "error_reason" if domain.error_on_valid else "nullif(error_reason, '')"
    listed = {"kafka_key": kafka_key, **cast, "error_reason": reason}
    keys = ", ".join(f"CASE WHEN {sql} IS NOT NULL THEN '{c}' END" for c, sql in listed.items())
    stamp = "CASE WHEN error_reason = '' THEN 'validated_at' ELSE 'failed_at' END"

    @query(
        f"SELECT CASE WHEN error_reason = '' THEN {cast[domain.key]} ELSE {cast['event_id']} END AS key, "
        f"concat_ws(',', {keys}, {stamp}) AS json_keys, {', '.join(f'{sql} AS {c}' for c, sql in listed.items())}, "
        f"CAST({_STAMP} AS BIGINT) AS stamp FROM {checked_sql(name)}",
        f"json_{name.split('.')[1]}",
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        routed = domain_messages(check_domain(decoded_events(spark, sf_dir, name), domain), domain, AS_OF)
        fields = ", ".join(f"{c} {k}" for c, k in {"kafka_key": "string", **columns, "error_reason": "string"}.items())
        body = F.from_json("value", f"{fields}, validated_at timestamp, failed_at timestamp").alias("body")
        return routed.select("key", F.array_join(F.json_object_keys("value"), ",").alias("json_keys"), body).select(
            "key",
            "json_keys",
            *[F.col(f"body.{c}").alias(c) for c in listed],
            F.coalesce("body.validated_at", "body.failed_at").cast("long").alias("stamp"),
        )


for _name in DOMAINS:
    _json_query(_name)
