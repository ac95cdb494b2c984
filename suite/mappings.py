"""The given tables read as events of the nine streams.

Each mapping is a list of SQL expressions valid in Spark and DuckDB alike. Some values are made
null or unknown by key arithmetic, so that every rule of every stream fires.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractflow import pin
from contractflow.functions import frame
from contractflow.operators import wrap_event
from contractflow.plans import DOMAINS, Domain
from contractflow.sources import as_messages, file_stream, table_stream
from suite.registry import AS_OF, table

# stream -> table, event id, payload columns
MAPPINGS: dict[str, tuple[str, str, dict[str, str]]] = {
    "sales.transactions": (
        "orders",
        "'E' || o_orderkey",
        {
            "transaction_id": "CASE WHEN o_orderkey % 50 <> 0 THEN 'T' || o_orderkey END",
            "customer_id": "'C' || o_custkey",
            "store_id": "'STORE_' || o_orderstatus",
            "amount": "o_totalprice - 5000",
            "currency": "CASE WHEN o_orderkey % 20 = 7 THEN 'INVALID' WHEN o_orderkey % 3 = 0 THEN 'MAD' "
            "WHEN o_orderkey % 3 = 1 THEN 'EUR' ELSE 'USD' END",
            "payment_method": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'CARD' WHEN '2' THEN 'CASH' "
            "WHEN '3' THEN 'TRANSFER' WHEN '5' THEN 'CHEQUE' END",
            "transaction_time": "CAST(o_orderdate AS STRING)",
        },
    ),
    "sales.customers": (
        "customer",
        "'E' || c_custkey",
        {
            "customer_id": "CASE WHEN c_custkey % 40 <> 0 THEN 'C' || c_custkey END",
            "full_name": "c_name",
            "email": "CASE WHEN c_custkey % 25 <> 3 THEN c_name || '@example.com' END",
            "city": "'CITY_' || c_nationkey",
            "customer_segment": "CASE c_mktsegment WHEN 'MACHINERY' THEN 'UNKNOWN' WHEN 'BUILDING' THEN 'RETAIL' "
            "WHEN 'AUTOMOBILE' THEN 'PREMIUM' ELSE 'ENTERPRISE' END",
            "registration_time": "'2024-01-01T00:00:00+00:00'",
        },
    ),
    "sales.products": (
        "part",
        "'E' || p_partkey",
        {
            "product_id": "CASE WHEN p_partkey % 30 <> 0 THEN 'P' || p_partkey END",
            "product_name": "p_name",
            "category": "CASE p_type WHEN 'PROMO' THEN 'OTHER' WHEN 'ECONOMY' THEN 'ACCESSORIES' "
            "WHEN 'SMALL' THEN 'ACCESSORIES' WHEN 'STANDARD' THEN 'COMPUTING' ELSE 'ELECTRONICS' END",
            "price": "p_retailprice - 910",
            "currency": "CASE WHEN p_size > 45 THEN 'INVALID' ELSE 'MAD' END",
            "updated_at": "'2024-01-01T00:00:00+00:00'",
        },
    ),
    "logistics.shipments": (
        "lineitem",
        "'E' || l_orderkey || '-' || l_linenumber",
        {
            "shipment_id": "CASE WHEN l_partkey % 60 <> 0 THEN 'S' || l_orderkey END",
            "vehicle_id": "CASE WHEN l_suppkey <> 0 THEN 'V' || l_suppkey END",
            "origin_city": "'CITY_' || (l_partkey % 25)",
            "destination_city": "'CITY_' || (l_suppkey % 25)",
            "status": "CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'CANCELLED' WHEN 'AF' THEN 'DELIVERED' "
            "WHEN 'NO' THEN 'CREATED' WHEN 'RO' THEN 'DELAYED' ELSE 'IN_TRANSIT' END",
            "weight_kg": "l_quantity - 2",
            "event_time": "CAST(l_shipdate AS STRING)",
        },
    ),
    "logistics.vehicles": (
        "supplier",
        "'E' || s_suppkey",
        {
            "vehicle_id": "CASE WHEN s_suppkey % 20 <> 0 THEN 'V' || s_suppkey END",
            "vehicle_type": "CASE WHEN s_suppkey % 2 = 0 THEN 'TRUCK' ELSE 'VAN' END",
            "capacity_kg": "s_acctbal",
            "status": "CASE s_nationkey % 5 WHEN 0 THEN 'RETIRED' WHEN 1 THEN 'MAINTENANCE' "
            "WHEN 2 THEN 'INACTIVE' ELSE 'ACTIVE' END",
            "updated_at": "'2024-01-01T00:00:00+00:00'",
        },
    ),
    "logistics.locations": (
        "nation",
        "'E' || n_nationkey",
        {
            "location_id": "CASE WHEN n_nationkey <> 24 THEN 'L' || n_nationkey END",
            "city": "CASE WHEN n_nationkey % 10 <> 3 THEN n_name END",
            "country": "n_name",
            "zone_type": "CASE n_regionkey WHEN 0 THEN 'WAREHOUSE' WHEN 1 THEN 'STORE' WHEN 2 THEN 'HUB' "
            "WHEN 3 THEN 'CUSTOMER_ZONE' ELSE 'PORT' END",
            "updated_at": "'2024-01-01T00:00:00+00:00'",
        },
    ),
    "sensors.readings": (
        "events",
        "'E' || event_id",
        {
            "reading_id": "CASE WHEN event_id % 100 <> 0 THEN 'R' || event_id END",
            "sensor_id": "CASE WHEN user_id <> 7 THEN 'S' || user_id END",
            "machine_id": "CASE WHEN user_id <> 149 THEN 'M' || user_id END",
            "temperature": "value - 25",
            "vibration_level": "(user_id - 10) / CAST(5 AS DOUBLE)",
            "event_time": "CAST(ts AS STRING)",
        },
    ),
    "sensors.machines": (
        "supplier",
        "'E' || s_suppkey",
        {
            "machine_id": "CASE WHEN s_suppkey % 20 <> 0 THEN 'M' || s_suppkey END",
            "machine_type": "CASE WHEN s_suppkey % 2 = 0 THEN 'PUMP' ELSE 'CNC' END",
            "site_id": "CASE WHEN s_nationkey <> 0 THEN 'SITE_' || s_nationkey END",
            "status": "CASE s_nationkey % 4 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'STOPPED' "
            "ELSE 'MAINTENANCE' END",
            "installed_at": "'2024-01-01T00:00:00+00:00'",
        },
    ),
    "sensors.alerts": (
        "events",
        "'E' || event_id",
        {
            "alert_id": "CASE WHEN event_id % 100 <> 0 THEN 'A' || event_id END",
            "sensor_id": "CASE WHEN user_id <> 7 THEN 'S' || user_id END",
            "machine_id": "'M' || user_id",
            "severity": "CASE event_type WHEN 'error' THEN 'EMERGENCY' WHEN 'click' THEN 'LOW' WHEN 'view' THEN 'MEDIUM' "
            "WHEN 'signup' THEN 'HIGH' ELSE 'CRITICAL' END",
            "alert_type": "CASE event_id % 5 WHEN 0 THEN 'TEMPERATURE' WHEN 1 THEN 'VIBRATION' "
            "WHEN 2 THEN 'CONNECTIVITY' WHEN 3 THEN 'POWER' ELSE 'OVERHEATING' END",
            "event_time": "CAST(ts AS STRING)",
        },
    ),
}
PRODUCED_AT = "2024-01-25T00:00:00.000000+00:00"
SCHEMA_ID = 7


def envelope_columns(name: str) -> dict[str, str]:
    """The flattened event, envelope first, as SQL expressions."""
    _, event_id, payload = MAPPINGS[name]
    domain, kind = name.split(".")
    return {
        "event_id": event_id,
        "domain": f"'{domain}'",
        "event_type": f"'{kind}_event'",
        "produced_at": f"'{PRODUCED_AT}'",
        **payload,
    }


def events_sql(name: str) -> str:
    columns = ", ".join(f"{expression} AS {column}" for column, expression in envelope_columns(name).items())
    return f"(SELECT {columns} FROM {MAPPINGS[name][0]})"


def events_of(df: DataFrame, name: str) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {column}" for column, expression in envelope_columns(name).items()])


def flat_events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return events_of(table(spark, sf_dir, MAPPINGS[name][0]), name)


def messages_of(df: DataFrame, domain: Domain) -> DataFrame:
    """Table rows as framed messages of a stream, keyed by business id."""
    flat = events_of(df, domain.name)
    group, kind = domain.name.split(".")
    wrapped = wrap_event(flat, group, f"{kind}_event", AS_OF, list(domain.columns), F.col("event_id"))
    return as_messages(
        wrapped,
        F.coalesce(F.col(domain.key), F.col("event.event_id")),
        frame(F.to_json("event"), F.lit(SCHEMA_ID)),
        domain.bronze_topic,
        F.lit(0),
        F.lit(AS_OF),
    )


# Messages written beforehand, by stream; the benchmark fills it so as not to time their making.
PREPARED: dict[str, str] = {}


def prepare(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Write the messages of all streams and of the events table once and read them from there from now on."""
    made = {name: domain_messages_of(spark, sf_dir, name) for name in DOMAINS}
    made["events"] = event_messages(table(spark, sf_dir, "events"))
    for name, messages in made.items():
        messages.write.parquet(f"{folder}/{name}")
        PREPARED[name] = f"{folder}/{name}"


def domain_messages_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in PREPARED:
        return spark.read.parquet(PREPARED[name])
    return messages_of(table(spark, sf_dir, MAPPINGS[name][0]), DOMAINS[name])


def row_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream."""
    return table_stream(pin(spark), sf_dir, f"{name}.parquet")


def domain_message_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in PREPARED:
        return file_stream(pin(spark), PREPARED[name])
    return messages_of(row_stream(spark, sf_dir, MAPPINGS[name][0]), DOMAINS[name])


def event_value() -> Column:
    """An events row as a JSON message of the events contract."""
    return F.to_json(
        F.struct(
            "event_id",
            F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"),
            "user_id",
            "event_type",
            "value",
            "props",
        )
    )


def event_messages(df: DataFrame) -> DataFrame:
    """Rows of the events table as plain JSON messages."""
    if "events" in PREPARED:
        spark = df.sparkSession
        return file_stream(spark, PREPARED["events"]) if df.isStreaming else spark.read.parquet(PREPARED["events"])
    return as_messages(df, F.col("event_id"), event_value(), "bronze.web.events", F.col("event_id"), F.col("ts"))
