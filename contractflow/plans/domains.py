"""The nine business event streams as data: payload columns, business key and rules."""

from __future__ import annotations

from dataclasses import dataclass

from contractflow.plans.rules import Rule


@dataclass(frozen=True)
class Domain:
    name: str
    key: str
    columns: dict[str, str]
    rules: tuple[Rule, ...]
    keeps_kafka_key: bool = False
    error_on_valid: bool = True
    """Whether certified rows carry the (empty) error_reason in their JSON."""

    @property
    def bronze_topic(self) -> str:
        return f"bronze.{self.name}"

    @property
    def silver_topic(self) -> str:
        return f"silver.{self.name}"

    @property
    def dlq_topic(self) -> str:
        return f"dlq.{self.name}"


def _missing(name: str) -> Rule:
    return Rule(f"{name} is null", "missing", name)


def _positive(name: str) -> Rule:
    return Rule(f"{name} must be positive", "not_positive", name)


def _one_of(name: str, *values: str) -> Rule:
    return Rule(f"{name} is invalid", "unknown_value", name, {"values": list(values)})


def _within(name: str, low: float, high: float) -> Rule:
    return Rule(f"{name} out of range", "out_of_range", name, {"min": low, "max": high})


ENVELOPE = ("event_id", "domain", "event_type", "produced_at")

# Columns, keys, value lists, bounds and rule order of the nine streams.
DOMAINS = {
    d.name: d
    for d in (
        Domain(
            "sales.transactions",
            "transaction_id",
            {
                "transaction_id": "string",
                "customer_id": "string",
                "store_id": "string",
                "amount": "double",
                "currency": "string",
                "payment_method": "string",
                "transaction_time": "string",
            },
            (
                _missing("transaction_id"),
                _positive("amount"),
                _one_of("currency", "MAD", "EUR", "USD"),
                _one_of("payment_method", "CARD", "CASH", "TRANSFER"),
            ),
            error_on_valid=False,
        ),
        Domain(
            "sales.customers",
            "customer_id",
            {
                "customer_id": "string",
                "full_name": "string",
                "email": "string",
                "city": "string",
                "customer_segment": "string",
                "registration_time": "string",
            },
            (
                _missing("customer_id"),
                _one_of("customer_segment", "RETAIL", "PREMIUM", "ENTERPRISE"),
                _missing("email"),
            ),
            keeps_kafka_key=True,
        ),
        Domain(
            "sales.products",
            "product_id",
            {
                "product_id": "string",
                "product_name": "string",
                "category": "string",
                "price": "double",
                "currency": "string",
                "updated_at": "string",
            },
            (
                _missing("product_id"),
                _positive("price"),
                _one_of("currency", "MAD", "EUR", "USD"),
                _one_of("category", "ELECTRONICS", "ACCESSORIES", "COMPUTING"),
            ),
            keeps_kafka_key=True,
        ),
        Domain(
            "logistics.shipments",
            "shipment_id",
            {
                "shipment_id": "string",
                "vehicle_id": "string",
                "origin_city": "string",
                "destination_city": "string",
                "status": "string",
                "weight_kg": "double",
                "event_time": "string",
            },
            (
                _missing("shipment_id"),
                _missing("vehicle_id"),
                _one_of("status", "CREATED", "IN_TRANSIT", "DELIVERED", "CANCELLED"),
                _positive("weight_kg"),
            ),
        ),
        Domain(
            "logistics.vehicles",
            "vehicle_id",
            {
                "vehicle_id": "string",
                "vehicle_type": "string",
                "capacity_kg": "double",
                "status": "string",
                "updated_at": "string",
            },
            (
                _missing("vehicle_id"),
                _positive("capacity_kg"),
                _one_of("status", "ACTIVE", "MAINTENANCE", "INACTIVE"),
            ),
        ),
        Domain(
            "logistics.locations",
            "location_id",
            {
                "location_id": "string",
                "city": "string",
                "country": "string",
                "zone_type": "string",
                "updated_at": "string",
            },
            (
                _missing("location_id"),
                _missing("city"),
                _one_of("zone_type", "WAREHOUSE", "STORE", "HUB", "CUSTOMER_ZONE"),
            ),
        ),
        Domain(
            "sensors.readings",
            "reading_id",
            {
                "reading_id": "string",
                "sensor_id": "string",
                "machine_id": "string",
                "temperature": "double",
                "vibration_level": "double",
                "event_time": "string",
            },
            (
                _missing("reading_id"),
                _missing("sensor_id"),
                _missing("machine_id"),
                _within("temperature", -20, 100),
                _within("vibration_level", 0, 20),
            ),
        ),
        Domain(
            "sensors.machines",
            "machine_id",
            {
                "machine_id": "string",
                "machine_type": "string",
                "site_id": "string",
                "status": "string",
                "installed_at": "string",
            },
            (
                _missing("machine_id"),
                _missing("site_id"),
                _one_of("status", "ACTIVE", "MAINTENANCE", "STOPPED"),
            ),
        ),
        Domain(
            "sensors.alerts",
            "alert_id",
            {
                "alert_id": "string",
                "sensor_id": "string",
                "machine_id": "string",
                "severity": "string",
                "alert_type": "string",
                "event_time": "string",
            },
            (
                _missing("alert_id"),
                _missing("sensor_id"),
                _one_of("severity", "LOW", "MEDIUM", "HIGH", "CRITICAL"),
                _one_of("alert_type", "TEMPERATURE", "VIBRATION", "CONNECTIVITY", "POWER"),
            ),
        ),
    )
}
