"""Fixed schemas of the domain tables."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _I, _L, _D, _TS = (T.StringType(), T.IntegerType(), T.LongType(),
                       T.DoubleType(), T.TimestampType())

CORRUPT = "_corrupt_record"

# --- event streams -----------------------------------------------------------
ENVELOPE = _struct(value=_S, timestamp=_TS, partition=_I, offset=_L)

SHIPMENT = _struct(
    shipment_id=_S, event_type=_S, carrier_code=_S, service_type=_S, origin_wh=_S,
    dest_city=_S, dest_country=_S, weight_kg=_D, promised_eta=_S, event_ts=_S,
    latitude=_D, longitude=_D, delay_minutes=_I, notes=_S)

CARRIER_UPDATE = _struct(
    carrier_code=_S, region=_S, active_shipments=_I, on_time_rate=_D,
    avg_delay_minutes=_D, report_ts=_S)

WAREHOUSE_OP = _struct(
    warehouse_id=_S, operation=_S, shipment_id=_S, operator_id=_S, dock_door=_I, op_ts=_S)

ALERT_COLUMNS = [
    "shipment_id", "event_type", "carrier_code", "service_type", "delay_minutes",
    "delay_severity", "sla_breached", "origin_wh", "dest_city", "event_ts", "notes"]

ALERT = _struct(
    shipment_id=_S, event_type=_S, carrier_code=_S, service_type=_S, delay_minutes=_I,
    delay_severity=_S, sla_breached=T.BooleanType(), origin_wh=_S, dest_city=_S,
    event_ts=_TS, notes=_S, alert_generated_at=_TS)

CARRIER_KPI = _struct(
    carrier_code=_S, window_start=_TS, window_end=_TS, total_events=_L, delayed_events=_L,
    avg_delay_minutes=_D, sla_breach_rate=_D, p95_delay_minutes=_I)

# --- commerce ----------------------------------------------------------------
ORDER_TIMES = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date"]

# The eight raw tables, in load order.
RAW_COMMERCE = [
    "orders", "order_items", "customers", "products",
    "sellers", "order_payments", "order_reviews", "category_translation"]

# --- indicators --------------------------------------------------------------
INDICATOR = _struct(
    country_code=_S, country_name=_S, indicator_code=_S, indicator_name=_S,
    year=_I, value=_D, loaded_at=_TS)

PAYLOAD_RECORDS = T.ArrayType(_struct(
    country=_struct(value=_S), countryiso3code=_S, date=_S, value=_S))
