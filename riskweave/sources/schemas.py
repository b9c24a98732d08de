"""Declared schemas of the risk tables (money is DECIMAL(18,2))."""

from pyspark.sql.types import (BooleanType, DateType, DecimalType, DoubleType,
                               IntegerType, LongType, StringType, StructField,
                               StructType)

MONEY = DecimalType(18, 2)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


COUNTERPARTY = _s(
    ("counterparty_code", StringType()), ("canonical_name", StringType()),
    ("ultimate_parent", StringType()), ("regulatory_regime", StringType()),
    ("threshold_amount", MONEY), ("entity_search_field", StringType()))

DATE_DIM = _s(
    ("trade_date", DateType()), ("month_name", StringType()),
    ("month_number", IntegerType()), ("quarter_name", StringType()),
    ("year_number", IntegerType()))

TRADES = _s(
    ("trade_id", StringType()), ("trade_date", DateType()),
    ("counterparty_code", StringType()), ("booked_name", StringType()),
    ("source_system", StringType()), ("margin_type", StringType()),
    ("exposure_amount", MONEY), ("call_amount", MONEY),
    ("resolution_status", StringType()))

LEGAL_ENTITY = _s(
    ("lei_code", StringType()), ("ultimate_parent_lei", StringType()),
    ("ultimate_parent_name", StringType()), ("legal_entity_name", StringType()),
    ("counterparty_code", StringType()), ("entity_type", StringType()),
    ("incorporation_country", StringType()),
    ("regulatory_jurisdiction", StringType()),
    ("is_ultimate_parent", BooleanType()))

NAME_VARIANTS = _s(
    ("variant_id", StringType()), ("counterparty_code", StringType()),
    ("variant_name", StringType()), ("source_system", StringType()),
    ("variant_type", StringType()), ("is_canonical", BooleanType()),
    ("canonical_name", StringType()), ("risk_impact", StringType()))

ANOMALY_EXPOSURE = _s(
    ("anomaly_id", StringType()), ("variant_id", StringType()),
    ("counterparty_code", StringType()), ("booked_name", StringType()),
    ("as_of_date", DateType()), ("margin_type", StringType()),
    ("base_total_exposure", MONEY), ("base_call_amount", MONEY),
    ("im_requirement", MONEY), ("source_system", StringType()),
    ("is_resolved", BooleanType()))

COLLATERAL_EXPOSURE = _s(
    ("event_id", StringType()), ("agreement_id", StringType()),
    ("counterparty_code", StringType()), ("as_of_date", DateType()),
    ("csa_type_key", IntegerType()), ("margin_type", StringType()),
    ("call_status", StringType()), ("action", StringType()),
    ("reporting_currency", StringType()), ("base_total_exposure", MONEY),
    ("itm_exposure", MONEY), ("otm_exposure", MONEY),
    ("base_call_amount", MONEY), ("agreed_amount", MONEY),
    ("im_requirement", MONEY), ("threshold_principal", MONEY),
    ("threshold_counterparty", MONEY), ("min_transfer_principal", MONEY),
    ("min_transfer_cp", MONEY), ("dispute_amount", MONEY),
    ("dispute_age", IntegerType()), ("is_disputed", BooleanType()))

CONSUMER_REGISTRY = _s(
    ("consumer_id", StringType()), ("consumer_type", StringType()),
    ("consumer_owner", StringType()), ("consumer_platform", StringType()),
    ("producer_product", StringType()), ("producer_version", StringType()),
    ("registered_date", DateType()), ("last_validated_date", DateType()),
    ("business_critical", BooleanType()))

COLUMN_TAGS = _s(
    ("table_catalog", StringType()), ("table_schema", StringType()),
    ("table_name", StringType()), ("column_name", StringType()),
    ("tag_name", StringType()), ("tag_value", StringType()))

CURVE_QUOTES = _s(
    ("curve_id", StringType()), ("tenor_y", DoubleType()),
    ("spread_bp", DoubleType()))

PATH_VALUES = _s(
    ("netting_set", StringType()), ("trade_id", StringType()),
    ("scenario", StringType()), ("path_id", LongType()),
    ("time_y", DoubleType()), ("value", MONEY))
