"""Column names and types of the layer tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW_TRANSACTIONS = (
    "idx bigint, transaction_id string, user_id string, transaction_date timestamp_ntz, "
    "product_category string, product_name string, merchant_name string, "
    "product_amount double, transaction_fee double, cashback double, loyalty_points bigint, "
    "payment_method string, transaction_status string, merchant_id string, "
    "device_type string, location string"
)

DAILY_BATCH = (
    "transaction_id string, customer_id string, transaction_timestamp timestamp_ntz, "
    "merchant_id string, merchant_name string, product_category string, product_name string, "
    "amount double, fee_amount double, cashback_amount double, loyalty_points bigint, "
    "payment_method string, transaction_status string, device_type string, "
    "location_type string, currency string, updated_at timestamp_ntz"
)

SILVER = (
    "transaction_id string, product_category string, product_name string, "
    "loyalty_points bigint, payment_method string, transaction_status string, "
    "merchant_id string, device_type string, customer_id string, "
    "transaction_timestamp timestamp_ntz, merchant_name string, amount decimal(18,2), "
    "fee_amount decimal(18,2), cashback_amount decimal(18,2), location_type string, "
    "currency string, loaded_at timestamp, source_system string"
)

DIM_CUSTOMERS = (
    "customer_key bigint, customer_id string, customer_name string, email string, "
    "phone string, country string, city string, customer_segment string, "
    "registration_date date, is_verified boolean, risk_score double, "
    "effective_start_date timestamp, effective_end_date timestamp, is_current boolean, "
    "created_at timestamp, updated_at timestamp"
)

DIM_MERCHANTS = (
    "merchant_key bigint, merchant_id string, merchant_name string, business_type string, "
    "industry string, country string, website string, onboarding_date date, "
    "settlement_frequency string, is_active boolean, created_at timestamp, updated_at timestamp"
)

DIM_PAYMENT_METHODS = (
    "payment_method_key bigint, payment_method_name string, method_type string, "
    "requires_verification boolean, average_processing_time_ms bigint, is_instant boolean, "
    "created_at timestamp, updated_at timestamp"
)

DIM_TRANSACTION_STATUS = (
    "status_key bigint, status_name string, status_category string, is_terminal boolean, "
    "display_order bigint, created_at timestamp, updated_at timestamp"
)

DIM_LOCATION = (
    "location_key bigint, location_type string, region string, state string, "
    "country string, timezone string, created_at timestamp, updated_at timestamp"
)

DIM_DATE = (
    "date_key bigint, full_date date, day_of_month bigint, day_of_week_number bigint, "
    "day_of_week_name string, week_of_year bigint, month_number bigint, month_name string, "
    "quarter bigint, year bigint, is_weekend boolean, is_holiday boolean, "
    "fiscal_year bigint, fiscal_quarter bigint"
)

FACT_TRANSACTIONS = (
    "customer_key bigint, merchant_key bigint, payment_method_key bigint, status_key bigint, "
    "location_key bigint, date_key bigint, transaction_id string, product_category string, "
    "product_name string, device_type string, amount decimal(18,2), fee_amount decimal(18,2), "
    "cashback_amount decimal(18,2), loyalty_points bigint, net_customer_amount decimal(18,2), "
    "merchant_net_amount decimal(18,2), gateway_revenue decimal(18,2), "
    "transaction_timestamp timestamp_ntz, currency string, is_refunded boolean, "
    "refund_amount decimal(18,2), refund_date timestamp, attempt_number bigint, "
    "loaded_at timestamp, source_system string, created_at timestamp, updated_at timestamp"
)


def struct(ddl: str) -> StructType:
    """The StructType of a DDL schema string."""
    return StructType.fromDDL(ddl)


def column_types(ddl: str) -> dict[str, str]:
    """Column name to simple type name, in order; needs no session."""
    return dict(column.split(" ", 1) for column in ddl.split(", "))
