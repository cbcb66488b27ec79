"""Small literal tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from decimal import Decimal

from tallyhouse import schemas
from tallyhouse.operators import dimensions
from tallyhouse.operators.fact import Dimensions, build_fact
from tallyhouse.session import stage

AT = datetime(2024, 12, 1)


def ts(text: str) -> datetime:
    return datetime.fromisoformat(text)


def silver(spark, rows):
    """Conformed rows from dicts; everything not given has a plain default."""
    base = {
        "transaction_id": None, "product_category": "Food", "product_name": "Tea",
        "loyalty_points": 1, "payment_method": "UPI", "transaction_status": "Successful",
        "merchant_id": "MERCH_0001", "device_type": "Web", "customer_id": "USER_0001",
        "transaction_timestamp": ts("2024-01-15 10:00:00"), "merchant_name": "Shop",
        "amount": Decimal("100.00"), "fee_amount": Decimal("2.00"),
        "cashback_amount": Decimal("1.00"), "location_type": "Urban", "currency": "INR",
        "loaded_at": AT, "source_system": "test",
    }
    filled = []
    for i, row in enumerate(rows):
        full = base | {"transaction_id": f"T{i}"} | row
        for c in ("amount", "fee_amount", "cashback_amount"):
            full[c] = None if full[c] is None else Decimal(str(full[c]))
        filled.append(tuple(full[c] for c in base))
    return spark.createDataFrame(filled, schemas.SILVER)


def batches(spark, rows):
    """Daily batch rows from dicts, with ``batch_day``."""
    base = {
        "transaction_id": None, "customer_id": "USER_0001",
        "transaction_timestamp": ts("2024-11-02 10:00:00"), "merchant_id": "MERCH_0001",
        "merchant_name": "Shop", "product_category": "Food", "product_name": "Tea",
        "amount": Decimal("10.00"), "fee_amount": Decimal("0.20"),
        "cashback_amount": Decimal("0.10"), "loyalty_points": 1, "payment_method": "UPI",
        "transaction_status": "Successful", "device_type": "Web", "location_type": "Urban",
        "currency": "INR", "updated_at": ts("2024-11-02 10:00:00"),
        "batch_day": ts("2024-11-02").date(),
    }
    filled = []
    for i, row in enumerate(rows):
        full = base | {"transaction_id": f"T{i}"} | row
        full["amount"] = Decimal(str(full["amount"]))
        filled.append(tuple(full[c] for c in base))
    schema = schemas.DAILY_BATCH.replace("double", "decimal(18,2)") + ", batch_day date"
    return spark.createDataFrame(filled, schema)


def star(spark, rows):
    """Written conformed table, dimensions and fact of the given rows."""
    table = stage(silver(spark, rows), "silver")
    builds = [dimensions.dim_customers, dimensions.dim_merchants, dimensions.dim_payment_methods,
              dimensions.dim_transaction_status, dimensions.dim_location]
    with ThreadPoolExecutor(len(builds)) as pool:
        built = list(pool.map(lambda build: stage(build(table, AT), build.__name__), builds))
    dims = Dimensions(*built, dimensions.dim_date(spark))
    return table, dims, stage(build_fact(table, dims, AT), "fact")
