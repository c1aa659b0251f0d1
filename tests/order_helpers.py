"""Silver orders for the analytic tests."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from flowcubes import schemas

FF, FAILED = schemas.FILLED, schemas.FAILED

SILVER = T.StructType([f for f in schemas.ORDERS.fields if f.name != "run_ts"] + list(schemas.SILVER_EXTRAS.fields))


def make_orders(spark: SparkSession, rows: list[dict]):
    """Silver orders from partial dicts; money given as numbers."""
    out = []
    for i, r in enumerate(rows):
        r = dict(r)
        r.setdefault("lt", str(1_000 + i))
        r.setdefault("status", FF)
        r.setdefault("src_chain_id", "ton")
        r.setdefault("dst_chain_id", "bnb")
        r.setdefault("src_trader_address", f"w{i}")
        usd = Decimal(str(r.pop("usd", 10)))
        r.setdefault("finalized_usd", usd)
        r.setdefault("filled_usd", usd if r["status"] == FF else Decimal("0"))
        r.setdefault("protocol_fee_usd", Decimal("0"))
        r.setdefault("integrator_fee_usd", Decimal("0"))
        for k in ("finalized_usd", "filled_usd", "protocol_fee_usd", "integrator_fee_usd"):
            r[k] = Decimal(str(r[k]))
        r.setdefault("order_create_time", 1_700_000_000.0)
        if "day" not in r:
            import datetime as dt
            r["day"] = dt.datetime.fromtimestamp(r["order_create_time"], dt.timezone.utc).date()
        r.setdefault("lt_num", int(r["lt"]) if str(r["lt"]).isdigit() else None)
        out.append(tuple(r.get(f.name) for f in SILVER.fields))
    return spark.createDataFrame(out, SILVER)
