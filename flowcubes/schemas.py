"""Typed schemas: raw landed JSON, the flat order table and the six cubes."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source service's vocabulary: statuses, metric
# names in publication order, cube dimensions, raw fields and published columns.
# ---------------------------------------------------------------------------
FILLED = "TRADE_STATUS_FULLY_FILLED"
FAILED = "TRADE_STATUS_FAILED"
KNOWN_STATUSES = (FILLED, FAILED)

# The six cube metrics, in publication order.
METRICS = (
    "finalized_orders_volume_usd",
    "filled_orders_volume_usd",
    "protocol_fees_usd",
    "integrator_fees_usd",
    "finalized_orders_count",
    "unique_trader_wallets_count",
)
# Both volume metrics are priced on the input side of a trade, so a cube keyed
# by the bought asset cannot carry them.
INPUT_SIDE_VOLUME = ("finalized_orders_volume_usd", "filled_orders_volume_usd")
ADDITIVE_METRICS = METRICS[:5]

PAIR = ("src_chain_id", "dst_chain_id")
CUBE_DIMENSIONS: dict[str, tuple[str, ...]] = {
    "daily_total": (),
    "daily_chainpair": (*PAIR, "status"),
    "daily_resolver": (*PAIR, "resolver_id", "status"),
    "daily_input_asset": (*PAIR, "input_asset_chain", "input_asset_kind", "input_asset_address"),
    "daily_output_asset": (*PAIR, "output_asset_chain", "output_asset_kind", "output_asset_address"),
    "daily_integrator": (*PAIR, "integrator_chain", "integrator_address"),
}
ORDERS_TABLE = "orders"
TABLES = (*CUBE_DIMENSIONS, ORDERS_TABLE)


def cube_metrics(table: str) -> tuple[str, ...]:
    if table == "daily_output_asset":
        return tuple(m for m in METRICS if m not in INPUT_SIDE_VOLUME)
    return METRICS


# ---------------------------------------------------------------------------
# Raw landed JSON (bronze)
# ---------------------------------------------------------------------------
ASSET = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))
CHAIN_ADDRESS = T.MapType(T.StringType(), T.StringType())

UNIT_FIELDS = (
    "quote_input_units",
    "quote_output_units",
    "actual_input_units",
    "actual_output_units",
    "actual_protocol_fee_units",
    "actual_integrator_fee_units",
)
ADDRESS_FIELDS = (
    "src_trader_address",
    "dst_trader_address",
    "src_resolver_address",
    "dst_resolver_address",
    "integrator_address",
)
CLOCK_FIELDS = ("quote_request_time", "quote_time", "order_create_time", "order_finalize_time")

RAW_ORDER = T.StructType(
    [
        T.StructField("lt", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("quote_id", T.StringType()),
        T.StructField("resolver_id", T.StringType()),
        T.StructField("input_asset", ASSET),
        T.StructField("output_asset", ASSET),
        *[T.StructField(f, T.StringType()) for f in UNIT_FIELDS],
        T.StructField("integrator_fee_pips", T.StringType()),
        T.StructField("protocol_fee_pips", T.StringType()),
        *[T.StructField(f, CHAIN_ADDRESS) for f in ADDRESS_FIELDS],
        *[T.StructField(f, T.StringType()) for f in CLOCK_FIELDS],
    ]
)
ORDER_PAGE = T.StructType(
    [
        T.StructField(
            "result",
            T.StructType(
                [
                    T.StructField("orders", T.ArrayType(RAW_ORDER)),
                    T.StructField("has_next_page", T.BooleanType()),
                ]
            ),
        )
    ]
)

RAW_CUBE_ROW = T.StructType(
    [
        T.StructField("time_period", T.StringType()),
        T.StructField("src_chain_id", T.StringType()),
        T.StructField("dst_chain_id", T.StringType()),
        T.StructField("resolver_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("input_asset", ASSET),
        T.StructField("output_asset", ASSET),
        *[T.StructField(f, CHAIN_ADDRESS) for f in ADDRESS_FIELDS],
        *[T.StructField(m, T.StringType()) for m in METRICS],
    ]
)
CUBE_PAGE = T.StructType(
    [T.StructField("result", T.StructType([T.StructField("rows", T.ArrayType(RAW_CUBE_ROW))]))]
)

# ---------------------------------------------------------------------------
# Published tables (silver / gold)
# ---------------------------------------------------------------------------
_S, _D = T.StringType(), T.DoubleType()

ORDERS = T.StructType(
    [
        T.StructField("lt", _S, nullable=False),
        T.StructField("run_ts", T.TimestampType(), nullable=False),
        T.StructField("status", _S),
        T.StructField("quote_id", _S),
        T.StructField("src_chain_id", _S),
        T.StructField("dst_chain_id", _S),
        T.StructField("input_asset_chain", _S),
        T.StructField("input_asset_kind", _S),
        T.StructField("input_asset_address", _S),
        T.StructField("output_asset_chain", _S),
        T.StructField("output_asset_kind", _S),
        T.StructField("output_asset_address", _S),
        *[T.StructField(f, _S) for f in UNIT_FIELDS],
        T.StructField("integrator_fee_pips", _D),
        T.StructField("protocol_fee_pips", _D),
        T.StructField("resolver_id", _S),
        T.StructField("src_trader_chain", _S),
        T.StructField("src_trader_address", _S),
        T.StructField("dst_trader_chain", _S),
        T.StructField("dst_trader_address", _S),
        T.StructField("src_resolver_chain", _S),
        T.StructField("src_resolver_address", _S),
        T.StructField("dst_resolver_chain", _S),
        T.StructField("dst_resolver_address", _S),
        T.StructField("integrator_chain", _S),
        T.StructField("integrator_address", _S),
        *[T.StructField(f, _D) for f in CLOCK_FIELDS],
        T.StructField("t_quote", _D),
        T.StructField("t_decide", _D),
        T.StructField("t_settle", _D),
        T.StructField("t_total", _D),
    ]
)

# Columns the silver order table carries beside the published ones: the
# creation-day partition key, a numeric seek key and exact USD amounts.
USD = T.DecimalType(18, 2)
FEE_USD = T.DecimalType(24, 4)
# Amounts priced from raw units: tokens carry up to 18 decimals, none is cut.
EXACT_USD = T.DecimalType(38, 18)
SILVER_EXTRAS = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("lt_num", T.LongType()),
        T.StructField("finalized_usd", EXACT_USD),
        T.StructField("filled_usd", EXACT_USD),
        T.StructField("protocol_fee_usd", EXACT_USD),
        T.StructField("integrator_fee_usd", EXACT_USD),
    ]
)
# Columns that differ from order to order: a dictionary of them only takes room.
PER_ORDER = ("lt", "lt_num", "quote_id", *UNIT_FIELDS, "finalized_usd", "filled_usd", "protocol_fee_usd", "integrator_fee_usd")


def cube_schema(table: str) -> T.StructType:
    fields = [
        T.StructField("day", T.DateType(), nullable=False),
        T.StructField("run_ts", T.TimestampType(), nullable=False),
    ]
    fields += [T.StructField(d, _S) for d in CUBE_DIMENSIONS[table]]
    fields += [T.StructField(m, _D) for m in cube_metrics(table)]
    return T.StructType(fields)


def table_schema(table: str) -> T.StructType:
    return ORDERS if table == ORDERS_TABLE else cube_schema(table)


def required_columns(table: str) -> list[str]:
    return [f.name for f in table_schema(table).fields if not f.nullable]
