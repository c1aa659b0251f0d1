"""Stand-in inputs built from the driver's TPC-H-like tables.

The driver ships no swap data, so the library's inputs are derived from it:

* **orders** -- one order per ``lineitem``, joined to its order, customer,
  supplier, part and both nations/regions. Customer region = source chain,
  supplier region = destination chain, customer = trader, supplier =
  resolver, order priority = integrator, part brand = asset sold, part type =
  asset bought, extended price = USD value (a 2-decimal dollar stablecoin).
* **token dimensions** -- an EVM token list and a revisioned TON jetton list,
  one token per part brand and part type.
* **wallet events** -- signups (the funded-wallet set), purchases (deposits)
  and clicks / views (trades, maker / taker side) from ``events``.

Every frame is lazy; selecting a few columns prunes the scans to them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.address import FRIENDLY_CHAIN
from ..session import ensure_checkpoint_dir, size_shuffles
from .tables import table

# ---------------------------------------------------------------------------
# Fixed values of the stand-in mapping (region -> chain id); any other region
# name becomes its lower-case, underscored self.
# ---------------------------------------------------------------------------
CHAIN_OF_REGION = {
    "AFRICA": "ton",
    "AMERICA": "ethereum",
    "ASIA": "bnb",
    "EUROPE": "polygon",
    "MIDDLE EAST": "arbitrum",
}
EVM_CHAINS = ("ethereum", "bnb", "polygon", "arbitrum")
FAILED_ORDER_STATUS = "P"          # o_orderstatus of a failed order
NO_INTEGRATOR = "4-NOT SPECIFIED"  # o_orderpriority meaning "no integrator"
NATIVE_PART_TYPE = "ECONOMY"       # p_type whose sold asset is the native coin
TOKEN_DECIMALS = 2
# Metadata revisions of every jetton: (symbol rule, decimals, updated at).
# The newest revision has no symbol and must be skipped by the dedupe.
JETTON_REVISIONS = (
    ("lower", 9, "2024-01-01 00:00:00"),
    ("name", TOKEN_DECIMALS, "2024-02-01 00:00:00"),
    ("null", None, "2024-03-01 00:00:00"),
)
# Event roles in ``events.event_type``.
SIGNUP, DEPOSIT, MAKER, TAKER, UNPRICED = "signup", "purchase", "click", "view", "error"
EVENTS_AS_OF = "2024-01-31"
# Orders that one task joins: what it sorts stays as large however many there are.
ORDERS_PER_TASK = 100_000


def chain_of(region_name: Column) -> Column:
    expr = None
    for region, chain in CHAIN_OF_REGION.items():
        expr = (F.when(region_name == region, F.lit(chain)) if expr is None
                else expr.when(region_name == region, F.lit(chain)))
    return expr.otherwise(F.lower(F.regexp_replace(region_name, " ", "_")))


def friendly_address(name: Column) -> Column:
    """A TON-style friendly address for a token name: base64url of
    flag, workchain, sha-256 of the name, 2-byte tail."""
    raw = F.concat(F.unhex(F.lit("1100")), F.unhex(F.sha2(name, 256)), F.unhex(F.lit("0000")))
    return F.translate(F.base64(raw), "+/", "-_")


def evm_address(name: Column) -> Column:
    return F.concat(F.lit("0x"), F.hex(name))


def _chains(spark: SparkSession, data_dir: str) -> DataFrame:
    nation = table(spark, data_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, data_dir, "region").select("r_regionkey", "r_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("nationkey"), chain_of(F.col("r_name")).alias("chain")
    )


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ORDERS_PER_TASK))


def order_rows(spark: SparkSession, data_dir: str) -> int:
    """The orders, one of each lineitem."""
    return table(spark, data_dir, "lineitem").count()


def order_tasks(spark: SparkSession, data_dir: str) -> int:
    """Tasks for all orders."""
    return tasks_for(order_rows(spark, data_dir))


def day_orders(spark: SparkSession, data_dir: str) -> DataFrame:
    """``day, orders``: about how many orders a day has, without the join; as
    many lineitems for each row of its orders as there are of all."""
    o = table(spark, data_dir, "orders")
    lines = order_rows(spark, data_dir) / max(1, o.count())
    return o.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg((F.count(F.lit(1)) * F.lit(lines)).alias("orders"))


def orders(spark: SparkSession, data_dir: str) -> DataFrame:
    """The silver order table: the 39 published columns (``run_ts`` aside)
    plus ``day``, ``lt_num`` and exact USD amounts."""
    # Cast before they are shuffled: a few significant bytes instead of a double's eight.
    li = table(spark, data_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("double").alias("t_quote"),
        F.col("l_extendedprice").cast(schemas.USD).alias("vol"),
        F.col("l_discount").cast("decimal(4,2)").alias("disc"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("finalized"),
    )
    o = table(spark, data_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    c = table(spark, data_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, data_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # The names travel; token addresses, several times as long, are made from
    # them after the last shuffle.
    p = table(spark, data_dir, "part").select("p_partkey", "p_type", "p_brand")
    chains = _chains(spark, data_dir)
    src = chains.select(F.col("nationkey").alias("c_nk"), F.col("chain").alias("src_chain_id"))
    dst = chains.select(F.col("nationkey").alias("s_nk"), F.col("chain").alias("dst_chain_id"))

    # Orders is a fact table (a quarter of lineitem's rows): joined by a
    # sort-merge shuffle on the order key, which can spill, and never broadcast,
    # whatever its size here. Customers are joined to it first, as its rows are
    # the fewer. The customer, supplier and part dimensions are left to the size
    # estimate and AQE (broadcast when small, sort-merge when not). Parts, the
    # largest, are joined while the lineitems are narrow, before the columns of
    # their orders are there to be shuffled with them.
    placed = o.join(c, o.o_custkey == c.c_custkey).join(src, F.col("c_nationkey") == F.col("c_nk"))
    rows = order_rows(spark, data_dir)
    # The other joins and the groupings are shuffled to as many tasks as the
    # session says; with fewer, Spark would shuffle both sides of this one again.
    parts = max(tasks_for(rows), size_shuffles(spark, rows))
    j = (
        li.join(p, F.col("l_partkey") == p.p_partkey)
        .repartition(parts, "l_orderkey")
        .join(placed.repartition(parts, "o_orderkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(s, F.col("l_suppkey") == s.s_suppkey)
        .join(dst, F.col("s_nationkey") == F.col("s_nk"))
    )

    settled = F.col("o_orderstatus") != F.lit(FAILED_ORDER_STATUS)
    settled = F.coalesce(settled, F.lit(True))
    integrator = F.when(F.col("o_orderpriority") != F.lit(NO_INTEGRATOR), F.col("o_orderpriority"))
    has_integrator = integrator.isNotNull()
    vol, tax, disc = F.col("vol"), F.col("tax"), F.col("disc")
    cents = (vol * F.lit(100)).cast("decimal(20,0)").cast("string")
    pfee = (vol * tax).cast(schemas.FEE_USD)
    ifee = (vol * disc).cast(schemas.FEE_USD)
    zero_units = F.lit("0")
    created = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double")
    finalized, t_quote = F.col("finalized"), F.col("t_quote")
    t_decide = F.col("l_linenumber").cast("double")
    src_chain, dst_chain = F.col("src_chain_id"), F.col("dst_chain_id")
    native = F.col("p_type") == F.lit(NATIVE_PART_TYPE)
    lt_num = finalized * F.lit(1_000_000_000) + F.pmod(
        F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber"), F.lit(1_000_000_000)
    )

    return j.select(
        lt_num.cast("string").alias("lt"),
        F.when(settled, F.lit(schemas.FILLED)).otherwise(F.lit(schemas.FAILED)).alias("status"),
        F.col("l_orderkey").cast("string").alias("quote_id"),
        src_chain,
        dst_chain,
        src_chain.alias("input_asset_chain"),
        F.when(native, F.lit("native"))
        .when(src_chain == F.lit(FRIENDLY_CHAIN), F.lit("jetton"))
        .otherwise(F.lit("erc20")).alias("input_asset_kind"),
        F.when(native, F.lit(None).cast("string"))
        .when(src_chain == F.lit(FRIENDLY_CHAIN), friendly_address(F.col("p_brand")))
        .otherwise(evm_address(F.col("p_brand"))).alias("input_asset_address"),
        dst_chain.alias("output_asset_chain"),
        F.when(dst_chain == F.lit(FRIENDLY_CHAIN), F.lit("jetton"))
        .otherwise(F.lit("erc20")).alias("output_asset_kind"),
        F.when(dst_chain == F.lit(FRIENDLY_CHAIN), friendly_address(F.col("p_type")))
        .otherwise(evm_address(F.col("p_type"))).alias("output_asset_address"),
        cents.alias("quote_input_units"),
        cents.alias("quote_output_units"),
        F.when(settled, cents).otherwise(zero_units).alias("actual_input_units"),
        F.when(settled, cents).otherwise(zero_units).alias("actual_output_units"),
        F.when(settled, (pfee * F.lit(10_000)).cast("decimal(28,0)").cast("string"))
        .otherwise(zero_units).alias("actual_protocol_fee_units"),
        F.when(settled & has_integrator, (ifee * F.lit(10_000)).cast("decimal(28,0)").cast("string"))
        .otherwise(zero_units).alias("actual_integrator_fee_units"),
        F.when(has_integrator, disc * F.lit(1_000_000)).otherwise(F.lit(0)).cast("double")
        .alias("integrator_fee_pips"),
        (tax * F.lit(1_000_000)).cast("double").alias("protocol_fee_pips"),
        F.col("s_name").alias("resolver_id"),
        src_chain.alias("src_trader_chain"),
        F.col("c_custkey").cast("string").alias("src_trader_address"),
        dst_chain.alias("dst_trader_chain"),
        F.col("c_custkey").cast("string").alias("dst_trader_address"),
        src_chain.alias("src_resolver_chain"),
        F.col("s_suppkey").cast("string").alias("src_resolver_address"),
        dst_chain.alias("dst_resolver_chain"),
        F.col("s_suppkey").cast("string").alias("dst_resolver_address"),
        F.when(has_integrator, src_chain).alias("integrator_chain"),
        integrator.alias("integrator_address"),
        (created - t_decide - t_quote).alias("quote_request_time"),
        (created - t_decide).alias("quote_time"),
        created.alias("order_create_time"),
        finalized.cast("double").alias("order_finalize_time"),
        t_quote.alias("t_quote"),
        t_decide.alias("t_decide"),
        (finalized.cast("double") - created).alias("t_settle"),
        (finalized.cast("double") - (created - t_decide - t_quote)).alias("t_total"),
        F.col("o_orderdate").cast("date").alias("day"),
        lt_num.alias("lt_num"),
        vol.alias("finalized_usd"),
        F.when(settled, vol).otherwise(F.lit(0).cast(schemas.USD)).alias("filled_usd"),
        F.when(settled, pfee).otherwise(F.lit(0).cast(schemas.FEE_USD)).alias("protocol_fee_usd"),
        F.when(settled & has_integrator, ifee).otherwise(F.lit(0).cast(schemas.FEE_USD))
        .alias("integrator_fee_usd"),
    )


def _token_names(spark: SparkSession, data_dir: str) -> DataFrame:
    part = table(spark, data_dir, "part")
    return (
        part.select(F.col("p_brand").alias("name"))
        .union(part.select(F.col("p_type").alias("name")))
        .distinct()
    )


def evm_tokens(spark: SparkSession, data_dir: str) -> DataFrame:
    """``blockchain, contract_address (binary), symbol, decimals``."""
    names = _token_names(spark, data_dir)
    return names.select(
        F.explode(F.array(*[F.lit(c) for c in EVM_CHAINS])).alias("blockchain"),
        F.col("name").cast("binary").alias("contract_address"),
        F.col("name").alias("symbol"),
        F.lit(TOKEN_DECIMALS).alias("decimals"),
    )


def jetton_metadata(spark: SparkSession, data_dir: str) -> DataFrame:
    """``address ('0:HEX'), symbol, decimals, _updated_at``, several revisions
    per address."""
    names = _token_names(spark, data_dir)
    name = F.col("name")
    symbol_of = {"lower": F.lower(name), "name": name, "null": F.lit(None).cast("string")}
    revisions = F.array(
        *[
            F.struct(
                symbol_of[rule].alias("symbol"),
                F.lit(decimals).cast("int").alias("decimals"),
                F.lit(updated).cast("timestamp").alias("_updated_at"),
            )
            for rule, decimals, updated in JETTON_REVISIONS
        ]
    )
    return names.select(
        F.concat(F.lit("0:"), F.upper(F.sha2(name, 256))).alias("address"),
        F.explode(revisions).alias("r"),
    ).select("address", "r.symbol", "r.decimals", "r._updated_at")


def stable_symbols(spark: SparkSession | None = None) -> tuple[str, ...]:
    """The symbols treated as dollar stablecoins in the stand-in data: the
    first twenty part brands (brands 21-25 stay unpriced)."""
    return tuple(f"Brand#{i}" for i in range(1, 21))


# ---------------------------------------------------------------------------
# Wallet events
# ---------------------------------------------------------------------------
def _events(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "events")


def deposit_wallets(spark: SparkSession, data_dir: str) -> DataFrame:
    """``addr``: the verified wallet set (every user with a signup)."""
    ev = _events(spark, data_dir)
    return ev.where(F.col("event_type") == SIGNUP).select(
        F.col("user_id").cast("string").alias("addr")
    )


def deposits(spark: SparkSession, data_dir: str) -> DataFrame:
    """``wallet, deposit_time, usd``: funds arriving in a wallet."""
    ev = _events(spark, data_dir)
    return ev.where(F.col("event_type") == DEPOSIT).select(
        F.col("user_id").cast("string").alias("wallet"),
        F.col("ts").cast("timestamp").alias("deposit_time"),
        F.col("value").cast(schemas.USD).alias("usd"),
    )


def market_trades(spark: SparkSession, data_dir: str) -> DataFrame:
    """``maker, taker, amount, block_time``: one side known per event."""
    ev = _events(spark, data_dir).where(F.col("event_type").isin(MAKER, TAKER))
    user = F.col("user_id").cast("string")
    return ev.select(
        F.when(F.col("event_type") == MAKER, user).alias("maker"),
        F.when(F.col("event_type") == TAKER, user).alias("taker"),
        F.col("value").cast(schemas.USD).alias("amount"),
        F.col("ts").cast("timestamp").alias("block_time"),
    )


WALLET_BYTES = 20
#: Market segments whose customers' wallets the factory created.
FACTORY_SEGMENTS = ("BUILDING", "MACHINERY", "FURNITURE")
OTHER_DEPLOYER = "00000000000000000000000000000000000000ff"
TRADE_FILES_PER_MONTH = 4


def wallet_hex(key: Column) -> Column:
    return F.lpad(F.hex(key), 2 * WALLET_BYTES, "0")


def hex_wallet_orders(spark: SparkSession, data_dir: str) -> DataFrame:
    """The order view with destination traders as hex addresses, in either case
    and with or without ``0x``."""
    o = orders(spark, data_dir)
    key = F.col("dst_trader_address").cast("bigint")
    digits = wallet_hex(key)
    return o.withColumn("dst_trader_address", F.when(key % 2 == 0, F.concat(F.lit("0x"), F.lower(digits))).otherwise(digits))


def creation_traces(spark: SparkSession, data_dir: str, factory: str) -> DataFrame:
    """``from, address`` (binary), written to the shared folder and read from
    there: every customer's wallet, some of them traced twice."""
    c = table(spark, data_dir, "customer")
    maker = F.when(F.col("c_mktsegment").isin(*FACTORY_SEGMENTS), F.lit(factory)).otherwise(F.lit(OTHER_DEPLOYER))
    times = F.when(F.col("c_custkey") % 10 == 0, 2).otherwise(1)
    rows = c.select(F.unhex(maker).alias("from"), F.unhex(wallet_hex(F.col("c_custkey"))).alias("address"), F.explode(F.sequence(F.lit(1), times)).alias("n"))
    return _landed(rows.drop("n"), "traces")


def monthly_trades(spark: SparkSession, data_dir: str) -> DataFrame:
    """``maker, taker`` (binary), ``amount, block_time``, in folders by
    ``block_month``: one trade an order, between a customer and the next one;
    every third has no taker."""
    o = table(spark, data_dir, "orders")
    key = F.col("o_orderkey")
    at = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + key % 400_000)
    rows = o.select(
        F.unhex(wallet_hex(F.col("o_custkey"))).alias("maker"), F.when(key % 3 != 0, F.unhex(wallet_hex(F.col("o_custkey") + 1))).alias("taker"),
        F.col("o_totalprice").cast(schemas.USD).alias("amount"), at.alias("block_time"), F.trunc(at, "month").alias("block_month"), key.alias("k"))
    # a month's rows go to a few files, however many tasks and rows there are
    rows = rows.repartition("block_month", F.pmod(F.xxhash64("k"), F.lit(TRADE_FILES_PER_MONTH))).drop("k")
    return _landed(rows, "trades", "block_month")


def _landed(rows: DataFrame, name: str, *folders: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(rows.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    (rows.write.partitionBy(*folders) if folders else rows.write).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def clocked(orders: DataFrame) -> DataFrame:
    """The orders at a second of their creation day, since the driver's order
    dates are midnights."""
    return orders.withColumn("order_create_time", F.col("order_create_time") + F.col("lt_num") % 86400)


def activity(spark: SparkSession, data_dir: str) -> DataFrame:
    """``ts, trader, usd``: settled swaps with second-resolution clocks for the
    hour / weekday rhythm; error events carry no dollar value."""
    ev = _events(spark, data_dir)
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("trader"),
        F.when(F.col("event_type") != UNPRICED, F.col("value").cast(schemas.USD)).alias("usd"),
    )


# ---------------------------------------------------------------------------
# Landed pages: the order view rendered as the service's raw JSON
# ---------------------------------------------------------------------------
def _quoted(text: Column) -> Column:
    """A JSON string literal, escaped by Spark's own JSON writer."""
    return F.btrim(F.to_json(F.array(text)), F.lit("[]"))  # quotes keep brackets of the text


def _asset_json(chain: Column, kind: Column, address: Column) -> Column:
    """``{"chain": {"kind": "address"}}``; a native coin is ``{"chain":
    {"native": {}}}`` and an unknown asset ``{}``."""
    value = F.when(kind == F.lit("native"), F.lit("{}")).otherwise(_quoted(address))
    inner = F.concat(F.lit("{"), _quoted(kind), F.lit(":"), value, F.lit("}"))
    return F.when(chain.isNull(), F.lit("{}")).otherwise(
        F.concat(F.lit("{"), _quoted(chain), F.lit(":"), inner, F.lit("}")))


def order_pages(spark: SparkSession, data_dir: str) -> DataFrame:
    """``value``: one landed page of JSON text per order of the order view,
    with one-key asset and address maps and clocks, pips and units as text,
    as the order service sends them. One order per page, so rendering never
    gathers rows."""
    o = orders(spark, data_dir)
    text = ("lt", "status", "quote_id", "resolver_id") + schemas.UNIT_FIELDS
    numbers = ("integrator_fee_pips", "protocol_fee_pips") + schemas.CLOCK_FIELDS
    maps = []
    for field in schemas.ADDRESS_FIELDS:
        chain = F.col(field.removesuffix("_address") + "_chain")
        maps.append(F.when(chain.isNotNull(), F.create_map(chain, F.col(field))).alias(field))
    flat = F.to_json(F.struct(*[F.col(c) for c in text], *[F.col(c).cast("string").alias(c) for c in numbers],
                              *maps))
    order = F.concat(
        F.expr("substr(_flat, 1, length(_flat) - 1)"),  # the flat fields without the closing brace
        F.lit(',"input_asset":'),
        _asset_json(F.col("input_asset_chain"), F.col("input_asset_kind"), F.col("input_asset_address")),
        F.lit(',"output_asset":'),
        _asset_json(F.col("output_asset_chain"), F.col("output_asset_kind"), F.col("output_asset_address")),
        F.lit("}"),
    )
    return o.withColumn("_flat", flat).select(
        F.concat(F.lit('{"result":{"orders":['), order, F.lit('],"has_next_page":true}}')).alias("value"))


def cube_pages(spark: SparkSession, data_dir: str, table: str) -> DataFrame:
    """``value``: one landed cube page per row of a daily cube built from the
    order view, in the service's shape: ISO day text, nested asset and
    address dimensions, every metric as decimal text."""
    from ..operators import cubes

    cube = cubes.named_cube(orders(spark, data_dir), table)
    dims = schemas.CUBE_DIMENSIONS[table]
    plain = [F.col(d) for d in ("src_chain_id", "dst_chain_id", "resolver_id", "status") if d in dims]
    maps = []
    for field in schemas.ADDRESS_FIELDS:
        chain = field.removesuffix("_address") + "_chain"
        if field in dims:
            maps.append(F.when(F.col(chain).isNotNull(), F.create_map(F.col(chain), F.col(field))).alias(field))
    metrics = [F.col(m).cast("string").alias(m) for m in schemas.cube_metrics(table)]
    day = F.date_format(F.col("day"), "yyyy-MM-dd'T'00:00:00'Z'").alias("time_period")
    flat = F.to_json(F.struct(day, *plain, *maps, *metrics))
    assets = []
    for side in ("input", "output"):
        if f"{side}_asset_chain" in dims:
            assets += [F.lit(f',"{side}_asset":'), _asset_json(
                F.col(f"{side}_asset_chain"), F.col(f"{side}_asset_kind"), F.col(f"{side}_asset_address"))]
    row = F.concat(F.expr("substr(_flat, 1, length(_flat) - 1)"), *assets, F.lit("}"))
    return cube.withColumn("_flat", flat).select(
        F.concat(F.lit('{"result":{"rows":['), row, F.lit("]}}")).alias("value"))
