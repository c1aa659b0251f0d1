import json

import pytest

from flowcubes import schemas
from flowcubes.functions.flatten import asset_columns, chain_address_columns
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat_asset(spark, asset):
    df = spark.createDataFrame([(json.dumps({"a": asset}),)], "j string")
    parsed = df.select(F.from_json("j", T.StructType([T.StructField("a", schemas.ASSET)])).alias("p"))
    row = parsed.select(*asset_columns(F.col("p.a"), "x")).collect()[0]
    return (row.x_chain, row.x_kind, row.x_address)


CASES = {
    "coin": ({"lunar": {"native": {}}}, ("lunar", "native", None)),
    "friendly address": ({"ton": {"jetton": "kQAB-_cd"}}, ("ton", "jetton", "kQAB-_cd")),
    "contract": ({"solis": {"erc20": "0xAB12"}}, ("solis", "erc20", "0xAB12")),
    "unknown chain and kind": ({"pluto": {"p2p": "addr 9"}}, ("pluto", "p2p", "addr 9")),
    "token of a contract": ({"solis": {"erc1155": {"contract_address": "0x77", "token_id": "900"}}}, ("solis", "erc1155", "0x77:900")),
    "no token id": ({"solis": {"erc1155": {"contract_address": "0x77"}}}, ("solis", "erc1155", "0x77:")),
    "object without contract": ({"solis": {"erc1155": {"token_id": "900"}}}, ("solis", "erc1155", None)),
    "numeric token id": ({"solis": {"erc721": {"contract_address": "0x78", "token_id": 5}}}, ("solis", "erc721", "0x78:5")),
    "quotes": ({"lunar": {"erc20": 'a"b'}}, ("lunar", "erc20", 'a"b')),
    "chain alone": ({"lunar": {}}, ("lunar", None, None)),
    "empty": ({}, (None, None, None)),
    "null": (None, (None, None, None)),
}


@pytest.mark.parametrize("asset, expected", CASES.values(), ids=CASES.keys())
def test_asset_flatten(spark, asset, expected):
    assert flat_asset(spark, asset) == expected


def test_chain_address(spark):
    df = spark.createDataFrame([({"lunar": "w-1"},), ({},), (None,)], T.StructType([T.StructField("a", schemas.CHAIN_ADDRESS)]))
    rows = df.select(*chain_address_columns(F.col("a"), "t")).collect()
    assert [tuple(r) for r in rows] == [("lunar", "w-1"), (None, None), (None, None)]
