"""Flatten one-key JSON maps into columns (native expressions, no UDF).

An asset arrives as ``{"ton": {"jetton": "EQ.."}}``: exactly one chain key, and
under it exactly one kind key whose value is a string, ``{}`` (native coin) or
a multi-token object ``{"contract_address": .., "token_id": ..}``.  Read with a
``map<string, map<string, string>>`` schema, Spark hands the inner value over
as text -- the JSON text for objects -- so objects are told apart by a leading
``{`` and decoded with ``get_json_object``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_key(m: Column) -> Column:
    # try_element_at: an empty map yields NULL instead of an ANSI error.
    return F.try_element_at(F.map_keys(m), F.lit(1))


def _first_value(m: Column) -> Column:
    return F.try_element_at(F.map_values(m), F.lit(1))


def asset_columns(asset: Column, prefix: str) -> list[Column]:
    """``{chain: {kind: value}}`` -> ``{prefix}_chain, _kind, _address``.

    NULL or ``{}`` -> three NULLs; a chain with an empty inner map -> (chain,
    NULL, NULL); ``native: {}`` -> address NULL; a multi-token object ->
    ``contract:token_id`` with an empty token id when it is absent.
    """
    chain = _first_key(asset)
    inner = _first_value(asset)
    kind = _first_key(inner)
    value = _first_value(inner)
    is_object = F.startswith(F.ltrim(value), F.lit("{"))
    contract = F.get_json_object(value, "$.contract_address")
    token_id = F.coalesce(F.get_json_object(value, "$.token_id"), F.lit(""))
    address = (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(is_object, F.when(contract.isNotNull(), F.concat(contract, F.lit(":"), token_id)))
        .otherwise(value)
    )
    return [
        chain.alias(f"{prefix}_chain"),
        kind.alias(f"{prefix}_kind"),
        address.alias(f"{prefix}_address"),
    ]


def chain_address_columns(value: Column, prefix: str) -> list[Column]:
    """``{chain: address}`` -> ``{prefix}_chain, {prefix}_address``."""
    return [_first_key(value).alias(f"{prefix}_chain"), _first_value(value).alias(f"{prefix}_address")]


def seconds(text: Column) -> Column:
    """Epoch seconds sent as text; NULL for absent or empty values."""
    return F.nullif(text.cast("string"), F.lit("")).try_cast("double")


def units(text: Column) -> Column:
    """Raw token units stay text (they are up to 256-bit); ``""`` becomes NULL."""
    return F.nullif(text.cast("string"), F.lit(""))
