"""SQL surface: the address helpers as SQL functions, published tables as views.

The functions are SQL-bodied temporary functions (no Python in the row
path): Catalyst inlines them like any built-in expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

FUNCTIONS = {
    "ton_raw": (
        "address STRING", "STRING",
        "concat('0:', upper(hex(substr(try_to_binary(translate(address, '-_', '+/'), 'base64'), 3, 32))))",
    ),
    "evm_key": ("address STRING", "BINARY", "if(address rlike '^(0x)?([0-9A-Fa-f]{2})+$', unhex(regexp_replace(address, '^0x', '')), NULL)"),
    "short_label": (
        "value STRING, head INT, tail INT", "STRING",
        "concat(substr(value, 1, head), '…', if(tail > 0, substr(value, -tail, tail), ''))",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)
