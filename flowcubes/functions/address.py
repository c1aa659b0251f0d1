"""Token identity across address encodings, and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The chain whose token addresses arrive in the friendly base64url form.
FRIENDLY_CHAIN = "ton"


def ton_raw(address: Column) -> Column:
    """Friendly base64url address -> raw ``0:<HEX>`` form.

    The friendly form is 36 bytes: a flag byte, a workchain byte, the 32-byte
    account hash and a 2-byte checksum; the raw form is the hash in upper hex.
    Undecodable text gives NULL.
    """
    decoded = F.try_to_binary(F.translate(address, "-_", "+/"), F.lit("base64"))
    return F.concat(F.lit("0:"), F.upper(F.hex(F.substring(decoded, 3, 32))))


def ton_raw_if(chain: Column, address: Column, friendly_chain: str = FRIENDLY_CHAIN) -> Column:
    """The raw key only where the chain uses friendly addresses, else NULL."""
    return F.when((chain == F.lit(friendly_chain)) & address.isNotNull(), ton_raw(address))


def evm_key(address: Column) -> Column:
    """``0x``-hex address -> binary key; NULL unless whole bytes of hex follow
    the prefix (which may be left out)."""
    return F.when(address.rlike("^(0x)?([0-9A-Fa-f]{2})+$"), F.unhex(F.regexp_replace(address, "^0x", "")))


def truncate_label(value: Column, head: int, tail: int = 0) -> Column:
    """``first <head> chars + '…' [+ last <tail> chars]``; NULL stays NULL."""
    parts = [F.substring(value, 1, head), F.lit("…")]
    if tail:
        parts.append(F.substring(value, -tail, tail))
    return F.concat(*parts)
