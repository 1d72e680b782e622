"""Column expressions of the ledger: hex, amounts, bits, enums, partitions. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and codes of the ledger's formats.
SCRIPT_CODES = {
    "pubkeyhash": 0, "p2pkh": 0, "scripthash": 1, "p2sh": 1, "witness_v0_keyhash": 2, "p2wpkh": 2, "witness_v0_scripthash": 3, "p2wsh": 3,
    "witness_v1_taproot": 4, "p2tr": 4, "nulldata": 5, "op_return": 5, "multisig": 6,
}
SCRIPT_NAMES = ["p2pkh", "p2sh", "p2wpkh", "p2wsh", "p2tr", "op_return", "multisig", "unknown"]
ROLE_NAMES = ["receiver", "sender", "both"]
DIRECTION_NAMES = ["OUT", "IN", "BOTH"]
RECEIVER, SENDER, BOTH = 0, 1, 2
DEFAULT_SEQUENCE = 4294967294
BUCKET = 100_000

HEX = r"^([0-9a-fA-F]{2})+$"


def hex_lenient(c: Column) -> Column:
    """Bytes of a hex string; null if it is missing, empty, of odd length or not hex."""
    return F.when(c.rlike(HEX), F.unhex(c))


def hex_strict(c: Column, what: str) -> Column:
    """Bytes of a hex string; a missing or bad one is an error."""
    return F.when(c.rlike(HEX), F.unhex(c)).otherwise(F.raise_error(F.concat(F.lit(f"bad hex in {what}: "), F.coalesce(c, F.lit("missing")))).cast("binary"))


def to_hex(c: Column | str) -> Column:
    return F.lower(F.hex(c))


def sats(coins: Column) -> Column:
    """Coins to whole satoshis, half away from zero; exact, as the input is decimal(18,8)."""
    return F.round(coins.cast("decimal(18,8)") * F.lit(100_000_000), 0).cast("bigint")


def bits(c: Column) -> Column:
    """A compact target: a hex string; 0 if it can't be read."""
    return F.coalesce(F.when(c.rlike("^[0-9a-fA-F]{1,15}$"), F.conv(c, 16, 10).cast("bigint")), F.lit(0).cast("bigint"))


def number(c: Column, default: int = 0) -> Column:
    return F.coalesce(c, F.lit(default).cast("bigint"))


def zero_to_null(c: Column) -> Column:
    return F.when(c != 0, c)


def script_code(name: Column) -> Column:
    table = F.create_map(*[x for k, v in SCRIPT_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(table, F.lower(name)), F.lit(7)).cast("smallint")


def _named(c: Column, names: list[str], other: str) -> Column:
    out = F.when(c == 0, names[0])
    for i, n in enumerate(names[1:], 1):
        out = out.when(c == i, n)
    return out.otherwise(other)


def script_name(code: Column) -> Column:
    return _named(code, SCRIPT_NAMES, "unknown")


def role_name(role: Column) -> Column:
    return _named(role, ROLE_NAMES, "unknown")


def direction_name(role: Column) -> Column:
    return _named(role, DIRECTION_NAMES, "UNKNOWN")


def direction_role(direction: str | None) -> int | None:
    """The role that a direction asks for: `in` senders, `out` receivers, anything else all."""
    return {"in": SENDER, "out": RECEIVER}.get((direction or "").lower())


def height_bucket(height: Column, width: int = BUCKET) -> Column:
    return F.floor(height / width).cast("int")


def positive(c: Column) -> Column:
    return F.greatest(c, F.lit(0).cast("bigint"))


def negative(c: Column) -> Column:
    return F.greatest(-c, F.lit(0).cast("bigint"))


def partition_label(height: int) -> str:
    """Thousands as `k`, whole millions as `m`, other multiples of 100,000 from a million on by those (1,100,000 is `11m`), anything else in full."""
    if height == 0:
        return "0"
    if height < 1_000_000:
        return f"{height // 1000}k"
    if height % 1_000_000 == 0:
        return f"{height // 1_000_000}m"
    return f"{height // 100_000}m" if height % 100_000 == 0 else str(height)


def partition_range(height: int, width: int = BUCKET) -> tuple[int, int]:
    low = height // width * width
    return low, low + width


def partition_bounds(height: int, width: int = BUCKET) -> str:
    low, high = partition_range(height, width)
    return f"FOR VALUES FROM ({low}) TO ({high})"


def partition_label_column(low: Column) -> Column:
    """partition_label of a height, as a column."""
    unit = lambda n, mark: F.concat(F.floor(low / n).cast("string"), F.lit(mark))
    return F.when(low == 0, "0").when(low < 1_000_000, unit(1000, "k")).when(low % 1_000_000 == 0, unit(1_000_000, "m")).when(low % 100_000 == 0, unit(100_000, "m")).otherwise(low.cast("string"))


def split_heights(start: int, end: int, width: int) -> list[tuple[int, int]]:
    """[start, end] in runs of `width` heights, both ends inclusive."""
    return [(a, min(a + width - 1, end)) for a in range(start, end + 1, width)]
