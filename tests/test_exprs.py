import pytest
from pyspark.sql import functions as F

from satlake.functions import exprs as X


def one(spark, value, kind, f):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("height, label", [(0, "0"), (100_000, "100k"), (900_000, "900k"), (1_000_000, "1m"), (1_100_000, "11m"), (1_234_567, "1234567")])
def test_labels(spark, height, label):
    assert X.partition_label(height) == label
    assert one(spark, height, "int", X.partition_label_column) == label


def test_bounds():
    assert X.partition_bounds(950_000) == "FOR VALUES FROM (900000) TO (1000000)"
    assert X.split_heights(5, 30, 12) == [(5, 16), (17, 28), (29, 30)]


@pytest.mark.parametrize("text, want", [("0a", b"\n"), ("0A", b"\n"), ("abc", None), ("zz", None), ("", None), (None, None)])
def test_hex(spark, text, want):
    got = one(spark, text, "string", X.hex_lenient)
    assert (None if got is None else bytes(got)) == want
    if want is None:
        with pytest.raises(Exception, match="bad hex"):
            one(spark, text, "string", lambda c: X.hex_strict(c, "x"))


@pytest.mark.parametrize("coins, want", [("0.00000001", 1), ("0.29", 29_000_000), ("20999999.9769", 2_099_999_997_690_000), (None, None)])
def test_sats(spark, coins, want):
    assert one(spark, coins, "string", lambda c: X.sats(c.cast("decimal(18,8)"))) == want


def test_bits(spark):
    assert one(spark, "1d00ffff", "string", X.bits) == 486604799
    assert one(spark, "nonsense", "string", X.bits) == 0


def test_script_codes(spark):
    for name, code in [("PubKeyHash", 0), ("scripthash", 1), ("witness_v0_keyhash", 2), ("witness_v0_scripthash", 3), ("witness_v1_taproot", 4), ("nulldata", 5), ("MULTISIG", 6), ("pubkey", 7), ("witness_unknown", 7), (None, 7)]:
        assert one(spark, name, "string", X.script_code) == code


@pytest.mark.parametrize("direction, role", [("in", 1), ("OUT", 0), ("both", None), ("junk", None), ("", None), (None, None)])
def test_directions(direction, role):
    assert X.direction_role(direction) == role


def test_names(spark):
    assert [one(spark, r, "int", X.role_name) for r in (0, 1, 2, 9)] == ["receiver", "sender", "both", "unknown"]
    assert [one(spark, r, "int", X.direction_name) for r in (0, 1, 2, 9)] == ["OUT", "IN", "BOTH", "UNKNOWN"]
    assert one(spark, -5, "bigint", X.negative) == 5 and one(spark, -5, "bigint", X.positive) == 0
