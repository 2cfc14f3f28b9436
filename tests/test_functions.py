import base64
from decimal import Context, Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewell.functions.numbers import any_decimal, base64_decimal, minor_units
from tidewell.functions.text import contains, has_token, normal_term, tokens
from tidewell.functions.times import duration_micros, event_time


def encode(number: int) -> str:
    size = max(1, (number.bit_length() + 8) // 8)
    return base64.b64encode(number.to_bytes(size, "big", signed=True)).decode()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**37), 10**37), min_size=1, max_size=60))
def test_base64_decimal_is_exact(spark, numbers):
    numbers += [-12345, -1, 0, 127, 128, 255, 256, -128, -129, 2**63, -(2**63), 2**64]
    df = spark.createDataFrame([(i, encode(n)) for i, n in enumerate(numbers)], "i long, b string")
    got = {r.i: r.d for r in df.select("i", base64_decimal(F.col("b"), 2).alias("d")).collect()}
    for i, n in enumerate(numbers):
        # 38 digits hold 36 before the point; a value beyond that is null, never wrong.
        exact = Decimal(n).scaleb(-2, Context(prec=50))
        assert got[i] == exact or (got[i] is None and abs(n) >= 10**36), n


def test_base64_decimal_rejects_what_is_not_one(spark):
    df = spark.createDataFrame([("!!",), (None,), ("",), (encode(2**130),)], "b string")
    assert rows(df.select(base64_decimal(F.col("b")))) == [(None,)] * 4


def test_any_decimal_encodings(spark):
    df = spark.createDataFrame([("12.5",), ("-3",), ("1e2",), (encode(-12345),), ("!!",)], "v string")
    got = [r[0] for r in df.select(any_decimal(F.col("v"), 2)).collect()]
    assert got == [Decimal("12.50"), Decimal("-3.00"), Decimal("100.00"), Decimal("-123.45"), None]
    digits = spark.createDataFrame([("1234",)], "v string")
    assert digits.select(any_decimal(F.col("v"), 2, "plain")).first()[0] == Decimal("1234.00")
    as_bytes = int.from_bytes(base64.b64decode("1234"), "big", signed=True)
    assert digits.select(any_decimal(F.col("v"), 0, "base64")).first()[0] == as_bytes
    with pytest.raises(ValueError):
        any_decimal(F.col("v"), 2, "hex")


def test_minor_units(spark):
    df = spark.createDataFrame([(0.1,), (4000.01,), (-2.5,), (None,)], "v double")
    assert [r[0] for r in df.select(minor_units(F.col("v"))).collect()] == [10, 400001, -250, None]


TEXTS = [
    (1, "license at the start"), (2, "ends in License"), (3, "LICENSE"), (4, "a licensed word"),
    (5, "(license)."), (6, "sub-license_x"), (7, "nothing"), (8, ""), (9, None),
    (10, "license license"),
]


def test_three_text_predicates_differ(spark):
    df = spark.createDataFrame(TEXTS, "id long, t string")

    def ids(condition):
        return [r.id for r in df.filter(condition).orderBy("id").collect()]

    assert ids(contains(F.col("t"), "license")) == [1, 4, 5, 6, 10]
    assert ids(contains(F.col("t"), "License", ignore_case=True)) == [1, 2, 3, 4, 5, 6, 10]
    assert ids(has_token(F.col("t"), "License")) == [1, 2, 3, 5, 6, 10]


def test_has_token_is_membership_in_tokens(spark):
    df = spark.createDataFrame(TEXTS, "id long, t string")
    both = df.select(
        F.coalesce(has_token(F.col("t"), "license"), F.lit(False)),
        F.coalesce(F.array_contains(tokens(F.col("t")), "license"), F.lit(False)),
    )
    assert all(a == b for a, b in both.collect())


def test_search_term_is_one_token():
    assert normal_term(" License! ") == "license"
    for bad in ("two words", "", "--"):
        with pytest.raises(ValueError):
            normal_term(bad)


def test_durations():
    assert duration_micros("60 seconds") == 60_000_000
    assert duration_micros("1 day") == 86_400_000_000
    with pytest.raises(ValueError):
        duration_micros("soon")


def test_event_time_keeps_milliseconds(spark):
    df = spark.createDataFrame([(1768142570123,)], "t long")
    assert df.select(F.unix_millis(event_time(F.col("t")))).first()[0] == 1768142570123
