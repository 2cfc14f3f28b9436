import base64
import json
from decimal import Decimal

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tidewell.operators import cdc, rollup
from tidewell.operators.deltas import part_paths, write_delta
from tidewell.session import new_dir
from tidewell.sources.schemas import TRANSACTIONS
from tidewell.streaming.runner import run_to_end, start_query

ACTIVITY = StructType([
    StructField("id", LongType()), StructField("name", StringType()), StructField("email", StringType()),
])
PAID = StructType([
    StructField("id", LongType()), StructField("user_id", IntegerType()),
    StructField("amount", DecimalType(10, 2)), StructField("created_at", TimestampType()),
])


def b64(cents):
    return base64.b64encode(cents.to_bytes(4, "big", signed=True)).decode()


def messages(spark, values):
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame(list(enumerate(texts)), "offset long, value string").withColumn(
        "value", F.col("value").cast("binary")
    )


def test_bare_and_wrapped_envelopes(spark):
    after = {"id": 1, "name": "Alice"}
    decoded = cdc.cdc_decode(
        messages(spark, [{"op": "c", "after": after}, {"payload": {"op": "c", "after": after}},
                         {"payload": {"after": after}}]),
        ACTIVITY,
    )
    got = cdc.changed_rows(decoded, ("offset", "op")).orderBy("offset").collect()
    assert [tuple(r) for r in got] == [
        (0, "c", 1, "Alice", None), (1, "c", 1, "Alice", None), (2, None, 1, "Alice", None)]


def test_all_amount_encodings(spark):
    values = [{"after": {"id": i, "amount": a}} for i, a in enumerate([12.5, "12.50", b64(1250), b64(-1250)])]
    got = cdc.changed_rows(cdc.cdc_decode(messages(spark, values), PAID, {"amount": 2}))
    assert [r.amount for r in got.orderBy("id").collect()] == [
        Decimal("12.50"), Decimal("12.50"), Decimal("12.50"), Decimal("-12.50")]
    assert got.schema["amount"].dataType == TRANSACTIONS["amount"].dataType


def test_time_encodings(spark):
    for encoding, sent in [("millis", 1704067200123), ("micros", 1704067200123000),
                           ("text", "2024-01-01T00:00:00.123Z")]:
        decoded = cdc.cdc_decode(
            messages(spark, [{"after": {"id": 1, "created_at": sent}}]), PAID,
            times={"created_at": encoding},
        )
        seen = decoded.select(F.unix_millis("after.created_at")).first()[0]
        assert seen == 1704067200123, encoding
    with pytest.raises(ValueError):
        cdc.cdc_decode(messages(spark, []), PAID, times={"created_at": "days"})


def test_malformed_records_are_marked_and_skipped(spark):
    decoded = cdc.cdc_decode(
        messages(spark, ["{not json", None, {"op": "d", "before": {"id": 3}}, "[]", "{}"]), ACTIVITY)
    assert [r.malformed for r in decoded.orderBy("offset").collect()] == [True, False, False, True, True]
    assert cdc.changed_rows(decoded).count() == 0
    assert cdc.cdc_apply(decoded, ["id"], ["offset"]).count() == 0


def create(key, name):
    return {"op": "c", "after": {"id": key, "name": name}}


def test_apply_keeps_the_latest_row(spark):
    changes = [create(1, "a"), create(2, "b"), {"op": "u", "after": {"id": 1, "name": "z"}},
               {"op": "d", "before": {"id": 2}}, create(3, "c"), {"op": "d", "before": {"id": 3}},
               create(3, "back"), {"op": "?", "after": {"id": 4, "name": "odd op"}}]
    decoded = cdc.cdc_decode(messages(spark, changes), ACTIVITY)
    assert rows(cdc.cdc_apply(decoded, ["id"], ["offset"]).select("id", "name")) == [
        (1, "z"), (3, "back"), (4, "odd op")]


STEPS = st.lists(
    st.tuples(st.sampled_from("cud"), st.integers(1, 4), st.integers(0, 99)), min_size=1, max_size=25)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(STEPS, st.integers(1, 24), st.booleans())
def test_mirror_over_batches_equals_replay(spark, steps, cut, compact):
    table, values = {}, []
    for op, key, number in steps:
        if op == "d":
            table.pop(key, None)
            values.append({"op": "d", "before": {"id": key}})
        else:
            table[key] = str(number)
            values.append({"op": op, "after": {"id": key, "name": str(number)}})
    decoded = cdc.cdc_decode(messages(spark, values), ACTIVITY)
    target = new_dir(spark, "mirror")
    sink = cdc.mirror_sink(target, ["id"], ["offset"])
    sink(decoded.filter(F.col("offset") < cut), 0)
    if compact:
        cdc.compact_mirror(spark, target, ["id"])
    sink(decoded.filter(F.col("offset") >= cut), 1)
    sink(decoded.filter(F.col("offset") >= cut), 1)
    if compact:
        cdc.compact_mirror(spark, target, ["id"])
    got = rows(cdc.read_mirror(spark, target, ["id"]).select("id", "name"))
    assert got == sorted(table.items(), key=repr)
    assert got == rows(cdc.cdc_apply(decoded, ["id"], ["offset"]).select("id", "name"))


def test_mirror_stream_over_several_files(spark):
    source, target = new_dir(spark, "topic"), new_dir(spark, "mirror")
    checkpoints = new_dir(spark, "checkpoints")

    def arrive(values, first):
        df = messages(spark, values).withColumn("offset", F.col("offset") + first)
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        sink = cdc.mirror_sink(target, ["id"], ["offset"])
        run_to_end(start_query(cdc.cdc_decode(stream, ACTIVITY), "mirror", sink, checkpoints))

    arrive([create(1, "a"), create(2, "b")], 0)
    arrive([{"op": "u", "after": {"id": 1, "name": "z"}}, {"op": "d", "before": {"id": 2}}], 10)
    assert rows(cdc.read_mirror(spark, target, ["id"]).select("id", "name")) == [(1, "z")]


def test_a_key_with_most_changes_is_reduced_before_the_shuffle(spark):
    from conftest import plan

    decoded = cdc.cdc_decode(messages(spark, [create(1, "a")]), ACTIVITY)
    text = plan(cdc.cdc_apply(decoded, ["id"], ["offset"]))
    assert "partial_max_by" in text
    assert text.count("from_json") == 1



def aggs():
    v = F.col("v")
    return {"n": ("count", None), "known": ("count", v), "s": ("sum", v), "lo": ("min", v), "hi": ("max", v)}


def test_rollup_merges_and_repeats_safely(spark):
    data = [("a", 1), ("a", None), ("b", 5), ("a", 7), ("b", -5), ("c", 2)]
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(data)], "i int, k string, v int")
    target = new_dir(spark, "rollup")
    for batch, (low, high) in enumerate([(0, 2), (2, 4), (4, 6)]):
        part = df.filter(F.col("i").between(low, high - 1))
        for _ in range(batch + 1):
            rollup.rollup_refresh(part, target, ["k"], aggs(), batch)
        if batch == 1:
            rollup.compact_rollup(spark, target, ["k"], aggs())
    got = rows(rollup.read_rollup(spark, target, ["k"], aggs()))
    assert got == [("a", 3, 2, 8, 1, 7), ("b", 2, 2, 0, -5, 5), ("c", 1, 1, 2, 2, 2)]


def test_rollup_keeps_decimal_types(spark):
    df = spark.createDataFrame([("a", "1.10"), ("a", "2.20")], "k string, v string").withColumn(
        "v", F.col("v").cast("decimal(10,2)"))
    target, wanted = new_dir(spark, "rollup"), {"s": ("sum", F.col("v"))}
    for batch in range(3):
        rollup.rollup_refresh(df, target, ["k"], wanted, batch)
        rollup.compact_rollup(spark, target, ["k"], wanted)
    assert rows(rollup.read_rollup(spark, target, ["k"], wanted)) == [("a", Decimal("9.90"))]


def test_unfinished_parts_are_not_read(spark):
    import os

    target = new_dir(spark, "parts")
    write_delta(spark.range(3), target, 0)
    write_delta(spark.range(3), target, 1)
    folder = target.removeprefix("file:")
    os.remove(f"{folder}/delta/batch=1/_SUCCESS")
    assert part_paths(spark, target) == ([f"{target}/delta/batch=0"], 0)
