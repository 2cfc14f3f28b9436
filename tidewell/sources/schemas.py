"""The record layouts this library reads."""

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PEOPLE = StructType([
    StructField("first_name", StringType()),
    StructField("last_name", StringType()),
    StructField("gender", StringType()),
    StructField("department", StringType()),
    StructField("salary", IntegerType()),
    StructField("country", StringType()),
])

ORDERS = StructType([
    StructField("customer_name", StringType()),
    StructField("product_category", StringType()),
    StructField("quantity", IntegerType()),
    StructField("price_per_unit", DecimalType(10, 2)),
    StructField("order_date", DateType()),
    StructField("country", StringType()),
])

TEMPERATURE = StructType([
    StructField("id", LongType()),
    StructField("sensor_id", StringType()),
    StructField("temperature", DoubleType()),
    StructField("recorded_at", TimestampType()),
])

TRANSACTIONS = StructType([
    StructField("id", LongType()),
    StructField("user_id", IntegerType()),
    StructField("amount", DecimalType(10, 2)),
    StructField("card_type", StringType()),
    StructField("merchant_id", IntegerType()),
    StructField("created_at", TimestampType()),
])

LOGS = StructType([
    StructField("timestamp", LongType()),
    StructField("status", StringType()),
    StructField("severity", StringType()),
    StructField("source_ip", StringType()),
    StructField("user_id", StringType()),
    StructField("content", StringType()),
])

TOPIC_RECORD = StructType([
    StructField("key", BinaryType()),
    StructField("value", BinaryType()),
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])
