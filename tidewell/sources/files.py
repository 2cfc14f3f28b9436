"""CSV and Parquet tables, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

from tidewell.session import changed_at, data_files, estimated_bytes, is_file, set_changed

SLICE_BYTES = 512 * 1024 * 1024  # of a table in one micro-batch of a replay
# Of a table in one file of a slice, so that a micro-batch is many tasks' work: one file per core
# if they have the first size then, and more files rather than larger ones than the second.
MIN_FILE_BYTES, MAX_FILE_BYTES = 1024 * 1024, 32 * 1024 * 1024


def csv_scan(
    spark: SparkSession, path: str, schema: StructType, header: bool = True, sep: str = ","
) -> DataFrame:
    """A typed CSV scan. A row that does not fit the schema fails the load."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "FAILFAST")
        .option("enforceSchema", not header)
        .csv(path)
    )


def save_table(
    df: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    max_records_per_file: int = 0,
) -> None:
    """Create or replace a Parquet table: a path if ``target`` has a slash, else a name."""
    writer = df.write.mode(mode).format("parquet")
    writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def _with_instants(schema: StructType) -> StructType:
    """The same schema with zone-less times read as instants, which watermarks need."""
    return StructType([
        StructField(f.name, TimestampType(), f.nullable)
        if isinstance(f.dataType, TimestampNTZType) else f
        for f in schema.fields
    ])


def parquet_scan(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table. Reading times as instants in the scan keeps filters pushed down."""
    plain = spark.read.parquet(path)
    wanted = _with_instants(plain.schema)
    return plain if wanted == plain.schema else spark.read.schema(wanted).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A scan's rows over all cores where it has fewer partitions than there are.

    Meant for work that is costly per row. A large table has partitions enough
    and is left alone, and so are rows whose size Spark can't tell before running them;
    only a small scan, in a few files, is moved.
    """
    spark = df.sparkSession
    cores, size = spark.sparkContext.defaultParallelism, estimated_bytes(df)
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    part = as_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(cores) if size is not None and size < cores * part else df


def parquet_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """The files of a Parquet table as a stream, oldest first.

    ``max_files`` or ``max_bytes`` bounds a micro-batch.
    """
    if schema is None:
        schema = _with_instants(spark.read.parquet(path).schema)
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if not is_file(spark, path):
        return reader.parquet(path)
    # A stream wants a folder: the file's own, of which it takes only that name.
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def in_order_of(
    df: DataFrame, ts: str, path: str, slices: int = 4, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """``df`` written in slices of time, and read as a stream of one slice per micro-batch.

    A replay then meets its rows in order of ``ts``, whatever the order and number of
    files that the table came in, and carries state from slice to slice. There are at least
    ``slices``, more for a large table. A slice is several files where it is large, each a range
    of time and a task's work when written and when read. Rows of one time are in one file. A
    stream of files goes by their times of change, which are set to follow the slices; storage
    that does not keep them, as object stores, raises.
    """
    spark = df.sparkSession
    size = estimated_bytes(df) or 0
    n = max(slices, -(-size // slice_bytes))
    per_slice = files_per_slice(-(-size // n), spark.sparkContext.defaultParallelism)
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    earlier = spark.conf.get(coalescing)
    spark.conf.set(coalescing, "false")
    try:
        df.repartitionByRange(n * per_slice, ts).sortWithinPartitions(ts).write.parquet(path)
    finally:
        spark.conf.set(coalescing, earlier)
    # By the number of the task that wrote it, which outgrows the digits of names.
    names = sorted(data_files(spark, path), key=lambda name: int(name.split("-")[1]))
    for i, name in enumerate(names):
        millis = 1_000_000_000_000 + 1000 * i
        set_changed(spark, f"{path}/{name}", millis)
        if changed_at(spark, f"{path}/{name}") != millis:
            raise OSError(f"the storage of {path} keeps no times that are set, so slices have no order")
    # Ranges without rows have no file; what is there makes as many micro-batches all the same.
    together = per_slice if len(names) == n * per_slice else max(1, len(names) // n)
    return parquet_stream(spark, path, max_files=together, schema=_with_instants(df.schema))


def files_per_slice(slice_bytes: int, cores: int) -> int:
    """Into how many files a slice of a replay is cut."""
    least, most = -(-slice_bytes // MAX_FILE_BYTES), -(-slice_bytes // MIN_FILE_BYTES)
    return max(1, least, min(cores, most))
