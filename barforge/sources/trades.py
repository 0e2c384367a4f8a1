"""Trade message sources: decode, parse, split.

The same functions serve a batch DataFrame of captured messages and a
streaming DataFrame from Kafka or from a folder of text files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.exprs import parse_ts
from barforge.functions.validity import missing_fields
from barforge.schema import TRADE_WIRE_SCHEMA


def read_kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    extra_options: dict | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Kafka scan of the trade topic (key = symbol bytes, value = JSON bytes).

    ``max_offsets_per_trigger`` bounds each micro-batch (a backlog after a restart
    is drained in bounded steps); ``min_partitions`` splits large topic partitions
    over more tasks than the topic has partitions. Needs the spark-sql-kafka
    connector on the classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    for k, v in (extra_options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 over files: one message per line, exposed as a ``value`` column like Kafka's."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def parse_trades(
    raw: DataFrame, value_col: str = "value", keep_ts_text: bool = False, passthrough: list[str] | None = None
) -> DataFrame:
    """Payload -> typed trade columns plus ``raw_json``.

    ``from_json`` is PERMISSIVE: bad JSON gives all-NULL fields, one bad field
    gives only that field NULL. ``ts`` is parsed with ``try_to_timestamp`` so an
    unparseable time is NULL (malformed), never a query failure.
    ``passthrough`` carries source columns along (e.g. Kafka partition/offset).
    """
    extra = list(passthrough or [])
    decoded = raw.select(*extra, F.col(value_col).cast("string").alias("raw_json"))
    parsed = decoded.select(*extra, "raw_json", F.from_json("raw_json", TRADE_WIRE_SCHEMA).alias("d"))
    fields = [
        F.col("d.symbol").alias("symbol"),
        F.col("d.price").alias("price"),
        F.col("d.size").alias("size"),
        F.col("d.side").alias("side"),
        F.col("d.trade_id").alias("trade_id"),
        parse_ts(F.col("d.ts")).alias("ts"),
    ]
    if keep_ts_text:
        fields.append(F.col("d.ts").alias("ts_text"))
    # The struct is expanded by a one-row ``inline`` (a Generate node): filters on
    # the parsed fields cannot be pushed below it, so each message is parsed once
    # instead of once per field referenced by the validity predicate.
    return parsed.select(*extra, "raw_json", F.inline(F.array(F.struct(*fields))))


def split_trades(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, malformed). The predicate is never NULL, so the split is exact."""
    missing = missing_fields()
    return parsed.filter(missing == 0), parsed.filter(missing > 0)
