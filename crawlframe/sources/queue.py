"""The id queue: messages are decimal text, one id each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlframe.functions.text import strip

MESSAGE_SCHEMA = "delivery_tag long, value binary, ts timestamp"


def publish_ids(ids: DataFrame, id_column: str = "id") -> DataFrame:
    """One message per id, in the column a file or Kafka sink expects."""
    return ids.select(F.col(id_column).cast("string").cast("binary").alias("value"))


def write_messages(messages: DataFrame, path: str) -> None:
    """Add messages to a queue folder; a message file appears whole or not at all."""
    messages.write.mode("append").parquet(path)


def read_message_stream(
    spark: SparkSession,
    path: str,
    max_files: int = 1,
    schema: str = MESSAGE_SCHEMA,
    file_glob: str | None = None,
) -> DataFrame:
    """Stream of messages from a queue folder, ``max_files`` files in flight."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.parquet(path)


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str, max_offsets: int, **options: str
) -> DataFrame:
    """The same columns from a Kafka topic; the tag is unique per delivery."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .options(**options)
        .load()
    )
    tag = F.shiftleft(F.col("partition").cast("long"), 44) + F.col("offset")
    return raw.select(tag.alias("delivery_tag"), "value", F.col("timestamp").alias("ts"))


def parse_message_id(messages: DataFrame) -> DataFrame:
    """Add ``submission_id``: null marks a message that is not a decimal long.

    Surrounding whitespace and a sign are fine; anything else, also a number
    beyond 64 bits, is not an id.
    """
    text, decimal = F.col("value").cast("string"), r"\A[+-]?[0-9]+\z"
    # Almost every message is a bare number; only the others are stripped.
    number = F.when(text.rlike(decimal), text).when(strip(text).rlike(decimal), strip(text))
    return messages.withColumn("submission_id", number.try_cast("long"))


def split_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(ids, dead letters)``; together they hold every message once."""
    parsed = parse_message_id(messages)
    good = parsed.filter(F.col("submission_id").isNotNull())
    dead = parsed.filter(F.col("submission_id").isNull()).drop("submission_id")
    return good, dead
