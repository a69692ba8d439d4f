"""Stream record decoding (ops 6, 7) and stream sources.

A record is base64 text holding one JSON object.  Decoding is
``unbase64 -> checked UTF-8 -> from_json`` with an explicit schema, so the
same function serves a static DataFrame (tests, replays) and a
``readStream`` source.  Undecodable records parse to NULL fields and are
then skipped by validation rather than failing the micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow import schemas


def decode_records(records: DataFrame, schema: T.StructType, data: str = "data",
                   keep: tuple[str, ...] = ("record_id",)) -> DataFrame:
    # bytes that are not UTF-8 give NULL, hence NULL fields and a skipped record
    text = F.try_validate_utf8(F.try_to_binary(F.col(data), F.lit("base64")).cast("string"))
    payload = F.from_json(text, schema, {"mode": "PERMISSIVE"})
    kept = [c for c in keep if c in records.columns]
    return records.select(*kept, payload.alias("p")).select(*kept, "p.*")


def decode_stream_events(records: DataFrame) -> DataFrame:
    """6: base64 JSON click events -> typed columns (camel-case names kept)."""
    return decode_records(records, schemas.STREAM_EVENT)


def decode_stream_content(records: DataFrame) -> DataFrame:
    """7: base64 JSON article updates -> typed columns."""
    return decode_records(records, schemas.STREAM_CONTENT)


def read_record_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100,
                       fmt: str = "json") -> DataFrame:
    """File-backed record stream (``record_id``, ``data``).

    ``maxFilesPerTrigger`` bounds a micro-batch the way the source
    system's batch size does; a Kafka source would use
    ``maxOffsetsPerTrigger`` with ``value`` cast to string as ``data``.
    """
    return (spark.readStream.format(fmt).schema(schemas.STREAM_RECORD)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def read_kafka_record_stream(spark: SparkSession, servers: str, topic: str,
                             max_offsets_per_trigger: int = 100_000,
                             starting: str = "latest") -> DataFrame:
    """Kafka-backed record stream with the same (``record_id``, ``data``) shape.

    ``startingOffsets=latest`` matches the source system's LATEST start;
    ``maxOffsetsPerTrigger`` bounds a micro-batch.  Needs the Spark Kafka
    connector on the classpath (not part of the test image).
    """
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", max_offsets_per_trigger).load()
            .select(F.concat_ws(":", F.col("partition").cast("string"),
                                F.col("offset").cast("string")).alias("record_id"),
                    F.col("value").cast("string").alias("data")))
