"""Packet sources and sinks: JSON text bodies from files (batch or stream); encoding for forwarding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.packets import ENVELOPE_DDL, JSON_OPTIONS

BODY_SCHEMA = "body STRING"


def parse_packets(raw: DataFrame, body: str = "body") -> DataFrame:
    """Decode JSON text bodies into the envelope; other columns of ``raw`` are kept.

    A body that is not a JSON object decodes to all-NULL fields (``action`` NULL -> malformed).
    Duplicate JSON keys: the last one wins.
    """
    parsed = F.from_json(F.col(body), ENVELOPE_DDL, {"mode": "PERMISSIVE"})
    rest = [c for c in raw.columns if c != body]
    return raw.select(*rest, parsed.alias("__p")).select(
        "__p.seq", "__p.action", "__p.data", "__p.restriction", *rest
    )


def encode_packets(packets: DataFrame) -> DataFrame:
    """Envelope -> one JSON text ``body`` per packet; explicit nulls are kept."""
    rest = [c for c in packets.columns if c not in ("seq", "action", "data", "restriction")]
    return packets.select(
        *rest, F.to_json(F.struct("seq", "action", "data", "restriction"), JSON_OPTIONS).alias("body")
    )


def write_packets(bodies: DataFrame, path: str) -> None:
    """Append JSON bodies as text files (one packet per line)."""
    bodies.select("body").write.mode("append").text(path)


def read_packets(spark: SparkSession, path: str, streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Packets from JSON text files: batch ``read.text`` or a Structured Streaming file source.

    The stream takes files in modification order; ``max_files_per_trigger`` bounds a micro-batch.
    """
    if streaming:
        reader = spark.readStream.format("text")
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        raw = reader.load(path).withColumnRenamed("value", "body")
    else:
        raw = spark.read.text(path).withColumnRenamed("value", "body")
    return parse_packets(raw)
