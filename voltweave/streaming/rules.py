"""Hard rules on a stream of readings: an extension of the batch rules, with the same columns and results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltweave.operators.rules import hard_anomalies, hard_flags


def deduplicated(readings: DataFrame, late: str = "2 days") -> DataFrame:
    """First reading of each meter, date and slot; READ_AT is its event time, and what is later than `late` is dropped, with its state."""
    return readings.withWatermark("READ_AT", late).dropDuplicatesWithinWatermark(["MTR_NO", "DATE", "TIME_SLOT"])


def anomaly_stream(readings: DataFrame, late: str = "2 days") -> DataFrame:
    """One row per true flag of the deduplicated stream; stateless beyond the deduplication."""
    return hard_anomalies(hard_flags(deduplicated(readings, late)))


def anomaly_counts(readings: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Anomalies by type in windows of event time; a window is final when the watermark has passed it."""
    flags = hard_flags(readings.withWatermark("READ_AT", late))
    kinds = F.array(*[F.when(F.col(f), F.lit(name)) for f, name in _names().items()])
    rows = flags.select("READ_AT", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("ANOMALY_TYPE"))
    return rows.groupBy(F.window("READ_AT", window), "ANOMALY_TYPE").agg(F.count("*").alias("n"))


def _names() -> dict[str, str]:
    from voltweave.operators.rules import rules

    return {flag: name for flag, (_, name, _) in rules().items()}


def to_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends what has come so far to a Parquet table, then stops; run again, it goes on from there."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
