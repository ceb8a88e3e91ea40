"""Structured Streaming forms: windowed event counts and a running pattern ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def windowed_counts(events: DataFrame, at: str, by: list[str], window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(window_start, by, n, total): tumbling windows with a watermark; batch frames give the same rows."""
    w = events.withWatermark(at, late) if events.isStreaming else events
    out = w.groupBy(F.window(at, window).alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), *by, "n")


def ledger_stream(decisions: DataFrame, path: str, checkpoint: str, keys: list[str], at: str):
    """A query that keeps the latest decision of each key: every micro-batch upserts into a new version of the table.

    The table's current version is the last line of ``path``/current; a batch that is run again writes the
    same rows, so the result is exactly once.
    """
    from textlens.operators.curation import upsert

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = current(spark, path, before=number)
        new = batch.select(*(old.columns if old is not None else batch.columns))
        merged = upsert(old.limit(0) if old is None else old, new, keys, at) if old is not None else upsert(new.limit(0), new, keys, at)
        merged.write.mode("overwrite").parquet(f"{path}/v={number}")

    return decisions.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)


def current(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The latest complete version of the ledger table, None before the first."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    found = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(name[2:]))
    found = [v for v in found if before is None or v < before]
    return spark.read.parquet(f"{path}/v={max(found)}") if found else None
