"""A long-lived worker as a Structured Streaming query, and windows over event streams (an extension)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = ("batch", "package", "config")


def envelope(value: Column) -> Column:
    """The parts of a job: an object of the known keys alone, or a whole document that is the package; unknown keys next to
    known ones are an error. struct(batch, package, config, error)."""
    m = F.from_json(value, "map<string,string>")
    keys = F.map_keys(m)
    known = F.array(*map(F.lit, ENVELOPE))
    none, odd = ~F.arrays_overlap(keys, known), F.size(F.array_except(keys, known)) > 0
    part = lambda k: F.when(~none & ~odd, F.element_at(m, k))
    return F.struct(part("batch").alias("batch"), F.when(none, value).otherwise(part("package")).alias("package"), part("config").alias("config"), F.when(m.isNull(), "unreadable").when(~none & odd, "unknown keys").alias("error"))


def run_jobs(jobs: DataFrame, process: Callable[[DataFrame], DataFrame], done: str, failed: str, checkpoint: str, interval: str | None = "5 seconds"):
    """Process micro-batches of jobs (id, value). Rows with a bad envelope go to ``failed``; where a batch fails its jobs run
    again one by one, so that only those that fail themselves go there. A job's id must be its own. Each batch writes a
    folder of its own, which a retry replaces."""
    def handle(df: DataFrame, n: int) -> None:
        df = df.persist()
        parsed = df.select("id", "value", envelope(F.col("value")).alias("job"))
        bad = [parsed.where("job.error IS NOT NULL").select("id", "value", F.col("job.error").alias("error"))]
        good = parsed.where("job.error IS NULL").select("id", "job.*")
        try:
            process(good).write.mode("overwrite").parquet(f"{done}/batch={n}")
        except Exception:  # noqa: BLE001  a failing job must not stop the worker or the others
            mode = "overwrite"
            for row in good.select("id").toLocalIterator():
                try:
                    process(good.where(F.col("id") == row.id)).write.mode(mode).parquet(f"{done}/batch={n}")
                    mode = "append"
                except Exception as e:  # noqa: BLE001
                    bad.append(df.where(F.col("id") == row.id).select("id", "value", F.lit(str(e)[:500]).alias("error")))
        for i, rows in enumerate(bad):
            rows.write.mode("append" if i else "overwrite").parquet(f"{failed}/batch={n}")
        df.unpersist()

    writer = jobs.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def tumbling(events: DataFrame, time: str, keys: list[str], width: str, late: str = "1 hour") -> DataFrame:
    """Counts per window: not an operator of the reference, added because an event table is there."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), *keys, "n")


def sessions(events: DataFrame, time: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("session_window.start").alias("session_start"), *keys, "n")
