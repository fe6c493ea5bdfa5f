"""The audit trail of runs: events as a table, and reports over log lines."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docvec.sources.storage import Storage

# The line format ``yyyy-MM-dd HH:mm:ss | message``.
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
_STRFTIME = "%Y-%m-%d %H:%M:%S"
SEPARATOR = " | "
LINE_PATTERN = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) \| (.*)$"

EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)


@dataclass
class Audit:
    """Events of one run: a few dozen rows, kept on the driver until stored."""

    run_id: str
    events: list[tuple] = field(default_factory=list)
    echo: bool = False

    def note(
        self, stage: str, message: str, metric: str | None = None,
        value: int | None = None, channel: str = "audit",
    ) -> None:
        now = dt.datetime.now()
        self.events.append((self.run_id, stage, channel, metric, value, message, now))
        if self.echo:
            print(f"{now:{_STRFTIME}}{SEPARATOR}{message}")

    def count(self, stage: str, metric: str, value: int) -> None:
        self.note(stage, f"{stage}: {metric} = {value}", metric, int(value))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.events, EVENTS_SCHEMA)

    def publish_log(self, spark: SparkSession, folder: str, job: str) -> str:
        """Write the run's lines as one text file; the path."""
        at = int(self.events[0][-1].timestamp() * 1000) if self.events else 0
        path = f"{folder.rstrip('/')}/{job}_{self.run_id}_{at}.log"
        lines = [f"{ts:{_STRFTIME}}{SEPARATOR}{message}" for *_, message, ts in self.events]
        Storage(spark).publish(path, "".join(f"{line}\n" for line in lines))
        return path

    def store(self, spark: SparkSession, path: str) -> None:
        """Append the events to the ``audit_events`` table."""
        self.table(spark).coalesce(1).write.mode("append").parquet(path)


def log_line() -> Column:
    """An event in the line format."""
    return F.concat(F.date_format("ts", TS_FORMAT), F.lit(SEPARATOR), "message")


def log_lines(events: DataFrame) -> DataFrame:
    """One ``value`` per event in the line format."""
    return events.select(log_line().alias("value"))


def write_log(events: DataFrame, folder: str, job: str, run_id: str, at_ms: int) -> str:
    """Write one run's lines as one text file; a run has few of them."""
    path = f"{folder.rstrip('/')}/{job}_{run_id}_{at_ms}.log"
    ordered = events.filter(F.col("run_id") == run_id).coalesce(1).sortWithinPartitions("ts")
    log_lines(ordered).write.mode("overwrite").text(path)
    return path


def audit_summary(events: DataFrame, by: str = "channel") -> DataFrame:
    """Entries per channel."""
    return events.groupBy(by).agg(F.count(F.lit(1)).alias("entries"))


def parse_lines(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """``ts`` and ``message`` of audit lines; other lines are left out."""
    rest = [c for c in lines.columns if c != line_col]
    stamp = F.regexp_extract(line_col, LINE_PATTERN, 1)
    return lines.filter(F.col(line_col).rlike(LINE_PATTERN)).select(
        *rest,
        F.to_timestamp(stamp, TS_FORMAT).alias("ts"),
        F.regexp_extract(line_col, LINE_PATTERN, 2).alias("message"),
    )


def number_runs(lines: DataFrame, starts: str, log_col: str = "log") -> DataFrame:
    """Adds ``run``: how many runs of its log had started by a row's ``ts``.

    ``starts`` counts the run starts of a row. The running count is taken within
    each hour of a log, and the counts of the hours before are added from a small
    table, so that a long log is spread over many tasks.
    """
    hourly = lines.withColumn("_hour", F.date_trunc("hour", "ts"))
    hours = hourly.groupBy(log_col, "_hour").agg(F.sum(starts).alias("_n"))
    earlier = (
        Window.partitionBy(log_col)
        .orderBy("_hour")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = hours.select(
        log_col, "_hour", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    within = (
        Window.partitionBy(log_col, "_hour")
        .orderBy("ts")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = hourly.withColumn("_within", F.sum(starts).over(within))
    return (
        counted.join(offsets, [log_col, "_hour"])
        .withColumn("run", F.col("_before") + F.col("_within"))
        .drop("_hour", "_before", "_within")
    )


def run_report(
    lines: DataFrame, start_pattern: str, stage_pattern: str, log_col: str = "log"
) -> DataFrame:
    """Lines, first and last time and seconds per log, run and stage.

    ``start_pattern`` matches the line that opens a run, the first group of
    ``stage_pattern`` names the stage of a line; lines without one, or before the
    first run, are left out. Lines are counted per second first, map-side, so a
    busy second of a log becomes one row per stage.
    """
    stage = F.regexp_extract("message", stage_pattern, 1)
    opens = F.col("message").rlike(start_pattern).cast("bigint")
    seconds = (
        parse_lines(lines)
        .groupBy(log_col, "ts", stage.alias("stage"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(opens).alias("starts"))
    )
    runs = number_runs(seconds, "starts", log_col)
    kept = runs.filter((F.col("stage") != "") & (F.col("run") > 0))
    first, last = F.min("ts"), F.max("ts")
    return kept.groupBy(log_col, "run", "stage").agg(
        F.sum("n").alias("n_lines"),
        first.alias("started"),
        last.alias("ended"),
        (F.unix_timestamp(last) - F.unix_timestamp(first)).alias("seconds"),
    )
