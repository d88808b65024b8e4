"""Streams: the batch operators with watermarks, and context carried across pages as they come."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewater.operators.context import context_updates

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream; a file is read once, as the query's checkpoint remembers."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed(events: DataFrame, width: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """Counts and sums of each window and event type; the same on a batch and on a stream that isn't later than ``late``."""
    timed = events.withColumn("t", F.col("ts").cast("timestamp")).withWatermark("t", late)
    return timed.groupBy(F.window("t", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v"))


def sessions(events: DataFrame, gap: str = "2 hours", late: str = "1 hour") -> DataFrame:
    timed = events.withColumn("t", F.col("ts").cast("timestamp")).withWatermark("t", late)
    return timed.groupBy(F.session_window("t", gap), "user_id").agg(F.count("*").alias("n"))


def first_events(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Without repeats of a signature within the watermark."""
    timed = events.withColumn("t", F.col("ts").cast("timestamp")).withWatermark("t", late)
    return timed.dropDuplicatesWithinWatermark(["user_id", "event_type", "ts"])


def carry(lines: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, order, value): the last value of a key that isn't null, carried over micro-batches; lines come in order."""

    def fill(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(order)
        out = []
        for v in rows[value]:
            last = v if v is not None and v == v else last
            out.append(last)
        state.update((last,))
        yield pd.DataFrame({key: rows[key].to_numpy(), order: rows[order].to_numpy(), value: pd.Series(out, dtype="object")})

    kinds = {c: lines.schema[c].dataType.simpleString() for c in (key, order, value)}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items())
    return lines.select(key, order, value).groupBy(key).applyInPandasWithState(fill, schema, f"last {kinds[value]}", "append", GroupStateTimeout.NoTimeout)


def carry_context(lines: DataFrame, key: str, order: list[str], line: str = "line", idle_ms: int | None = None) -> DataFrame:
    """(key, order, port, month, day): the context of each line as ``operators.context.carry_context`` gives it, carried over micro-batches.

    The state of a key is its city, port, month and day; a record's own date becomes the context of the lines after it. Lines of a micro-batch are put in
    order; those of later batches come later in the document. What a line changes is worked out by columns; only four values
    are carried in Python. With ``idle_ms`` a key without lines for so long is forgotten, and begins anew if more come; Spark then
    runs empty batches to see who is idle, so give it to queries that run on, not to those that end with the data at hand.
    """
    own = lines.select(key, *order, *(v.alias(n) for n, v in context_updates(F.col(line)).items()))
    state = "city string, port string, month string, day int"

    def fill(group: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        city, port, month, day = held.get if held.exists else (None, None, None, None)
        rows = pd.concat(list(batches)).sort_values(order)
        out: list[tuple] = []
        for name, is_city, is_dock, m, d in zip(rows["_name"], rows["_is_city"], rows["_dock"], rows["month"], rows["day"]):
            if isinstance(name, str):
                if is_city:
                    city = name
                elif not is_dock:
                    city = None
                port = f"{city} ({name})" if is_dock and city else name
            month = m if isinstance(m, str) else month
            day = int(d) if d == d and d is not None else day
            out.append((port, month, day))
        held.update((city, port, month, day))
        if idle_ms is not None:
            held.setTimeoutDuration(idle_ms)
        filled = {c: pd.Series([o[i] for o in out], dtype="Int32" if c == "day" else "object") for i, c in enumerate(("port", "month", "day"))}
        yield pd.DataFrame({c: rows[c].to_numpy() for c in (key, *order)} | filled)

    kinds = ", ".join(f"{c} {lines.schema[c].dataType.simpleString()}" for c in (key, *order))
    timeout = GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return own.groupBy(key).applyInPandasWithState(fill, f"{kinds}, port string, month string, day int", state, "append", timeout)
