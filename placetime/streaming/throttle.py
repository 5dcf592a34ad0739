"""Leading-edge throttle over a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from placetime.functions import values
from placetime.operators.events import NEVER, THROTTLE_MS, kept_positions


def throttle_stream(events: DataFrame, key: str, ts: str, tie: str, wait_ms: int = THROTTLE_MS) -> DataFrame:
    """Let one event per key through, drop the rest for ``wait_ms``, repeat.

    The state of a key is the time of its last kept event and a count of late events.
    Events older than the last kept one are dropped and counted in ``late``; the count
    so far comes with every kept row.
    """
    wait = wait_ms * 1000
    kind = events.schema[ts].dataType.simpleString()
    key_type = events.schema[key].dataType.simpleString()
    tie_type = events.schema[tie].dataType.simpleString()
    timed = events.select(key, values.micros(ts, kind).alias("_at"), tie)
    columns = [key, "_at", tie]

    def run(group, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, late = state.get if state.exists else (NEVER, 0)
        # one micro-batch of one key
        batch = pd.concat(list(frames)).sort_values(["_at", tie])
        at = batch["_at"].to_numpy()
        late += int((at < last).sum())
        rows = batch.iloc[kept_positions(at, wait, last + wait)]
        if len(rows):
            last = int(rows["_at"].iloc[-1])
        state.update((last, late))
        yield rows[columns].assign(late=late)

    kept = timed.groupBy(key).applyInPandasWithState(
        run,
        f"{key} {key_type}, _at bigint, {tie} {tie_type}, late bigint",
        "last bigint, late bigint",
        "append",
        "NoTimeout",
    )
    return kept.select(key, values.from_micros("_at", kind).alias(ts), tie, "late")


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Drain what the source holds now into a parquet table and read it back."""
    spark: SparkSession = stream.sparkSession
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
