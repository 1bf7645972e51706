"""Request scoring and state refresh as micro-batches.

A stream of (store, item, forecast_date) requests is joined to the stored state, which is the
batch form of a scoring endpoint. New sales refresh the state table from the clean panel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators.forecast import score_requests
from shelfcast.operators.normalize import normalize_schema
from shelfcast.operators.state import feature_state
from shelfcast.schema import DATE, SERIES
from shelfcast.session import materialize
from shelfcast.sources import tables

REQUEST_SCHEMA = "store string, item string, forecast_date date"


def score_request_stream(
    spark: SparkSession,
    requests: str,
    state_path: str,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """Score each new file of requests once; the state is read anew for every micro-batch."""

    def score_batch(batch: DataFrame, epoch: int) -> None:
        state = tables.load_state(batch.sparkSession, state_path)
        scored = score_requests(batch, state, score).select(*SERIES, "forecast_date", "prediction")
        # The folder is named after the epoch, so a repeated batch replaces its own output.
        tables.write_table(scored, f"{out}/epoch={epoch}")

    return (
        spark.readStream.schema(REQUEST_SCHEMA)
        .json(requests)
        .writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_state(spark: SparkSession, clean_path: str, new_raw: DataFrame, state_path: str) -> None:
    """Append the new days to the clean panel and rebuild the state from it.

    Days that are already stored are kept as they are, so a repeated delivery changes nothing. Rows that a delivery
    repeats count once; one that gives a key two values is refused before anything is written.
    """
    stored = tables.read_table(spark, clean_path)
    delivered = materialize(normalize_schema(new_raw).distinct())
    twice = delivered.groupBy(DATE, *SERIES).count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"The delivery has several values for a key, first {twice.first().asDict()}.")
    fresh = delivered.join(stored.select(DATE, *SERIES), [DATE, *SERIES], "left_anti")
    tables.write_table(fresh.select(*stored.columns), clean_path, mode="append")
    tables.write_state(feature_state(tables.read_table(spark, clean_path)), state_path)
