"""Streaming forecast of requests that arrive in pieces (M16s).

Request rows announce how many rows their request has (``n_rows``). Keyed
state holds the rows of a request until it is complete, whatever files and
micro-batches they come in; complete requests are scored by the batch operator
(M16), so any split gives the batch result. Every other row goes to the
rejects with its reason:

* ``incomplete_request``: rows were missing when ``wait_ms`` had passed since
  the request's last row;
* ``too_many_rows``: the request announces or sends more rows than a request
  may have, or more than it announced;
* ``late_row``: the request was already answered or given up (known for
  ``keep_ms`` after that; then the id may be used anew);
* ``missing_request_id``, and the reasons of the batch operator.

A request's state is bounded by ``MAX_REQUEST_ROWS`` rows. The checkpoint
holds states and offsets, so a restarted stream goes on where it stopped; each
micro-batch writes its own folder, so a repeated one writes the same output
once.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shopcast.operators.forecast import MAX_REQUEST_ROWS, RULES, forecast_batch
from shopcast.sources.schemas import REQUEST, REQUEST_PART

INCOMPLETE, LATE, NO_ID = "incomplete_request", "late_row", "missing_request_id"
TOO_MANY = RULES[3]
OUT = T.StructType([*REQUEST.fields, T.StructField("reason", T.StringType())])
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE = "rows string, expected int, closed boolean"


def assembler(wait_ms: int, keep_ms: int, max_rows: int = MAX_REQUEST_ROWS):
    """The state function: rows of one request -> rows with their reason (NULL
    where the request is complete), or nothing while it is held."""
    names = REQUEST.fieldNames()

    def out(rows: list[list], reason: str | None) -> pd.DataFrame:
        # Objects keep integers beside missing values.
        return pd.DataFrame([[*r, reason] for r in rows], columns=[*names, "reason"], dtype=object)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, expected, closed = ([], None, False)
        if state.exists:
            rows, expected, closed = state.get
            held = json.loads(rows)
        if state.hasTimedOut:
            if closed:
                state.remove()
            else:
                state.update(("[]", expected, True))
                state.setTimeoutDuration(keep_ms)
                yield out(held, INCOMPLETE)
            return
        for batch in batches:
            batch = batch.astype(object).where(batch.notna(), None)
            if key[0] is None:
                yield out(batch[names].values.tolist(), NO_ID)
                continue
            if closed:
                yield out(batch[names].values.tolist(), LATE)
                continue
            announced = [int(n) for n in batch["n_rows"] if n is not None]
            expected = max([*announced, *([expected] if expected is not None else [])], default=None)
            held += [[None if v is None else int(v) if isinstance(v, (int, float)) else str(v) for v in r] for r in batch[names].values.tolist()]
            if len(held) > max_rows or expected is not None and expected > max_rows:
                closed = True
                yield out(held, TOO_MANY)
                held = []
        if key[0] is None:
            return
        if not closed and expected is not None and len(held) >= expected:
            closed = True
            yield out(held, None if len(held) == expected else TOO_MANY)
            held = []
        state.update((json.dumps(held), expected, closed))
        state.setTimeoutDuration(keep_ms if closed else wait_ms)

    return run


def assembled(parts: DataFrame, wait_ms: int, keep_ms: int) -> DataFrame:
    """Request rows with ``reason`` from a stream of request parts."""
    return parts.groupBy("request_id").applyInPandasWithState(
        assembler(wait_ms, keep_ms), OUT, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def start_request_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str, store: DataFrame, calendar: DataFrame,
                         aggs, model, epoch: str, fmt: str = "parquet", available_now: bool = True, with_interval: bool = True,
                         files_per_batch: int | None = None, wait_ms: int = 600_000, keep_ms: int = 86_400_000):
    """Start the stream; forecasts go to ``sink_dir``, rejected rows with their
    reason to ``<sink_dir>_rejected``."""
    stream = spark.readStream.schema(REQUEST_PART).format(fmt)
    if fmt == "csv":
        stream = stream.option("header", True)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    def score(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            complete = batch.where("reason is null").drop("reason")
            out, rejected = forecast_batch(complete, store, calendar, aggs, model, epoch, with_interval)
            out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch={number}")
            rejected.unionByName(batch.where("reason is not null")).write.mode("overwrite").parquet(
                f"{sink_dir.rstrip('/')}_rejected/batch={number}")
        finally:
            batch.unpersist()

    w = assembled(stream.load(source_dir), wait_ms, keep_ms).writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    if not available_now:
        return w.trigger(processingTime="10 seconds").start()
    # Waiting times keep a stream busy with batches of no data, so one that ends
    # with its files goes without them: times that ran out count in the next batch.
    before = spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(EMPTY_BATCHES, "false")
    try:
        return w.trigger(availableNow=True).start()
    finally:
        spark.conf.set(EMPTY_BATCHES, before)
