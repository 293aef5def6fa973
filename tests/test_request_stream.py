"""Requests that arrive in pieces (M16s): any split gives the batch result."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from shopcast.operators import forecast as FC
from shopcast.operators import ml
from shopcast.plans import ml_queries as MQ
from shopcast.plans.context import build_context
from shopcast.session import checkpoint_dir
from shopcast.sources.schemas import REQUEST_PART
from shopcast.streaming import request_stream as RS


@pytest.fixture(scope="module")
def small(spark):
    ctx = build_context(spark, SF_SMALL)
    train, _, aggs = MQ.split_frames(ctx)
    return ctx, aggs, ml.fit_model(train, "rf", {"numTrees": 5, "maxDepth": 3, "minInstancesPerNode": 5})[0]


def run(spark, small, root, **options):
    ctx, aggs, model = small
    q = RS.start_request_stream(spark, f"{root}/in", f"{root}/out", f"{root}/chk", ctx.inputs.store, ctx.calendar, aggs, model, ctx.epoch, **options)
    q.awaitTermination()


def parts(spark, rows):
    full = [(i, s, d, 0, 0, 0, 0, 1, n) for i, s, d, n in rows]
    return spark.createDataFrame(full, REQUEST_PART).coalesce(1)


def test_any_split_equals_batch(spark, small):
    ctx, aggs, model = small
    req = MQ._requests_from_future(ctx)
    want, _ = FC.forecast_batch(req, ctx.inputs.store, ctx.calendar, aggs, model, ctx.epoch)
    want = sorted(map(tuple, want.collect()))
    sizes = req.groupBy("request_id").agg(F.count(F.lit(1)).cast("int").alias("n_rows"))
    pieces = req.join(sizes, "request_id").withColumn("Date", F.col("Date").cast("string"))
    for files, by, per_batch in ((1, "Date", 1), (4, "Date", 2), (3, "request_id", 1)):
        root = os.path.join(checkpoint_dir(spark), f"pieces-{uuid.uuid4().hex[:8]}")
        pieces.repartition(files, by).write.parquet(f"{root}/in")
        run(spark, small, root, files_per_batch=per_batch)
        assert sorted(map(tuple, spark.read.parquet(f"{root}/out").drop("batch").collect())) == want, (files, by)
        assert spark.read.parquet(f"{root}/out_rejected").count() == 0


def test_reasons_of_rows_that_are_not_scored(spark, small):
    root = os.path.join(checkpoint_dir(spark), f"pieces-{uuid.uuid4().hex[:8]}")
    day = "2001-11-{:02d}".format
    first = [("whole", 1, day(1), 2), ("whole", 1, day(2), 2), ("half", 1, day(1), 3), (None, 1, day(1), 1), ("over", 1, day(1), 1), ("over", 1, day(2), 1),
             ("huge", 1, day(1), FC.MAX_REQUEST_ROWS + 1), ("bad", 99999, day(1), 2), ("bad", 1, "never", 2), ("silent", 1, day(1), None)]
    parts(spark, first).write.parquet(f"{root}/in")
    run(spark, small, root, wait_ms=1)
    time.sleep(0.1)
    # A later run of the same stream: rows of an answered and of a given-up request.
    parts(spark, [("whole", 1, day(3), 2), ("new", 1, day(4), 1)]).write.mode("append").parquet(f"{root}/in")
    run(spark, small, root, wait_ms=1)
    parts(spark, [("half", 1, day(2), 3)]).write.mode("append").parquet(f"{root}/in")
    run(spark, small, root, wait_ms=1)
    done = sorted((r.request_id, str(r.Date)) for r in spark.read.parquet(f"{root}/out").collect())
    assert done == [("new", day(4)), ("whole", day(1)), ("whole", day(2))]
    bad = sorted(((r.request_id or "", r.Date, r.reason) for r in spark.read.parquet(f"{root}/out_rejected").collect()))
    assert bad == sorted([("", day(1), RS.NO_ID), ("half", day(1), RS.INCOMPLETE), ("silent", day(1), RS.INCOMPLETE), ("over", day(1), RS.TOO_MANY),
                          ("over", day(2), RS.TOO_MANY), ("huge", day(1), RS.TOO_MANY), ("bad", day(1), FC.UNKNOWN_STORE),
                          ("bad", "never", "unparsable_date"), ("whole", day(3), RS.LATE), ("half", day(2), RS.LATE)])
