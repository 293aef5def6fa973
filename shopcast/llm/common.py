"""Helpers that the operators share: narrow inputs, batches of texts, shared
intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopcast.session import materialize

#: Rows that one numpy step works on; bounds what a task holds beside the Arrow batch.
CHUNK_ROWS = 512

WORD = r"[^\x20\x09-\x0D]+"


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that text operators read, whatever else ``docs`` has;
    a null text becomes the empty text, a null id stays null."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def map_texts(rows: DataFrame, make: Callable[[], tuple], schema: str) -> DataFrame:
    """Apply a per-batch text function inside tasks.

    ``rows`` has (key, text, ...); ``make()`` runs once per task and returns a
    function (keys, texts) -> {column: values}, and what to call when the task
    ends. Batches are cut into ``CHUNK_ROWS`` rows, so memory is bounded by the
    rows of a chunk."""
    names = [f.split()[0] for f in schema.split(", ")]
    types = [_ARROW[f.split()[1]] for f in schema.split(", ")]
    key, text = rows.columns[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, forget = make()
        try:
            for b in chunks(batches):
                out = fn(b.column(key).to_pylist(), b.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names)
        finally:
            forget()

    return rows.mapInArrow(run, schema)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each made different from every column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n in taken:
            n = f"_{n}"
        taken.add(n)
        out.append(n)
    return out


def nothing() -> None:
    """For functions that hold nothing to forget."""


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, CHUNK_ROWS):
            yield whole.slice(at, CHUNK_ROWS)


def map_rows(df: DataFrame, make: Callable[[], tuple]) -> DataFrame:
    """Whole rows through a function batch -> batch of the same schema, with
    ``make`` as for ``map_texts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, forget = make()
        try:
            for b in chunks(batches):
                yield fn(b)
        finally:
            forget()

    return df.mapInArrow(run, df.schema)


def with_column(batch: pa.RecordBatch, name: str, values: list) -> pa.RecordBatch:
    """The batch with a column's values replaced."""
    i = batch.schema.get_field_index(name)
    cols = list(batch.columns)
    cols[i] = pa.array(values, batch.schema.field(i).type)
    return pa.RecordBatch.from_arrays(cols, schema=batch.schema)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
          "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}


#: Shuffle files go when the job that made them ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared(df: DataFrame, name: str, rows_per_batch: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back, so that
    later jobs start from files that outlive any executor; the shuffle files of
    the job that wrote it are not needed then and go at once. ``rows_per_batch``
    bounds the Arrow batches of a job whose rows are wide."""
    conf = df.sparkSession.conf
    settings = {TIDY: "true"} | ({"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_per_batch)} if rows_per_batch else {})
    before = {key: conf.get(key) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    try:
        return materialize(df, f"llm-{name}")
    finally:
        for key, value in before.items():
            conf.set(key, value)


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``shared`` wrote, once all that reads them is written too."""
    for df in tables:
        context = df.sparkSession.sparkContext
        jvm = context._jvm
        files = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
        for folder in {p.getParent().toString(): p.getParent() for p in files}.values():
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
