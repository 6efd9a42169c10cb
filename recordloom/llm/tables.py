"""Reading input tables and mapping Python code over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, opened by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_texts(
    docs: DataFrame,
    make: Callable[[], Callable],
    fields: list[tuple[str, T.DataType]],
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    batch_rows: int = 500,
    batched: bool = False,
) -> DataFrame:
    """Columns ``keep`` of every row beside what a function makes of its text.

    ``make`` runs once a task and returns the function from a text (or None)
    to a tuple of ``fields`` (``batched``: from a list of texts to a list of
    such tuples). Rows are neither dropped nor moved: there is no shuffle, and
    a task holds one Arrow batch at a time.
    """
    source = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *(T.StructField(n, t) for n, t in fields)])
    arrow = pa.schema([(n, _arrow(t)) for n, t in fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for whole in batches:
            for at in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(at, batch_rows)
                texts = batch.column(batch.num_columns - 1)
                rows = each(texts.to_pylist()) if batched else [each(t.as_py()) for t in texts]
                made = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)] if rows else [pa.array([], f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=schema.names)

    return source.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
