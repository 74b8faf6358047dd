"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Words are runs of anything but these six white-space characters.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Code points of text (bytes in `mapped_batches`) that a Python helper holds as tokens at one time.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def body(column: str = "text") -> Column:
    """A text column in which a missing text is an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def mapped(df: DataFrame, work: Callable[[list, list], dict], schema: str) -> DataFrame:
    """Rows of a two-column (id, text) table through `work(ids, texts)`, in slices of bounded length.

    `work` returns the columns of `schema` as lists or arrays. Slices end after `SLICE_CHARS`
    code points, so that a batch of long texts is not tokenised as a whole.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(fields)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in slices(texts):
                columns = work(ids[lo:hi], [t or "" for t in texts[lo:hi]])
                arrays = [pa.array(columns[f.name], type=f.type) for f in out]
                if len(arrays[0]):
                    yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.mapInArrow(run, fields)


def mapped_batches(df: DataFrame, work: Callable[[pa.RecordBatch], dict], more: str) -> DataFrame:
    """`df` with the columns `more` instead of `text`, in slices of bounded length as in `mapped`.

    `work` gets a slice of the table in Arrow form and returns the columns `more` as Arrow arrays.
    """
    added = df.sparkSession.createDataFrame([], more).schema
    fields = StructType([f for f in df.schema if f.name != "text"] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(fields)
        for batch in batches:
            for lo, hi in cuts(pc.binary_length(batch["text"]).to_pylist()):
                part = batch.slice(lo, hi - lo)
                columns = {n: part[n] for n in part.schema.names} | work(part)
                yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in out], schema=out)

    return df.mapInArrow(run, fields)


def slices(texts: list) -> Iterator[tuple[int, int]]:
    return cuts([len(text or "") for text in texts])


def cuts(lengths: list) -> Iterator[tuple[int, int]]:
    lo = held = 0
    for i, length in enumerate(lengths):
        held += length or 0
        if held >= SLICE_CHARS:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(lengths):
        yield lo, len(lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
