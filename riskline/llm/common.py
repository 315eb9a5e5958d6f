"""Small helpers shared by the training-data operators."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words, as a regular expression class body.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str) -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the words of a text (empty for a text without words)."""
    trimmed = F.trim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE}]+"))


def byte_slices(texts: pa.Array, max_bytes: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of consecutive slices of about ``max_bytes`` text bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at, done = 0, 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
        yield at, to - at
        at, done = to, int(ends[to - 1])


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage and survives lost executors."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
