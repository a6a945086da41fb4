"""Words, batches and splits shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: space and U+0009 to U+000D.
BLANK = r"[\x20\x09-\x0D]"


def words_of(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z lower-cased; a null text has none.

    ``bytes.lower`` touches ASCII letters only and ``bytes.split`` cuts at exactly ``BLANK``.
    """
    return text.encode("utf-8", "replace").lower().split() if text else []


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(n).to_pylist() for n in names]


def map_batches(df: DataFrame, convert: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Applies ``convert`` to each Arrow batch; nothing is kept between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield convert(batch)

    return df.mapInArrow(run, schema)


def remainder(id_col: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``: the fold of a document."""
    return F.crc32(F.col(id_col).cast("string") if isinstance(id_col, str) else id_col.cast("string")) % modulus
