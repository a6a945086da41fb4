"""Small batches of the fact table brought together into few, without disturbing readers."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .tables import STORED_FACT, commit_batch, effective_batches, next_numbers, write_rows

TARGET_BYTES = 16 << 30


def batch_bytes(spark: SparkSession, fact_path: str) -> dict[int, int]:
    """Stored bytes of each batch that readers see, from the file listing alone: one number per batch."""
    wanted = effective_batches(spark, fact_path)
    if not wanted:
        return {}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load([f"{fact_path}/batch_id={b}" for b in wanted])
    number = F.regexp_extract("path", r"/batch_id=(\d+)/", 1).cast("int")
    sizes = {r[0]: r[1] for r in files.groupBy(number).agg(F.sum("length")).collect()}
    return {b: sizes.get(b, 0) for b in wanted}


def bins(sizes: dict[int, int], target: int) -> list[list[int]]:
    """Batches below half of ``target`` in bins of up to ``target`` bytes, largest first into the first bin with room.

    A bin of one batch is left as it is. There is one number for each batch, so this is a small list at any size of the table.
    """
    filled: list[tuple[int, list[int]]] = []
    for batch, size in sorted(((b, s) for b, s in sizes.items() if 2 * s < target), key=lambda x: (-x[1], x[0])):
        at = next((i for i, (used, _) in enumerate(filled) if used + size <= target), None)
        if at is None:
            filled.append((size, [batch]))
        else:
            filled[at] = (filled[at][0] + size, [*filled[at][1], batch])
    return [sorted(members) for _, members in filled if len(members) > 1]


def compact(spark: SparkSession, fact_path: str, target_bytes: int = TARGET_BYTES) -> list[int]:
    """Rewrites small batches as larger ones; returns the new batch numbers.

    A new batch takes effect with its manifest, one file that appears at once and names the batches it replaces:
    from then on readers see it instead of them. Readers that began earlier keep the old folders, which stay
    where they are. A run that breaks before the manifest leaves a number that the next load uses anew.
    Rows keep their ids. It counts as a load: one at a time may write to a store.
    """
    made = []
    for members in bins(batch_bytes(spark, fact_path), target_bytes):
        number, _ = next_numbers(spark, fact_path)
        rows = spark.read.schema(STORED_FACT).parquet(fact_path).filter(F.col("batch_id").isin(members)).drop("batch_id")
        write_rows(rows, fact_path, number)
        commit_batch(spark, fact_path, number, replaces=members)
        made.append(number)
    return made
