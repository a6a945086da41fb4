"""SimHash near-duplicates through deletion-variant signatures."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.components import connected_components
from ledgerwatch.llm.text import columns_of, map_batches, words_of
from ledgerwatch.session import stored

#: Fingerprints in one signature bucket whose pairs are compared one by one; see ``links``.
CROWD = 8
_BLOCK = 1 << 16


def simhash(words: list[bytes], width: int = 3) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = words[at : min(at + _BLOCK, n) + width - 1]
        shingles = zip(*(part[i:] for i in range(width))) if len(part) >= width else [part]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(42)), np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, row_key: Column | None = None) -> DataFrame:
    """The id column and ``fp`` (long) for each row, and ``key`` (binary) where asked for; null and empty texts have fingerprint zero."""
    kind = docs.schema[id_col].dataType.simpleString()

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        (texts,) = columns_of(batch, "t")
        prints = pa.array([simhash(words_of(t), width) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("i"), batch.column("k"), prints], ["i", "k", "fp"])

    key = F.lit(None).cast("binary") if row_key is None else row_key
    rows = docs.select(F.col(id_col).alias("i"), key.alias("k"), F.col(text_col).alias("t"))
    found = map_batches(rows, convert, f"i {kind}, k binary, fp long")
    return found.select(F.col("i").alias(id_col), "fp") if row_key is None else found.select(F.col("i").alias(id_col), F.col("k").alias("key"), "fp")


def _variants(fps: DataFrame) -> DataFrame:
    """64 keys for each fingerprint: either half with one of its 32 bits cleared.

    Fingerprints that differ in at most two bits have a half that differs in at most one, so they
    share a key. A key holds the half (bit 37), the place (bits 32 to 36) and the masked half.
    """
    half = "(shiftrightunsigned(fp, 32 * s) & 4294967295)"
    keys = F.expr(f"flatten(transform(array(0, 1), s -> transform(sequence(0, 31), p -> shiftleft(CAST(32 * s + p AS BIGINT), 32) | ({half} & ~shiftleft(1L, p)))))")
    return fps.select("fp", F.explode(keys).alias("key"))


def links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints at two or fewer differing bits.

    The links join the same components as all such pairs do. Buckets of up to ``crowd``
    fingerprints are compared pair by pair. Those of larger buckets are taken to the 65 points within
    one bit of each: two fingerprints share a point exactly if they differ in at most two bits, so
    linking each to the smallest at the point loses nothing, and a point has 65 visitors at most.
    """
    # one shuffle: every variant meets its bucket, and only those of buckets with company go on
    in_bucket = F.count("*").over(Window.partitionBy("key"))
    crowded = stored(_variants(fps).withColumn("n", in_bucket).where("n > 1"), "crowded")

    few = crowded.where(F.col("n") <= crowd).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("all"))
    few = few.select(F.explode("all").alias("a"), "all").select("a", F.explode(F.expr("filter(all, x -> x > a AND bit_count(x ^ a) <= 2)")).alias("b"))

    points = F.expr("array_append(transform(sequence(0, 63), p -> fp ^ shiftleft(1L, p)), fp)")
    many = crowded.where(F.col("n") > crowd).select("fp").distinct().select("fp", F.explode(points).alias("point"))
    met = many.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("point", "a")
    dense = many.join(met, "point").where("fp != a").select("a", F.col("fp").alias("b"))
    return few.unionByName(dense).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, crowd: int = CROWD) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row.

    Fingerprints link at two or fewer differing bits; ``component_id`` is the smallest id reachable
    over links, the row's own included. Rows with equal fingerprints (copies, repeated rows, null and
    empty texts) are one node, so a group of copies of any size is one row in the search. A row with a
    null id gets the smallest id of its component, or null if there is none. Other columns of
    ``docs`` are not read. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    groups = stored(prints.groupBy("fp").agg(F.min(id_col).alias("first_id")), "groups")
    parts = connected_components(links(groups.select("fp"), crowd)).select(F.col("node").alias("fp"), "label")
    tops = groups.join(parts, "fp").groupBy("label").agg(F.min("first_id").alias("top"))
    named = parts.join(tops, "label").select("fp", "top")
    found = groups.join(named, "fp", "left").select("fp", F.coalesce("top", "first_id").alias("component_id"))
    return prints.join(found, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """16 bytes that tell rows apart by id and text; a null id is one of its own, a null text is empty."""
    both = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(F.col(text_col), F.lit("")))
    return F.unhex(F.substring(F.sha2(both, 256), 1, 32))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, crowd: int = CROWD) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component of ``near_duplicates`` the row with the smallest id.

    Rows are told apart by id and text, not by id alone: two texts that share an id are judged each. A row
    without an id stays only where no row of its component has one; of several rows with the smallest id, or
    without any, the one with the least hash stays, and repeats of it are cut to one. Texts without words
    are one component. All columns are kept; an empty table stays empty. ``_row_key`` is a reserved column name.
    """
    prints = stored(fingerprints(docs, id_col, text_col, width, row_key(id_col, text_col)), "fingerprints")
    order = F.struct(F.col(id_col).isNull().alias("unnamed"), F.col(id_col).alias("id"), "key")
    groups = stored(prints.groupBy("fp").agg(F.min(order).alias("first")), "groups")
    parts = connected_components(links(groups.select("fp"), crowd)).select(F.col("node").alias("fp"), "label")
    labelled = groups.join(parts, "fp", "left").select(F.coalesce("label", "fp").alias("label"), "first")
    firsts = labelled.groupBy("label").agg(F.min("first").alias("first"))
    kept = stored(firsts.select(F.col("first.key").alias("_row_key")), "kept")
    # both steps are dealt by the key, so texts move once
    return docs.withColumn("_row_key", row_key(id_col, text_col)).join(kept, "_row_key").dropDuplicates(["_row_key"]).select(docs.columns)
