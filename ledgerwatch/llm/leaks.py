"""Benchmark passages in training texts: n-gram seeds, then local alignment."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of, words_of
from ledgerwatch.session import stored

#: Words of a seed.
SEED = 4
#: Bits of the seed filter that goes to every task: 2 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 24
#: Words of a test item that are aligned at once; longer items are cut into passages of this size.
PASSAGE = 256
#: Least similarity that counts as a leak: alignment score over the score of an untouched copy.
THRESHOLD = 0.6
#: A part of an item counts as a leak by itself if it aligns like this many untouched words.
VERBATIM = 30
#: A seed is common if it stands in more passages than the first number and would bring more pairs than the second.
FEW_PASSAGES, RARE_PAIRS = 8, 256

_MATCH, _MISMATCH, _GAP = 2, -1, -1


class _Hashes(dict):
    """64-bit hashes of words, remembered up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def seed_hashes(words: list[bytes], n: int = SEED) -> np.ndarray:
    """A 64-bit hash for each run of ``n`` words, mixed from the words' hashes."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i]
    return out


def alignment(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman over words: best score, and where the aligned part of ``text`` begins and ends.

    Match +2, mismatch -1, gap -1; row by row, with gaps along the row as a running maximum. The
    begin travels with the score.
    """
    m = len(text)
    along = np.arange(m + 1, dtype=np.int64)
    # score and origin in one number: higher score first, then the later (shorter) begin
    base = np.int64(m + 2)
    prev = along.copy()  # score 0, begin = own place
    best, begin, end = 0, 0, 0
    for w in item:
        same = text == w
        row = np.empty(m + 1, np.int64)
        row[0] = 0
        diagonal = prev[:-1] + np.where(same, _MATCH, _MISMATCH) * base
        up = prev[1:] + _GAP * base
        row[1:] = np.maximum(diagonal, up)
        fresh = row < base  # score under 1: begin here
        row[fresh] = along[fresh]
        lifted = np.maximum.accumulate(row - _GAP * base * along) + _GAP * base * along
        row = np.where(lifted >= base, np.maximum(row, lifted), row)
        at = int(row.argmax())
        if row[at] // base > best:
            best, begin, end = int(row[at] // base), int(row[at] % base), at
        prev = row
    return best, begin, end


def passages_of(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = SEED) -> DataFrame:
    """``item``, ``part``, ``words`` and ``seeds`` of each passage.

    Passages of up to ``PASSAGE`` words overlap by half. Items of fewer than ``n`` words have none.
    """
    kind = benchmark.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = ([], [], [], [])
            for item, text in zip(*columns_of(batch, "i", "t")):
                words = words_of(text)
                for part, at in enumerate(range(0, max(1, len(words) - PASSAGE // 2), PASSAGE // 2)):
                    piece = words[at : at + PASSAGE]
                    for column, value in zip(out, (item, part, b" ".join(piece).decode("utf-8", "replace"), seed_hashes(piece, n).view(np.int64).tolist())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [batch.schema.field("i").type, pa.int32(), pa.string(), pa.list_(pa.int64())])], ["item", "part", "words", "seeds"])

    rows = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").distinct()
    return rows.mapInArrow(run, f"item {kind}, part int, words string, seeds array<bigint>").where("size(seeds) > 0")


def _filter_bits(seeds: DataFrame) -> bytes:
    """One bitmap with the low bits of every seed, joined from one bitmap a partition; its size is fixed."""
    mask = FILTER_BITS - 1
    slots = seeds.select(F.expr(f"seed & {mask}").alias("s")).distinct()
    words = slots.groupBy(F.expr("CAST(s div 32768 AS INT)").alias("page")).agg(F.collect_set(F.expr("CAST(s % 32768 AS INT)")).alias("s"))  # at most 512 pages of 32,768 bits
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in words.toLocalIterator():
        at = np.asarray(row.s, np.int64) + row.page * 32768
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits.tobytes()


def seed_hits(docs: DataFrame, bits, id_col: str, text_col: str, longest: int, n: int = SEED) -> DataFrame:
    """Windows of texts around runs whose hash may be a seed: ``doc``, ``offset`` (word), ``window``, ``at`` and ``seeds``, ``print``.

    Hits of a text that lie close together share one window, so a copied passage is one row. ``at`` and ``seeds``
    are the places and hashes of all hits in the window; they follow from its words, as does ``print``.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        table = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            out = ([], [], [], [], [], [])
            for doc, text in zip(*columns_of(batch, "i", "t")):
                words = words_of(text)
                h = seed_hashes(words, n)
                slot = h & np.uint64(FILTER_BITS - 1)
                hit = np.flatnonzero((table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1)
                if not len(hit):
                    continue
                # a window closes where the next hit is further away than an item is long, or at a fixed size
                first = 0
                for k in range(1, len(hit) + 1):
                    if k == len(hit) or hit[k] - hit[k - 1] > longest or hit[k] - hit[first] > 2 * longest:
                        low, high = max(0, int(hit[first]) - longest), min(len(words), int(hit[k - 1]) + n + longest)
                        inside = hit[np.searchsorted(hit, low) : np.searchsorted(hit, high - n, side="right")]
                        out[0].append(doc)
                        out[1].append(low)
                        out[2].append(b" ".join(words[low:high]).decode("utf-8", "replace"))
                        out[3].append((inside - low).tolist())
                        out[4].append(h[inside].view(np.int64).tolist())
                        out[5].append(int(xxhash.xxh64_intdigest(b" ".join(words[low:high])) >> 1))
                        first = k
            types = [batch.schema.field("i").type, pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc", "offset", "window", "at", "seeds", "print"])

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"doc {kind}, offset long, window string, at array<int>, seeds array<bigint>, print long")


def _longer(runs: DataFrame, common: DataFrame, keys: list[str], more: int) -> DataFrame:
    """Runs that are ``more`` words longer: two common ones, that many words apart, are the seed of both together."""
    kept = runs.join(common, "seed")
    later = kept.select(*keys, (F.col("pos") - more).alias("pos"), F.col("seed").alias("then"))
    return kept.join(later, [*keys, "pos"]).select(*keys, "pos", F.xxhash64("seed", "then").alias("seed"))


def candidate_pairs(windows: DataFrame, passages: DataFrame, n: int = SEED, threshold: float = THRESHOLD, few: int = FEW_PASSAGES, most: int = RARE_PAIRS) -> DataFrame:
    """``print`` and ``body`` of windows and passages that share a rare seed.

    A seed of ``n`` words is rare if it stands in ``few`` passages at most, or brings ``most`` pairs at most. A common
    one brings no pairs by itself but grows by half its length, with the words beside it. It joins whatever it
    meets once its length alone makes a leak: ``threshold`` of the passage, or ``VERBATIM`` words. So a pair is
    left out only if every run of words they share is common at each length and none is a leak by itself.
    """
    runs = stored(windows.select("print", F.explode(F.arrays_zip(F.col("at"), F.col("seeds"))).alias("x")).select("print", F.col("x.at").alias("pos"), F.col("x.seeds").alias("seed")), "runs")
    items = passages.select("body", (F.size("seeds") + n - 1).alias("size"), F.posexplode("seeds").alias("pos", "seed"))
    pairs, length = None, n
    while True:
        sides = runs.groupBy("seed").agg(F.count_distinct("print").alias("w")).join(items.groupBy("seed").agg(F.count_distinct("body").alias("i")), "seed")
        counts = stored(sides.withColumn("rare", (F.col("i") <= few) | (F.col("w") * F.col("i") <= most)), "seed-counts")
        enough = F.col("rare") | (F.col("size") * threshold <= length) | F.lit(length >= VERBATIM)
        sought = items.join(counts, "seed").where(enough).select("body", "seed").distinct()
        met = runs.select("print", "seed").distinct().join(sought, "seed").select("print", "body")
        pairs = met if pairs is None else pairs.unionByName(met)
        common = counts.where("NOT rare").select("seed")
        if length >= VERBATIM or common.isEmpty():
            return stored(pairs.distinct(), "pairs")
        more = min(max(1, length // 2), VERBATIM - length)
        runs, items = stored(_longer(runs, common, ["print"], more), "runs"), stored(_longer(items, common, ["body", "size"], more), "items")
        length += more


@lru_cache(maxsize=4096)
def _encoded(words: str) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words.encode().split()), np.uint64)


def _may_reach(item: np.ndarray, window: np.ndarray, threshold: float) -> bool:
    """Whether enough of the item's words stand in the window at all: a score is at most that of all of them in order."""
    return np.isin(item, window).sum() >= min(threshold * len(item), VERBATIM)


def _aligned(pairs: DataFrame, threshold: float) -> DataFrame:
    def run(frames):
        for frame in frames:
            frame = frame[[_may_reach(_encoded(i), _encoded(w), threshold) for i, w in zip(frame.item_words, frame.window)]]
            found = [alignment(_encoded(i), _encoded(w)) for i, w in zip(frame.item_words, frame.window)]
            yield pd.DataFrame({"print": frame.print, "body": frame.body, "score": [f[0] for f in found], "a": [f[1] for f in found], "b": [f[2] for f in found], "size": [len(_encoded(i)) for i in frame.item_words]})

    return pairs.mapInPandas(run, "print long, body string, score long, a long, b long, size long")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", n: int = SEED, threshold: float = THRESHOLD) -> DataFrame:
    """Training passages that copy a test item: id, item, ``similarity`` and the passage's words ``begin`` to ``end``.

    A seed is a run of ``n`` words of an item. Windows of texts that share a rare seed with an item, or a common one
    that its neighbours make rare (``candidate_pairs``), are aligned with it by Smith-Waterman over words, unless
    too few of the item's words stand in the window for any alignment to do. The score divided by that of an
    untouched copy must reach ``threshold``, or the score itself that of ``VERBATIM`` untouched words. Edits,
    insertions and gaps inside the passage are met; a copy without ``n`` untouched words in a row is not.

    One row for each id and item, with the best passage. Null or empty texts and items of fewer than
    ``n`` words take no part; repeated rows give one row for each id; a null id can't be reported and is
    left out; an empty benchmark or corpus gives an empty result.
    """
    passages = stored(passages_of(benchmark, item_id_col, item_text_col, n).withColumn("body", F.sha2("words", 256)), "passages")
    # passages and windows with the same words are searched and aligned once
    bodies = stored(passages.groupBy("body").agg(F.first("words").alias("item_words"), F.first("seeds").alias("seeds")), "bodies")
    seeds = bodies.select(F.explode(F.array_distinct("seeds")).alias("seed"))
    longest = int(bodies.agg(F.coalesce(F.max(F.size("seeds")), F.lit(1))).first()[0]) + n
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(seeds))
    hits = stored(seed_hits(docs.where(F.col(id_col).isNotNull()), bits, id_col, text_col, longest, n), "hits")
    windows = stored(hits.groupBy("print").agg(F.first("window").alias("window"), F.first("at").alias("at"), F.first("seeds").alias("seeds")), "windows")
    pairs = candidate_pairs(windows, bodies, n, threshold)
    pairs = pairs.join(bodies.select("body", "item_words"), "body").join(windows.select("print", "window"), "print")
    found = _aligned(pairs.repartition("print", "body"), threshold).withColumn("similarity", F.col("score") / (F.lit(float(_MATCH)) * F.col("size")))
    found = found.where((F.col("similarity") >= threshold) | (F.col("score") >= _MATCH * VERBATIM))
    placed = found.join(passages.select("body", "item"), "body").join(hits.select("print", "doc", "offset"), "print")
    best = placed.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-(F.col("offset") + F.col("a"))).alias("from"), (F.col("offset") + F.col("b")).alias("to"))).alias("best"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias("item_id"), F.round("best.similarity", 6).alias("similarity"), (-F.col("best.from")).alias("begin"), F.col("best.to").alias("end"))
