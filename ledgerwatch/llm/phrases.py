"""Collocations: phrases of two and three words that occur together more often than their parts let expect.

Texts are written as shards of word ids. In each shard an FM-index enumerates the phrases with their counts; the
sums over all shards are exact. A phrase is no more frequent than its parts, so rare words are found first and
taken out of the shards, and phrases of three are only counted where both their pairs may be frequent.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.fmindex import BiIndex
from ledgerwatch.llm.text import columns_of
from ledgerwatch.session import scratch_path, stored

#: Words of a shard, all languages of a task together; a text of more is cut between pieces.
SHARD_WORDS = 2_000_000
_BLOCK_BYTES = 8 << 20
#: Shards are large rows: few to a file keep the readers' batches small.
_SHARDS_A_FILE = 4
_ROWS_AT_ONCE = 1 << 16
#: Bits of the filter of frequent pairs that goes to every task: 32 MB, whatever the size of the corpus.
PAIR_BITS = 1 << 28
_PAGE = 32_768
#: A word of a shard is one number: task, shard of the task, place in the shard's vocabulary.
_TASK, _MADE, _PLACE = 20, 16, 27
#: Pieces end at [.,;:!?\x0A-\x0D]; words are separated by space and tab.
_CUTS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


class _Words(dict):
    """Numbers words as they come; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _blocks(raw: bytes) -> Iterator[bytes]:
    """``raw`` in parts of about ``_BLOCK_BYTES`` that end with a piece."""
    at = 0
    while len(raw) - at > _BLOCK_BYTES:
        cut = raw.rfind(b"\n", at, at + _BLOCK_BYTES) + 1 or raw.find(b"\n", at + _BLOCK_BYTES) + 1 or len(raw)
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def _without_doubles(ids: np.ndarray) -> np.ndarray:
    """``ids`` with one 0 for several in a row."""
    return ids[(ids > 0) | (np.roll(ids, 1) > 0)] if len(ids) else ids


def _packed(ids: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(ids, np.uint32).tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, 4 * size, "zstd", asbytes=True), np.uint32)


def _checked(value: int, bits: int, what: str) -> int:
    if value >> bits:
        raise ValueError(f"more than 2^{bits} {what}")
    return value


def word_shards(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``shard``, ``lang``, ``vocab`` and ``counts`` (arrays, word 1 first), ``ids``, ``size`` and ``n_words`` of every shard.

    A-Z are lower-cased. A null language is ``und``, a null text is empty. ``ids`` are ``size`` packed unsigned 32-bit
    numbers; 0 ends a piece or a text. Word k of a shard is known everywhere as ``shard`` + k - 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shards: dict[str, tuple[_Words, array]] = {}
        waiting = made = worker = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal waiting, made
            for lang in sorted(open_shards):
                words, ids = open_shards[lang]
                ids = _without_doubles(np.frombuffer(ids, np.uint32))
                counts = np.bincount(ids, minlength=len(words))[1:]
                _checked(len(words), _PLACE, "words in a shard")
                shard = ((_checked(worker, _TASK, "tasks") << _MADE) + _checked(made, _MADE, "shards of a task")) << _PLACE
                row = {"shard": [shard], "lang": [lang], "vocab": [list(words)[1:]], "counts": [counts], "ids": [_packed(ids)], "size": [len(ids)], "n_words": [int(counts.sum())]}
                types = [pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))
                made += 1
            open_shards.clear()
            waiting = 0

        for batch in batches:
            if batch.num_rows:
                worker = batch.column("worker")[0].as_py()
            for lang, text in zip(*columns_of(batch, "l", "t")):
                for block in _blocks(text.encode("utf-8", "replace").lower().translate(_CUTS)):
                    words, ids = open_shards.setdefault(lang, (_Words({b"\n": 0}), array("I")))
                    before = len(ids)
                    ids.extend(map(words.__getitem__, filter(None, block.replace(b"\n", b" \n ").split(b" "))))
                    ids.append(0)
                    waiting += len(ids) - before
                    if waiting >= shard_words:
                        yield from flush()
        yield from flush()

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("l"), F.coalesce(F.col(text_col), F.lit("")).alias("t"), F.spark_partition_id().alias("worker"))
    return _stored(rows.mapInArrow(run, "shard long, lang string, vocab array<binary>, counts array<long>, ids binary, size long, n_words long"), "phrase-shards")


def _stored(shards: DataFrame, label: str) -> DataFrame:
    path = scratch_path(shards.sparkSession, label)
    shards.write.option("maxRecordsPerFile", _SHARDS_A_FILE).parquet(path)
    return shards.sparkSession.read.schema(shards.schema).parquet(path)


def frequent_words(shards: DataFrame, least: int) -> DataFrame:
    """``at``, ``wid``, ``f`` for every word of every shard that occurs ``least`` times in its language.

    ``at`` is the word's own number in its shard, ``wid`` (long) one number for a word of a language: the
    least of them. ``lang`` and ``word`` stand in one row of each word. One shuffle: every shard's own
    count of a word meets the others, and goes on with the sum.
    """
    own = shards.select("shard", "lang", F.posexplode(F.arrays_zip("vocab", "counts")))
    own = own.select((F.col("shard") + F.col("pos")).alias("at"), "lang", F.col("col.vocab").alias("word"), F.col("col.counts").alias("n"))
    same = Window.partitionBy("lang", "word")
    summed = own.withColumn("f", F.sum("n").over(same)).withColumn("wid", F.min("at").over(same)).where(F.col("f") >= least)
    once = F.col("at") == F.col("wid")
    return stored(summed.select("at", "wid", "f", F.when(once, F.col("lang")).alias("lang"), F.when(once, F.col("word").cast("string")).alias("word")), "phrase-words")


def frequent_shards(shards: DataFrame, words: DataFrame) -> DataFrame:
    """``ids`` and ``size`` of each shard again, with its frequent words only: word k is ``wids[k - 1]``."""

    def keep(shard: pa.Table, known: pa.Table) -> pa.Table:
        out = {"ids": [], "size": [], "wids": []}
        if shard.num_rows and known.num_rows:
            places = known.column("at").to_numpy() - shard.column("shard")[0].as_py()
            ids = _unpacked(shard.column("ids")[0].as_py(), shard.column("size")[0].as_py())
            number = np.zeros(max(int(ids.max(initial=0)), int(places.max())) + 2, np.uint32)
            number[places + 1] = np.arange(1, len(places) + 1)
            ids = _without_doubles(number[ids])
            out = {"ids": [_packed(ids)], "size": [len(ids)], "wids": [known.column("wid").to_numpy()]}
        return pa.table([pa.array(out["ids"], pa.binary()), pa.array(out["size"], pa.int64()), pa.array(out["wids"], pa.list_(pa.int64()))], ["ids", "size", "wids"])

    shard = F.shiftleft(F.shiftright("at", _PLACE), _PLACE)
    both = shards.select("shard", "ids", "size").groupBy("shard").cogroup(words.select(shard.alias("shard"), "at", "wid").groupBy("shard"))
    return _stored(both.applyInArrow(keep, "ids binary, size long, wids array<long>"), "phrase-frequent")


def pair_slots(w1: np.ndarray, w2: np.ndarray, bits: int) -> np.ndarray:
    """Place of each pair in a filter of ``bits`` bits."""
    with np.errstate(over="ignore"):
        h = w1.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + w2.astype(np.uint64)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(29))) % np.uint64(bits)).astype(np.int64)


def pair_filter(pairs: DataFrame, bits: int = PAIR_BITS) -> bytes:
    """Bitmap with the place of every pair; pages are put together in Spark, the driver strings at most bits / 32,768 of them together."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pair_slots(batch.column("w1").to_numpy(), batch.column("w2").to_numpy(), bits))], ["slot"])

    slots = pairs.select("w1", "w2").mapInArrow(place, "slot long")
    pages = slots.groupBy(F.expr(f"slot div {_PAGE}").alias("page")).agg(F.bitmap_construct_agg(F.col("slot") % _PAGE).alias("bitmap"))
    whole = bytearray(-(-bits // _PAGE) * _PAGE // 8)
    for row in pages.toLocalIterator():
        whole[row.page * _PAGE // 8 : (row.page + 1) * _PAGE // 8] = row.bitmap
    return bytes(whole)


def shard_pairs(index: BiIndex) -> tuple[np.ndarray, np.ndarray]:
    """All phrases of two words in a shard, as rows of symbols, and their counts: words grow to the right."""
    _, (words, counts) = index.grams(2)
    return words, counts


def shard_triples(index: BiIndex, may_be_frequent) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of three words whose pairs both may be frequent: such pairs grow to the left."""
    first, lo, rlo, n = index.singles()
    pattern, second, lo, rlo, n = index.extend(lo, rlo, n, to_left=False)
    words = np.stack([first[pattern], second], axis=1)
    keep = may_be_frequent(words)
    words, lo, rlo, n = words[keep], lo[keep], rlo[keep], n[keep]
    pattern, before, _, _, n = index.extend(lo, rlo, n, to_left=True)
    words = np.hstack([before[:, None], words[pattern]])
    keep = may_be_frequent(words[:, :2])
    return words[keep], n[keep]


def _counted(shards: DataFrame, length: int, least: int, label: str, bits=None, n_bits: int = PAIR_BITS) -> DataFrame:
    names = [f"w{k + 1}" for k in range(length)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if bits is None else np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            for ids, size, wids in zip(*(batch.column(c) for c in ("ids", "size", "wids"))):
                wids = wids.values.to_numpy()
                index = BiIndex(_unpacked(ids.as_py(), size.as_py()), len(wids) + 1, length)

                def may_be_frequent(pairs: np.ndarray) -> np.ndarray:
                    slot = pair_slots(wids[pairs[:, 0] - 1], wids[pairs[:, 1] - 1], n_bits)
                    return (table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)

                words, counts = shard_pairs(index) if table is None else shard_triples(index, may_be_frequent)
                for low in range(0, len(words), _ROWS_AT_ONCE):
                    part = words[low : low + _ROWS_AT_ONCE]
                    columns = [*(wids[part[:, k] - 1] for k in range(length)), counts[low : low + _ROWS_AT_ONCE]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [*names, "n"])

    grams = shards.mapInArrow(count, ", ".join(f"{c} long" for c in [*names, "n"]))
    return stored(grams.groupBy(*names).agg(F.sum("n").alias("a")).where(F.col("a") >= least), label)


def phrase_counts(shards: DataFrame, least: int, bits: int = PAIR_BITS) -> tuple[DataFrame, DataFrame]:
    """Phrases of two (``w1``, ``w2``, ``a``) and of three (``w3`` too) that occur ``least`` times, from ``frequent_shards``.

    The filter of frequent pairs has a fixed size. Where there are more pairs than it can tell apart it lets
    phrases through that are counted and dropped: the result is the same.
    """
    twos = _counted(shards, 2, least, "phrase-twos")
    table = shards.sparkSession.sparkContext.broadcast(pair_filter(twos, bits))
    return twos, _counted(shards, 3, least, "phrase-threes", table, bits)


def _score(l: str, r: str) -> Column:
    """floor(1000000 a a / (l r)), exact for counts up to 10^15."""
    big = lambda c: f"CAST({c} AS DECIMAL(15,0))"
    return F.expr(f"({big('a')} * {big('a')} * CAST(1000000 AS DECIMAL(8,0))) DIV ({big(l)} * {big(r)})")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 10, top: int = 2000, covered_percent: int = 50, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the first ``top`` phrases of each language.

    ``a`` counts a phrase within pieces, overlaps included, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` all
    words of the language. A phrase of two that stands in a candidate of three with at least ``covered_percent`` of its
    own count is left out. Ranked by score, then count, both descending, then by the phrase's UTF-8 bytes.

    A null language is ``und``, a null or empty text has no words, repeated rows count each, an empty table gives an
    empty result; other columns are not read.
    """
    shards = word_shards(docs, lang_col, text_col, shard_words)
    words = frequent_words(shards, least)
    twos, threes = phrase_counts(frequent_shards(shards, words), least)
    names = words.where("word IS NOT NULL").select("wid", "lang", "word", "f")

    def named(grams: DataFrame, k: int) -> DataFrame:
        one = names.select(F.col("wid").alias(f"w{k}"), F.col("word").alias(f"word{k}"), F.col("f").alias(f"f{k}"), *(["lang"] if k == 1 else []))
        return grams.join(one, f"w{k}")

    ends = threes.select("w1", "w2", "a").unionByName(threes.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longer = ends.groupBy("w1", "w2").agg(F.max("a").alias("most"))
    free = twos.join(longer, ["w1", "w2"], "left").where(f"most IS NULL OR 100 * most < {int(covered_percent)} * a").select("w1", "w2", "a")
    two = named(named(free, 1), 2).select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    two = two.withColumn("score", _score("l", "r"))
    three = threes.join(twos.select("w1", "w2", F.col("a").alias("f12")), ["w1", "w2"]).join(twos.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23")), ["w2", "w3"])
    three = named(named(named(three, 1), 2), 3).withColumn("s1", _score("f1", "f23")).withColumn("s2", _score("f12", "f3"))
    second = F.col("s2") < F.col("s1")
    three = three.select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
        F.when(second, F.col("f12")).otherwise(F.col("f1")).alias("l"), F.when(second, F.col("f3")).otherwise(F.col("f23")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    sizes = shards.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
