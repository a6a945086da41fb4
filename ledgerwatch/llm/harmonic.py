"""Harmonic packing: a fixed number of documents of like length in each sequence, gaps filled from documents cut anyway."""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of

#: A worker packs what it has read as soon as this many tokens or documents wait.
GROUP_TOKENS, GROUP_DOCS = 4_000_000, 65_536
#: Texts whose characters are all below this code point may take the fast encoder, after each of them was probed.
_PROBED = 0x2100
#: Runs of this many blanks go to the tokenizer: the fast encoder's pattern recurses over them.
_WIDE = 1_000
_ENCODED_AT_ONCE = 256


class ByteIds:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, as the tokenizer file gives them.

    With ``ranks_path``, the same vocabulary as ranks, texts of probed characters without strings of added
    tokens are encoded from the ranks, which is about four times as fast. The probes compare both encoders
    over every character in four neighbourhoods; where any differs, the fast one is not used at all.
    """

    def __init__(self, path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.model = Tokenizer.from_file(path)
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.beyond = re.compile(f"[^\\x00-{chr(_PROBED - 1)}]")
        self.wide = re.compile(rf"\s{{{_WIDE}}}")
        self.fast = self._ranked(ranks_path) if ranks_path else None

    def _ranked(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        probes = [f"a{c}b {c}{c}1{c} 's{c}\n  {c}" for c in map(chr, range(_PROBED))]
        probes += ["", "it's we'll I'M  x\t\ty\r\n\n z ", "    a", "a" * 3000, " " * (_WIDE - 1) + "b"]
        same = all(list(a) == b for a, b in zip(map(fast.encode_ordinary, probes), (e.ids for e in self.model.encode_batch_fast(probes, add_special_tokens=False))))
        return fast if same else None

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.fast and not self.beyond.search(text) and not self.wide.search(text) and not any(a in text for a in self.added):
                out[i] = array("I", self.fast.encode_ordinary(text)).tobytes()
            else:
                slow.append(i)
        for i, e in zip(slow, self.model.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False) if slow else ()):
            out[i] = array("I", e.ids).tobytes()
        return out


@lru_cache(maxsize=2)
def byte_ids(path: str, ranks_path: str | None = None) -> ByteIds:
    """Loaded once for each Python worker."""
    return ByteIds(path, ranks_path)


def powers_of_two(n: int) -> Iterator[int]:
    """The powers of two that add up to ``n``, largest first."""
    while n:
        top = 1 << (n.bit_length() - 1)
        yield top
        n -= top


def fill(lengths: list[int], limit: int) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences as lists of (document, start, length) in their order, which cover every document exactly.

    A document of ``n < limit`` tokens belongs to the class ``k = limit // n``: n lies between limit / (k + 1)
    and limit / k, and k of them share a sequence. What a sequence lacks then is cut from fillers: the ends
    of documents over ``limit`` first, which are cut anyway, then the documents that leave the widest gaps.
    All other documents stay whole. Every sequence is full but the last, which is cut into powers of two.
    """
    shelves: dict[int, deque[int]] = {}
    fillers: deque[tuple[int, int, int]] = deque()
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        for start in range(0, n - n % limit, limit):
            yield [(i, start, limit)]
        if n < limit:
            shelves.setdefault(limit // n, deque()).append(i)
        elif n % limit:
            fillers.append((i, n - n % limit, n % limit))
    classes = sorted(shelves)  # the longest documents first

    def cut(gap: int) -> Iterator[tuple[int, int, int]]:
        """Pieces from the fillers that fill ``gap``, as far as there are documents."""
        while gap:
            if not fillers:
                widest = next((k for k in classes if shelves[k]), None)
                if widest is None:
                    return
                i = shelves[widest].pop()
                fillers.append((i, 0, lengths[i]))
            i, start, n = fillers.popleft()
            if n > gap:
                fillers.appendleft((i, start + gap, n - gap))
                n = gap
            gap -= n
            yield i, start, n

    last: list[tuple[int, int, int]] = []
    for k in reversed(classes):
        shelf = shelves[k]
        while shelf:
            parts = [(i, 0, lengths[i]) for i in (shelf.popleft() for _ in range(min(k, len(shelf))))]
            parts += cut(limit - sum(p[2] for p in parts))
            if sum(p[2] for p in parts) < limit:
                last = parts
            else:
                yield parts
    while fillers:
        parts = list(cut(limit))
        if sum(p[2] for p in parts) < limit:
            last = parts
        else:
            yield parts
    rest = deque(last)
    for size in powers_of_two(sum(p[2] for p in last)):
        parts = []
        while size:
            i, start, n = rest.popleft()
            if n > size:
                rest.appendleft((i, start + size, n - size))
                n = size
            parts.append((i, start, n))
            size -= n
        yield parts


def harmonic_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    limit: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """``id_col``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids`` of every piece.

    A text's ids are closed by ``end_id``. ``start`` is the piece's place in its document, ``offset`` its place in
    its sequence, gapless from 0; ``ids`` are little-endian unsigned 32-bit. Each worker encodes and packs its own
    documents, at most ``group_tokens`` (or one document more) at a time, so nothing is shuffled. Sequences hold
    ``limit`` tokens; the last of a worker's group, being shorter, is cut into sequences whose lengths are powers
    of two, so none needs padding.

    A null text counts as empty: one piece, the end id alone. Repeated rows and rows with a null or equal id are
    packed each; an empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    tail = array("I", [end_id]).tobytes()

    def packed(group: list[tuple[object, bytes]], worker: int, sequence: int) -> tuple[list[list], int]:
        out: list[list] = [[], [], [], [], [], [], [], []]
        for parts in fill([len(ids) // 4 for _, ids in group], limit):
            at = 0
            for i, start, n in parts:
                doc, ids = group[i]
                part = ids[4 * start : 4 * (start + n)]
                for column, value in zip(out, (doc, start, n, zlib.crc32(part), len(ids) // 4, (worker << 36) + sequence, at, part)):
                    column.append(value)
                at += n
            sequence += 1
        return out, sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_ids(tokenizer_path, ranks_path)
        group: list[tuple[object, bytes]] = []
        waiting = sequence = worker = 0
        types = None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal group, waiting, sequence
            columns, sequence = packed(group, worker, sequence)
            group, waiting = [], 0
            names = ["i", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field("i").type, *[pa.int64()] * 6, pa.binary()]
            worker = batch.column("worker")[0].as_py()
            ids_here, texts = columns_of(batch, "i", "t")
            for low in range(0, len(texts), _ENCODED_AT_ONCE):
                high = low + _ENCODED_AT_ONCE
                for doc, ids in zip(ids_here[low:high], model.encode([t or "" for t in texts[low:high]])):
                    group.append((doc, ids + tail))
                    waiting += len(ids) // 4 + 1
                    if waiting >= group_tokens or len(group) >= GROUP_DOCS:
                        yield from flush()
        if group:
            yield from flush()

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.spark_partition_id().alias("worker"))
    schema = f"i {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return rows.mapInArrow(run, schema).withColumnRenamed("i", id_col)


def sequences_of(pieces: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` (little-endian unsigned 32-bit) of the sequences, for writing them out.

    ``pieces`` is the stored result of ``harmonic_sequences``. A sequence holds at most the limit of ids.
    """
    parts = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"))
