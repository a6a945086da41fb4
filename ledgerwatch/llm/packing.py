"""Packing of token sequences by length patterns fitted with non-negative least squares."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import compress
from operator import not_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of
from ledgerwatch.session import stored

#: Lengths are rounded up to 1 / UNITS of a sequence for the patterns.
UNITS = 64
#: Most documents of a pattern.
DEPTH = 3
#: Pieces that are placed together; only their ids and lengths meet.
GROUP = 32_768
#: Words remembered; beyond them all are forgotten and learnt anew.
_WORDS = 1_000_000
#: A word whose last mark of punctuation stands behind a letter or digit.
_MARKED = re.compile(rb".*[0-9A-Za-z][.,;:!?]", re.S).fullmatch
_BLANKS = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")
#: Plain words that are encoded as one text.
_JOINED = 500
#: Letters below this code point have one form only: no combining marks, nothing to compose.
_LATIN = 0x250


def _is_plain(word: str) -> bool:
    """Letters of the Latin blocks only, none of them a capital."""
    return word.isalpha() and word.islower() and max(word) < chr(_LATIN)


class WordIds:
    """Ids of the words between white space, as little-endian unsigned 32-bit bytes.

    Only for tokenizers that never look across white space (``separable``): then a text's ids are those of
    its words one after the other, and a word is encoded once for as long as it is remembered. Where
    the tokenizer lower-cases, words are remembered in lower case; a word's last mark of punctuation
    is a token start of its own and is looked up apart (``splits``). Lower-case Latin words skip the
    normaliser and the word pattern where neither changes any such letter (``plain``).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.model = Tokenizer.from_file(path)
        self.words: dict[bytes, int] = {}
        self.pool = _Pool()
        probe = "ab  cd\n'll 12 ü\t<|endoftext|> x'd a.b c, d."
        self.separable = self._ids([probe])[0] == b"".join(self._ids(probe.split()))
        self.lowers = self._ids(["ABC Xyz"]) == self._ids(["abc xyz"])
        pre = self.model.pre_tokenizer
        self.splits = self.separable and pre is not None and all([p for _, p in pre.pre_tokenize_str(f"ab{c}")] == [(0, 2), (2, 3)] and [p for _, p in pre.pre_tokenize_str(f"1{c}")][-1] == (1, 2) for c in ".,;:!?")
        self.plain = self._without_normaliser() if self.separable else None
        size = self.model.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(size, bool)  # ids that end a word
        self.ends[[i for token, i in self.model.get_vocab().items() if token.endswith("</w>")]] = True

    def _without_normaliser(self):
        """The bare model behind bytes, or None if a lower-case Latin letter inside a word then gets other ids."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        plain = Tokenizer(self.model.model)
        plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        letters = [c for c in map(chr, range(_LATIN)) if _is_plain(f"b{c}")]
        self.latin = re.compile(f"[{''.join(letters)}]+").fullmatch
        probes = [*(f"b{c}" for c in letters), *(f"{c}d" for c in letters), *(f"b{c}d" for c in letters), "".join(letters)]
        return plain if self._ids(probes) == self._ids(probes, plain) else None

    def _plain_ids(self, words: list[str]) -> list[bytes]:
        """The ids of plain words, many in one text, which is cut behind every id that ends a word."""
        out: list[bytes] = []
        for text in self._ids([" ".join(words[low : low + _JOINED]) for low in range(0, len(words), _JOINED)], self.plain):
            cuts = (4 * np.flatnonzero(self.ends[np.frombuffer(text, np.uint32)]) + 4).tolist()
            out.extend(text[low:high] for low, high in zip([0, *cuts], cuts))
        # a vocabulary without marks of word ends gives other counts: then one by one
        return out if len(out) == len(words) else self._ids(words, self.plain)

    def _ids(self, texts: list[str], model=None) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in (model or self.model).encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; words not remembered are encoded in one call."""
        if not self.separable:
            return self._ids(texts)
        if len(self.words) >= _WORDS:
            self.words, self.pool = {}, _Pool()
        raw = [text.encode("utf-8", "replace").translate(_BLANKS) for text in texts]
        # strings of special tokens keep their case: in another case they are ordinary text
        raw = [r.lower() if self.lowers and b"<|" not in r else r for r in raw]
        split = pc.split_pattern(pa.array(raw, pa.large_binary()), " ")
        coded = split.flatten().dictionary_encode()
        # each different word of these texts is looked up once
        words = coded.dictionary.to_pylist()
        numbers = list(map(self.words.get, words))
        if None in numbers:
            self._learn([w for w, n in zip(words, numbers) if n is None])
            numbers = list(map(self.words.__getitem__, words))
        ids, ends = self.pool.joined(np.array(numbers, np.int64)[coded.indices.to_numpy()])
        cuts = (4 * ends[split.offsets.to_numpy()]).tolist()
        return [ids[low:high] for low, high in zip(cuts, cuts[1:])]

    def _learn(self, new: list[bytes]) -> None:
        """Numbers new words and takes their ids into the pool, in the order of the numbers."""
        marked, alone = _parted(new, _MARKED) if self.splits else ([], new)
        stems = [w[:-1] for w in marked]
        alone += set(stems).union(w[-1:] for w in marked).difference(alone).difference(self.words)
        self.words.update(zip(alone, range(len(self.words), len(self.words) + len(alone))))
        self.pool.add(self._alone_ids(alone))
        # a stem is a word without such a mark, so both its parts are there
        parts = np.empty((len(marked), 2), np.int64)
        parts[:, 0], parts[:, 1] = (np.fromiter(map(self.words.__getitem__, side), np.int64, len(marked)) for side in (stems, (w[-1:] for w in marked)))
        self.words.update(zip(marked, range(len(self.words), len(self.words) + len(marked))))
        ids, ends = self.pool.joined(parts.ravel())
        self.pool.extend(np.frombuffer(ids, np.uint32), np.diff(ends[::2]))

    def _alone_ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of words without a last mark: plain ones many at once, the others as they are."""
        if not self.plain:
            return self._ids([w.decode() for w in words])
        texts = b" ".join(words).decode().split(" ")
        plain, other = _parted(texts, self.latin)
        found = iter(self._plain_ids(plain)), iter(self._ids(other) if other else ())
        return [next(found[0] if self.latin(text) else found[1]) for text in texts] if words else []


def _parted(words: list, test) -> tuple[list, list]:
    """The words that pass a test, and the others."""
    flags = list(map(bool, map(test, words)))
    return list(compress(words, flags)), list(compress(words, map(not_, flags)))


class _Pool:
    """The ids of numbered words, one after the other."""

    def __init__(self):
        self.size, self.used = 0, 0
        self.ids, self.starts, self.lengths = np.empty(1 << 16, np.uint32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def add(self, words: list[bytes]) -> None:
        self.extend(np.frombuffer(b"".join(words), np.uint32), np.fromiter(map(len, words), np.int64, len(words)) // 4)

    def extend(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while self.size + len(lengths) > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.empty_like(x)]) for x in (self.starts, self.lengths))
        self.ids[self.used : self.used + len(ids)] = ids
        self.lengths[self.size : self.size + len(lengths)] = lengths
        self.starts[self.size : self.size + len(lengths)] = self.used + np.cumsum(lengths) - lengths
        self.used, self.size = self.used + len(ids), self.size + len(lengths)

    def joined(self, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The ids of the words one after the other, and how many there are before each word and after the last."""
        lengths = self.lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(ends[-1]) + np.repeat(self.starts[numbers] - ends[:-1], lengths)
        return self.ids[place].tobytes(), ends


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """Loaded once for each Python worker."""
    return WordIds(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, limit: int, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit) of each piece.

    A text's ids, closed by ``end_id``, are cut every ``limit`` ids; a text that fits is one piece. Null
    texts count as empty. Without ``end_id`` an empty text is one empty piece.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    tail = b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        model = word_ids(tokenizer_path)
        for batch in batches:
            out = ([], [], [], [], [])
            docs_here, texts = columns_of(batch, "i", "t")
            coded = (ids for low in range(0, len(texts), 2048) for ids in model.encode([t or "" for t in texts[low : low + 2048]]))
            for doc, ids in zip(docs_here, coded):
                ids += tail
                for piece, at in enumerate(range(0, max(1, len(ids)), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    for column, value in zip(out, (doc, piece, at // 4, len(part) // 4, part)):
                        column.append(value)
            types = [batch.schema.field("i").type, pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["i", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return rows.mapInArrow(run, f"i {kind}, piece int, start long, length long, ids binary").withColumnRenamed("i", id_col)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with least ||a x - b||, by the active-set method; ends where no gradient is positive."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    ata, atb = a.T @ a, a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(atb).max(initial=0)))
    for _ in range(rounds):
        gradient = atb - ata @ x
        gradient[active] = -np.inf
        j = int(gradient.argmax())
        if gradient[j] <= tolerance:
            break
        active[j] = True
        while True:
            on = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[on] = z
                break
            low = z <= 0
            step = (x[on][low] / np.maximum(x[on][low] - z[low], 1e-300)).min()
            x[on] += step * (z - x[on])
            active[on[(x[on] <= 1e-12) & low]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


@lru_cache(maxsize=4)
def patterns(units: int = UNITS, depth: int = DEPTH) -> tuple[tuple[int, ...], ...]:
    """All ways to fill a sequence of ``units`` exactly with 2 to ``depth`` lengths, longest first."""

    def fill(left: int, most: int, parts: int):
        if parts == 1:
            if 1 <= left <= most:
                yield (left,)
            return
        for first in range(min(most, left - parts + 1), 0, -1):
            for rest in fill(left - first, first, parts - 1):
                yield (first, *rest)

    return tuple(p for k in range(2, depth + 1) for p in fill(units, units, k))


def fit_patterns(histogram: np.ndarray, units: int = UNITS, depth: int = DEPTH) -> list[tuple[tuple[int, ...], float]]:
    """Patterns with the number of times to use them, for ``histogram[u]`` pieces of ``u`` units.

    Least squares over the lengths; a piece left over weighs as much as its length, since short
    ones still fit into gaps.
    """
    shapes = patterns(units, depth)
    weight = np.arange(1, units + 1) / units
    a = np.zeros((units, len(shapes)))
    for j, shape in enumerate(shapes):
        for u in shape:
            a[u - 1, j] += 1
    total = max(1.0, float(histogram.sum()))
    x = nnls(a * weight[:, None], histogram[1:] * weight / total) * total
    return [(shapes[j], float(x[j])) for j in np.flatnonzero(x > 0)]


class _ByLength:
    """Numbers of pieces or sequences by a length, with the lengths that occur as bits of one integer."""

    def __init__(self):
        self.at: dict[int, list[int]] = {}
        self.bits = 0

    def put(self, n: int, i: int) -> None:
        self.at.setdefault(n, []).append(i)
        self.bits |= 1 << n

    def take(self, n: int) -> int:
        i = self.at[n].pop()
        if not self.at[n]:
            self.bits &= ~(1 << n)
        return i

    def longest(self, most: int) -> int:
        """The greatest length up to ``most``, -1 if there is none."""
        return (self.bits & ((1 << (most + 1)) - 1)).bit_length() - 1

    def shortest(self, least: int) -> int:
        """The least length from ``least`` on, -1 if there is none."""
        above = self.bits >> least
        return least + (above & -above).bit_length() - 1 if above else -1


def place(lengths: np.ndarray, limit: int, plan: list[tuple[tuple[int, ...], float]], share: np.ndarray, units: int = UNITS) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of one group.

    Patterns are used floor(count x the group's share) times while pieces last: each slot takes the longest piece
    of its length class, the last one the longest piece of any class that fits the room the others have
    really left. What remains goes, longest first, to the sequence with the smallest gap that holds it, or to
    a new one. Full pieces stand alone.
    """
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    waiting, gaps = _ByLength(), _ByLength()
    for i in range(len(lengths) - 1, -1, -1):
        waiting.put(int(lengths[i]), i)
    top = [u * limit // units for u in range(units + 1)]  # longest length of each class
    room: list[int] = []

    def put(n: int, s: int) -> None:
        i = waiting.take(n)
        sequence[i], offset[i] = s, limit - room[s]
        room[s] -= n

    def fits(shape: tuple[int, ...]) -> list[int] | None:
        """Lengths for a pattern's slots, or None where a class has run out."""
        found, used, left = [], {}, limit
        for u in shape[:-1]:
            n = waiting.longest(min(top[u], left))
            while n > top[u - 1] and used.get(n, 0) >= len(waiting.at[n]):
                n = waiting.longest(n - 1)
            if n <= top[u - 1] and not (u == 1 and n >= 0):
                return None
            found.append(n)
            used[n] = used.get(n, 0) + 1
            left -= n
        n = waiting.longest(left)
        while n >= 0 and used.get(n, 0) >= len(waiting.at[n]):
            n = waiting.longest(n - 1)
        return None if n < 0 else [*found, n]

    for shape, count in plan:
        for _ in range(int(count * min(share[u] for u in shape))):
            slots = fits(shape)
            if slots is None:
                break
            room.append(limit)
            for n in slots:
                put(n, len(room) - 1)
            if room[-1]:
                gaps.put(room[-1], len(room) - 1)
    while waiting.bits:
        n = waiting.longest(limit)
        gap = gaps.shortest(n)
        if gap >= 0:
            s = gaps.take(gap)
        else:
            room.append(limit)
            s = len(room) - 1
        put(n, s)
        if room[s]:
            gaps.put(room[s], s)
    return sequence, offset


def pack(pieces: DataFrame, limit: int, key: list[str], length_col: str = "length", group: int = GROUP) -> DataFrame:
    """``pieces`` with ``sequence_id`` (long) and ``offset`` (long): at most ``limit`` tokens each, gapless from 0.

    Patterns are fitted once to the whole histogram of lengths (at most ``limit`` counts reach the driver). Pieces
    are dealt evenly, whatever their keys, into groups of about ``group`` rows; each group uses the patterns for its share, fills their last slots exactly and the gaps best-fit. Every piece is placed once;
    ``pieces`` is a stored table, so that a lost task deals the same rows again;
    pieces of length 0 fit anywhere. Lengths are at most ``limit``. Send only what placing needs through here: keys
    and lengths, not ids.
    """
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy(length_col).count().collect()}  # at most limit + 1 rows
    if any(n > limit for n in counts):
        raise ValueError(f"a piece is longer than {limit}")
    histogram = np.zeros(UNITS + 1)
    for n, c in counts.items():
        histogram[-(-n * UNITS // limit) or 1] += c
    total = int(histogram.sum())
    histogram[UNITS] = 0  # full ones need no company
    plan = fit_patterns(histogram)
    groups = max(1, round(total / group))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(key, kind="stable", ignore_index=True)
        lengths = frame[length_col].to_numpy(np.int64)
        own = np.bincount(np.maximum(-(-lengths * UNITS // limit), 1), minlength=UNITS + 1)
        share = own / np.maximum(histogram, 1)
        sequence, offset = place(lengths, limit, plan, share)
        return frame.drop(columns="_group").assign(sequence_id=sequence + (int(frame["_group"].iloc[0]) << 32) if len(frame) else sequence, offset=offset)

    schema = pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    return dealt.groupBy("_group").applyInPandas(run, schema)


def packed_documents(docs: DataFrame, tokenizer_path: str, limit: int = 4096, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece of every text.

    Ids are made once and written to the shared folder; packing moves ids of documents, lengths and checksums only.
    Null texts count as empty (one piece with the end id alone); repeated rows are packed each; an empty table gives
    an empty result; a null id is kept.
    """
    pieces = stored(token_pieces(docs, tokenizer_path, limit, end_id, id_col, text_col), "pieces")
    digest = pieces.select(id_col, "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digest, limit, [id_col, "piece", "ids_crc32"])


def sequences(packed: DataFrame, pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``sequence_id`` and ``ids`` (little-endian unsigned 32-bit) of the packed sequences, for writing them out.

    For tables whose id is unique; ``pieces`` is the result of ``token_pieces``. A sequence has at most its limit of ids.
    """
    both = packed.select(id_col, "piece", "sequence_id", "offset").join(pieces.select(id_col, "piece", "ids"), [id_col, "piece"])
    parts = both.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "")).alias("ids"))
