"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of, map_batches

#: Texts longer than this many characters are cut into chunks of this size.
CHUNK = 32_768
OVERLAP = 256


class PieceEncoder:
    """A sentencepiece model; ``spans`` gives the place at which each token of a text begins."""

    mark = "▁"
    #: The encoder puts a mark in front of a text, which stands for the space at a cut.
    skip = 1

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        #: No piece has a word mark behind other characters, and white space is kept as it is. So no
        #: token reaches over a space that follows another character.
        self.cuts_at_spaces = not any(self.mark in p.lstrip(self.mark) for p in pieces) and self.model.encode("a  b ", out_type=str)[-1].endswith(self.mark)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def starts(self, text: str) -> list[int]:
        """Places of the tokens' first characters.

        Pieces spell the text with a mark for each space and one more mark in front; a character
        outside the vocabulary becomes one byte piece for each of its UTF-8 bytes.
        """
        at, out, left = -1, [], 0
        for piece in self.model.encode(text, out_type=str):
            if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">") and text[max(at, 0) : max(at, 0) + 6] != piece:
                out.append(max(at, 0))
                left = left or len(text[max(at, 0)].encode())
                left -= 1
                at += left == 0
            else:
                out.append(max(at, 0))
                at += len(piece)
        return out

    def stable(self, text: str, at: int) -> bool:
        return self.cuts_at_spaces and text[at] == " " and text[at - 1] not in (" ", self.mark)


class WordEncoder:
    """A file of the tokenizers library."""

    skip = 0

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.splits = self.model.pre_tokenizer is not None and self._splits_at_spaces()

    def _splits_at_spaces(self) -> bool:
        """Single spaces between letters start a new pre-token or belong to none."""
        spans = [span for _, span in self.model.pre_tokenizer.pre_tokenize_str("ab cd ef")]
        return all(not (a < at < b) for a, b in spans for at in (2, 5))

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)]

    def starts(self, text: str) -> list[int]:
        return [a for a, _ in self.model.encode(text, add_special_tokens=False).offsets]

    def stable(self, text: str, at: int) -> bool:
        """A single space between ASCII letters."""
        near = text[at - 1 : at + 2]
        return self.splits and len(near) == 3 and near[1] == " " and near.isascii() and near[0].isalpha() and near[2].isalpha()


@lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder | WordEncoder:
    """Loaded once for each Python worker."""
    return (PieceEncoder if path.endswith(".model") else WordEncoder)(path)


def spliced_count(model, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text`` from overlapping chunks, the same number as of one encoding.

    Two chunks are joined at the last place of their overlap that is stable (no token can reach over
    it, whatever stands around it) and at which neither encoding has a token that runs across. The
    left chunk counts up to there, the right one from there on. If there is no such place, the
    overlap is doubled, in the end to the whole text.
    """
    total, begin = 0, 0
    while True:
        end = min(begin + chunk, len(text))
        starts = model.starts(text[begin:end])
        if end == len(text):
            return total + len(starts)
        wide = overlap
        while True:
            cut = _common_cut(model, text, begin, end, starts, wide)
            if cut is not None:
                break
            if wide >= end - begin:  # no stable place in this chunk at all: take a longer one
                if end == len(text):
                    return total + len(starts)
                end = min(begin + 2 * (end - begin), len(text))
                starts = model.starts(text[begin:end])
                if end == len(text):
                    return total + len(starts)
            wide *= 2
        total += bisect_left(starts, cut - begin)
        begin = cut + model.skip


def _common_cut(model, text: str, begin: int, end: int, starts: list[int], wide: int) -> int | None:
    """The last stable place in the ``wide`` characters before ``end`` where the chunk's encoding and one of text on both sides of ``end`` agree on a token's start."""
    low = max(begin + 2, end - wide)
    places = [at for at in range(end - 1, low - 1, -1) if model.stable(text, at)]
    if not places:
        return None
    right = set(model.starts(text[low : end + wide]))
    left = set(starts)
    for at in places[:-1] or places:
        word = at + (text[at] == " ")  # a tokenizer may leave the space out of its tokens
        if {at - begin, word - begin} & left and {at - low, word - low} & right:
            return at
    return None


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``id_col``, ``n_bytes`` and ``n_tokens`` (long) and ``over_limit`` for every row.

    ``model_path`` is a file of the tokenizers library (.json) or of sentencepiece (.model), readable
    on every executor. Null texts count as empty: no bytes, no tokens. Texts beyond ``chunk``
    characters are encoded piece by piece (``spliced_count``), so the encoder's memory is bounded.
    Repeated rows and null ids give a row each; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = encoder(model_path)
        texts = [t or "" for t in columns_of(batch, "t")[0]]
        short = [i for i, t in enumerate(texts) if len(t) <= chunk]
        counts = dict(zip(short, model.counts([texts[i] for i in short])))
        n = [counts[i] if i in counts else spliced_count(model, t, chunk, overlap) for i, t in enumerate(texts)]
        return pa.RecordBatch.from_arrays([batch.column("i"), batch.column("b"), pa.array(n, pa.int64())], ["i", "b", "n"])

    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("b"), F.col(text_col).alias("t"))
    counted = map_batches(rows, convert, f"i {kind}, b long, n long")
    return counted.select(F.col("i").alias(id_col), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"), (F.col("n") > limit).alias("over_limit"))
