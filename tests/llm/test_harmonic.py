"""Harmonic packing: every id once, no padding, whole documents where they fit."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerwatch.llm.harmonic import byte_ids, fill, harmonic_sequences, sequences_of
from test_text_operators import ODD, prose, table

BYTES, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("lengths", [[], [1], [3], [2048], [5000], [1] * 100, [1500] * 7, [2047] * 3, list(range(1, 2048, 7)), [random.Random(1).randrange(1, 9000) for _ in range(700)]])
def test_every_token_once_and_no_padding(lengths):
    pieces, sizes, cut = [[] for _ in lengths], [], set()
    for parts in fill(lengths, 2048):
        sizes.append(sum(n for *_, n in parts))
        for i, start, n in parts:
            pieces[i].append((start, n))
    for n, own in zip(lengths, pieces):
        at = 0
        for start, k in sorted(own):
            assert start == at and k > 0
            at += k
        assert at == n
    assert all(n == 2048 or n & (n - 1) == 0 for n in sizes) and sum(n < 2048 for n in sizes) <= 11


def test_short_documents_stay_whole():
    rng = random.Random(2)
    lengths = [rng.randrange(20, 900) for _ in range(2000)] + [rng.randrange(1025, 6000) for _ in range(800)]
    seen = [0] * len(lengths)
    for parts in fill(lengths, 2048):
        for i, *_ in parts:
            seen[i] += 1
    assert sum(n > 1 for n in seen[:2000]) <= 1


def test_a_class_has_a_fixed_number_of_documents():
    for parts in fill([400] * 100 + [3000] * 30, 2048):
        whole = [p for p in parts if p[0] < 100 and p[2] == 400]
        assert len(whole) in (0, 5)


def test_ids_are_the_tokenizers():
    texts = [t or "" for t in ODD] + ["x<|endoftext|>y", "漢字 and more", " " * 5000 + "a", "it's\r\n\n we'LL", "é" * 2000, "퟿ \x85"]
    model, plain = byte_ids(BYTES, RANKS), Tokenizer.from_file(BYTES)
    assert model.fast is not None
    assert model.encode(texts) == [np.asarray(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


@pytest.mark.parametrize("group_tokens", [300, 4_000_000])
def test_documents_come_back_from_their_sequences(spark, group_tokens):
    texts = ODD + [prose(i, 5 * i) for i in range(1, 60)]
    ids = [None, 5, 5, *range(100, 97 + len(texts))]
    docs = table(spark, texts, ids).withColumnRenamed("d", "sequence_id").withColumnRenamed("w", "worker")
    rows = harmonic_sequences(docs, BYTES, RANKS, group_tokens=group_tokens).collect()
    plain = Tokenizer.from_file(BYTES)
    expected = sorted(np.asarray([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for t in texts)
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if r.doc_id not in (None, 5):
            by_doc.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    for doc, parts in by_doc.items():
        whole = b"".join(p[2] for p in sorted(parts))
        assert len(whole) == 4 * parts[0][3] and whole in expected
    assert sum(r.length for r in rows) * 4 == sum(map(len, expected))


def test_no_documents_and_written_sequences(spark):
    assert harmonic_sequences(table(spark, []), BYTES, RANKS).count() == 0
    pieces = harmonic_sequences(table(spark, [prose(i, 300) for i in range(40)]), BYTES).coalesce(1).cache()
    written = {r.sequence_id: len(r.ids) // 4 for r in sequences_of(pieces).collect()}
    total = {r[0]: r[1] for r in pieces.groupBy("sequence_id").sum("length").collect()}
    assert written == total
