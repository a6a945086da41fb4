"""FM-index and collocations against brute force."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from ledgerwatch.llm import phrases
from ledgerwatch.llm.fmindex import BiIndex
from ledgerwatch.llm.phrases import collocations

SCHEMA = "doc_id long, text string, lang string, shard long, word string, ids string"


@pytest.mark.parametrize("size, n, depth", [(2, 50, 3), (5, 400, 3), (5, 400, 5), (300, 2000, 4), (3, 1, 2), (3, 0, 3)])
def test_index_counts_every_gram(size, n, depth):
    symbols = np.random.default_rng(size + n).integers(0, size, n)
    expected = [Counter(tuple(symbols[i : i + k]) for i in range(n - k + 1) if 0 not in symbols[i : i + k]) for k in range(1, depth + 1)]
    found = list(BiIndex(symbols, size, depth).grams(depth))
    assert [dict(zip(map(tuple, words.tolist()), counts.tolist())) for words, counts in found] == [dict(c) for c in expected]


def test_both_ends_extend_alike():
    symbols = np.random.default_rng(5).integers(0, 6, 500)
    index = BiIndex(symbols, 6, 3)
    one, lo, rlo, n = index.singles()
    both = []
    for to_left in (True, False):
        pattern, symbol, lo2, rlo2, n2 = index.extend(lo, rlo, n, to_left)
        pairs = list(zip(symbol, one[pattern])) if to_left else list(zip(one[pattern], symbol))
        both.append(sorted(zip(pairs, lo2, rlo2, n2)))
    assert both[0] == both[1]


@pytest.mark.parametrize("bits", [8, 1 << 16])
def test_filter_lets_every_frequent_pair_through(spark, bits):
    """A filter that is far too small changes what is counted, not the result."""
    docs = spark.createDataFrame([(1, t, lang, 1, "x", "y") for t, lang in texts()], SCHEMA)
    shards = phrases.word_shards(docs, shard_words=500)
    kept = phrases.frequent_shards(shards, phrases.frequent_words(shards, 10))
    results = [tuple(sorted(map(tuple, t.collect())) for t in phrases.phrase_counts(kept, 10, b)) for b in (bits, 1 << 20)]
    assert results[0] == results[1] and all(results[0])
    pairs = spark.createDataFrame([(1, 2), (5, 6), (10**15, 3)], "w1 long, w2 long")
    table = np.unpackbits(np.frombuffer(phrases.pair_filter(pairs, bits), np.uint8), bitorder="little")
    assert set(np.flatnonzero(table)) == {int(phrases.pair_slots(np.array([a]), np.array([b]), bits)[0]) for a, b in ((1, 2), (5, 6), (10**15, 3))}


def brute(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in candidates.items():
        if len(p) == 3 and any(len(q) == 4 and 100 * b >= 50 * a and q[0] == p[0] and p[1:] in (q[1:3], q[2:4]) for q, b in candidates.items()):
            continue
        cuts = [(10**6 * a * a // (f[p[:k]] * f[(p[0], *p[k:])]), k) for k in range(2, len(p))]
        score, k = min(cuts)
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), f[p[:k]], f[(p[0], *p[k:])]))
    ranked, place = [], Counter()
    for lang, s, a, phrase, left, right in sorted(out):
        place[lang] += 1
        if place[lang] <= top:
            ranked.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(ranked)


def texts():
    rng = np.random.default_rng(1)
    vocabulary = ["the", "New", "york", "of", "ä", "é\x85x", "日本", "a\x1cb", "rare1", "x"] + [f"w{i}" for i in range(30)]
    marks = [" ", " ", " ", " ", "\t ", ", ", ".", "\n", " ; "]
    rows = []
    for i in range(200):
        words = rng.choice(vocabulary, 60, p=np.array([8] * 5 + [1] * 35) / 75)
        text = "".join(w + marks[rng.integers(len(marks))] for w in words)
        rows.append((text + " in new york city" * (i % 3), ("en", "de", None)[i % 3]))
    return [*rows, (None, "en"), ("", "xx"), (" \n,", None), ("only one piece of words " * 3000, "long")]


@pytest.mark.parametrize("shard_words", [50, 100_000])
def test_collocations_are_those_of_brute_force(spark, shard_words):
    rows = texts()
    docs = spark.createDataFrame([(7, t, lang, 1, "x", "y") for t, lang in rows], SCHEMA)
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in collocations(docs, shard_words=shard_words).select(names).collect()) == brute(rows)
    assert sorted(tuple(r) for r in collocations(docs, top=3, least=25, shard_words=shard_words).select(names).collect()) == brute(rows, 25, 3)


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "_BLOCK_BYTES", 40)
    text = b"a b c\n" * 30 + b"d e f g h i j k l m n o p q r s t u v w x y z a b c d e f g\n\n" + b"z" * 90
    blocks = list(phrases._blocks(text))
    assert b"".join(blocks) == text and len(blocks) > 3 and all(b.endswith(b"\n") for b in [b for b in blocks if b][:-1])


def test_no_documents(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations(spark.createDataFrame([(1, "a b", None, 1, "", ""), (None, None, None, 1, "", "")], SCHEMA)).count() == 0


def test_scores_pass_64_bits(spark):
    a, left, right = 4_000_000_000_000, 5_000_000_000_001, 4_000_000_000_003
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(phrases._score("l", "r")).first()
    assert row[0] == 10**6 * a * a // (left * right)
