"""The language model's probabilities and vocabulary, and pattern packing against best fit alone."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerwatch.llm import language_model as lm
from ledgerwatch.llm.packing import UNITS, fit_patterns, place
from ledgerwatch.llm.toxicity import score_toxicity
from ledgerwatch.llm.weak_labels import score_quality
from test_text_operators import prose


def small_model(n_units=40, seed=3):
    rng = np.random.default_rng(seed)
    vocabulary = lm.Vocabulary({bytes([65 + i]): i for i in range(20)}, rng.integers(1, 900, n_units), np.ones(n_units, np.int64), {})
    model = lm.Model(vocabulary)
    for part in model.parts:
        part += rng.normal(0, 0.7, part.shape).astype(np.float32)
    return vocabulary, model


def softmax(model, context):
    scores = np.array([sum(model.q[c] * model.c[k] for k, c in enumerate(context)) @ model.r[u] + model.b[u] for u in range(len(model.b))], np.float64)
    return np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()


def test_probabilities_are_normalised(spark):
    vocabulary, model = small_model()
    norms = lm.all_norms(spark, vocabulary, model.vector())
    assert len(norms) == model.contexts() == 41**2
    rng = np.random.default_rng(1)
    context, target = rng.integers(0, 41, (300, 2)), rng.integers(0, 40, 300)
    got = model.log10_probabilities(context, target, norms)
    assert got == pytest.approx([np.log10(softmax(model, c)[t]) for c, t in zip(context, target)], abs=1e-4)


def test_norms_survive_large_scores():
    _, model = small_model()
    model.b[:] = 200.0
    norms = model.norms(0, 41)
    assert np.isfinite(norms).all() and norms.min() > 190


def test_equally_frequent_words_are_known_up_to_the_limit(spark):
    counts = spark.createDataFrame([(f"w{i:04d}".encode(), 7) for i in range(2000)] + [(b"top", 900), (lm.END, 50)], "token binary, n long")
    vocabulary, total, kinds = lm.vocabulary_of(counts, 1000)
    assert (total, kinds) == (14_950, 2002)
    assert len(vocabulary.known) == 1000 and {b"top", lm.END, b"w0000", b"w0997"} <= set(vocabulary.known) and b"w0998" not in vocabulary.known
    assert len(vocabulary.units) == lm.FREQUENT[0] and vocabulary.totals.sum() == total and vocabulary.kinds.sum() == kinds


def test_units_grow_with_the_vocabulary(spark):
    counts = spark.range(500_000).selectExpr("CAST(CAST(id AS STRING) AS BINARY) AS token", "1000000 - id AS n")
    vocabulary, _, _ = lm.vocabulary_of(counts, 2000)
    assert len(vocabulary.units) == 707 + 1  # the end is a unit of its own here


@pytest.mark.parametrize("seed", range(4))
def test_patterns_need_no_more_sequences_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(4096, 1 + (rng.pareto(1.2 + seed / 5, 6000) * 300).astype(int))
    histogram = np.bincount(np.maximum(-(-lengths * UNITS // 4096), 1), minlength=UNITS + 1).astype(float)
    histogram[UNITS] = 0
    counts = []
    for plan in (fit_patterns(histogram), []):
        sequence, offset = place(lengths, 4096, plan, np.ones(UNITS + 1))
        ends = {}
        for s, at, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths.tolist())):
            assert at == ends.get(s, 0)
            ends[s] = at + n
        assert max(ends.values()) <= 4096
        counts.append(len(ends))
    assert counts[0] <= counts[1] + 1 and counts[0] >= lengths.sum() / 4096


def labelled(spark, texts, ids):
    schema = "doc_id long, text string, i string, h long, votes string"
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in zip(ids, texts)], schema)


def test_quality_of_rows_that_share_one_id(spark):
    """The sample goes by id and text: one id in all rows, or none, trains as well as different ones."""
    texts = [prose(k, 80) if k % 3 else "@@ ## $$ BUY!!! " * 30 + str(k) for k in range(240)]
    for ids in ([5] * len(texts), [None] * len(texts), range(len(texts))):
        got = score_quality(labelled(spark, texts, ids), sample=90).select("kept").collect()
        assert sum(r.kept for r in got) == pytest.approx(160, abs=8)
    repeated = labelled(spark, [texts[1]] * 150 + texts, [5] * 150 + [5] * len(texts))
    assert sum(r.kept for r in score_quality(repeated, sample=90).collect()) >= 150 + 150


def test_quality_and_toxicity_of_nothing(spark):
    none = labelled(spark, [], [])
    assert score_quality(none).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert score_toxicity(none, labels).count() == 0
    odd = labelled(spark, [None, "", "a word", prose(3, 20_000)], [None, 1, 1, 2])
    assert {r.score for r in score_toxicity(odd, labels).collect()} == {0.0}
    assert score_quality(odd).count() == 4


def test_toxicity_reads_one_text_of_a_repeated_id(spark):
    bad, good = "vile rotten scum", "kind gentle words"
    texts = [f"{prose(k, 20)} {bad if k % 2 else good} {prose(k + 500, 20)}" for k in range(200)]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(200)], "doc_id long, quality int, toxic int")
    docs = labelled(spark, texts + [texts[0]] * 300, [*range(200), *[0] * 300])
    once = {r.doc_id: r.score for r in score_toxicity(labelled(spark, texts, range(200)), labels).collect()}
    again = score_toxicity(docs, labels).collect()
    assert len(again) == 500 and all(r.score == pytest.approx(once[r.doc_id]) for r in again)
    held = [r for r in again if r.held_out and r.doc_id]
    assert sum(r.predicted == r.doc_id % 2 for r in held) >= 0.9 * len(held)
