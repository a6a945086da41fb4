"""A quality classifier from weak labels: expectation-maximisation, then a hashed linear scorer."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of

#: Documents that train the scorer, those with the least hash of the id.
SAMPLE = 20_000
#: Hashed features.
DIMENSIONS = 1 << 13

GOOD, BAD, NONE = 1, 0, 2
_SYMBOLS = re.compile(r"[#*$%&|<>{}\\^~=]")
_SHAPE = (("lower", re.compile(r"[^\W\d_]+[.,;:!?]?")), ("number", re.compile(r"[\d.,]+")), ("marked", re.compile(r".*[#*$%&|<>!]{2,}")))


def _share(count: float, of: float) -> float:
    return count / of if of else 0.0


def measures(text: str | None) -> tuple[dict[str, float], Counter]:
    """What the labellers look at, and the counts of the words."""
    words = text.split() if text else []
    counts, n = Counter(words), len(words)
    lines = [x for x in text.split("\n") if x.strip()] if text else []
    return {
        "n": n,
        "symbols": _share(len(_SYMBOLS.findall(text)) if text else 0, n),
        "capitals": _share(sum(k for w, k in counts.items() if len(w) > 1 and w.isupper()), n),
        "exclamations": _share(text.count("!") if text else 0, n),
        "kinds": _share(len(counts), min(n, 400)) if n else 0.0,
        "stutter": _share(sum(a == b for a, b in zip(words, words[1:])), n),
        "top": _share(max(counts.values(), default=0), n),
        "lines": _share(len(lines) - len(set(lines)), len(lines)),
        "sentences": _share(sum(k for w, k in counts.items() if w[-1] in ".?!,;:"), n),
        "length": _share(sum(len(w) * k for w, k in counts.items()), n),
        "letters": _share(sum(k for w, k in counts.items() if w[0].isalpha()), n),
    }, counts


def _band(value: float, bad_over: float, good_under: float) -> int:
    return BAD if value > bad_over else GOOD if value < good_under else NONE


#: Labellers, which overlap and err: each votes GOOD, BAD or NONE on a document's measurements.
LABELLERS = {
    "symbols": lambda m: _band(m["symbols"], 0.2, 0.02),
    "capitals": lambda m: _band(m["capitals"], 0.4, 0.1),
    "exclamations": lambda m: _band(m["exclamations"], 0.3, 0.05),
    "stutter": lambda m: _band(m["stutter"], 0.2, 0.03),
    "top_word": lambda m: _band(m["top"], 0.25, 0.12) if m["n"] >= 20 else NONE,
    "repeated_lines": lambda m: _band(m["lines"], 0.5, 0.2),
    "sentences": lambda m: GOOD if 0.02 <= m["sentences"] <= 0.4 else BAD if m["n"] >= 20 else NONE,
    "word_length": lambda m: GOOD if 3 <= m["length"] <= 9 else BAD if m["n"] >= 5 else NONE,
    "letters": lambda m: _band(1 - m["letters"], 0.4, 0.1),
    "variety": lambda m: (BAD if m["kinds"] < 0.25 else GOOD if m["kinds"] > 0.5 else NONE) if m["n"] >= 20 else NONE,
    "any_words": lambda m: BAD if m["n"] == 0 else NONE,
}


def votes(m: dict[str, float]) -> int:
    """All votes in one number, base 3, the first labeller's last."""
    code = 0
    for vote in reversed(LABELLERS.values()):
        code = 3 * code + vote(m)
    return code


def vote_matrix(codes: np.ndarray) -> np.ndarray:
    return np.stack([codes // 3**k % 3 for k in range(len(LABELLERS))], axis=1)


def fit_labellers(codes: np.ndarray, counts: np.ndarray, rounds: int = 200, trust: float = 0.05) -> tuple[float, np.ndarray]:
    """P(good), and P(vote | class, the labeller votes) of each labeller (class x labeller x vote), by expectation-maximisation.

    ``counts`` documents have the vote pattern ``codes``. A labeller that abstains says nothing. Starts from the majority of
    the votes, of which BAD weighs more, as labellers abstain where they are in doubt. Pseudo-documents, ``trust`` times
    the real ones, hold that good documents get few BAD votes; they keep probabilities above 0.
    """
    v, counts = vote_matrix(codes), counts.astype(float)
    good, bad = (v == GOOD).sum(axis=1), (v == BAD).sum(axis=1)
    posterior = (good + 1.0) / (good + 20.0 * bad + 2.0)
    belief = np.empty((2, 2))
    belief[1, GOOD], belief[1, BAD] = 0.998, 0.002
    belief[0, GOOD], belief[0, BAD] = 0.6, 0.4
    prior, tables = 0.5, np.empty((2, v.shape[1], 2))
    for _ in range(rounds):
        for label, weight in ((1, counts * posterior), (0, counts * (1 - posterior))):
            for k in range(v.shape[1]):
                seen = np.bincount(v[:, k], weight, 3)[:2] + (1.0 + trust * counts.sum()) * belief[label]
                tables[label, k] = seen / seen.sum()
        prior = (counts @ posterior + 1) / (counts.sum() + 2)
        new = posteriors(codes, prior, tables)
        done = np.abs(new - posterior).max(initial=0) < 1e-9
        posterior = new
        if done:
            break
    return float(prior), tables


def posteriors(codes: np.ndarray, prior: float, tables: np.ndarray) -> np.ndarray:
    """P(good) of vote patterns."""
    v = vote_matrix(codes)
    odds = np.full(len(codes), log(prior) - log(1 - prior))
    for k in range(v.shape[1]):
        voted = v[:, k] != NONE
        odds[voted] += np.log(tables[1, k][v[voted, k]]) - np.log(tables[0, k][v[voted, k]])
    return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def _slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % DIMENSIONS


class _WordSlots(dict):
    """Slots of a word's shape and ending, remembered up to a fixed number of words."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= 200_000:
            self.clear()
        shape = next((name for name, pattern in _SHAPE if pattern.fullmatch(word)), "other")
        shape += "^" if len(word) > 1 and word.isupper() else ""
        value = self[word] = (_slot(f"shape {shape}"), _slot(f"end {word[-2:].lower()}"))
        return value


_SLOTS = _WordSlots()


def features(m: dict[str, float], counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: levels of the measurements, and shares of word shapes and endings, scaled to length 1 together."""
    total: dict[int, float] = {}
    for word, k in counts.items():
        a, b = _SLOTS[word]
        total[a] = total.get(a, 0.0) + k
        total[b] = total.get(b, 0.0) + k
    size = sqrt(sum(x * x for x in total.values())) or 1.0
    for slot in total:
        total[slot] /= size
    for name, value in m.items():
        slot = _slot(f"{name} {min(12, int(log(1 + value) * 2)) if name == 'n' else min(12, int(value * 10))}")
        total[slot] = total.get(slot, 0.0) + 1.0
    return np.fromiter(total, np.int64, len(total)), np.fromiter(total.values(), np.float64, len(total))


def train_scorer(slots: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, rounds: int = 300, ridge: float = 1e-5) -> np.ndarray:
    """Weights of a logistic scorer (the last one is the constant) on posterior labels, by full-batch Adagrad."""
    weights = np.zeros(DIMENSIONS + 1)
    if not len(target):
        return weights
    at = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    flat, value = np.concatenate(slots), np.concatenate(values)
    squares = np.full(DIMENSIONS + 1, 1e-8)
    for _ in range(rounds):
        z = np.bincount(at, weights[flat] * value, len(slots)) + weights[-1]
        error = target - 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        gradient = np.append(np.bincount(flat, error[at] * value, DIMENSIONS), error.sum()) / len(target) - ridge * weights
        squares += gradient**2
        weights += gradient / np.sqrt(squares)
    return weights


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``id_col``, ``votes``, ``posterior`` (of the labellers), ``score`` and ``kept`` (score >= 0.5) for every row.

    One pass lets every labeller vote on every text. The counts of vote patterns (3^labellers at most, over all rows) go to
    the driver, where their accuracies are estimated. A documented sample of ``sample`` different rows, whatever their ids, with posterior labels, trains the
    linear scorer, which then scores all texts. Nobody's labels are read. Null and empty texts have no words, get the labellers'
    votes for that and a score like any text; repeated rows are scored each; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))

    def vote(batches):
        for batch in batches:
            codes = [votes(measures(t)[0]) for t in columns_of(batch, "t")[0]]
            at, n = np.unique(codes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n, pa.int64())], ["votes", "n"])

    patterns = rows.select("t").mapInArrow(vote, "votes long, n long").groupBy("votes").agg(F.sum("n").alias("n")).toPandas()  # 3^11 rows at most
    prior, tables = fit_labellers(patterns["votes"].to_numpy(np.int64), patterns["n"].to_numpy(np.int64))

    def featured(batches):
        for batch in batches:
            out = ([], [], [])
            for text in columns_of(batch, "t")[0]:
                m, counts = measures(text)
                slots, values = features(m, counts)
                for column, x in zip(out, (votes(m), slots.astype("<i4").tobytes(), values.astype("<f4").tobytes())):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["votes", "slots", "values"])

    chosen = _least_hashes(rows, sample)
    taught = list(chosen.mapInArrow(featured, "votes long, slots binary, values binary").toLocalIterator())
    target = posteriors(np.array([r.votes for r in taught], np.int64), prior, tables)
    weights = train_scorer([np.frombuffer(bytes(r.slots), "<i4") for r in taught], [np.frombuffer(bytes(r.values), "<f4") for r in taught], target)
    shared = docs.sparkSession.sparkContext.broadcast((prior, tables, weights))

    def score(batches):
        p, t, w = shared.value
        for batch in batches:
            codes, z = [], []
            for text in columns_of(batch, "t")[0]:
                m, counts = measures(text)
                slots, values = features(m, counts)
                codes.append(votes(m))
                z.append(float(w[slots] @ values + w[-1]))
            codes = np.array(codes, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(codes), pa.array(posteriors(codes, p, t)), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["i", "votes", "posterior", "score"])

    scored = rows.mapInArrow(score, f"i {kind}, votes long, posterior double, score double")
    return scored.select(F.col("i").alias(id_col), "votes", "posterior", "score", (F.col("score") >= 0.5).alias("kept"))


def _least_hashes(rows: DataFrame, sample: int) -> DataFrame:
    """The ``sample`` different rows with the least hashes of id and text, or all if there are fewer; repeats count once."""
    keyed = rows.withColumn("h", F.xxhash64(F.coalesce(F.col("i").cast("string"), F.lit("")), F.coalesce("t", F.lit("")), F.lit("weak labels")))
    limit = keyed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    return keyed.where(F.col("h") <= F.lit(limit)).dropDuplicates(["h"]).select("i", "t")
