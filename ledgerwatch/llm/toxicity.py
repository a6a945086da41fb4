"""Toxicity from class-conditional Kneser-Ney models."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of, remainder, words_of

#: Labelled texts of either class that are read to fit the models.
SAMPLE = 4_000
#: Words of a stretch whose log-likelihoods are compared.
STRETCH = 8
DISCOUNT = 4
_LETTERS = re.compile(rb"[^a-z0-9\x80-\xff]+")
_START = 1
_BLOCK = 1 << 16


def word_codes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words without ASCII punctuation; words of punctuation alone are left out."""
    words = (w for w in _LETTERS.sub(b" ", b" ".join(words_of(text))).split())
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64)


def _heads(codes: np.ndarray) -> np.ndarray:
    """The word before each word, or the start."""
    return np.concatenate([[_START], codes[:-1]]).astype(np.uint64) if len(codes) else codes


class _Table:
    """Values under sorted 64-bit keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values

    def get(self, asked: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(asked))
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.values[at], 0.0)


class KneserNey:
    """P(word | word before) of two classes over one backoff.

    A class's bigrams back off to its unigrams, and these to continuation counts that both classes
    share: the different words in front of a word, as many as both have. Each text counts an expression
    once, so that repeats within a text don't swell it, and the absolute discount takes all of an
    expression that few texts of a class have. So a rare expression is as likely in both, and one that
    a class has often and the other never gets the whole difference.
    """

    def __init__(self, texts: list[np.ndarray], toxic: np.ndarray):
        self.tables, met = [], []
        for label in (0, 1):
            words, heads, tails, pairs = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for codes in (t for t, y in zip(texts, toxic) if y == label):
                before = _heads(codes)
                own, first = np.unique(_join_codes(before, codes), return_index=True)
                words.append(np.unique(codes))
                pairs.append(own)
                heads.append(before[first])
                tails.append(codes[first])
            words, heads, tails, pairs = (np.concatenate(x) for x in (words, heads, tails, pairs))
            kinds, counts = np.unique(words, return_counts=True)
            n = max(1, len(words))
            alone = _Table(kinds, np.maximum(counts - DISCOUNT, 0) / n)
            spare = 1.0 - float(alone.values.sum())  # what the discount takes
            codes, first, times = np.unique(pairs, return_index=True, return_counts=True)
            met.append(tails[first])
            head_kinds, head_counts = np.unique(heads, return_counts=True)
            often = times > DISCOUNT
            share = (times[often] - DISCOUNT) / _Table(head_kinds, head_counts).get(heads[first[often]])
            back_keys, at = np.unique(heads[first[often]], return_inverse=True)
            back = _Table(back_keys, 1.0 - np.bincount(at, share, len(back_keys)))
            self.tables.append((alone, _Table(codes[often], share), back, spare))
        # continuation counts: different words in front of a word, as far as both classes have them
        (kinds, counts), other = (np.unique(tails, return_counts=True) for tails in met)
        also = _Table(*other).get(kinds)
        kinds, counts = kinds[also > 0], np.minimum(counts, also)[also > 0]
        total = counts.sum() + len(kinds) + 1.0
        self.floor = 1.0 / total  # of a word that only one class, or none, has
        self.shared = _Table(kinds, counts / total)
        self.unseen = float(np.log(self.tables[1][3]) - np.log(self.tables[0][3]))

    def ratios(self, codes: np.ndarray) -> np.ndarray:
        """log P(word | before, toxic) - log P(word | before, ordinary) of each word, less that of a word neither has seen."""
        before = _heads(codes)
        pairs = _join_codes(before, codes)
        shared = self.shared.get(codes) + self.floor
        logs = []
        for alone, both, back, spare in self.tables:
            unigram = alone.get(codes) + spare * shared
            left = back.get(before)
            logs.append(np.log(both.get(pairs) + np.where(left > 0, left, 1.0) * unigram))
        return logs[1] - logs[0] - self.unseen


def _join_codes(before: np.ndarray, codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (before ^ (before >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + codes


def evidence(model: KneserNey, text: str | None, stretch: int = STRETCH) -> tuple[float, float, float]:
    """Length-normalised log-likelihood ratios of a text: of all its words, and of its two strongest stretches.

    Stretches of ``stretch`` words, half overlapping, cover the whole text, so an insult weighs the same in a
    long text as in a short one.
    """
    return evidence_of(model, word_codes(text), stretch)


def evidence_of(model: KneserNey, codes: np.ndarray, stretch: int = STRETCH) -> tuple[float, float, float]:
    if not len(codes):
        return 0.0, 0.0, 0.0
    sums = _running_sums(model, codes)
    starts = np.arange(0, max(1, len(codes) - stretch // 2), stretch // 2)
    ends = np.minimum(starts + stretch, len(codes))
    means = np.sort((sums[ends] - sums[starts]) / stretch)
    return float(sums[-1] / len(codes)), float(means[-1]), float(means[-3] if len(means) > 2 else 0.0)


def _running_sums(model: KneserNey, codes: np.ndarray) -> np.ndarray:
    """Sums of the words' ratios up to each place, made in blocks of a fixed size."""
    parts, total = [np.zeros(1)], 0.0
    for a in range(0, len(codes), _BLOCK):
        low = max(0, a - 1)
        part = np.cumsum(model.ratios(codes[low : a + _BLOCK])[a - low :]) + total
        total = part[-1]
        parts.append(part)
    return np.concatenate(parts)


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (y - p)) - ridge * beta
        hessian = (x * (weights * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held: int = 0, sample: int = SAMPLE):
    """The two models and the coefficients that turn ``evidence`` into a probability; None with fewer than two classes.

    Of the labelled rows outside fold ``held``, up to ``sample`` of each class are read: those with the least
    hash of the id, one text of each. Three quarters are counted, the rest sets the coefficients, where each text stands for as
    many as its class has labelled rows for a row read: so the constant keeps the labels' class shares at any size.
    """
    wanted = labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("y")).where((remainder("i", folds) != held) & F.col("y").isin(0, 1)).groupBy("i").agg(F.max("y").alias("y"))
    picked = wanted.withColumn("h", F.xxhash64(F.col("i").cast("string"), F.lit("toxic")))
    totals = {r.y: r["count"] for r in wanted.groupBy("y").count().collect()}
    weight = np.array([max(1.0, totals.get(y, 0) / sample) for y in (0, 1)])
    rows = []
    for y in (0, 1):
        some = picked.where(F.col("y") == y).orderBy("h").limit(sample)
        found = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(some), "i")  # at most ``sample`` ids
        found = found.groupBy("h", "y").agg(F.min("t").alias("t"))  # one text of an id that repeats
        kind = "h long, y int, codes binary"
        coded = found.select("h", F.col("y").cast("int").alias("y"), "t").mapInArrow(_coded, kind)
        rows += [(r.h, y, np.frombuffer(bytes(r.codes), np.uint64)) for r in coded.toLocalIterator()]
    rows.sort(key=lambda r: r[0])
    y = np.array([r[1] for r in rows])
    count = np.arange(len(rows)) % 4 != 3
    texts = [r[2] for r in rows]
    if len(set(y[count])) < 2:
        return None
    model = KneserNey([t for t, c in zip(texts, count) if c and len(t)], np.array([r[1] for r, c in zip(rows, count) if c and len(r[2])]))
    use = ~count if len(set(y[~count])) == 2 else count
    x = np.array([evidence_of(model, t) for t, u in zip(texts, use) if u])
    weights = weight[y[use]]
    beta = logistic(x, y[use].astype(float), weights / weights.mean())
    return model, beta


def _coded(batches):
    for batch in batches:
        codes = [word_codes(t).tobytes() for t in columns_of(batch, "t")[0]]
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("y"), pa.array(codes, pa.binary())], ["h", "y", "codes"])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row of ``docs``.

    Labels are read only from rows whose fold (crc32 of the id as text, modulo ``folds``) is not ``held``; a null id is
    held out. Texts alone are scored. A text without words has no evidence and gets the score of none; without
    labels of both classes every score is 0. Repeated rows are scored each; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, folds, held, sample))

    def run(batches):
        fitted = shared.value
        for batch in batches:
            texts = columns_of(batch, "t")[0]
            if fitted is None:
                scores = np.zeros(len(texts))
            else:
                model, beta = fitted
                x = np.array([evidence(model, t) for t in texts])
                scores = 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("held_out"), pa.array(scores)], ["i", "held_out", "score"])

    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(remainder(id_col, folds) == held, F.lit(True)).alias("held_out"), F.col(text_col).alias("t"))
    scored = rows.mapInArrow(run, f"i {kind}, held_out boolean, score double")
    return scored.select(F.col("i").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
