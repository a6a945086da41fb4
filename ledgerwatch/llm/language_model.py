"""A log-bilinear language model, trained with noise-contrastive estimation over the whole corpus."""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of, remainder, words_of
from ledgerwatch.session import stored

END = b"\n"  # no word holds a line break
#: Least and most number of frequent tokens that are units of the model: the square root of the number of distinct
#: tokens between these; the others are met through classes of endings.
FREQUENT = 512, 1024
#: Classes of the other tokens, by a hash of their last three bytes.
CLASSES = 256
CONTEXT = 2
WIDTH = 16
#: Frequent words whose counts go to every task; rarer ones meet their counts in a join.
KNOWN = 150_000
#: Passes over disjoint parts of the training documents; parameters are averaged after each.
ROUNDS = 2
_BATCH, _NOISE, _RATE = 4096, 64, 0.06


def ending_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


@dataclass
class Vocabulary:
    """Model units: frequent tokens (END among them), then classes of endings, then the start of a text."""

    units: dict[bytes, int]
    totals: np.ndarray  # training tokens of each unit
    kinds: np.ndarray  # distinct training tokens of each unit
    known: dict[bytes, int]  # exact counts of the most frequent tokens

    @property
    def start(self) -> int:
        return len(self.totals)

    def unit(self, word: bytes) -> int:
        u = self.units.get(word)
        return len(self.units) + ending_class(word) if u is None else u


class _Codes(dict):
    """A number for each word: its place among the known ones, or behind them its class of endings.

    ``unit``, ``log_count`` (log10 of count + 1) and ``in_class`` are arrays over these numbers. Words that
    are not known are remembered up to a fixed number.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__((word, i) for i, word in enumerate(vocabulary.known))
        self.n_known = len(self)
        self.setdefault(END, self.n_known + CLASSES)
        self.vocabulary, exact = vocabulary, len(vocabulary.units)
        self.unit = np.array([*map(vocabulary.unit, vocabulary.known), *range(exact, exact + CLASSES), vocabulary.unit(END), vocabulary.start], np.int32)
        self.start = len(self.unit) - 1
        self.log_count = np.log10(np.array([*vocabulary.known.values(), *[0] * (CLASSES + 2)]) + 1.0)
        self.in_class = self.unit >= exact

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.n_known + 200_000:
            known = list(self.vocabulary.known)
            self.clear()
            self.update((w, i) for i, w in enumerate(known))
            self.setdefault(END, self.n_known + CLASSES)
        value = self[word] = self.n_known + ending_class(word)
        return value

    def flat(self, texts: list[list[bytes]]) -> np.ndarray:
        """The numbers of all texts' tokens, each text with CONTEXT starts in front and END behind."""
        out: list[int] = []
        front, end, get = [self.start] * CONTEXT, self[END], self.__getitem__
        for words in texts:
            out += front
            out += map(get, words)
            out.append(end)
        return np.array(out, np.int32)


class Model:
    """score(w | context) = (sum of place weights x context vectors) . vector of w + bias of w."""

    def __init__(self, vocabulary: Vocabulary, seed: int = 7):
        rng, n = np.random.default_rng(seed), len(vocabulary.totals)
        p = (vocabulary.totals + 1.0) / (vocabulary.totals + 1.0).sum()
        self.q = rng.normal(0, 0.1, (n + 1, WIDTH)).astype(np.float32)
        self.r = rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32)
        self.c = np.ones((CONTEXT, WIDTH), np.float32)
        self.b = np.log(p).astype(np.float32)
        self.noise, self.steps = p, np.cumsum(p)
        self.squares = [np.full_like(x, 1e-8) for x in self.parts]

    @property
    def parts(self) -> list[np.ndarray]:
        return [self.q, self.r, self.c, self.b]

    def vector(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for x in self.parts:
            x[...] = vector[at : at + x.size].reshape(x.shape)
            at += x.size

    def predict(self, context: np.ndarray) -> np.ndarray:
        return sum(self.q[context[:, k]] * self.c[k] for k in range(CONTEXT))

    def step(self, context: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> None:
        """One Adagrad step on the NCE loss; all targets of the batch share their noise, drawn at even steps of its distribution."""
        m = len(target)
        noise = np.minimum(np.searchsorted(self.steps, (np.arange(_NOISE) + rng.random()) / _NOISE), len(self.noise) - 1)
        log_kp = np.log(_NOISE * self.noise).astype(np.float32)
        hat = self.predict(context)
        with np.errstate(over="ignore"):
            up = 1 / (1 + np.exp(np.einsum("ij,ij->i", hat, self.r[target]) + self.b[target] - log_kp[target]))  # 1 - P(true)
            down = -1 / (1 + np.exp(-(hat @ self.r[noise].T + self.b[noise] - log_kp[noise])))  # -P(true) of noise
        d_hat = up[:, None] * self.r[target] + down @ self.r[noise]
        n = len(self.b)
        mix = np.zeros((n, WIDTH), np.float32)
        _add_rows(mix, target, up[:, None] * hat)
        np.add.at(mix, noise, down.T @ hat)
        bias = np.bincount(target, up, n).astype(np.float32)
        np.add.at(bias, noise, down.sum(axis=0))
        d_q = np.zeros_like(self.q)
        d_c = np.empty_like(self.c)
        for k in range(CONTEXT):
            _add_rows(d_q, context[:, k], d_hat * self.c[k])
            d_c[k] = (d_hat * self.q[context[:, k]]).sum(axis=0)
        for x, g, s in zip(self.parts, (d_q, mix, d_c, bias), self.squares):
            g /= m
            s += g * g
            x += _RATE * g / np.sqrt(s)

    def contexts(self) -> int:
        """Number of contexts: any unit or the start of a text at each place."""
        return (len(self.b) + 1) ** CONTEXT

    def numbers(self, context: np.ndarray) -> np.ndarray:
        """The number of each context."""
        number = context[:, 0].astype(np.int64)
        for k in range(1, CONTEXT):
            number = number * (len(self.b) + 1) + context[:, k]
        return number

    def norms(self, low: int, high: int) -> np.ndarray:
        """Log of the sum of exp(score) over all units, for the contexts numbered ``low`` to ``high``."""
        out = np.empty(high - low, np.float32)
        table = np.ascontiguousarray(np.column_stack([self.r, self.b]).T)
        ones = np.ones(len(self.b), np.float32)
        for at in range(low, high, 256):
            number = np.arange(at, min(at + 256, high))
            context = np.stack(np.unravel_index(number, (len(self.b) + 1,) * CONTEXT), axis=1)
            scores = np.column_stack([self.predict(context), np.ones(len(number), np.float32)]) @ table
            with np.errstate(over="ignore"):
                sums = np.exp(scores) @ ones
            if not np.isfinite(sums).all():
                top = scores.max(axis=1)
                out[at - low : at - low + len(number)] = np.log(np.exp(scores - top[:, None]) @ ones) + top
            else:
                out[at - low : at - low + len(number)] = np.log(sums)
        return out

    def log10_probabilities(self, context: np.ndarray, target: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Normalised over all units; ``norms`` holds those of all contexts."""
        out = np.empty(len(target))
        for at in range(0, len(target), 1 << 18):
            c, t = context[at : at + (1 << 18)], target[at : at + (1 << 18)]
            own = np.einsum("ij,ij->i", self.predict(c), self.r[t]) + self.b[t]
            out[at : at + (1 << 18)] = (own - norms[self.numbers(c)]) / np.log(10)
        return out


def all_norms(spark: SparkSession, vocabulary: Vocabulary, vector: np.ndarray) -> np.ndarray:
    """The norms of every context, computed once in blocks over the tasks: a table of fixed size (6.6 MB at most)."""
    shared = spark.sparkContext.broadcast((vocabulary, vector))
    count = Model(vocabulary).contexts()
    block = 1 << 14

    def run(batches):
        words, parts = shared.value
        model = Model(words)
        model.load(parts)
        for batch in batches:
            for n in batch.column("id").to_pylist():
                found = model.norms(n * block, min((n + 1) * block, count))
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([found.tobytes()], pa.binary())], ["n", "v"])

    blocks = spark.range(-(-count // block)).repartition(-(-count // block)).mapInArrow(run, "n long, v binary").collect()
    return np.concatenate([np.frombuffer(bytes(r.v), np.float32) for r in sorted(blocks)])


def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """into[rows] += values with repeated rows: sorted runs are summed first."""
    order = np.argsort(rows, kind="stable")
    at, first = np.unique(rows[order], return_index=True)
    into[at] += np.add.reduceat(values[order], first, axis=0)


def _pairs(units: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and targets of a row of units in which CONTEXT starts stand before each text."""
    places = np.flatnonzero(units != start)
    return np.stack([units[places - CONTEXT + k] for k in range(CONTEXT)], axis=1), units[places]


def token_counts(train: DataFrame, text_col: str = "text") -> DataFrame:
    """``token`` (binary), ``n`` over all rows: each text's words and one END."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in columns_of(batch, "t")[0]:
                counts.update(words_of(text))
                counts[END] += 1
            if len(counts) > 250_000:
                yield from _counted(counts)
                counts.clear()
        yield from _counted(counts)

    return train.select(F.col(text_col).alias("t")).mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def _counted(counts: Counter):
    if counts:
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["token", "n"])


def vocabulary_of(counts: DataFrame, known: int = KNOWN) -> tuple[Vocabulary, int, int]:
    """The model's units from stored counts, with the number of training tokens and of distinct ones.

    At most ``known`` tokens reach the driver: the most frequent ones, by their bytes where counts are equal.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    level = F.floor(8 * F.log2("n"))  # at most 512 levels, whatever the counts
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(level).count().collect()), reverse=True)
    reached, least = 0, None
    for at, size in sizes:
        reached += size
        if reached > known:
            break
        least = at
    whole = counts.where(level >= least if least is not None else F.lit(False)).toPandas()
    room = known - len(whole)
    # the level that does not fit as a whole
    part = counts.where(level < least if least is not None else F.lit(True)).orderBy(F.desc("n"), "token").limit(room).toPandas()
    top = pd.concat([whole, part])
    top = top.assign(token=top["token"].map(bytes)).sort_values(["n", "token"], ascending=[False, True], ignore_index=True)
    frequent = [bytes(t) for t in top["token"].head(min(max(FREQUENT[0], int(total[1] ** 0.5)), FREQUENT[1]))]
    units = {t: i for i, t in enumerate(frequent)}
    units.setdefault(END, len(units))
    rest = counts.where(~F.col("token").isin(list(units)) if units else F.lit(True))

    def classed(batches):
        for batch in batches:
            tokens, n = columns_of(batch, "token", "n")
            kind = [ending_class(t) for t in tokens]
            sums, kinds = np.bincount(kind, n, CLASSES).astype(np.int64), np.bincount(kind, minlength=CLASSES)
            yield pa.RecordBatch.from_arrays([pa.array(range(CLASSES), pa.int32()), pa.array(sums), pa.array(kinds)], ["class", "n", "kinds"])

    totals, kinds = np.zeros(len(units) + CLASSES, np.int64), np.zeros(len(units) + CLASSES, np.int64)
    known_counts = {bytes(t): int(n) for t, n in zip(top["token"], top["n"])}
    if END not in known_counts:  # the end is looked up in no join
        known_counts |= {END: int(r.n) for r in counts.where(F.col("token") == F.lit(END)).take(1)}
    for t, u in units.items():
        totals[u], kinds[u] = known_counts.get(t, 0), 1
    for row in rest.mapInArrow(classed, "class int, n long, kinds long").groupBy("class").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds")).collect():  # CLASSES rows
        totals[len(units) + row[0]], kinds[len(units) + row[0]] = row[1], row[2]
    return Vocabulary(units, totals, kinds, known_counts), int(total[0]), int(total[1])


def train_model(train: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> Model:
    """Each task trains on all its texts from the last averages; then parameters are averaged by tokens seen.

    Averages are made by Spark in two steps, so that neither a task nor the driver meets more than about the
    square root of the tasks' models; the driver gets one.
    """
    model = Model(vocabulary)
    spark = train.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, model.vector()))

        def run(batches, shared=shared):
            words, start_vector = shared.value
            local, codes, rng, seen = Model(words), _Codes(words), np.random.default_rng(11), 0
            local.load(start_vector)
            waiting: list[list[bytes]] = []

            def learn(texts):
                context, target = _pairs(codes.unit[codes.flat(texts)], words.start)
                mixed = rng.permutation(len(target))
                for at in range(0, len(mixed), _BATCH):
                    local.step(context[mixed[at : at + _BATCH]], target[mixed[at : at + _BATCH]], rng)
                return len(target)

            size = 0
            for batch in batches:
                for text in columns_of(batch, "t")[0]:
                    waiting.append(words_of(text))
                    size += len(waiting[-1]) + 1
                    if size >= 64 * _BATCH:
                        seen += learn(waiting)
                        waiting, size = [], 0
            seen += learn(waiting)
            if seen:
                vector = local.vector()
                for chunk, at in enumerate(range(0, len(vector), 4096)):
                    yield pa.RecordBatch.from_arrays([pa.array([int(rng.integers(1 << 30))], pa.int64()), pa.array([chunk], pa.int32()), pa.array([float(seen)]), pa.array([(vector[at : at + 4096].astype(np.float64) * seen).tobytes()], pa.binary())], ["salt", "chunk", "weight", "v"])

        part = train.where(F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(rounds)) == turn) if rounds > 1 else train
        local = stored(part.select(F.col(text_col).alias("t")).mapInArrow(run, "salt long, chunk int, weight double, v binary"), "models")

        def added(frame: pd.DataFrame) -> pd.DataFrame:
            v = sum(np.frombuffer(x) for x in frame["v"])
            return pd.DataFrame({"salt": [0], "chunk": [frame["chunk"].iloc[0]], "weight": [frame["weight"].sum()], "v": [v.tobytes()]})

        tasks = local.where("chunk = 0").count()
        if not tasks:
            continue
        salted = local.withColumn("salt", F.pmod("salt", F.lit(max(1, int(tasks**0.5)))))
        sums = salted.groupBy("chunk", "salt").applyInPandas(added, local.schema).groupBy("chunk").applyInPandas(added, local.schema)
        chunks = sorted((r["chunk"], np.frombuffer(bytes(r["v"])) / r["weight"]) for r in sums.collect())  # one model
        model.load(np.concatenate([v for _, v in chunks]).astype(np.float32))
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, known: int = KNOWN) -> DataFrame:
    """``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` for every row.

    Trained on rows whose fold (crc32 of the id as text, modulo ``folds``) is not ``held``; a null id is in no fold and
    is scored as held out. ``base_score`` is the unigram log10 probability with one added; ``score`` that of the model: the
    probability of a token's unit after its ``CONTEXT`` units (normalised over all units), times, within a class of endings, its
    share (count + 1) / (class tokens + class kinds + 1), which leaves one share for all unknown tokens. Null and empty texts
    are scored for their end. Repeated rows are scored each. An empty table gives an empty result; with nothing to train on all
    counts are 0.

    The ``known`` most frequent tokens and the model, both of fixed size, go to every task. Each text's rarer tokens are joined
    with the corpus counts and added up for each text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    fold = remainder(id_col, folds)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.coalesce(fold == held, F.lit(True)).alias("held_out"))
    counts = stored(token_counts(rows.where("NOT held_out"), "t"), "counts")
    vocabulary, n, v = vocabulary_of(counts, known)
    model = train_model(rows.where("NOT held_out"), vocabulary, "i", "t")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, model.vector(), all_norms(spark, vocabulary, model.vector())))
    bottom = log10(n + 1 * (v + 1))

    def run(batches):
        words, vector, norms = shared.value
        local, codes = Model(words), _Codes(words)
        local.load(vector)
        shares = np.where(np.arange(len(words.totals)) >= len(words.units), np.log10(words.totals + words.kinds + 1.0), 0.0)
        for batch in batches:
            texts = columns_of(batch, "t")[0]
            n_tokens, n_known, base, score, rare = [], [], [], [], []
            for low in range(0, len(texts), 512):
                tokens = [words_of(t) for t in texts[low : low + 512]]
                flat = codes.flat(tokens)
                context, target = _pairs(codes.unit[flat], words.start)
                own = flat[flat != codes.start]
                known = own < codes.n_known
                logs, counted = local.log10_probabilities(context, target, norms) - shares[target], codes.log_count[own]
                sizes = [len(t) + 1 for t in tokens]
                starts = np.cumsum([0, *sizes[:-1]])
                n_tokens += sizes
                n_known += np.add.reduceat(known, starts, dtype=np.int64).tolist()
                base += np.add.reduceat(counted, starts).tolist()
                score += np.add.reduceat(logs + np.where(codes.in_class[own], counted, 0.0), starts).tolist()
                flags = known.tolist()
                for at, words_here in zip(starts.tolist(), tokens):
                    unknown = Counter(w for w, k in zip(words_here, flags[at : at + len(words_here)]) if not k) if not all(flags[at : at + len(words_here)]) else {}
                    rare.append([{"token": w, "times": k} for w, k in unknown.items()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), batch.column("held_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(base), pa.array(score), pa.array(rare, pa.list_(pa.struct([("token", pa.binary()), ("times", pa.int32())])))],
                ["i", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
            )

    scored = rows.mapInArrow(run, f"i {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<struct<token: binary, times: int>>")
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    # the tail of the counts: tokens no task has been given
    asked = scored.select("row", F.explode("rare").alias("x")).select("row", F.col("x.token").alias("token"), F.col("x.times").alias("times"))
    found = asked.join(counts, "token").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.expr("times * log10(n + 1)")).alias("more"))
    out = scored.drop("rare").join(found, "row", "left").select("*", F.coalesce("more", F.lit(0.0)).alias("m"))
    return out.select(
        F.col("i").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("m") - F.col("n_tokens") * F.lit(bottom)).alias("base_score"),
        (F.col("score") + F.col("m")).alias("score"),
    )
