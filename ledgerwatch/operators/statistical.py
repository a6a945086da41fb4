"""Statistical detectors (z-score, interquartile range, rolling window), their ensemble and metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import round_half_up
from .history import with_prior_stats
from .order_stats import exact_quantiles
from .skew import join_lines


def _amount() -> Column:
    return F.col("amount").cast("double")


def customer_stats(fact: DataFrame, keys: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Mean and sample deviation of the amount per customer, pre-aggregated before the shuffle."""
    return fact.groupBy(*keys).agg(
        F.avg("amount").cast("double").alias("cust_mean"),
        F.stddev_samp("amount").alias("cust_std"),
        F.min("amount").cast("double").alias("cust_min"),
        F.max("amount").cast("double").alias("cust_max"),
    )


def _z_score() -> Column:
    std = F.col("cust_std")
    return F.when(std > 0, F.try_divide(_amount() - F.col("cust_mean"), std)).otherwise(0.0)


_STATS = ("cust_mean", "cust_std", "cust_min", "cust_max")


def zscore_detection(fact: DataFrame, threshold: float = 3.0, history: DataFrame | None = None) -> DataFrame:
    """Every row with its z-score inside its customer's amounts, flagged where |z| > threshold.

    ``history`` takes the statistics from another table than the scored rows. Rows without a customer are
    scored as one customer, as they are in :func:`detector_flags`.
    """
    stats = customer_stats(fact if history is None else history)
    return (
        join_lines(fact, stats, ["customer_id"], nulls_meet=True)
        .withColumn("z_score", _z_score())
        .withColumn("is_anomaly_zscore", (F.abs("z_score") > threshold).cast("int"))
        .drop(*_STATS)
    )


def zscore_anomalies(fact: DataFrame, threshold: float = 3.0, keys: Sequence[str] = ("customer_id",)) -> DataFrame:
    """Only the flagged rows of :func:`zscore_detection`.

    A customer's extreme amounts show whether any of its rows can be flagged, so rows of all other
    customers are dropped by the join before anything is scored. ``keys`` may add a batch column to
    the customer, for statistics within each batch.
    """
    lowest, highest = F.col("cust_mean") - F.col("cust_min"), F.col("cust_max") - F.col("cust_mean")
    reachable = customer_stats(fact, keys).filter(F.greatest(lowest, highest) >= F.col("cust_std") * (threshold * 0.999999))
    return (
        join_lines(fact, reachable, keys, "inner", nulls_meet=True)
        .withColumn("z_score", _z_score())
        .filter(F.abs("z_score") > threshold)
        .withColumn("is_anomaly_zscore", F.lit(1))
        .drop(*_STATS)
    )


def iqr_limits(fact: DataFrame, multiplier: float = 1.5) -> DataFrame:
    """Quartiles and outlier limits of the amount per type."""
    quartiles = exact_quantiles(fact, ["transaction_type"], "amount", {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return quartiles.select(
        "transaction_type",
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - F.lit(multiplier) * iqr).alias("lower"),
        (F.col("q3") + F.lit(multiplier) * iqr).alias("upper"),
    )


def _outside() -> Column:
    outside = (_amount() < F.col("lower")) | (_amount() > F.col("upper"))
    return F.coalesce(outside, F.lit(False)).cast("int")


def iqr_detection(fact: DataFrame, multiplier: float = 1.5) -> DataFrame:
    """Every row, flagged where its amount is outside its type's limits."""
    limits = iqr_limits(fact, multiplier).select("transaction_type", "lower", "upper")
    return join_lines(fact, limits, ["transaction_type"]).withColumn("is_anomaly_iqr", _outside()).drop("lower", "upper")


def iqr_bounds(fact: DataFrame, multiplier: float = 1.5) -> DataFrame:
    """Per type: quartiles, limits (the lower one shown as at least 0), outliers and frauds among them."""
    limits = iqr_limits(fact, multiplier)
    placed = join_lines(fact.select("transaction_type", "amount", "is_fraud"), limits, ["transaction_type"]).withColumn("hit", _outside())
    digits = 6
    return (
        placed.groupBy("transaction_type", "q1", "q3", "iqr", "lower", "upper")
        .agg(F.sum("hit").alias("outliers"), F.sum(F.col("hit") * F.col("is_fraud")).alias("fraud_in_outliers"))
        .select(
            "transaction_type",
            round_half_up("q1", digits).alias("q1"),
            round_half_up("q3", digits).alias("q3"),
            round_half_up("iqr", digits).alias("iqr"),
            round_half_up(F.greatest("lower", F.lit(0.0)), digits).alias("lower"),
            round_half_up("upper", digits).alias("upper"),
            "outliers",
            "fraud_in_outliers",
        )
        .orderBy("transaction_type")
    )


def rolling_flags(threshold: float, min_rows: int = 3) -> dict[str, Column]:
    """The rolling detector's two columns from the statistics of the rows before."""
    enough = (F.col("prior_n") >= min_rows) & (F.col("prior_std_samp") > 0)
    above = _amount() > F.col("prior_avg") + F.lit(float(threshold)) * F.col("prior_std_samp")
    return {
        "has_history": F.coalesce(enough, F.lit(False)).cast("int"),
        "is_anomaly_rolling": F.coalesce(enough & above, F.lit(False)).cast("int"),
    }


def rolling_detection(fact: DataFrame, window: int = 10, threshold: float = 2.0, **parts) -> DataFrame:
    """Every row, flagged where its amount exceeds mean + threshold deviations of the previous rows.

    ``has_history`` tells the rows that could be judged: three previous rows with some spread.
    """
    return (
        with_prior_stats(fact, window, **parts)
        .withColumns(rolling_flags(threshold))
        .withColumnsRenamed({"prior_avg": "rolling_mean", "prior_std_samp": "rolling_std"})
        .drop("prior_n", "prior_std_pop")
    )


def detector_flags(
    fact: DataFrame,
    z_threshold: float = 3.0,
    multiplier: float = 1.5,
    window: int = 10,
    threshold: float = 2.0,
    **parts,
) -> DataFrame:
    """All three detectors on every row, from one partitioning of fact by customer.

    The customer totals for the z-score come from the same parts as the rolling statistics, so fact is
    partitioned once and never joined with itself.
    """
    limits = iqr_limits(fact, multiplier).select("transaction_type", "lower", "upper")
    needed = fact.select("transaction_id", "customer_id", "step", "transaction_type", "amount", "is_fraud", "transaction_day", "old_balance_orig", "new_balance_orig")
    history = with_prior_stats(needed, window, with_totals=True, **parts).withColumn("z_score", _z_score())
    return (
        join_lines(history, limits, ["transaction_type"])
        .withColumn("is_anomaly_iqr", _outside())
        .drop("lower", "upper")
        .withColumn("is_anomaly_zscore", (F.abs("z_score") > z_threshold).cast("int"))
        .withColumns(rolling_flags(threshold))
        .drop("prior_n", "prior_avg", "prior_std_pop", "prior_std_samp", "cust_mean", "cust_std")
    )


def ensemble_detection(fact: DataFrame, **options) -> DataFrame:
    """Number of methods that flag a row; two or more make it a high-confidence anomaly."""
    methods = F.col("is_anomaly_zscore") + F.col("is_anomaly_iqr") + F.col("is_anomaly_rolling")
    return (
        detector_flags(fact, **options)
        .withColumn("methods_flagged", methods)
        .withColumn("is_anomaly_ensemble", (methods >= 2).cast("int"))
        .select(
            "transaction_id",
            "is_fraud",
            "is_anomaly_zscore",
            "is_anomaly_iqr",
            "is_anomaly_rolling",
            "has_history",
            "methods_flagged",
            "is_anomaly_ensemble",
        )
    )


def ensemble_distribution(ensemble: DataFrame) -> DataFrame:
    """Rows and frauds for 0, 1, 2 and 3 methods; a number nobody reached counts 0."""
    counts = ensemble.groupBy("methods_flagged").agg(F.count(F.lit(1)).alias("txn_count"), F.sum("is_fraud").alias("fraud_count"))
    return (
        ensemble.sparkSession.range(4)
        .select(F.col("id").cast("int").alias("methods_flagged"))
        .join(counts, "methods_flagged", "left")
        .na.fill(0)
        .orderBy("methods_flagged")
    )


def detector_metrics(ensemble: DataFrame) -> DataFrame:
    """Classification report of every method against the fraud label, in long form.

    Rows are reduced to the few distinct combinations of label and flags first; undefined ratios
    are 0. The rolling method is judged on rows with enough history only.
    """
    flags = {"Z_SCORE": "is_anomaly_zscore", "IQR": "is_anomaly_iqr", "ROLLING": "is_anomaly_rolling", "ENSEMBLE": "is_anomaly_ensemble"}
    combos = ensemble.groupBy("is_fraud", "has_history", *flags.values()).agg(F.count(F.lit(1)).alias("n"))
    judged = F.array(
        *[
            F.struct(F.lit(m).alias("method"), F.col(c).alias("pred"), (F.col("has_history") if m == "ROLLING" else F.lit(1)).alias("use"))
            for m, c in flags.items()
        ]
    )

    def cell(label: int, pred: int) -> Column:
        return F.sum(F.when((F.col("is_fraud") == label) & (F.col("pred") == pred), F.col("n")).otherwise(0))

    table = (
        combos.select("is_fraud", "n", F.inline(judged))
        .filter(F.col("use") == 1)
        .groupBy("method")
        .agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))
    )
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))

    def over(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def scores(hit: Column, false_hit: Column, miss: Column):
        return over(hit, hit + false_hit), over(hit, hit + miss), over(2 * hit, 2 * hit + false_hit + miss), hit + miss

    legit, fraud = scores(tn, fn, fp), scores(tp, fp, fn)
    n = tn + fp + fn + tp
    macro = [(a + b) / 2 for a, b in zip(legit[:3], fraud[:3])]
    weighted = [over(a * legit[3] + b * fraud[3], n) for a, b in zip(legit[:3], fraud[:3])]
    accuracy = over(tn + tp, n)
    lines = {
        "Legitimate": legit,
        "Fraud": fraud,
        "accuracy": (F.lit(None).cast("double"), F.lit(None).cast("double"), accuracy, n),
        "macro avg": (*macro, n),
        "weighted avg": (*weighted, n),
    }
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                round_half_up(p, 6).alias("precision"),
                round_half_up(r, 6).alias("recall"),
                round_half_up(f1, 6).alias("f1_score"),
                support.cast("long").alias("support"),
            )
            for name, (p, r, f1, support) in lines.items()
        ]
    )
    return table.select("method", F.inline(entries)).orderBy("method", "class")
