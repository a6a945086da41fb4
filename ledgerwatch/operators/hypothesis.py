"""Hypothesis tests on the full table. Spark reduces the data to one row per test."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pearson, percent, ratio, round_half_up
from ..functions.conditions import is_fraud, is_legit, is_outflow
from ..functions.tails import chi2_p_value, t_p_value
from .order_stats import exact_quantiles

ALPHA = 0.05


def contingency(fact: DataFrame) -> DataFrame:
    """Legitimate and fraudulent transactions per type with the fraud rate."""
    counts = fact.groupBy("transaction_type").agg(F.count_if(is_legit()).alias("legitimate"), F.count_if(is_fraud()).alias("fraud"))
    return counts.withColumn("fraud_rate_pct", percent("fraud", F.col("legitimate") + F.col("fraud"), 4)).orderBy("transaction_type")


def chi2_independence(fact: DataFrame, with_p: bool = True) -> DataFrame:
    """Chi-square test of fraud against type; continuity correction at one degree of freedom."""
    counts = fact.groupBy("transaction_type").agg(F.count_if(is_legit()).alias("legitimate"), F.count_if(is_fraud()).alias("fraud"))
    few = Window.partitionBy()  # one row per type
    table = counts.withColumns(
        {
            "all0": F.sum("legitimate").over(few),
            "all1": F.sum("fraud").over(few),
            "kinds": F.count(F.lit(1)).over(few),
        }
    ).withColumn("dof", (F.col("kinds") - 1) * F.when((F.col("all0") > 0) & (F.col("all1") > 0), 1).otherwise(0))
    n = (F.col("all0") + F.col("all1")).cast("double")
    row = (F.col("legitimate") + F.col("fraud")).cast("double")

    def part(observed: str, column: str):
        expected = row * F.col(column) / n
        gap = F.abs(F.col(observed) - expected)
        gap = F.when(F.col("dof") == 1, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
        return F.coalesce(F.try_divide(gap * gap, expected), F.lit(0.0))

    one_row = table.agg(
        F.sum(part("legitimate", "all0") + part("fraud", "all1")).alias("stat"), F.max("dof").alias("dof")
    ).select(F.lit("Chi-Square: Fraud x Type").alias("test"), "stat", "dof")
    return _finish(one_row, chi2_p_value, with_p)


def _finish(one_row: DataFrame, p_value, with_p: bool, dof: str = "dof", stat: str = "stat") -> DataFrame:
    out = one_row.withColumn("statistic", round_half_up("stat", 6))
    if with_p:
        out = out.withColumn("p_value", p_value(F.col(stat).cast("double"), F.col(dof).cast("double")))
    return out.drop("stat")


def welch_t_test(fact: DataFrame, with_p: bool = True) -> DataFrame:
    """Fraudulent against legitimate amounts: Welch's t, Cohen's d and descriptive figures."""
    figures = []
    for name, cond in (("fraud", is_fraud()), ("legit", is_legit())):
        own = F.when(cond, F.col("amount"))
        figures += [
            F.count(own).alias(f"{name}_count"),
            ratio(F.sum(own), F.count(own)).alias(f"{name}_mean"),
            F.var_samp(own).alias(f"{name}_var"),
            F.min(own).alias(f"{name}_min"),
            F.max(own).alias(f"{name}_max"),
        ]
    medians = exact_quantiles(fact.filter(F.col("is_fraud").isin(0, 1)), ["is_fraud"], "amount", {"median": 0.5}).agg(
        F.max(F.when(is_fraud(), F.col("median"))).alias("fraud_median"), F.max(F.when(is_legit(), F.col("median"))).alias("legit_median")
    )
    se1, se0 = ratio("fraud_var", "fraud_count"), ratio("legit_var", "legit_count")
    gap = F.col("fraud_mean") - F.col("legit_mean")
    d = F.try_divide(gap, F.sqrt((F.col("fraud_var") + F.col("legit_var")) / 2))
    both = (
        fact.agg(*figures)
        .crossJoin(F.broadcast(medians))
        .withColumns({"stat": F.try_divide(gap, F.sqrt(se1 + se0)), "d": d})
        .withColumn(
            "freedom",
            F.try_divide((se1 + se0) * (se1 + se0), ratio(se1 * se1, F.col("fraud_count") - 1) + ratio(se0 * se0, F.col("legit_count") - 1)),
        )
    )
    size = F.abs(F.col("d"))
    descriptive = []
    for name in ("fraud", "legit"):
        descriptive += [
            F.col(f"{name}_count"),
            round_half_up(f"{name}_mean", 2).alias(f"{name}_mean"),
            round_half_up(f"{name}_median", 4).alias(f"{name}_median"),
            round_half_up(F.sqrt(f"{name}_var"), 2).alias(f"{name}_std"),
            F.col(f"{name}_min"),
            F.col(f"{name}_max"),
        ]
    one_row = both.select(
        F.lit("Welch t-test: Amount").alias("test"),
        "stat",
        "freedom",
        round_half_up("freedom", 4).alias("dof"),
        round_half_up("d", 6).alias("cohens_d"),
        F.when(size > 0.8, "large").when(size > 0.5, "medium").otherwise("small").alias("effect"),
        *descriptive,
    )
    return _finish(one_row, t_p_value, with_p, dof="freedom").drop("freedom")


def point_biserial(fact: DataFrame, with_p: bool = True) -> DataFrame:
    """Correlation of the fraud flag with the drained share of the balance, outflows only."""
    drain = ratio(F.col("old_balance_orig") - F.col("new_balance_orig"), "old_balance_orig")
    rows = fact.filter(is_outflow() & (F.col("old_balance_orig") > 0)).select(
        F.col("is_fraud").cast("double").alias("is_fraud"), drain.alias("drain")
    )
    figures = [pearson("is_fraud", "drain").alias("r"), F.count(F.lit(1)).alias("n")]
    for name, cond in (("fraud", is_fraud()), ("legit", is_legit())):
        own = F.when(cond, F.col("drain"))
        figures += [
            round_half_up(F.avg(own), 6).alias(f"{name}_mean_drain"),
            round_half_up(F.stddev_samp(own), 6).alias(f"{name}_std_drain"),
            percent(F.count_if(cond & (F.col("drain") > 0.8)), F.count(own), 4).alias(f"{name}_over_80_pct"),
        ]
    r = F.col("r")
    one_row = rows.agg(*figures).withColumns(
        {"stat": r, "t": r * F.sqrt(F.try_divide(F.col("n") - 2, 1 - r * r)), "dof": F.col("n") - 2}
    )
    out = one_row.select(
        F.lit("Point-Biserial: Drain").alias("test"),
        "stat",
        "t",
        "dof",
        "n",
        *[f"{name}_{part}" for name in ("fraud", "legit") for part in ("mean_drain", "std_drain", "over_80_pct")],
    )
    return _finish(out, t_p_value, with_p, stat="t").drop("t")


def fraud_hours(fact: DataFrame) -> DataFrame:
    """Frauds per hour against an even spread over the hours that have any; ``unusual`` outside 0.8..1.2."""
    hours = fact.filter(is_fraud()).groupBy("transaction_hour").agg(F.count(F.lit(1)).alias("observed"))
    few = Window.partitionBy()  # at most 24 rows
    expected = ratio(F.sum("observed").over(few), F.count(F.lit(1)).over(few))
    share = ratio("observed", "expected")
    return (
        hours.withColumn("expected", expected)
        .withColumns({"ratio": round_half_up(share, 4), "unusual": ((share > 1.2) | (share < 0.8)).cast("int")})
        .orderBy("transaction_hour")
    )


def chi2_goodness(fact: DataFrame, with_p: bool = True) -> DataFrame:
    """Chi-square test of frauds per hour against an even spread."""
    gap = F.col("observed") - F.col("expected")
    one_row = (
        fraud_hours(fact)
        .agg(
            F.sum(F.try_divide(gap * gap, F.col("expected"))).alias("stat"),
            (F.count(F.lit(1)) - 1).alias("dof"),
            F.sum("observed").alias("total_fraud"),
        )
        .select(F.lit("Chi-Square: Fraud by Hour").alias("test"), "stat", "dof", "total_fraud")
    )
    return _finish(one_row, chi2_p_value, with_p)


def test_summary(fact: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """All four tests with p-value, verdict and the number of rejected hypotheses."""
    tests = [chi2_independence(fact), welch_t_test(fact), point_biserial(fact), chi2_goodness(fact)]
    parts = [t.select(F.lit(i).alias("number"), "test", "statistic", "p_value") for i, t in enumerate(tests, 1)]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    rejected = F.col("p_value") < alpha
    return (
        together.withColumn("verdict", F.when(rejected, "REJECT H0").otherwise("FAIL TO REJECT"))
        .withColumn("rejected_total", F.sum(rejected.cast("int")).over(Window.partitionBy()))
        .withColumn("p_value", round_half_up("p_value", 6))
        .orderBy("number")
    )
