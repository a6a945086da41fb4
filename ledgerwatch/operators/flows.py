"""Traced flow: which transfer paid which cash-out, first in, first out, per account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .history import in_parts, parts_of, split_keys

_MONEY = "decimal(27,2)"


def _here(order: list[str]):
    return Window.partitionBy("_part", "account").orderBy(*order)


def _before(order: list[str]):
    return _here(order).rowsBetween(Window.unboundedPreceding, -1)


def _up_to(order: list[str]):
    return _here(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _per_split_account(placed: DataFrame, rows: DataFrame, **figures: Column) -> DataFrame:
    """One line per part for the accounts that lie in several parts: fewer than two for each part.

    ``rows`` has the rows of ``placed`` with figures computed inside a part.
    """
    split = split_keys(placed, "account")
    return rows.join(F.broadcast(split), "account", "left_semi").groupBy("account", "_part").agg(*[c.alias(n) for n, c in figures.items()])


def _running(moves: DataFrame, parts: int) -> DataFrame:
    """Moves with ``came`` and ``went``, all money in and out up to the row, and ``low``, ``low_before``.

    ``low`` is the least came - went at any cash-out so far, ``low_before`` without the row's own.
    """
    order = ["step", "transaction_id"]
    placed = in_parts(moves, ["account", *order], parts, "moves")
    local = placed.withColumns({"came": F.sum("money_in").over(_up_to(order)), "went": F.sum("money_out").over(_up_to(order))})
    level = F.when(F.col("money_out") > 0, F.col("came") - F.col("went"))
    local = local.withColumn("level", level).withColumns({"low": F.min("level").over(_up_to(order)), "low_before": F.min("level").over(_before(order))})
    lines = _per_split_account(placed, local, a=F.sum("money_in"), c=F.sum("money_out"), m=F.min("level"))
    earlier = Window.partitionBy("account").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(_MONEY)
    lines = lines.withColumns({"a0": F.coalesce(F.sum("a").over(earlier), zero), "c0": F.coalesce(F.sum("c").over(earlier), zero)})
    lines = lines.withColumn("m0", F.min(F.col("a0") - F.col("c0") + F.col("m")).over(earlier)).select("account", "_part", "a0", "c0", "m0")
    joined = local.join(F.broadcast(lines), ["account", "_part"], "left").withColumns({"a0": F.coalesce("a0", zero), "c0": F.coalesce("c0", zero)})
    shift = F.col("a0") - F.col("c0")
    return joined.select(
        "account",
        *order,
        "money_in",
        "money_out",
        (F.col("came") + F.col("a0")).alias("came"),
        (F.col("went") + F.col("c0")).alias("went"),
        F.least("m0", F.col("low") + shift).alias("low"),
        F.least("m0", F.col("low_before") + shift).alias("low_before"),
    )


def flow_trace(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """One row for every transfer and cash-out of the receiving account that the transfer paid for, with the amount.

    An account's money is spent in the order it came in, (step, transaction_id). A cash-out takes what transfers
    have brought and earlier cash-outs have left; anything beyond is the account's own money and not
    traced, and it is not owed to later transfers. Rows without account, step or a positive amount take no part.

    What was taken up to a cash-out is its running sum plus the least lead of the money that came in so far
    over the money that went out, where that is negative. Transfers and payments are then intervals on one
    line per account, the money that came in. Their starting points cut it into pieces that belong to one of
    each, so no pairs are compared and an account brings at most one row for each of its moves. Both steps
    work on range-partitioned rows: a busy account is cut, and one line per part carries its sums on.
    """
    money = F.col("amount").cast(_MONEY)
    none = F.lit(0).cast(_MONEY)
    usable = fact.filter((F.col("amount") > 0) & F.col("step").isNotNull())
    outs = usable.filter((F.col("transaction_type") == "CASH_OUT") & F.col("customer_id").isNotNull())
    ins = usable.filter(F.col("transaction_type") == "TRANSFER").join(outs.select(F.col("customer_id").alias("recipient_id")).distinct(), "recipient_id", "left_semi")
    moves = ins.select(F.col("recipient_id").alias("account"), "step", "transaction_id", money.alias("money_in"), none.alias("money_out")).unionByName(
        outs.select(F.col("customer_id").alias("account"), "step", "transaction_id", none.alias("money_in"), money.alias("money_out"))
    )
    n = parts_of(fact, parts)
    running = _running(moves, n)
    taken = F.col("went") + F.least(F.lit(0).cast(_MONEY), "low")
    taken_before = F.col("went") - F.col("money_out") + F.least(F.lit(0).cast(_MONEY), F.coalesce("low_before", F.lit(0).cast(_MONEY)))
    is_in = F.col("money_in") > 0
    own = F.struct(F.col("transaction_id").alias("id"), "step")
    paid = F.struct(F.col("transaction_id").alias("id"), "step", taken.cast(_MONEY).alias("end"))
    points = running.select(
        "account",
        F.when(is_in, F.col("came") - F.col("money_in")).otherwise(taken_before).cast(_MONEY).alias("at"),
        "transaction_id",
        F.when(is_in, own).alias("transfer"),
        F.when(~is_in, paid).alias("payment"),
    ).filter(F.col("transfer").isNotNull() | (F.col("payment.end") > F.col("at")))

    order = ["at", "transaction_id"]
    placed = in_parts(points, ["account", *order], n, "flow-points")
    newest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order)))
    lines = _per_split_account(placed, placed, t=newest("transfer"), p=newest("payment"), first=F.min("at"))
    by_part = Window.partitionBy("account").orderBy("_part")
    so_far = by_part.rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.select("account", "_part", F.last("t", True).over(so_far).alias("t0"), F.last("p", True).over(so_far).alias("p0"), F.lead("first").over(by_part).alias("next0"))
    # the last part of an account that goes on has the next part's first point behind its own last one
    found = placed.withColumns(
        {
            "t": F.last("transfer", True).over(_up_to(order)),
            "p": F.last("payment", True).over(_up_to(order)),
            "next": F.lead("at").over(_here(order)),
        }
    ).join(F.broadcast(lines), ["account", "_part"], "left")
    transfer, payment, next_at = F.coalesce("t", "t0"), F.coalesce("p", "p0"), F.coalesce("next", "next0")
    pieces = found.select(
        F.col("account").alias("customer_id"),
        transfer["id"].alias("transfer_id"),
        payment["id"].alias("cash_out_id"),
        transfer["step"].alias("transfer_step"),
        payment["step"].alias("cash_out_step"),
        (F.least(payment["end"], next_at) - F.col("at")).cast(_MONEY).alias("amount"),
    )
    return pieces.filter((F.col("amount") > 0) & F.col("transfer_id").isNotNull())
