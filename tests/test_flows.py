"""Traced flow against a queue per account."""

import random
from collections import defaultdict, deque

import pytest

from ledgerwatch.operators.flows import flow_trace


def queue(rows):
    """(transfer, cash-out) -> amount, by paying each cash-out from the oldest money left."""
    waiting, out = defaultdict(deque), defaultdict(int)
    for i, r in sorted(enumerate(rows, 1), key=lambda x: (x[1]["step"], x[0])):
        if r["transaction_type"] == "TRANSFER":
            waiting[r["recipient_id"]].append([i, r["amount"]])
        elif r["transaction_type"] == "CASH_OUT":
            left, own = r["amount"], waiting[r["customer_id"]]
            while left and own:
                part = min(left, own[0][1])
                out[own[0][0], i] += part
                left -= part
                own[0][1] -= part
                if not own[0][1]:
                    own.popleft()
    return dict(out)


def log(seed, n):
    """One account with a third of all moves; small amounts, so that intervals often end together."""
    rng = random.Random(seed)
    return [
        {"transaction_type": rng.choice(["TRANSFER", "CASH_OUT", "PAYMENT"]), "customer_id": rng.choice("HHABCD"), "recipient_id": rng.choice("HHABCE"), "step": i // 5, "amount": rng.choice([1, 2, 5, 7, 50])}
        for i in range(n)
    ]


def traced(frame):
    return {(r.transfer_id, r.cash_out_id): r.amount for r in frame.collect()}


@pytest.mark.parametrize("parts", [1, 2, 7, 200])
def test_flow_is_that_of_a_queue(make_fact, parts):
    rows = log(parts, 500)
    got = traced(flow_trace(make_fact(rows), parts))
    assert got == queue(rows) and len(got) > 100


def test_sums_stay_within_both_sides(small_fact):
    found = flow_trace(small_fact)
    amounts = {r.transaction_id: r.amount for r in small_fact.collect()}
    for side in ("transfer_id", "cash_out_id"):
        sums = found.groupBy(side).sum("amount").collect()
        assert sums and all(0 < s[1] <= amounts[s[0]] for s in sums)
    assert found.filter("cash_out_step < transfer_step").count() == 0


def test_own_money_is_not_owed_to_later_transfers(make_fact):
    def move(kind, amount, step):
        return {"transaction_type": kind, "customer_id": "A" if kind == "CASH_OUT" else "Z", "recipient_id": "A" if kind == "TRANSFER" else "Z", "amount": amount, "step": step}

    rows = [move("CASH_OUT", 100, 0), move("TRANSFER", 30, 1), move("CASH_OUT", 50, 2), move("TRANSFER", 10, 3), move("CASH_OUT", 4, 3), move("CASH_OUT", 9, 4)]
    assert traced(flow_trace(make_fact(rows))) == {(2, 3): 30, (4, 5): 4, (4, 6): 6}


def test_nothing_to_trace(make_fact):
    rows = [{"transaction_type": "TRANSFER", "recipient_id": "A"}, {"transaction_type": "CASH_OUT", "customer_id": None}, {"transaction_type": "CASH_OUT", "customer_id": "A", "amount": None}]
    assert flow_trace(make_fact(rows)).count() == 0
