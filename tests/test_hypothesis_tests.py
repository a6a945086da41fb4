import math

import pytest

from ledgerwatch.functions.tails import chi2_tail, t_two_sided
from ledgerwatch.operators import hypothesis as hy


@pytest.mark.parametrize("x,dof,p", [(9.488, 4, 0.05), (3.841, 1, 0.05), (35.172, 23, 0.05), (13.277, 4, 0.01), (0, 5, 1), (2.0, 2, math.exp(-1)), (5, 0, 1)])
def test_chi2_table(x, dof, p):
    assert chi2_tail(x, dof) == pytest.approx(p, abs=2e-5)


@pytest.mark.parametrize("t,dof,p", [(2.228, 10, 0.05), (-2.228, 10, 0.05), (12.706, 1, 0.05), (1.96, 1e5, 0.05), (1.96, 1e9, 0.05), (0, 7, 1), (2.576, 1e7, 0.01)])
def test_t_table(t, dof, p):
    assert t_two_sided(t, dof) == pytest.approx(p, abs=3e-5)


def rows(kind, fraud, n):
    return [{"transaction_type": kind, "is_fraud": fraud}] * n


def test_two_by_two_is_continuity_corrected(make_fact):
    fact = make_fact(rows("TRANSFER", 1, 10) + rows("TRANSFER", 0, 20) + rows("DEBIT", 1, 5) + rows("DEBIT", 0, 25))
    row = hy.chi2_independence(fact).first()
    # by hand: expected frauds 7.5 and 7.5; (2.5 - 0.5)^2 * (2 / 7.5 + 2 / 22.5)
    assert row.dof == 1 and row.statistic == pytest.approx(4 * (2 / 7.5 + 2 / 22.5), abs=1e-6)
    assert row.p_value == pytest.approx(chi2_tail(4 * (2 / 7.5 + 2 / 22.5), 1))


def test_one_class_only(make_fact):
    row = hy.chi2_independence(make_fact(rows("TRANSFER", 0, 3) + rows("DEBIT", 0, 4))).first()
    assert (row.statistic, row.dof, row.p_value) == (0.0, 0, 1.0)


def test_welch_by_hand(make_fact):
    fraud, legit = [10, 12, 20, 40], [1, 2, 4, 5, 8]
    row = hy.welch_t_test(make_fact([{"amount": a, "is_fraud": 1} for a in fraud] + [{"amount": a} for a in legit])).first()

    def stats(v):
        m = sum(v) / len(v)
        return m, sum((x - m) ** 2 for x in v) / (len(v) - 1), len(v)

    (m1, v1, n1), (m0, v0, n0) = stats(fraud), stats(legit)
    a, b = v1 / n1, v0 / n0
    t, dof = (m1 - m0) / math.sqrt(a + b), (a + b) ** 2 / (a * a / (n1 - 1) + b * b / (n0 - 1))
    assert (row.statistic, row.dof) == (pytest.approx(t, abs=1e-6), pytest.approx(dof, abs=1e-4))
    assert row.cohens_d == pytest.approx((m1 - m0) / math.sqrt((v1 + v0) / 2), abs=1e-6)
    assert (row.effect, row.fraud_median, row.legit_median) == ("large", 16.0, 4.0)
    assert row.p_value == pytest.approx(t_two_sided(t, dof), abs=1e-9)


def test_goodness_uses_hours_with_fraud_only(make_fact):
    fact = make_fact([{"step": h, "is_fraud": 1} for h in [3] * 6 + [9] * 2 + [20] * 4] + [{"step": 7}])
    row = hy.chi2_goodness(fact).first()
    assert (row.statistic, row.dof, row.total_fraud) == (pytest.approx(2.0), 2, 12)
    assert row.p_value == pytest.approx(math.exp(-1))
    assert [(r.transaction_hour, r.unusual) for r in hy.fraud_hours(fact).collect()] == [(3, 1), (9, 1), (20, 0)]


def test_drain_that_never_varies(make_fact):
    fact = make_fact([{"transaction_type": "TRANSFER", "old_balance_orig": 10, "is_fraud": i % 2} for i in range(6)])
    row = hy.point_biserial(fact).first()
    assert (row.statistic, row.p_value, row.n, row.fraud_over_80_pct) == (None, None, 6, 100.0)


def test_summary_counts_rejections(small_fact):
    table = hy.test_summary(small_fact).collect()
    assert [r.number for r in table] == [1, 2, 3, 4]
    assert {r.rejected_total for r in table} == {sum(r.verdict == "REJECT H0" for r in table)}
