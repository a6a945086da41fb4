"""DuckDB statements that give the expected result of every registered query.

They are written on their own, from the definition of each result, over the same event table.
Doubles are rounded with floor on both sides, because the two engines' ``round`` and the last bit
of a floating-point mean differ now and then.
"""

from __future__ import annotations


def rnd(x: str, d: int = 2) -> str:
    return f"(sign(CAST({x} AS DOUBLE)) * (floor(abs(CAST({x} AS DOUBLE)) * 1e{d} + 0.5) / 1e{d}))"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, d: int) -> str:
    return rnd(div(f"(CAST({a} AS DOUBLE) * 100.0)", b), d)


def mean(x: str, d: int = 2, where: str = "") -> str:
    f = f" FILTER (WHERE {where})" if where else ""
    return rnd(div(f"sum({x}){f}", f"count({x}){f}"), d)


def num(*pairs: str) -> str:
    """'expr name' pairs as DOUBLE columns."""
    return ", ".join(f"CAST({p.rsplit(' ', 1)[0]} AS DOUBLE) AS {p.rsplit(' ', 1)[1]}" for p in pairs)


def cnt(*pairs: str) -> str:
    """'expr name' pairs as BIGINT columns."""
    return ", ".join(f"CAST({p.rsplit(' ', 1)[0]} AS BIGINT) AS {p.rsplit(' ', 1)[1]}" for p in pairs)


OUT = "transaction_type IN ('TRANSFER', 'CASH_OUT')"
LEVEL = "list_position(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW'], {})"

EVENT_FACT = """
src AS (
  SELECT event_id, user_id, event_id + 1 AS transaction_id,
         CAST(round(value * 100) AS BIGINT) AS c,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         date_diff('hour', TIMESTAMP '2024-01-01', ts) AS step,
         CASE event_type WHEN 'view' THEN 'PAYMENT' WHEN 'click' THEN 'CASH_OUT' WHEN 'purchase' THEN 'TRANSFER'
                         WHEN 'signup' THEN 'CASH_IN' ELSE 'DEBIT' END AS transaction_type
  FROM events),
amounts AS (
  SELECT *, CASE WHEN event_id % 17 = 0
                 THEN (1 + c % 30) * CASE c % 3 WHEN 0 THEN 10000000 WHEN 1 THEN 1000000 ELSE 100000 END
                 ELSE greatest((c * c) // 2, 1) END AS a
  FROM src),
balances AS (
  SELECT *, CASE WHEN k % 10 <= 1 THEN 0 WHEN k % 10 <= 4 THEN a WHEN k % 10 = 5 THEN a + a // 9 ELSE 4 * a END AS ob,
         CASE WHEN transaction_type IN ('TRANSFER', 'CASH_OUT') AND k % 10 = 3 AND event_id % 3 = 0 THEN 1 ELSE 0 END AS is_fraud
  FROM amounts),
cents AS (
  SELECT *, CASE WHEN event_id % 23 = 0 THEN ob WHEN transaction_type = 'CASH_IN' THEN ob + a ELSE greatest(ob - a, 0) END AS nb
  FROM balances),
fact AS (
  SELECT transaction_id, step, transaction_type,
         CAST(CAST(a AS DECIMAL(17,2)) / 100 AS DECIMAL(15,2)) AS amount,
         CASE WHEN event_id % 2 = 0 THEN 'C' || user_id ELSE 'C' || user_id || '_' || (event_id % 37) END AS customer_id,
         CAST(CAST(ob AS DECIMAL(17,2)) / 100 AS DECIMAL(15,2)) AS old_balance_orig,
         CAST(CAST(nb AS DECIMAL(17,2)) / 100 AS DECIMAL(15,2)) AS new_balance_orig,
         CASE WHEN transaction_type = 'PAYMENT' THEN 'M' || k
              WHEN transaction_type = 'TRANSFER' AND k % 2 = 0 THEN 'C' || ((user_id * 7 + k) % 15)
              ELSE 'R' || ((event_id * 31 + user_id) % 500) END AS recipient_id,
         CAST(0 AS DECIMAL(15,2)) AS old_balance_dest,
         CASE WHEN transaction_type IN ('TRANSFER', 'CASH_OUT')
              THEN CAST(CAST(a AS DECIMAL(17,2)) / 100 AS DECIMAL(15,2)) ELSE CAST(0 AS DECIMAL(15,2)) END AS new_balance_dest,
         is_fraud,
         CASE WHEN (is_fraud = 1 AND a > 20000000) OR event_id % 499 = 0 THEN 1 ELSE 0 END AS is_flagged_fraud,
         step % 24 AS transaction_hour, step // 24 AS transaction_day,
         CAST(CAST(nb - ob AS DECIMAL(17,2)) / 100 AS DECIMAL(15,2)) AS balance_change,
         CASE WHEN ob > 0 THEN round_even((CAST(a AS DOUBLE) / 100) / (CAST(ob AS DOUBLE) / 100), 4) END AS amount_to_balance_ratio
  FROM cents)
"""

_TIER = """CASE WHEN fraud_count > 0 THEN 'CRITICAL'
            WHEN top / nullif(mid, 0) > 10 AND total_amount > 1000000 THEN 'HIGH'
            WHEN top / nullif(mid, 0) > 5 OR total_amount > 500000 THEN 'MEDIUM' ELSE 'LOW' END"""

CUSTOMERS = f"""
profile AS (
  SELECT customer_id, count(*) AS total_transactions, sum(amount) AS total_amount, {mean('amount')} AS mid,
         CAST(max(amount) AS DOUBLE) AS top, sum(is_fraud) AS fraud_count, min(step) AS first_seen_step, max(step) AS last_seen_step
  FROM fact GROUP BY customer_id),
dim AS (
  SELECT *, top / nullif(mid, 0) AS peak,
         least(100, CASE WHEN fraud_count > 0 THEN 40 ELSE 0 END
           + CASE WHEN peak > 10 THEN 25 WHEN peak > 5 THEN 15 ELSE 5 END
           + CASE WHEN total_amount > 1000000 THEN 20 WHEN total_amount > 500000 THEN 10 ELSE 5 END
           + CASE WHEN total_transactions >= 20 THEN 15 ELSE 5 END) AS load_score,
         least(100, CASE WHEN fraud_count > 0 THEN 40 ELSE 0 END
           + CASE WHEN peak > 50 THEN 25 WHEN peak > 10 THEN 15 WHEN peak > 5 THEN 10 ELSE 3 END
           + CASE WHEN total_amount > 5000000 THEN 15 WHEN total_amount > 1000000 THEN 12 WHEN total_amount > 500000 THEN 8 ELSE 3 END
           + CASE WHEN total_transactions >= 20 THEN 15 ELSE 5 END) AS refresh_score,
         {_TIER} AS risk_tier
  FROM profile)
"""

FLAGS = """
limits AS (
  SELECT transaction_type, quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3,
         q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM fact GROUP BY transaction_type),
judged AS (
  SELECT f.*, CASE WHEN stddev_samp(amount) OVER c > 0
                   THEN (CAST(amount AS DOUBLE) - avg(amount) OVER c) / stddev_samp(amount) OVER c ELSE 0 END AS z,
         CASE WHEN amount < lower OR amount > upper THEN 1 ELSE 0 END AS iqr_hit,
         avg(amount) OVER w AS rolling_mean, stddev_samp(amount) OVER w AS rolling_std, count(*) OVER w AS prior_n
  FROM fact f JOIN limits USING (transaction_type)
  WINDOW c AS (PARTITION BY customer_id),
         w AS (PARTITION BY customer_id ORDER BY step, transaction_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
flags AS (
  SELECT *, CASE WHEN abs(z) > 3 THEN 1 ELSE 0 END AS z_hit,
         CASE WHEN prior_n >= 3 AND rolling_std > 0 THEN 1 ELSE 0 END AS known,
         CASE WHEN prior_n >= 3 AND rolling_std > 0 AND amount > rolling_mean + 2 * rolling_std THEN 1 ELSE 0 END AS roll_hit,
         z_hit + iqr_hit + roll_hit AS hits
  FROM judged)
"""


def _money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,2)) AS VARCHAR)"


STAT_ALERTS = f"""
stat_alerts AS (
  SELECT transaction_id, customer_id, 'Z_SCORE' AS alert_type, 3 AS code, CASE WHEN abs(z) > 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
         'Z-score=' || {_money(rnd('z'))} || ', Amount=' || {_money('amount')} AS alert_description, 'PYTHON_ZSCORE' AS detection_method
  FROM flags WHERE z_hit = 1
  UNION ALL
  SELECT transaction_id, customer_id, 'IQR_OUTLIER', 1, 'HIGH',
         'IQR outlier: Amount=' || {_money('amount')} || ', Type=' || transaction_type, 'PYTHON_IQR'
  FROM flags WHERE iqr_hit = 1
  UNION ALL
  SELECT transaction_id, customer_id, 'ROLLING_DEVIATION', 2, 'MEDIUM',
         'Amount=' || {_money('amount')} || ' exceeded rolling avg', 'PYTHON_ROLLING'
  FROM flags WHERE roll_hit = 1)
"""

HIGH_ALERTS = f"""
high_alerts AS (
  SELECT transaction_id, customer_id, 'HIGH_AMOUNT' AS alert_type, 0 AS code,
         CASE WHEN amount > mid + 5 * greatest(top - mid, 1) THEN 'CRITICAL'
              WHEN amount > mid + 3 * greatest(top - mid, 1) THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
         'Transaction amount ' || {_money('amount')} || ' exceeds customer avg ' || {_money('mid')} || ' by '
           || CAST(CAST({rnd('(CAST(amount AS DOUBLE) - mid) / mid * 100', 1)} AS DECIMAL(38,1)) AS VARCHAR) || '%' AS alert_description,
         'SQL_HIGH_AMOUNT' AS detection_method
  FROM fact JOIN dim USING (customer_id)
  WHERE total_transactions >= 3 AND CAST(amount AS DOUBLE) > mid * 5)
"""

ALERTS = """
alerts AS (
  SELECT u.*, u.transaction_id * 16 + code AS alert_id,
         TIMESTAMP '2024-02-01' + to_seconds(u.transaction_id * 16 + code) AS alert_timestamp,
         CASE WHEN u.transaction_id % 5 = 0 THEN 1 ELSE 0 END AS reviewed,
         CASE WHEN u.transaction_id % 5 = 0 THEN 1 - is_fraud END AS false_positive
  FROM (SELECT * FROM stat_alerts UNION ALL SELECT * FROM high_alerts) u JOIN fact USING (transaction_id))
"""

REPORTS = f"""
report AS (
  SELECT CAST(d AS BIGINT) AS report_day, count(transaction_id) AS total_txns, CAST(sum(amount) AS DOUBLE) AS total_volume,
         sum(is_fraud) AS fraud_count, {pct('sum(is_fraud)', 'count(transaction_id)', 4)} AS fraud_rate,
         {mean('amount')} AS avg_txn_amount, CAST(max(amount) AS DOUBLE) AS max_txn_amount,
         (SELECT count(*) FROM alerts JOIN fact f USING (transaction_id) WHERE f.transaction_day = d) AS alert_count,
         (SELECT count(*) FROM dim WHERE risk_tier IN ('CRITICAL', 'HIGH')) AS high_risk_customers
  FROM (SELECT unnest(generate_series((SELECT min(transaction_day) FROM fact), (SELECT max(transaction_day) FROM fact))) AS d) days
       LEFT JOIN fact ON transaction_day = d
  GROUP BY d)
"""


def stmt(body: str, *parts: str) -> str:
    return "WITH " + ",".join([EVENT_FACT, *parts]) + body


ALERTING = (CUSTOMERS, FLAGS, STAT_ALERTS, HIGH_ALERTS, ALERTS)
FRAUD_PCT4 = pct("sum(is_fraud)", "count(*)", 4)
RAW = f"""{cnt('transaction_id transaction_id', 'step step')}, transaction_type, {num('amount amount')}, customer_id,
  {num('old_balance_orig old_balance_orig', 'new_balance_orig new_balance_orig')}, recipient_id,
  {num('old_balance_dest old_balance_dest', 'new_balance_dest new_balance_dest')},
  {cnt('is_fraud is_fraud', 'is_flagged_fraud is_flagged_fraud')}"""
RAW_NO_ID = RAW.split(",", 1)[1]
DERIVED = f"""{cnt('transaction_hour transaction_hour', 'transaction_day transaction_day')},
  {num('balance_change balance_change', 'amount_to_balance_ratio amount_to_balance_ratio')}"""
ALERT_CORE = "CAST(transaction_id AS BIGINT) AS transaction_id, customer_id, alert_type, severity, alert_description, detection_method"
DIM_COLS = f"""customer_id, {cnt('total_transactions total_transactions')},
  {num('total_amount total_amount', 'mid avg_transaction', 'top max_transaction')},
  {cnt('fraud_count fraud_count', 'first_seen_step first_seen_step', 'last_seen_step last_seen_step')}"""
REPORT_COLS = f"""{cnt('report_day report_day', 'total_txns total_txns')}, total_volume, {cnt('fraud_count fraud_count')},
  fraud_rate, avg_txn_amount, max_txn_amount, {cnt('alert_count alert_count', 'high_risk_customers high_risk_customers')}"""


def tail_chi2(stat: str, dof: str, steps: int = 20000) -> str:
    """Upper tail of chi-square by Simpson's rule on [0, stat] (dof of at least 2)."""
    return f"""(1 - ({stat}) / {steps} / 3 * (
      SELECT sum(CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * CASE WHEN i = 0 THEN CASE WHEN {dof} = 2 THEN 0.5 ELSE 0 END
               ELSE exp(({dof} / 2.0 - 1) * ln(i * ({stat}) / {steps}) - i * ({stat}) / {steps} / 2 - ({dof} / 2.0) * ln(2.0) - lgamma({dof} / 2.0)) END)
      FROM range(0, {steps} + 1) r(i)))"""


def tail_t(t: str, dof: str, steps: int = 20000) -> str:
    """Two-sided tail of Student's t by Simpson's rule on [0, |t|]."""
    return f"""(1 - 2 * abs({t}) / {steps} / 3 * (
      SELECT sum(CASE WHEN i IN (0, {steps}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
        * exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0) - 0.5 * ln({dof} * pi())
              - ({dof} + 1) / 2.0 * ln(1 + pow(i * abs({t}) / {steps}, 2) / {dof})))
      FROM range(0, {steps} + 1) r(i)))"""


CHI_TYPE = """
per_type AS (
  SELECT transaction_type, count(*) FILTER (WHERE is_fraud = 0) AS o0, count(*) FILTER (WHERE is_fraud = 1) AS o1 FROM fact GROUP BY ALL),
sides AS (
  SELECT CAST(o0 + o1 AS DOUBLE) * sum(o0) OVER () / sum(o0 + o1) OVER () AS e0, o0,
         CAST(o0 + o1 AS DOUBLE) * sum(o1) OVER () / sum(o0 + o1) OVER () AS e1, o1 FROM per_type),
chi_type AS (SELECT sum(pow(o0 - e0, 2) / e0 + pow(o1 - e1, 2) / e1) AS stat, count(*) - 1 AS dof FROM sides)
"""
WELCH = """
sample AS (
  SELECT count(*) FILTER (WHERE is_fraud = 1) AS n1, count(*) FILTER (WHERE is_fraud = 0) AS n0,
         avg(amount) FILTER (WHERE is_fraud = 1) AS m1, avg(amount) FILTER (WHERE is_fraud = 0) AS m0,
         var_samp(amount) FILTER (WHERE is_fraud = 1) AS v1, var_samp(amount) FILTER (WHERE is_fraud = 0) AS v0,
         median(CAST(amount AS DOUBLE)) FILTER (WHERE is_fraud = 1) AS d1, median(CAST(amount AS DOUBLE)) FILTER (WHERE is_fraud = 0) AS d0,
         min(amount) FILTER (WHERE is_fraud = 1) AS a1, min(amount) FILTER (WHERE is_fraud = 0) AS a0,
         max(amount) FILTER (WHERE is_fraud = 1) AS z1, max(amount) FILTER (WHERE is_fraud = 0) AS z0 FROM fact),
welch AS (
  SELECT *, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS t, (m1 - m0) / sqrt((v1 + v0) / 2) AS d,
         pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1)) AS dof FROM sample)
"""
BISERIAL = f"""
drains AS (
  SELECT is_fraud, CAST(old_balance_orig - new_balance_orig AS DOUBLE) / CAST(old_balance_orig AS DOUBLE) AS drain
  FROM fact WHERE {OUT} AND old_balance_orig > 0),
biserial AS (
  SELECT corr(is_fraud, drain) AS r, count(*) AS n, corr(is_fraud, drain) * sqrt((count(*) - 2) / (1 - pow(corr(is_fraud, drain), 2))) AS t FROM drains)
"""
CHI_HOUR = """
hours AS (SELECT transaction_hour, count(*) AS observed FROM fact WHERE is_fraud = 1 GROUP BY ALL),
spread AS (SELECT *, CAST(sum(observed) OVER () AS DOUBLE) / count(*) OVER () AS expected FROM hours),
chi_hour AS (SELECT sum(pow(observed - expected, 2) / expected) AS stat, count(*) - 1 AS dof, sum(observed) AS total_fraud FROM spread)
"""


def _metric_lines() -> str:
    methods = [("Z_SCORE", "z_hit", "true"), ("IQR", "iqr_hit", "true"), ("ROLLING", "roll_hit", "known = 1"), ("ENSEMBLE", "CASE WHEN hits >= 2 THEN 1 ELSE 0 END", "true")]
    long = " UNION ALL ".join(f"SELECT '{m}' AS method, is_fraud AS y, {p} AS p FROM flags WHERE {w}" for m, p, w in methods)
    s = "coalesce({} / nullif({}, 0), 0)"
    prf = {
        "Legitimate": (s.format("tn", "tn + fn"), s.format("tn", "tn + fp"), s.format("2 * tn", "2 * tn + fn + fp"), "tn + fp"),
        "Fraud": (s.format("tp", "tp + fp"), s.format("tp", "tp + fn"), s.format("2 * tp", "2 * tp + fp + fn"), "tp + fn"),
    }
    (lp, lr, lf, ln), (fp_, fr, ff, fn_) = prf["Legitimate"], prf["Fraud"]
    n = "tn + fp + fn + tp"
    rows = [("Legitimate", lp, lr, lf, ln), ("Fraud", fp_, fr, ff, fn_), ("accuracy", "NULL", "NULL", f"(tn + tp) / ({n})", n)]
    rows.append(("macro avg", *[f"({a} + {b}) / 2" for a, b in ((lp, fp_), (lr, fr), (lf, ff))], n))
    rows.append(("weighted avg", *[f"({a} * ({ln}) + {b} * ({fn_})) / ({n})" for a, b in ((lp, fp_), (lr, fr), (lf, ff))], n))
    lines = " UNION ALL ".join(
        f"SELECT method, '{name}' AS class, {rnd(p, 6)} AS precision, {rnd(r, 6)} AS recall, {rnd(f1, 6)} AS f1_score, CAST({sup} AS BIGINT) AS support FROM cells"
        for name, p, r, f1, sup in rows
    )
    return f""", scored AS ({long}),
    cells AS (SELECT method, CAST(count(*) FILTER (WHERE y = 0 AND p = 0) AS DOUBLE) AS tn, CAST(count(*) FILTER (WHERE y = 0 AND p = 1) AS DOUBLE) AS fp,
                     CAST(count(*) FILTER (WHERE y = 1 AND p = 0) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE y = 1 AND p = 1) AS DOUBLE) AS tp
              FROM scored GROUP BY method)
    {lines}"""


def _corr_rows() -> str:
    cols = ["amount", "old_balance_orig", "new_balance_orig", "old_balance_dest", "new_balance_dest", "balance_change", "is_fraud"]
    rows = [
        f"""SELECT '{cols[j]}' AS y, '{cols[i]}' AS x, CASE WHEN count(DISTINCT {cols[i]}) > 1 AND count(DISTINCT {cols[j]}) > 1
            THEN {rnd(f'corr(CAST({cols[i]} AS DOUBLE), CAST({cols[j]} AS DOUBLE))', 6)} END AS r FROM fact"""
        for i in range(len(cols))
        for j in range(i + 1, len(cols))
    ]
    return " UNION ALL ".join(rows)


def _rollup(days: int, name: str) -> str:
    return stmt(f"""
      SELECT {cnt(f'transaction_day//{days} {name}', 'min(transaction_day) first_day', 'max(transaction_day) last_day', 'count(*) total_txns')},
             {num('sum(amount) total_volume')}, {mean('amount')} AS avg_amount, {cnt('sum(is_fraud) fraud_count')},
             {FRAUD_PCT4} AS fraud_rate_pct, {cnt('count(DISTINCT customer_id) active_customers')}
      FROM fact GROUP BY transaction_day // {days}""")


def oracle_statements() -> dict[str, str]:
    o: dict[str, str] = {}

    # sources, cleaning, dimensions
    o["read_transactions"] = stmt(f"SELECT {RAW_NO_ID} FROM fact")
    o["clean_transactions"] = stmt(f"SELECT {RAW} FROM fact WHERE transaction_id % 11 <> 0")
    o["derive_features"] = stmt(f"SELECT {RAW}, {DERIVED} FROM fact")
    o["write_fact"] = stmt(f"SELECT {RAW}, {DERIVED}, CAST(transaction_id % 2 AS BIGINT) AS batch_id FROM fact")
    o["read_table"] = stmt(
        f"SELECT transaction_type, {cnt('count(*) txn_count')}, {num('sum(amount) total_volume')} FROM fact GROUP BY ALL"
    )
    o["two_bulk_loads"] = stmt(
        f"SELECT {RAW_NO_ID}, {DERIVED}, CAST(CASE WHEN transaction_id % 2 = 1 THEN 1 ELSE 2 END AS BIGINT) AS batch_id FROM fact"
    )
    o["rejected_rows"] = stmt("""
      SELECT CAST(1 AS BIGINT) AS batch_id, ['unreadable', 'amount', 'unreadable', 'missing', 'unreadable'][1 + (transaction_id // 11) % 5] AS reason,
             count(*) AS row_count FROM fact WHERE transaction_id % 11 = 0 GROUP BY ALL""")
    o["random_sample"] = stmt(f"SELECT {RAW}, {DERIVED} FROM fact ORDER BY md5('42-' || transaction_id), transaction_id LIMIT 1000")
    o["drain_scatter"] = stmt(f"""
      , points AS (SELECT transaction_id, is_fraud, old_balance_orig, amount FROM fact WHERE {OUT} AND old_balance_orig > 0),
      legit AS (SELECT * FROM points WHERE is_fraud = 0 ORDER BY md5('42-' || transaction_id), transaction_id LIMIT 300)
      SELECT {cnt('transaction_id transaction_id', 'is_fraud is_fraud')}, {num('old_balance_orig old_balance_orig', 'amount amount')}
      FROM (FROM points WHERE is_fraud = 1 UNION ALL FROM legit)""")
    o["incremental_files"] = stmt(
        f"SELECT {cnt('CASE WHEN transaction_day < 15 THEN 1 ELSE 2 END batch_id', 'transaction_day transaction_day', 'count(*) txn_count')} FROM fact GROUP BY ALL"
    )
    o["incremental_ingest_job"] = stmt(f"SELECT {RAW_NO_ID}, {DERIVED} FROM fact")
    o["dim_transaction_types"] = stmt(f"""
      SELECT CAST(type_id AS BIGINT) AS type_id, type_name, CAST(risk_weight AS DOUBLE) AS risk_weight, description,
             (SELECT count(*) FROM fact WHERE transaction_type = type_name) AS txn_count
      FROM (VALUES (1, 'CASH_IN', 0.20, 'Customer deposits cash into account'), (2, 'CASH_OUT', 0.80, 'Customer withdraws cash from account'),
                   (3, 'DEBIT', 0.40, 'Direct debit/automatic payment'), (4, 'PAYMENT', 0.30, 'Payment for goods or services'),
                   (5, 'TRANSFER', 0.90, 'Transfer to another account - highest fraud risk')) t(type_id, type_name, risk_weight, description)""")
    o["dim_customers"] = stmt(f"SELECT {DIM_COLS} FROM profile", CUSTOMERS)
    o["dim_customers_upsert"] = o["dim_customers"]
    o["append_alerts"] = stmt(f"SELECT {ALERT_CORE}, {cnt('alert_id alert_id')} FROM alerts", *ALERTING)

    # data quality
    o["dq_row_count"] = stmt("SELECT count(*) AS total_rows FROM fact")
    o["dq_nulls"] = stmt(
        "SELECT "
        + cnt(
            "count(*)-count(customer_id) null_customer",
            "count(*)-count(recipient_id) null_recipient",
            "count(*)-count(amount) null_amount",
            "count(*)-count(transaction_type) null_type",
            "count(*)-count(is_fraud) null_fraud",
        )
        + " FROM fact"
    )
    o["dq_ranges"] = stmt(
        f"""SELECT {num('min(amount) min_amount', 'max(amount) max_amount')}, {mean('amount')} AS avg_amount,
        {cnt('min(step) min_step', 'max(step) max_step', 'count(DISTINCT transaction_type) unique_types', 'count(DISTINCT customer_id) unique_customers', 'count(DISTINCT recipient_id) unique_recipients')} FROM fact"""
    )
    total = "(SELECT count(*) FROM fact)"
    o["dq_type_distribution"] = stmt(
        f"SELECT transaction_type, count(*) AS txn_count, {pct('count(*)', total, 2)} AS percentage, {mean('amount')} AS avg_amount, {num('sum(amount) total_volume')} FROM fact GROUP BY ALL"
    )
    o["dq_fraud_distribution"] = stmt(
        f"SELECT {cnt('is_fraud is_fraud')}, count(*) AS count, {pct('count(*)', total, 4)} AS percentage FROM fact GROUP BY is_fraud"
    )
    o["dq_tier_summary"] = stmt(
        f"SELECT risk_tier, count(*) AS customer_count, {mean('total_amount')} AS avg_total_amount, {mean('load_score', 1)} AS avg_risk_score FROM dim GROUP BY risk_tier",
        CUSTOMERS,
    )
    o["dq_derived_nulls"] = stmt(
        "SELECT "
        + cnt(
            "count(*) total_rows",
            "count(*)-count(transaction_hour) null_hours",
            "count(*)-count(transaction_day) null_days",
            "count(*)-count(balance_change) null_balance_change",
        )
        + " FROM fact"
    )
    o["dq_top_risk_sample"] = stmt(
        f"SELECT {DIM_COLS}, {cnt('load_score risk_score')}, risk_tier FROM dim ORDER BY load_score DESC, customer_id LIMIT 10", CUSTOMERS
    )
    o["dq_first_rows"] = stmt(f"SELECT {RAW}, {DERIVED} FROM fact ORDER BY transaction_id LIMIT 10")
    o["dq_quality_report"] = stmt(f"""
      SELECT 'total' AS section, 'all' AS key, 'txn_count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM fact
      UNION ALL SELECT 'type', transaction_type, 'txn_count', count(*) FROM fact GROUP BY transaction_type
      UNION ALL SELECT 'type', transaction_type, 'avg_amount', {mean('amount')} FROM fact GROUP BY transaction_type
      UNION ALL SELECT 'fraud', CASE is_fraud WHEN 1 THEN 'Fraud' ELSE 'Legitimate' END, 'txn_count', count(*) FROM fact GROUP BY is_fraud
      UNION ALL SELECT 'nulls', 'all', 'customer_id', count(*) FILTER (WHERE customer_id IS NULL) FROM fact
      UNION ALL SELECT 'nulls', 'all', 'amount', count(*) FILTER (WHERE amount IS NULL) FROM fact
      UNION ALL SELECT 'nulls', 'all', 'transaction_hour', count(*) FILTER (WHERE transaction_hour IS NULL) FROM fact""")

    o["dq_integrity"] = stmt("""
      SELECT 'transaction_id used twice' AS check_name, count(*) AS violations FROM (SELECT transaction_id FROM fact GROUP BY 1 HAVING count(*) > 1) a
      UNION ALL SELECT 'customer_id used twice', count(*) FROM (SELECT customer_id FROM dim GROUP BY 1 HAVING count(*) > 1) b
      UNION ALL SELECT 'alert without transaction', count(*) FROM alerts WHERE transaction_id NOT IN (SELECT transaction_id FROM fact)
      UNION ALL SELECT 'transaction with unknown type', count(*) FROM fact
        WHERE transaction_type NOT IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')""", *ALERTING)

    # exploration
    o["volume_by_type"] = stmt(
        f"""SELECT transaction_type, count(*) AS txn_count, {pct('count(*)', total, 2)} AS pct_of_total,
        {num('sum(amount) total_volume', 'min(amount) min_amount', 'max(amount) max_amount')}, {mean('amount')} AS avg_amount,
        {rnd('stddev_pop(amount)')} AS std_amount FROM fact GROUP BY transaction_type"""
    )
    fraud_mean, legit_mean = (div(f"sum(amount) FILTER (WHERE is_fraud = {f})", f"count(amount) FILTER (WHERE is_fraud = {f})") for f in (1, 0))
    o["fraud_rate_by_type"] = stmt(
        f"""SELECT transaction_type, count(*) AS total_txns, count(*) FILTER (WHERE is_fraud = 1) AS fraud_txns,
        count(*) FILTER (WHERE is_fraud = 0) AS legit_txns, {FRAUD_PCT4} AS fraud_rate_pct, {rnd(fraud_mean)} AS avg_fraud_amount,
        {rnd(legit_mean)} AS avg_legit_amount, {rnd(div(fraud_mean, legit_mean))} AS fraud_to_legit_ratio FROM fact GROUP BY transaction_type"""
    )
    o["hourly_pattern"] = stmt(
        f"""SELECT {cnt('transaction_hour transaction_hour', 'count(*) txn_count')}, {num('sum(amount) total_volume')}, {mean('amount')} AS avg_amount,
        {cnt('sum(is_fraud) fraud_count')}, {FRAUD_PCT4} AS fraud_rate_pct FROM fact GROUP BY transaction_hour"""
    )
    o["daily_trends"] = stmt(f"""
      , days AS (SELECT transaction_day AS d, count(*) AS n, sum(amount) AS v, sum(is_fraud) AS fr FROM fact GROUP BY d)
      SELECT {cnt('d transaction_day', 'n daily_txns', 'fr daily_fraud')}, {num('v daily_volume')}, {pct('fr', 'n', 4)} AS daily_fraud_rate,
             {cnt('sum(n) OVER (ORDER BY d) cumulative_txns', 'sum(fr) OVER (ORDER BY d) cumulative_fraud')}, {num('sum(v) OVER (ORDER BY d) cumulative_volume')},
             {rnd(div('sum(n) OVER w', 'count(*) OVER w'), 0)} AS ma_7day_txns, {rnd(div('sum(v) OVER w', 'count(*) OVER w'))} AS ma_7day_volume
      FROM days WINDOW w AS (ORDER BY d ROWS 6 PRECEDING)""")
    o["amount_percentiles"] = stmt(f"""
      , tiles AS (SELECT transaction_type, amount, ntile(100) OVER (PARTITION BY transaction_type ORDER BY amount, transaction_id) AS percentile FROM fact)
      SELECT transaction_type, {cnt('percentile percentile')}, {num('min(amount) min_amount', 'max(amount) max_amount')}, {mean('amount')} AS avg_amount,
             count(*) AS count_in_bucket
      FROM tiles WHERE percentile IN (25, 50, 75, 90, 95, 99) GROUP BY transaction_type, percentile""")
    o["top_customers"] = stmt(f"""
      , per_customer AS (SELECT customer_id, count(*) AS n, sum(amount) AS v, {mean('amount')} AS m, max(amount) AS mx, sum(is_fraud) AS fr,
                               count(DISTINCT transaction_type) AS kinds FROM fact GROUP BY customer_id)
      SELECT customer_id, n AS txn_count, {num('v total_volume')}, m AS avg_amount, {num('mx max_single_txn')}, {cnt('fr fraud_count')}, kinds AS types_used,
             dense_rank() OVER (ORDER BY v DESC) AS volume_rank, dense_rank() OVER (ORDER BY n DESC) AS frequency_rank
      FROM per_customer QUALIFY volume_rank <= 20""")
    o["fraud_deep_dive"] = stmt(f"""
      , overall AS (SELECT transaction_type, {div('sum(amount)', 'count(amount)')} AS m FROM fact GROUP BY transaction_type)
      SELECT transaction_type, count(*) AS fraud_txns, {mean('amount')} AS avg_fraud_amount, {num('max(amount) max_fraud_amount', 'sum(amount) total_fraud_volume')},
             {rnd(div(div('sum(amount)', 'count(amount)'), 'any_value(m)'))} AS fraud_vs_overall_ratio,
             {mean('old_balance_orig - new_balance_orig')} AS avg_balance_drained,
             {rnd('avg(CASE WHEN old_balance_orig > 0 THEN CAST(old_balance_orig - new_balance_orig AS DOUBLE) / CAST(old_balance_orig AS DOUBLE) * 100 ELSE 0 END)')} AS avg_drain_pct
      FROM fact JOIN overall USING (transaction_type) WHERE is_fraud = 1 GROUP BY transaction_type""")
    o["flag_confusion"] = stmt(f"""
      SELECT {cnt('is_fraud is_fraud', 'is_flagged_fraud is_flagged_fraud')}, count(*) AS count, {mean('amount')} AS avg_amount,
             CASE is_fraud * 2 + is_flagged_fraud WHEN 3 THEN 'TRUE POSITIVE (correctly flagged)' WHEN 2 THEN 'FALSE NEGATIVE (missed fraud)'
               WHEN 1 THEN 'FALSE POSITIVE (wrongly flagged)' WHEN 0 THEN 'TRUE NEGATIVE (correctly cleared)' END AS classification
      FROM fact GROUP BY is_fraud, is_flagged_fraud""")
    o["zero_balance"] = stmt(f"""
      SELECT transaction_type, count(*) AS zero_balance_txns, {mean('amount')} AS avg_amount, {mean('old_balance_orig')} AS avg_old_balance,
             {cnt('sum(is_fraud) fraud_among_zero_balance')}, {pct('sum(is_fraud)', 'count(*)', 2)} AS fraud_rate_pct
      FROM fact WHERE new_balance_orig = 0 AND old_balance_orig > 0 GROUP BY transaction_type""")
    o["amount_bands"] = stmt(f"""
      SELECT CASE WHEN amount >= 1000000 THEN '1M+' WHEN amount >= 100000 THEN '100K-1M' WHEN amount >= 10000 THEN '10K-100K'
                  WHEN amount >= 1000 THEN '1K-10K' WHEN amount >= 100 THEN '100-1K' ELSE '0-100' END AS amount_band,
             count(*) AS txn_count, {pct('count(*)', total, 2)} AS pct_of_total, {cnt('sum(is_fraud) fraud_count')}, {FRAUD_PCT4} AS fraud_rate_pct
      FROM fact GROUP BY amount_band""")

    # chart data
    o["amount_histogram"] = stmt(f"""
      , pick AS (SELECT is_fraud, CAST(amount * 100 AS BIGINT) AS c FROM fact WHERE amount < 1000000),
      edge0 AS (SELECT is_fraud, min(c) AS lo0, max(c) AS hi0, count(*) AS total FROM pick GROUP BY is_fraud),
      edge AS (SELECT is_fraud, total, CASE WHEN lo0 = hi0 THEN lo0 - 50 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 50 ELSE hi0 END AS hi FROM edge0),
      filled AS (SELECT is_fraud, least((c - lo) * 100 // (hi - lo), 99) AS b, count(*) AS n FROM pick JOIN edge USING (is_fraud) GROUP BY ALL),
      grid AS (SELECT *, (hi - lo) / (100.0::DOUBLE * 100) AS w FROM edge, (SELECT unnest(range(100)) AS b) bins)
      SELECT {cnt('g.is_fraud is_fraud', 'g.b bin')}, {rnd('lo / 100.0::DOUBLE + g.b * w', 4)} AS bin_from, {rnd('lo / 100.0::DOUBLE + (g.b + 1) * w', 4)} AS bin_to,
             {cnt('coalesce(n,0) txn_count')}, {rnd(div('coalesce(n, 0)', 'total * w'), 12)} AS density
      FROM grid g LEFT JOIN filled f ON g.is_fraud = f.is_fraud AND g.b = f.b""")
    o["amount_boxes"] = stmt(f"""
      , pick AS (SELECT transaction_type, CAST(amount AS DOUBLE) AS a FROM fact WHERE amount < 1000000),
      box AS (SELECT transaction_type, count(*) AS n, quantile_cont(a, 0.25) AS q1, quantile_cont(a, 0.5) AS q2, quantile_cont(a, 0.75) AS q3 FROM pick GROUP BY 1)
      SELECT transaction_type, n AS txn_count, {rnd('q1', 4)} AS q1, {rnd('q2', 4)} AS median, {rnd('q3', 4)} AS q3,
             min(a) FILTER (WHERE a >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max(a) FILTER (WHERE a <= q3 + 1.5 * (q3 - q1)) AS whisker_high
      FROM pick JOIN box USING (transaction_type) GROUP BY transaction_type, n, q1, q2, q3""")
    o["fraud_amount_quartiles"] = stmt(f"""
      , pick AS (SELECT transaction_type, is_fraud, CAST(amount AS DOUBLE) AS a FROM fact WHERE {OUT} AND amount < 2000000)
      SELECT transaction_type, CASE is_fraud WHEN 1 THEN 'Fraudulent' ELSE 'Legitimate' END AS label, count(*) AS txn_count,
             {rnd('quantile_cont(a, 0.25)', 4)} AS q1, {rnd('quantile_cont(a, 0.5)', 4)} AS median, {rnd('quantile_cont(a, 0.75)', 4)} AS q3
      FROM pick GROUP BY transaction_type, is_fraud""")
    o["correlation_matrix"] = stmt(_corr_rows())
    o["hourly_counts"] = stmt(
        f"SELECT {cnt('transaction_hour transaction_hour', 'count(*) total_txns', 'sum(is_fraud) fraud_txns')}, {num('sum(amount) total_volume')} FROM fact GROUP BY transaction_hour"
    )
    o["type_breakdown"] = stmt(
        f"SELECT transaction_type, count(*) AS txn_count, {cnt('sum(is_fraud) fraud_count')}, {FRAUD_PCT4} AS fraud_rate FROM fact GROUP BY transaction_type"
    )
    heat = ", ".join(f"count(*) FILTER (WHERE is_fraud = 1 AND transaction_hour = {h}) AS hour_{h:02d}" for h in range(24))
    o["fraud_heatmap"] = stmt(f"SELECT transaction_type, {heat} FROM fact GROUP BY transaction_type")
    o["drain_histogram"] = stmt(f"""
      , pick AS (SELECT is_fraud, greatest(least(CAST(old_balance_orig - new_balance_orig AS DOUBLE) / CAST(old_balance_orig AS DOUBLE) * 100.0, 100.0), 0.0) AS d
                FROM fact WHERE {OUT} AND old_balance_orig > 0),
      edge0 AS (SELECT is_fraud, min(d) AS lo0, max(d) AS hi0, count(*) AS total FROM pick GROUP BY is_fraud),
      edge AS (SELECT is_fraud, total, CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM edge0),
      guess AS (SELECT *, CAST(least(floor((d - lo) / (hi - lo) * 50.0::DOUBLE), 49) AS BIGINT) AS g, (hi - lo) / 50.0::DOUBLE AS w FROM pick JOIN edge USING (is_fraud)),
      filled AS (SELECT is_fraud, CASE WHEN d < lo + g * w THEN g - 1 WHEN g < 49 AND d >= lo + (g + 1) * w THEN g + 1 ELSE g END AS b, count(*) AS n FROM guess GROUP BY ALL),
      grid AS (SELECT *, (hi - lo) / 50.0::DOUBLE AS w FROM edge, (SELECT unnest(range(50)) AS b) bins)
      SELECT {cnt('g.is_fraud is_fraud', 'g.b bin')}, {rnd('lo + g.b * w', 4)} AS bin_from, {rnd('lo + (g.b + 1) * w', 4)} AS bin_to,
             {cnt('coalesce(n,0) txn_count')}, {rnd(div('coalesce(n, 0)', 'total * w'), 8)} AS density
      FROM grid g LEFT JOIN filled f ON g.is_fraud = f.is_fraud AND g.b = f.b""")

    # rule detectors
    o["velocity_alerts"] = stmt(f"""
      , hours AS (SELECT customer_id, transaction_day, transaction_hour, count(*) AS n, sum(amount) AS v FROM fact GROUP BY ALL),
      usual AS (SELECT *, avg(n) OVER c AS m, stddev_pop(n) OVER c AS s FROM hours WINDOW c AS (PARTITION BY customer_id))
      SELECT customer_id, {cnt('transaction_day transaction_day', 'transaction_hour transaction_hour', 'n txn_count')}, {num('v hourly_total')},
             {rnd('m', 6)} AS avg_hourly_txn, {rnd('s', 6)} AS std_hourly_txn, {rnd('(n - m) / s')} AS velocity_z_score, 'VELOCITY_ALERT' AS alert_type,
             CASE WHEN (n - m) / s > 3 THEN 'CRITICAL' WHEN (n - m) / s > 2 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
      FROM usual WHERE n > m + 2 * s AND s > 0 ORDER BY velocity_z_score DESC, customer_id, transaction_day, transaction_hour LIMIT 100""")
    o["balance_drain_alerts"] = stmt(f"""
      , moves AS (SELECT *, step - coalesce(lag(step) OVER (PARTITION BY customer_id ORDER BY step, transaction_id), step) AS gap,
                        CASE WHEN old_balance_orig > 0 THEN {rnd(div('old_balance_orig - new_balance_orig', 'old_balance_orig') + ' * 100')} ELSE 0 END AS drained
                 FROM fact WHERE {OUT})
      SELECT customer_id, {cnt('transaction_id transaction_id')}, transaction_type, {num('amount amount', 'old_balance_orig old_balance_orig', 'new_balance_orig new_balance_orig')},
             drained AS drain_percentage, {cnt('gap steps_between_txns', 'is_fraud is_fraud')}, 'BALANCE_DRAIN' AS alert_type,
             CASE WHEN drained >= 95 AND gap <= 1 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
      FROM moves WHERE drained > 80 ORDER BY drained DESC, transaction_id LIMIT 200""")
    o["rolling_deviation_alerts"] = stmt(f"""
      , rolled AS (SELECT *, avg(amount) OVER w AS m, stddev_pop(amount) OVER w AS s, count(*) OVER w AS n FROM fact
                  WINDOW w AS (PARTITION BY customer_id ORDER BY step, transaction_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
      scored AS (SELECT *, (CAST(amount AS DOUBLE) - m) / s AS z FROM rolled WHERE n >= 5 AND s > 0)
      SELECT {cnt('transaction_id transaction_id')}, customer_id, {num('amount amount')}, transaction_type, {cnt('is_fraud is_fraud')},
             {rnd('m')} AS rolling_avg, {rnd('s')} AS rolling_std, {rnd('z')} AS z_score, 'ROLLING_DEVIATION' AS alert_type,
             CASE WHEN z > 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
      FROM scored WHERE z > 3 ORDER BY z_score DESC, transaction_id LIMIT 200""")
    o["round_amount_alerts"] = stmt(f"""
      SELECT {cnt('transaction_id transaction_id')}, customer_id, recipient_id, transaction_type, {num('amount amount')}, {cnt('is_fraud is_fraud')},
             {num('old_balance_orig old_balance_orig', 'new_balance_orig new_balance_orig')}, 'ROUND_AMOUNT' AS alert_type,
             CASE WHEN amount >= 1000000 AND amount % 100000 = 0 THEN 'CRITICAL' WHEN amount >= 100000 AND amount % 10000 = 0 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
      FROM fact WHERE {OUT} AND amount >= 10000 AND amount % 1000 = 0 ORDER BY fact.amount DESC, fact.transaction_id LIMIT 200""")
    o["fan_out_alerts"] = stmt(f"""
      , days AS (SELECT customer_id, transaction_day AS d, count(DISTINCT recipient_id) AS u, count(*) AS n, sum(amount) AS v
                FROM fact WHERE transaction_type IN ('TRANSFER', 'CASH_OUT', 'PAYMENT') GROUP BY customer_id, d),
      usual AS (SELECT *, avg(u) OVER c AS m, stddev_pop(u) OVER c AS s FROM days WINDOW c AS (PARTITION BY customer_id))
      SELECT customer_id, {cnt('d transaction_day', 'u unique_recipients', 'n txn_count')}, {num('v daily_total')}, {rnd('m')} AS avg_daily_recipients,
             'FAN_OUT' AS alert_type, CASE WHEN u > 10 THEN 'CRITICAL' WHEN u > 5 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
      FROM usual WHERE u >= 3 AND u > m + 2 * s ORDER BY u DESC, customer_id, d LIMIT 100""")
    o["balance_mismatch_alerts"] = stmt(f"""
      SELECT {cnt('transaction_id transaction_id')}, customer_id, transaction_type, {num('amount amount', 'old_balance_orig old_balance_orig', 'new_balance_orig new_balance_orig')},
             {num('old_balance_orig-new_balance_orig expected_debit', 'abs(amount-(old_balance_orig-new_balance_orig)) mismatch_amount')},
             {cnt('is_fraud is_fraud')}, 'BALANCE_MISMATCH' AS alert_type, 'HIGH' AS severity
      FROM fact WHERE {OUT} AND old_balance_orig > 0 AND abs(fact.amount - (fact.old_balance_orig - fact.new_balance_orig)) > 1
      ORDER BY mismatch_amount DESC, fact.transaction_id LIMIT 200""")
    o["detection_coverage"] = stmt("""
      , frauds AS (SELECT * FROM fact WHERE is_fraud = 1)
      SELECT 'Total Fraud Transactions' AS metric, count(*) AS count FROM frauds
      UNION ALL SELECT 'Fraud with balance drain > 80%', count(*) FROM frauds
        WHERE old_balance_orig > 0 AND CAST(old_balance_orig - new_balance_orig AS DOUBLE) / CAST(old_balance_orig AS DOUBLE) > 0.8
      UNION ALL SELECT 'Fraud with zero final balance', count(*) FROM frauds WHERE new_balance_orig = 0
      UNION ALL SELECT 'Fraud in TRANSFER type', count(*) FROM frauds WHERE transaction_type = 'TRANSFER'
      UNION ALL SELECT 'Fraud in CASH_OUT type', count(*) FROM frauds WHERE transaction_type = 'CASH_OUT'""")

    # statistical detectors
    ident = cnt("transaction_id transaction_id", "is_fraud is_fraud")
    o["zscore_detection"] = stmt(f"SELECT {ident}, customer_id, {num('amount amount')}, {rnd('z', 4)} AS z_score, {cnt('z_hit is_anomaly_zscore')} FROM flags", FLAGS)
    o["zscore_anomalies"] = stmt(f"SELECT {ident}, customer_id, {num('amount amount')}, {rnd('z', 4)} AS z_score FROM flags WHERE z_hit = 1", FLAGS)
    o["iqr_detection"] = stmt(f"SELECT {ident}, transaction_type, {num('amount amount')}, {cnt('iqr_hit is_anomaly_iqr')} FROM flags", FLAGS)
    o["iqr_bounds"] = stmt(f"""
      SELECT transaction_type, {rnd('any_value(q1)', 6)} AS q1, {rnd('any_value(q3)', 6)} AS q3, {rnd('any_value(q3 - q1)', 6)} AS iqr,
             {rnd('greatest(any_value(lower), 0)', 6)} AS lower, {rnd('any_value(upper)', 6)} AS upper,
             {cnt('sum(iqr_hit) outliers', 'sum(iqr_hit*is_fraud) fraud_in_outliers')}
      FROM flags JOIN limits USING (transaction_type) GROUP BY transaction_type""", FLAGS)
    o["rolling_detection"] = stmt(
        f"""SELECT {ident}, customer_id, {num('amount amount')}, {rnd('rolling_mean')} AS rolling_mean, {rnd('rolling_std')} AS rolling_std,
        {cnt('known has_history', 'roll_hit is_anomaly_rolling')} FROM flags""",
        FLAGS,
    )
    o["ensemble_detection"] = stmt(
        f"""SELECT {ident}, {cnt('z_hit is_anomaly_zscore', 'iqr_hit is_anomaly_iqr', 'roll_hit is_anomaly_rolling', 'known has_history', 'hits methods_flagged')},
        CAST(CASE WHEN hits >= 2 THEN 1 ELSE 0 END AS BIGINT) AS is_anomaly_ensemble FROM flags""",
        FLAGS,
    )
    o["ensemble_distribution"] = stmt(
        "SELECT CAST(h AS BIGINT) AS methods_flagged, count(transaction_id) AS txn_count, CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS fraud_count FROM range(4) r(h) LEFT JOIN flags ON hits = h GROUP BY h",
        FLAGS,
    )
    o["detector_metrics"] = stmt(_metric_lines(), FLAGS)
    o["python_alerts"] = stmt(f"SELECT {ALERT_CORE} FROM stat_alerts", FLAGS, STAT_ALERTS)
    o["batch_zscore_alerts"] = stmt(f"""
      , batch AS (SELECT *, step // 240 AS b FROM fact),
      own AS (SELECT *, CASE WHEN stddev_samp(amount) OVER c > 0 THEN (CAST(amount AS DOUBLE) - avg(amount) OVER c) / stddev_samp(amount) OVER c ELSE 0 END AS z
              FROM batch WINDOW c AS (PARTITION BY b, customer_id))
      SELECT {cnt('transaction_id transaction_id')}, customer_id, 'Z_SCORE_AUTO' AS alert_type, CASE WHEN abs(z) > 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
             'Auto-detected: Z-score=' || {_money(rnd('z'))} || ', Amount=' || {_money('amount')} AS alert_description, 'PYTHON_AUTO_ZSCORE' AS detection_method
      FROM own WHERE abs(z) > 3""")

    # risk
    o["customer_risk_5factor"] = stmt(f"""
      , factor AS (SELECT customer_id, count(*) AS n, sum(is_fraud) AS fr, sum(amount) AS v, max(amount) AS mx, {mean('amount')} AS m,
                         {rnd(div('max(amount)', div('sum(amount)', 'count(amount)')))} AS peak, count(DISTINCT recipient_id) AS recips,
                         count(*) FILTER (WHERE new_balance_orig = 0 AND old_balance_orig > 0) AS emptied,
                         {pct(f'count(*) FILTER (WHERE {OUT})', 'count(*)', 2)} AS outpct
                  FROM fact GROUP BY customer_id),
      points AS (SELECT *, CASE WHEN fr > 0 THEN 40 ELSE 0 END
                   + CASE WHEN peak > 50 THEN 25 WHEN peak > 20 THEN 20 WHEN peak > 10 THEN 15 WHEN peak > 5 THEN 10 ELSE 3 END
                   + CASE WHEN v > 5000000 THEN 15 WHEN v > 1000000 THEN 12 WHEN v > 500000 THEN 8 ELSE 3 END
                   + CASE WHEN emptied > 3 THEN 10 WHEN emptied > 1 THEN 7 WHEN emptied = 1 THEN 4 ELSE 0 END
                   + CASE WHEN outpct > 80 THEN 10 WHEN outpct > 50 THEN 7 ELSE 3 END AS raw FROM factor)
      SELECT customer_id, n AS total_txns, {cnt('fr fraud_txns')}, {num('v total_volume', 'mx max_single_txn')}, m AS avg_txn, peak AS max_to_avg_ratio,
             recips AS unique_recipients, emptied AS full_drain_count, outpct AS high_risk_type_pct, {cnt('least(raw,100) risk_score')},
             CASE WHEN fr > 0 THEN 'CRITICAL' WHEN raw >= 60 THEN 'HIGH' WHEN raw >= 35 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier
      FROM points""")
    o["risk_tier_distribution"] = stmt(f"""
      , tiers AS (SELECT customer_id, sum(is_fraud) AS fraud_count, CAST(max(amount) AS DOUBLE) AS top, {div('sum(amount)', 'count(amount)')} AS mid,
                        sum(amount) AS total_amount, {_TIER} AS risk_tier FROM fact GROUP BY customer_id)
      SELECT risk_tier, count(*) AS customer_count, {pct('count(*)', '(SELECT count(*) FROM tiers)', 2)} AS pct_of_customers FROM tiers GROUP BY risk_tier""")
    o["recipient_risk"] = stmt(f"""
      , inbound AS (SELECT recipient_id, count(*) AS n, sum(amount) AS v, {mean('amount')} AS m, count(DISTINCT customer_id) AS senders, sum(is_fraud) AS fr
                   FROM fact WHERE {OUT} GROUP BY recipient_id)
      SELECT recipient_id, n AS incoming_txns, {num('v total_received')}, m AS avg_received, senders AS unique_senders, {cnt('fr fraud_received')},
             CASE WHEN fr > 0 THEN 'CRITICAL' WHEN senders > 20 AND v > 1000000 THEN 'HIGH' WHEN senders > 10 OR v > 500000 THEN 'MEDIUM' ELSE 'LOW' END AS recipient_risk_tier
      FROM inbound ORDER BY fr DESC, v DESC, recipient_id LIMIT 100""")
    o["peer_comparison"] = stmt(f"""
      , deciles AS (SELECT customer_id, total_transactions AS n, total_amount AS v, risk_tier, fraud_count,
                          ntile(10) OVER (ORDER BY total_amount, customer_id) AS vd, ntile(10) OVER (ORDER BY total_transactions, customer_id) AS fd FROM dim)
      SELECT customer_id, n AS txn_count, {num('v total_amount')}, {cnt('vd volume_decile', 'fd frequency_decile')}, risk_tier, {cnt('fraud_count fraud_count')},
             CASE WHEN vd >= 9 AND fd >= 9 THEN 'OUTLIER - High Volume & Frequency' WHEN vd >= 9 THEN 'OUTLIER - High Volume' ELSE 'OUTLIER - High Frequency' END AS peer_comparison
      FROM deciles WHERE vd >= 9 OR fd >= 9 ORDER BY v DESC, customer_id LIMIT 50""", CUSTOMERS)
    o["dim_risk_load"] = stmt(f"SELECT {DIM_COLS}, {cnt('load_score risk_score')}, risk_tier FROM dim", CUSTOMERS)
    o["dim_risk_refresh"] = stmt(f"SELECT {DIM_COLS}, {cnt('refresh_score risk_score')}, risk_tier FROM dim", CUSTOMERS)
    o["dim_risk_refresh_summary"] = stmt(
        f"SELECT risk_tier, count(*) AS customer_count, {mean('refresh_score', 1)} AS avg_score FROM dim GROUP BY risk_tier", CUSTOMERS
    )

    # reports and views
    def change(x: str) -> str:
        return rnd(div(f"(CAST({x} AS DOUBLE) - CAST(lag({x}) OVER d AS DOUBLE)) * 100.0", f"lag({x}) OVER d"))

    o["daily_summary"] = stmt(f"""
      , days AS (SELECT transaction_day AS dy, count(*) AS n, sum(amount) AS v, {mean('amount')} AS m, sum(is_fraud) AS fr, count(DISTINCT customer_id) AS cu FROM fact GROUP BY dy)
      SELECT {cnt('dy transaction_day', 'n total_txns')}, {num('v total_volume')}, m AS avg_amount, {cnt('fr fraud_count')}, {pct('fr', 'n', 4)} AS fraud_rate_pct,
             cu AS active_customers, lag(n) OVER d AS prev_day_txns, {change('n')} AS txn_change_pct, {change('v')} AS volume_change_pct,
             {rnd(div('sum(n) OVER w', 'count(*) OVER w'), 0)} AS ma7_txns, {rnd(div('sum(fr) OVER w', 'count(*) OVER w'), 1)} AS ma7_fraud
      FROM days WINDOW d AS (ORDER BY dy), w AS (ORDER BY dy ROWS 6 PRECEDING)""")
    kinds = [("CASH_IN", "cash_in"), ("CASH_OUT", "cash_out"), ("TRANSFER", "transfer"), ("PAYMENT", "payment"), ("DEBIT", "debit")]
    o["type_breakdown_by_day"] = stmt(
        f"SELECT {cnt('transaction_day transaction_day')}, "
        + ", ".join(f"count(*) FILTER (WHERE transaction_type = '{k}') AS {n}_count" for k, n in kinds)
        + ", "
        + ", ".join(f"CAST(coalesce(sum(amount) FILTER (WHERE transaction_type = '{k}'), 0) AS DOUBLE) AS {n}" for k, n in (("TRANSFER", "transfer_volume"), ("CASH_OUT", "cashout_volume")))
        + f", count(*) FILTER (WHERE {OUT} AND is_fraud = 1) AS high_risk_fraud FROM fact GROUP BY transaction_day"
    )
    o["alert_summary"] = stmt(f"""
      SELECT alert_type, severity, count(*) AS total_alerts, {cnt('sum(reviewed) reviewed_count')}, {pct('sum(reviewed)', 'count(*)', 1)} AS review_rate_pct,
             count(*) FILTER (WHERE false_positive = 1) AS false_positives, count(*) FILTER (WHERE false_positive = 0) AS true_alerts,
             {pct('count(*) FILTER (WHERE false_positive = 1)', 'count(false_positive)', 1)} AS false_positive_rate_pct, {mean('amount')} AS avg_alerted_amount
      FROM alerts LEFT JOIN (SELECT transaction_id, amount FROM fact) f USING (transaction_id) GROUP BY alert_type, severity""", *ALERTING)
    o["tier_trend"] = stmt(f"""
      , g AS (SELECT transaction_day AS dy, risk_tier, count(DISTINCT customer_id) AS cu, sum(amount) AS v, sum(is_fraud) AS fr
             FROM fact JOIN dim USING (customer_id) GROUP BY dy, risk_tier)
      SELECT {cnt('dy transaction_day')}, risk_tier, cu AS active_customers, {num('v total_volume')},
             {cnt('fr fraud_count', 'sum(fr) OVER (PARTITION BY risk_tier ORDER BY dy) cumulative_fraud')} FROM g""", CUSTOMERS)
    o["compliance_scorecard"] = stmt(f"""
      , t AS (SELECT count(*) AS total_transactions, {num('sum(amount) total_volume')}, {mean('amount')} AS avg_transaction_amount, {cnt('sum(is_fraud) total_fraud_txns')},
                    {FRAUD_PCT4} AS overall_fraud_rate_pct, CAST(coalesce(sum(amount) FILTER (WHERE is_fraud = 1), 0) AS DOUBLE) AS total_fraud_volume,
                    count(*) FILTER (WHERE is_fraud = 1 AND is_flagged_fraud = 1) AS correctly_flagged,
                    count(*) FILTER (WHERE is_fraud = 1 AND is_flagged_fraud = 0) AS missed_fraud,
                    {pct('count(*) FILTER (WHERE is_fraud = 1 AND is_flagged_fraud = 1)', 'sum(is_fraud)', 2)} AS detection_rate_pct FROM fact),
      a AS (SELECT count(*) AS total_alerts_generated, {cnt('sum(reviewed) alerts_reviewed')},
                   {pct('count(*) FILTER (WHERE false_positive = 1)', 'count(false_positive)', 1)} AS false_positive_rate_pct FROM alerts),
      c AS (SELECT {", ".join(f"count(*) FILTER (WHERE risk_tier = '{x}') AS {x.lower()}_risk_customers" for x in ('CRITICAL', 'HIGH', 'MEDIUM', 'LOW'))} FROM dim)
      SELECT * FROM t, a, c""", *ALERTING)
    o["review_queue"] = stmt(f"""
      SELECT {cnt('transaction_id transaction_id')}, customer_id, recipient_id, transaction_type,
             {num('amount amount', 'old_balance_orig old_balance_orig', 'new_balance_orig new_balance_orig')}, {cnt('is_fraud is_fraud')},
             risk_tier AS customer_risk_tier, {cnt('refresh_score customer_risk_score')}, wt AS type_risk_weight,
             {rnd(f"CAST(refresh_score AS DOUBLE) * wt * {div('fact.amount', 'mid')}")} AS transaction_risk_score
      FROM fact JOIN dim USING (customer_id) JOIN (VALUES ('CASH_IN', 0.2::DOUBLE), ('CASH_OUT', 0.8), ('DEBIT', 0.4), ('PAYMENT', 0.3), ('TRANSFER', 0.9)) w(transaction_type, wt)
           USING (transaction_type)
      WHERE risk_tier IN ('CRITICAL', 'HIGH') ORDER BY transaction_risk_score DESC, fact.transaction_id LIMIT 20""", CUSTOMERS)
    o["daily_report"] = stmt(f"SELECT {REPORT_COLS} FROM report WHERE report_day = 10", *ALERTING, REPORTS)
    o["all_daily_reports"] = stmt(f"SELECT {REPORT_COLS} FROM report", *ALERTING, REPORTS)
    o["high_amount_alerts"] = stmt(f"SELECT {ALERT_CORE} FROM high_alerts WHERE transaction_id NOT IN (SELECT transaction_id FROM fact WHERE transaction_day < 15)", CUSTOMERS, HIGH_ALERTS)
    stamp = "strftime(alert_timestamp, '%Y-%m-%d %H:%M:%S') AS alert_timestamp"
    o["active_alerts"] = stmt(f"""
      SELECT {cnt('alert_id alert_id')}, {ALERT_CORE}, {stamp}, {num('amount amount')}, transaction_type,
             {num('old_balance_orig old_balance_orig', 'new_balance_orig new_balance_orig')}, risk_tier AS customer_risk_tier,
             {cnt('refresh_score customer_risk_score', 'total_transactions customer_total_txns')}
      FROM alerts LEFT JOIN (SELECT transaction_id, amount, transaction_type, old_balance_orig, new_balance_orig FROM fact) f USING (transaction_id)
           LEFT JOIN dim USING (customer_id) WHERE reviewed = 0""", *ALERTING)
    o["daily_dashboard"] = stmt(
        f"SELECT {REPORT_COLS}, {change('total_txns')} AS txn_change_pct, {change('fraud_count')} AS fraud_change_pct FROM report WINDOW d AS (ORDER BY report_day)",
        *ALERTING,
        REPORTS,
    )
    o["customer_360"] = stmt(f"""
      SELECT {DIM_COLS}, risk_tier, {cnt('refresh_score risk_score', 'last_seen_step-first_seen_step activity_span_hours')},
             {cnt('coalesce(al,0) total_alerts', 'coalesce(cr,0) critical_alerts', 'tr transfer_count', 'co cashout_count', 're unique_recipients')}
      FROM dim LEFT JOIN (SELECT customer_id, count(*) AS al, count(*) FILTER (WHERE severity = 'CRITICAL') AS cr FROM alerts GROUP BY 1) x USING (customer_id)
           JOIN (SELECT customer_id, count(*) FILTER (WHERE transaction_type = 'TRANSFER') AS tr, count(*) FILTER (WHERE transaction_type = 'CASH_OUT') AS co,
                        count(DISTINCT recipient_id) AS re FROM fact GROUP BY 1) y USING (customer_id)""", *ALERTING)
    o["report_latest_days"] = stmt(f"SELECT {REPORT_COLS} FROM report ORDER BY report.report_day DESC LIMIT 5", *ALERTING, REPORTS)
    o["report_tier_totals"] = stmt(
        f"SELECT risk_tier, count(*) AS customer_count, {mean('refresh_score', 1)} AS avg_score, {num('sum(total_amount) total_volume')} FROM dim GROUP BY risk_tier",
        CUSTOMERS,
    )
    o["report_recent_alerts"] = stmt(
        f"SELECT alert_type, severity, alert_description, detection_method, {stamp} FROM alerts ORDER BY alerts.alert_timestamp DESC, alert_id DESC LIMIT 100", *ALERTING
    )

    # hypothesis tests
    o["chi2_contingency"] = stmt(
        f"SELECT transaction_type, o0 AS legitimate, o1 AS fraud, {pct('o1', '(o0 + o1)', 4)} AS fraud_rate_pct FROM per_type", CHI_TYPE
    )
    o["chi2_independence"] = stmt(f"SELECT 'Chi-Square: Fraud x Type' AS test, {rnd('stat', 6)} AS statistic, {cnt('dof dof')}, {rnd('greatest(' + tail_chi2('stat', 'dof') + ', 0)', 6)} AS p_value FROM chi_type", CHI_TYPE)
    o["welch_t_test"] = stmt(f"""
      SELECT 'Welch t-test: Amount' AS test, {rnd('t', 6)} AS statistic, {rnd('dof', 4)} AS dof, {rnd('greatest(' + tail_t('t', 'dof') + ', 0)', 6)} AS p_value, {rnd('d', 6)} AS cohens_d,
             CASE WHEN abs(d) > 0.8 THEN 'large' WHEN abs(d) > 0.5 THEN 'medium' ELSE 'small' END AS effect,
             {", ".join(f"n{i} AS {p}_count, {rnd(f'm{i}')} AS {p}_mean, {rnd(f'd{i}', 4)} AS {p}_median, {rnd(f'sqrt(v{i})')} AS {p}_std, {num(f'a{i} {p}_min', f'z{i} {p}_max')}" for i, p in ((1, 'fraud'), (0, 'legit')))}
      FROM welch""", WELCH)
    drain_cols = ", ".join(
        f"""{rnd(f'avg(drain) FILTER (WHERE is_fraud = {i})', 6)} AS {p}_mean_drain, {rnd(f'stddev_samp(drain) FILTER (WHERE is_fraud = {i})', 6)} AS {p}_std_drain,
        {pct(f'count(*) FILTER (WHERE is_fraud = {i} AND drain > 0.8)', f'count(*) FILTER (WHERE is_fraud = {i})', 4)} AS {p}_over_80_pct"""
        for i, p in ((1, "fraud"), (0, "legit"))
    )
    o["point_biserial"] = stmt(
        f"SELECT 'Point-Biserial: Drain' AS test, {rnd('(SELECT r FROM biserial)', 6)} AS statistic, count(*) - 2 AS dof, {rnd('(SELECT greatest(' + tail_t('t', '(n - 2)') + ', 0) FROM biserial)', 6)} AS p_value, count(*) AS n, {drain_cols} FROM drains", BISERIAL
    )
    o["chi2_goodness"] = stmt(
        f"SELECT 'Chi-Square: Fraud by Hour' AS test, {rnd('stat', 6)} AS statistic, {cnt('dof dof', 'total_fraud total_fraud')}, {rnd('greatest(' + tail_chi2('stat', 'dof') + ', 0)', 6)} AS p_value FROM chi_hour", CHI_HOUR
    )
    o["chi2_goodness_hours"] = stmt(
        f"""SELECT {cnt('transaction_hour transaction_hour', 'observed observed')}, expected, {rnd(div('observed', 'expected'), 4)} AS ratio,
        CAST(CASE WHEN observed / expected > 1.2 OR observed / expected < 0.8 THEN 1 ELSE 0 END AS BIGINT) AS unusual FROM spread""",
        CHI_HOUR,
    )
    o["test_summary"] = stmt(f"""
      , results AS (
        SELECT 1 AS number, 'Chi-Square: Fraud x Type' AS test, stat, {tail_chi2('stat', 'dof')} AS p FROM chi_type
        UNION ALL SELECT 2, 'Welch t-test: Amount', t, {tail_t('t', 'dof')} FROM welch
        UNION ALL SELECT 3, 'Point-Biserial: Drain', r, {tail_t('t', '(n - 2)')} FROM biserial
        UNION ALL SELECT 4, 'Chi-Square: Fraud by Hour', stat, {tail_chi2('stat', 'dof')} FROM chi_hour)
      SELECT {cnt('number number')}, test, {rnd('stat', 6)} AS statistic, {rnd('greatest(p, 0)', 6)} AS p_value,
             CASE WHEN p < 0.05 THEN 'REJECT H0' ELSE 'FAIL TO REJECT' END AS verdict, {cnt('count(*) FILTER (WHERE p < 0.05) OVER () rejected_total')} FROM results""",
        CHI_TYPE, WELCH, BISERIAL, CHI_HOUR)

    # streaming and extensions
    o["streaming_hourly_velocity"] = f"""
      SELECT CASE WHEN event_id % 2 = 0 THEN 'C' || user_id ELSE 'C' || user_id || '_' || (event_id % 37) END AS customer_id,
             strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour_start, count(*) AS txn_count
      FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 2 HOUR
      GROUP BY ALL"""
    o["pass_through"] = stmt(f"""
      , pairs AS (SELECT b.transaction_id, b.customer_id, b.step, b.amount, b.is_fraud, a.amount AS got, a.step AS got_step
                 FROM fact b JOIN fact a ON a.recipient_id = b.customer_id AND a.step BETWEEN b.step - 3 AND b.step
                 WHERE b.transaction_type = 'CASH_OUT' AND a.transaction_type = 'TRANSFER')
      SELECT {cnt('transaction_id transaction_id')}, customer_id, {cnt('step step')}, {num('amount amount')}, {cnt('is_fraud is_fraud', 'count(*) inbound_count')},
             {num('sum(got) inbound_total')}, {cnt('max(got_step) last_inbound_step', 'step-max(got_step) steps_since_inbound')}
      FROM pairs GROUP BY transaction_id, customer_id, step, amount, is_fraud""")
    # cash-outs take what transfers have left, first in, first out: intervals on the line of the money that came in
    o["flow_trace"] = stmt("""
      , moves AS (SELECT recipient_id AS acct, step, transaction_id AS id, amount AS i, 0 AS o FROM fact WHERE transaction_type = 'TRANSFER'
                  UNION ALL SELECT customer_id, step, transaction_id, 0, amount FROM fact WHERE transaction_type = 'CASH_OUT'),
      sums AS (SELECT *, sum(i) OVER w AS came, sum(o) OVER w AS went FROM moves WINDOW w AS (PARTITION BY acct ORDER BY step, id ROWS UNBOUNDED PRECEDING)),
      least_lead AS (SELECT *, least(0, min(came - went) FILTER (WHERE o > 0) OVER w) AS lead FROM sums
                     WINDOW w AS (PARTITION BY acct ORDER BY step, id ROWS UNBOUNDED PRECEDING)),
      ins AS (SELECT acct, step, id, came - i AS a, came AS b FROM sums WHERE i > 0),
      outs AS (SELECT acct, step, id, coalesce(lag(went + lead) OVER (PARTITION BY acct ORDER BY step, id), 0) AS a, went + lead AS b FROM least_lead WHERE o > 0)
      SELECT ins.acct AS customer_id, CAST(ins.id AS BIGINT) AS transfer_id, CAST(outs.id AS BIGINT) AS cash_out_id,
             CAST(ins.step AS BIGINT) AS transfer_step, CAST(outs.step AS BIGINT) AS cash_out_step, CAST(least(ins.b, outs.b) - greatest(ins.a, outs.a) AS DOUBLE) AS amount
      FROM ins JOIN outs ON ins.acct = outs.acct AND ins.a < outs.b AND outs.a < ins.b""")
    o["incremental_detection"] = stmt(f"""
      , cut AS (SELECT *, least(transaction_day // 10, 2) AS batch FROM fact),
      rolled AS (SELECT *, avg(amount) OVER c AS m, stddev_samp(amount) OVER c AS s, avg(amount) OVER w AS rm, stddev_samp(amount) OVER w AS rs, count(*) OVER w AS n
                 FROM cut WINDOW c AS (PARTITION BY customer_id ORDER BY batch RANGE UNBOUNDED PRECEDING),
                                 w AS (PARTITION BY customer_id ORDER BY step, transaction_id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
      judged AS (SELECT *, CASE WHEN s > 0 THEN (CAST(amount AS DOUBLE) - m) / s ELSE 0 END AS z, CASE WHEN n >= 3 AND rs > 0 THEN 1 ELSE 0 END AS known FROM rolled)
      SELECT {ident}, customer_id, {num('amount amount')}, {cnt('batch batch')}, {rnd('z', 4)} AS z_score,
             {cnt('CASE WHEN abs(z) > 3 THEN 1 ELSE 0 END is_anomaly_zscore', 'known has_history', 'CASE WHEN known = 1 AND amount > rm + 2 * rs THEN 1 ELSE 0 END is_anomaly_rolling')}
      FROM judged""")
    hours_done = "date_trunc('milliseconds', {}) - INTERVAL {} HOUR"
    o["streaming_velocity_alerts"] = f"""
      WITH hours AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'C' || user_id ELSE 'C' || user_id || '_' || (event_id % 37) END AS customer_id, date_trunc('hour', ts) AS h, count(*) AS n
                     FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= {hours_done.format('(SELECT max(ts) FROM events)', 2)} GROUP BY 1, 2),
      before AS (SELECT *, avg(n) OVER w AS m, stddev_pop(n) OVER w AS s, count(*) OVER w AS k FROM hours
                 WINDOW w AS (PARTITION BY customer_id ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
      SELECT customer_id, strftime(h, '%Y-%m-%d %H:%M:%S') AS hour_start, n AS txn_count, {rnd('m', 6)} AS usual_mean, {rnd('s', 6)} AS usual_std,
             CASE WHEN s > 0 THEN {rnd('(n - m) / nullif(s, 0)')} END AS velocity_z_score,
             CASE WHEN s = 0 THEN 'MEDIUM' WHEN (n - m) / s > 3 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
      FROM before WHERE k >= 5 AND n > m + 2 * s"""
    o["streaming_pass_through"] = stmt(f"""
      , done AS (SELECT least({hours_done.format("max(ts) FILTER (WHERE event_type = 'click')", 2)},
                              max(date_trunc('hour', ts)) FILTER (WHERE event_type = 'purchase') - INTERVAL 3 HOUR) AS w FROM events),
      pairs AS (SELECT b.transaction_id, b.customer_id, b.step, b.amount, b.is_fraud, a.amount AS got, a.step AS got_step
                FROM fact b JOIN fact a ON a.recipient_id = b.customer_id AND a.step BETWEEN b.step - 3 AND b.step
                WHERE b.transaction_type = 'CASH_OUT' AND a.transaction_type = 'TRANSFER')
      SELECT {cnt('transaction_id transaction_id')}, customer_id, strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(step AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS hour_start,
             {num('amount amount')}, {cnt('is_fraud is_fraud', 'count(*) inbound_count')}, {num('sum(got) inbound_total')}, {cnt('step-max(got_step) steps_since_inbound')}
      FROM pairs, done WHERE TIMESTAMP '2024-01-01' + to_hours(CAST(step + 1 AS INTEGER)) <= w GROUP BY transaction_id, customer_id, step, amount, is_fraud""")
    o["refresh_from_deltas"] = o["dim_risk_refresh"]
    o["reports_kept_up"] = f"SELECT * REPLACE (CAST(0 AS BIGINT) AS alert_count) FROM ({o['all_daily_reports']})"
    o["distinct_by_period"] = stmt(
        " UNION ALL ".join(
            f"SELECT '{name}' AS kind, CAST(transaction_day // {days} AS BIGINT) AS period, count(DISTINCT customer_id) AS customers, count(DISTINCT recipient_id) AS recipients, true AS within FROM fact GROUP BY transaction_day // {days}"
            for name, days in (("day", 1), ("week", 7), ("month", 30))
        )
    )
    o["compacted_fact"] = stmt(f"SELECT {RAW_NO_ID}, {DERIVED} FROM fact")
    o["weekly_rollup"] = _rollup(7, "week")
    o["monthly_rollup"] = _rollup(30, "month")
    return o
