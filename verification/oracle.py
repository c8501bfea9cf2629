"""DuckDB SQL for the registered queries, written separately from the Spark side.

The SQL works on a long month table with ordinary window and regression
functions; the Spark side uses closed-form columns and range-wise totals.
"""

from __future__ import annotations


def _month(i: int) -> str:
    status = "PAY_0" if i == 1 else f"PAY_{i}"
    prior = f"BILL_AMT{i + 1}" if i < 6 else "NULL::DOUBLE"
    return (f'SELECT ID, LIMIT_BAL, {i} AS m, BILL_AMT{i} AS bill, PAY_AMT{i} AS paid, '
            f'{status} AS st, {prior} AS prior FROM panel')


def six(expression: str) -> str:
    """Six decimals, cut just beside the half: sums of cents over round limits do
    end in an exact half, where the last bit of either engine would decide."""
    return f"floor(({expression}) * 1e6 + 0.4999) / 1e6"


def half_up_six(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5) / 1e6"


def digits(expression: str, n: int) -> str:
    return f"floor(CAST({expression} AS DOUBLE) * 1e{n} + 0.5) / 1e{n}"


_price = "CAST(l_extendedprice AS DECIMAL(12,2))"
PANEL = f"""
o AS (SELECT o_orderkey, o_custkey, o_orderstatus AS s, 2001 - year(o_orderdate) AS m
      FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001),
cnt AS (SELECT o_custkey, m, COUNT(*) AS n_ord, COUNT(*) FILTER (WHERE s = 'O') AS n_open,
               COUNT(*) FILTER (WHERE s = 'P') AS n_part FROM o GROUP BY ALL),
money AS (SELECT o_custkey, m,
                 SUM(CASE WHEN l_returnflag = 'R' THEN -{_price} ELSE {_price} END) AS bill,
                 SUM({_price}) FILTER (WHERE l_linestatus = 'F') AS paid
          FROM o JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
grid AS (SELECT c_custkey AS k, g.m FROM customer, range(0, 7) g(m)),
hist AS (SELECT k, grid.m, coalesce(n_ord, 0) AS n_ord, coalesce(n_open, 0) AS n_open,
                coalesce(n_part, 0) AS n_part, CAST(coalesce(bill, 0) AS DOUBLE) AS bill,
                CAST(coalesce(paid, 0) AS DOUBLE) AS paid
         FROM grid LEFT JOIN cnt ON cnt.o_custkey = k AND cnt.m = grid.m
                   LEFT JOIN money ON money.o_custkey = k AND money.m = grid.m),
wide AS (SELECT k, MAX(n_open) FILTER (WHERE m = 0) AS open0, MAX(n_open) FILTER (WHERE m = 1) AS open1,
                SUM(n_open) FILTER (WHERE m IN (2, 3)) AS open23,
                {", ".join(f"MAX(CASE WHEN n_ord = 0 THEN -2 WHEN n_open = 0 AND n_part = 0 THEN -1 ELSE least(n_open, 8) END) FILTER (WHERE m = {i}) AS st{i}, MAX(bill) FILTER (WHERE m = {i}) AS bill{i}, MAX(paid) FILTER (WHERE m = {i}) AS paid{i}" for i in range(1, 7))}
         FROM hist GROUP BY k),
panel AS (SELECT c_custkey + 1 AS ID,
                 CAST(10000 + 10000 * floor(greatest(c_acctbal, 0) / 100) AS DOUBLE) AS LIMIT_BAL,
                 CAST(1 + c_custkey % 2 AS INTEGER) AS SEX, CAST(c_nationkey % 7 AS INTEGER) AS EDUCATION,
                 CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'AUTOMOBILE' THEN 1
                      WHEN 'MACHINERY' THEN 2 ELSE 3 END AS INTEGER) AS MARRIAGE,
                 CAST(21 + (c_custkey * 7) % 59 AS INTEGER) AS AGE,
                 {", ".join(f"CAST(st{i} AS INTEGER) AS PAY_{0 if i == 1 else i}" for i in range(1, 7))},
                 {", ".join(f"bill{i} AS BILL_AMT{i}" for i in range(1, 7))},
                 {", ".join(f"paid{i} AS PAY_AMT{i}" for i in range(1, 7))},
                 CAST(open0 >= 1 OR (open1 >= 1 AND c_custkey % 3 = 0)
                      OR (open23 >= 3 AND c_custkey % 2 = 0) AS INTEGER) AS default_next_month
          FROM customer JOIN wide ON wide.k = c_custkey)"""

CLEAN = PANEL + """,
clean AS (SELECT * REPLACE (CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS EDUCATION,
                            CASE WHEN MARRIAGE = 0 THEN 3 ELSE MARRIAGE END AS MARRIAGE) FROM panel)"""


def _trend(value: str) -> str:
    return (f"CASE WHEN MAX({value}) = MIN({value}) THEN 0.0 "
            f"ELSE regr_slope({value}, 6 - m) END")


FEATURES = CLEAN + f""",
long AS ({" UNION ALL ".join(_month(i) for i in range(1, 7))}),
ratio AS (SELECT *, greatest(least(bill / LIMIT_BAL, 3), -2) AS util,
                 CASE WHEN prior > 0 THEN least(paid / prior, 5) END AS cov FROM long),
present AS (SELECT ID, cov, row_number() OVER (PARTITION BY ID ORDER BY m DESC) AS x
            FROM ratio WHERE cov IS NOT NULL),
covered AS (SELECT ID, AVG(cov) AS PAYCOV_AVG,
                   CASE WHEN COUNT(*) < 2 THEN NULL WHEN MAX(cov) = MIN(cov) THEN 0.0
                        ELSE regr_slope(cov, x) END AS PAYCOV_TREND FROM present GROUP BY ID),
derived AS (SELECT ID,
    {", ".join(f"MAX(util) FILTER (WHERE m = {i}) AS UTIL_{i}" for i in range(1, 7))},
    {", ".join(f"MAX(cov) FILTER (WHERE m = {i}) AS PAYCOV_{i}" for i in range(1, 6))},
    AVG(util) AS UTIL_AVG, MAX(util) AS UTIL_MAX, MIN(util) AS UTIL_MIN,
    MAX(util) FILTER (WHERE m = 1) AS UTIL_LATEST, stddev_pop(util) AS UTIL_VOLATILITY,
    {_trend("util")} AS UTIL_TREND, MAX(cov) FILTER (WHERE m = 1) AS PAYCOV_LATEST,
    CAST(COUNT(*) FILTER (WHERE st > 0) AS INTEGER) AS N_MONTHS_DELINQUENT,
    CAST(MAX(greatest(st, 0)) AS INTEGER) AS MAX_DELINQUENCY,
    AVG(greatest(st, 0)) AS AVG_DELINQUENCY_SEVERITY,
    CAST(COUNT(*) FILTER (WHERE st > 0 AND m = 1) AS INTEGER) AS RECENT_DELINQUENCY,
    CAST(MAX(st) >= 3 AS INTEGER) AS SEVERE_DELINQUENCY_FLAG,
    CAST(COUNT(*) FILTER (WHERE st > 0) >= 3 AS INTEGER) AS PERSISTENT_DELINQUENCY_FLAG,
    AVG(bill) AS BILL_AVG, MAX(bill) FILTER (WHERE m = 1) AS BILL_LATEST, MAX(bill) AS BILL_MAX,
    {_trend("bill")} AS BILL_TREND, stddev_pop(bill) AS BILL_VOLATILITY,
    AVG(paid) AS PAYAMT_AVG, MAX(paid) FILTER (WHERE m = 1) AS PAYAMT_LATEST, MAX(paid) AS PAYAMT_MAX,
    {_trend("paid")} AS PAYAMT_TREND, stddev_pop(paid) AS PAYAMT_VOLATILITY,
    MAX(util) FILTER (WHERE m = 1) AS BALANCE_TO_LIMIT_LATEST,
    MAX(greatest(least(paid / LIMIT_BAL, 2), 0)) FILTER (WHERE m = 1) AS PAYMENT_CAPACITY,
    CAST(COUNT(*) FILTER (WHERE m = 1 AND util > 0.8 AND st > 0) AS INTEGER) AS UTILIZATION_STRESS_FLAG
  FROM ratio GROUP BY ID),
feat AS (SELECT * FROM clean JOIN derived USING (ID) LEFT JOIN covered USING (ID))"""


def _score(months: float, late: float, util: float, start: float = -2.0) -> str:
    return half_up_six(f"1 / (1 + exp(-({start} + {months} * N_MONTHS_DELINQUENT + {late} * greatest(PAY_0, 0)"
               f" + {util} * UTIL_AVG)))")


SCORED = FEATURES + f""",
pop AS MATERIALIZED (SELECT *, default_next_month AS actual_default, {_score(0.35, 0.45, 0.10)} AS predicted_pd,
        CASE WHEN row_number() OVER (PARTITION BY default_next_month ORDER BY md5(CAST(ID AS VARCHAR)), ID)
             <= floor(0.25 * COUNT(*) OVER (PARTITION BY default_next_month)) THEN 'test' ELSE 'train' END AS fold
        FROM feat),
cuts AS (SELECT quantile_cont(predicted_pd, 0.5) AS low_max, quantile_cont(predicted_pd, 0.8) AS moderate_max,
                quantile_cont(predicted_pd, 0.95) AS high_max FROM pop WHERE fold = 'train'),
banded AS (SELECT pop.*, CASE WHEN predicted_pd < 0 OR predicted_pd > 1 THEN NULL
                              WHEN predicted_pd <= low_max THEN 'Low Risk'
                              WHEN predicted_pd <= moderate_max THEN 'Moderate Risk'
                              WHEN predicted_pd <= high_max THEN 'High Risk'
                              ELSE 'Very High Risk' END AS risk_band FROM pop, cuts),
scored AS (SELECT * FROM banded WHERE fold = 'test'),
train AS (SELECT * FROM pop WHERE fold = 'train')"""

MODELS = SCORED + f""",
two AS (SELECT 'first' AS model, predicted_pd AS p, actual_default AS y FROM scored
        UNION ALL SELECT 'second', {_score(0.20, 0.60, 0.30, -1.5)}, actual_default FROM scored),
curve AS (SELECT *, SUM(y) OVER w AS tp, SUM(1 - y) OVER w AS fp, SUM(y) OVER a AS np, SUM(1 - y) OVER a AS nn
          FROM two WINDOW w AS (PARTITION BY model ORDER BY p DESC RANGE UNBOUNDED PRECEDING),
                          a AS (PARTITION BY model)),
pts AS (SELECT model, p, MAX(tp)::DOUBLE AS tp, MAX(fp)::DOUBLE AS fp, SUM(y)::DOUBLE AS dp,
               SUM(1 - y)::DOUBLE AS dn, MAX(np)::DOUBLE AS np, MAX(nn)::DOUBLE AS nn
        FROM curve GROUP BY model, p),
ranks AS (SELECT model, SUM(dn * (tp - 0.5 * dp)) / (MAX(np) * MAX(nn)) AS roc_auc,
                 SUM(dp / np * (tp / (tp + fp))) AS pr_auc, MAX(abs(tp / np - fp / nn)) AS ks
          FROM pts GROUP BY model),
cells AS (SELECT model, AVG(power(p - y, 2)) AS brier_score,
                 COUNT(*) FILTER (WHERE p < 0.5 AND y = 0) AS tn, COUNT(*) FILTER (WHERE p >= 0.5 AND y = 0) AS fp,
                 COUNT(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn, COUNT(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp
          FROM two GROUP BY model),
classed AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS "precision",
                   CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
                   CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1 FROM cells)"""


def psi(expected: str, actual: str, features: list[str], by: str = "1", value=lambda f: f"CAST({f} AS DOUBLE)") -> str:
    """CTEs ending in `psi(period, feature, psi)`; one long row per value."""
    sides = " UNION ALL ".join(
        f"SELECT 'e' AS side, 0 AS period, '{f}' AS feature, {value(f)} AS v FROM {expected} "
        f"UNION ALL SELECT 'a', {by}, '{f}', {value(f)} FROM {actual}" for f in features)
    return f"""
vals AS (SELECT * FROM ({sides}) WHERE v IS NOT NULL),
cut AS (SELECT DISTINCT feature, c FROM (SELECT feature, unnest(quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS c
        FROM vals WHERE side = 'e' GROUP BY feature)),
edge AS (SELECT feature, c AS lo, lead(c, 1, 'inf'::DOUBLE) OVER (PARTITION BY feature ORDER BY c) AS hi FROM cut
         UNION ALL SELECT feature, '-inf'::DOUBLE, MIN(c) FROM cut GROUP BY feature),
periods AS (SELECT DISTINCT feature, period FROM vals WHERE side = 'a'),
binned AS (SELECT feature, period, lo,
    (SELECT COUNT(*) FROM vals v WHERE v.side = 'e' AND v.feature = edge.feature AND v.v >= lo AND v.v < hi)
      / (SELECT COUNT(*) FROM vals v WHERE v.side = 'e' AND v.feature = edge.feature) AS e,
    (SELECT COUNT(*) FROM vals v WHERE v.side = 'a' AND v.period = periods.period AND v.feature = edge.feature AND v.v >= lo AND v.v < hi)
      / (SELECT COUNT(*) FROM vals v WHERE v.side = 'a' AND v.period = periods.period AND v.feature = edge.feature) AS a
    FROM edge JOIN periods USING (feature)),
psi AS (SELECT feature, period, SUM((greatest(a, CASE WHEN a = 0 THEN 1e-6 ELSE 0 END) - CASE WHEN e = 0 THEN 1e-6 ELSE e END)
               * ln((CASE WHEN a = 0 THEN 1e-6 ELSE a END) / (CASE WHEN e = 0 THEN 1e-6 ELSE e END))) AS psi
        FROM binned GROUP BY feature, period)"""
