"""Independent SQL for the named queries, written for DuckDB over the same tables.

Each statement derives its panel from the order tables and states the result by the definition
(plain ordered windows, direct quantiles, day-by-day lookups), not by the way the operators work.
"""

from __future__ import annotations

from shelfcast.operators.rolling import PATTERN_COLUMNS
from shelfcast.schema import LAGS, SHAPE_WINDOWS, WINDOWS

LINES = """
lines AS (
  SELECT l.*, cast(l_shipdate AS DATE) AS date, r_name AS store, p_type AS item
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

SALES = LINES + """,
sales AS (SELECT date, store, item, sum(l_quantity) AS sales FROM lines GROUP BY ALL)"""

DENSE = SALES + """,
days AS (SELECT store, item, cast(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
         FROM sales GROUP BY store, item),
dense AS (SELECT d.date, d.store, d.item, coalesce(s.sales, 0.0) AS sales
          FROM days d LEFT JOIN sales s ON s.store = d.store AND s.item = d.item AND s.date = d.date)"""

RAW = LINES + """,
raw AS (SELECT cast(date AS VARCHAR) AS date, store, item,
  CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_linenumber = 6 AND l_returnflag = 'R' THEN NULL
       ELSE cast(cast(l_quantity AS INT) AS VARCHAR) END AS sales,
  CASE WHEN l_linenumber <> 2 THEN cast(l_tax AS VARCHAR) END AS price FROM lines)"""

DIRTY = LINES + """,
dirty AS (SELECT
  CASE WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN 'unknown' ELSE cast(date AS VARCHAR) END AS date, store, item,
  CASE WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN NULL
       WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS sales FROM lines)"""

CUTS = """,
cuts AS (SELECT max(date) - 89 AS test_start, max(date) - 179 AS validation_start, max(date) AS max_date,
                min(date) AS min_date FROM sales)"""

SPLIT = SALES + CUTS + """,
split AS (SELECT s.*, CASE WHEN date < validation_start THEN 'train' WHEN date < test_start THEN 'validation'
                      ELSE 'test' END AS split FROM sales s, cuts)"""


def r(expression: str, name: str = "", digits: int = 6) -> str:
    rounded = f"round(cast({expression} AS DOUBLE) + 1e-10, {digits}) + 0.0"
    return f"{rounded} AS {name}" if name else rounded


def d(expression: str, name: str) -> str:
    return f"cast({expression} AS VARCHAR) AS {name}"


def n(expression: str, name: str) -> str:
    return f"cast({expression} AS BIGINT) AS {name}"


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


# ---- feature pieces -----------------------------------------------------------------------------

FRAMES = ", ".join(f"r{k} AS (w ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)" for k in WINDOWS)
WINDOW = f"WINDOW w AS (PARTITION BY store, item ORDER BY date), {FRAMES}"

LAG_COLUMNS = {f"sales_lag_{k}": f"lag(sales, {k}) OVER w" for k in LAGS}
LAG_RATIOS = {
    "sales_lag_delta_7_14": "sales_lag_7 - sales_lag_14",
    "sales_lag_ratio_7_28": "CASE WHEN sales_lag_28 IS NOT NULL THEN sales_lag_7 / greatest(sales_lag_28, 1e-6) END",
    "sales_same_weekday_4wk_mean": "list_avg([sales_lag_7, sales_lag_14, sales_lag_28])",
}


def _guarded(k: int, value: str) -> str:
    return f"CASE WHEN count(sales) OVER r{k} >= {max(2, k // 2)} THEN {value} OVER r{k} END"


ROLLING_COLUMNS: dict[str, str] = {}
for _k in WINDOWS:
    ROLLING_COLUMNS[f"sales_rolling_mean_{_k}"] = _guarded(_k, "avg(sales)")
    if _k in SHAPE_WINDOWS:
        ROLLING_COLUMNS[f"sales_rolling_median_{_k}"] = _guarded(_k, "quantile_cont(sales, 0.5)")
        ROLLING_COLUMNS[f"sales_rolling_std_{_k}"] = _guarded(_k, "stddev_samp(sales)")
        ROLLING_COLUMNS[f"sales_rolling_min_{_k}"] = _guarded(_k, "min(sales)")
        ROLLING_COLUMNS[f"sales_rolling_max_{_k}"] = _guarded(_k, "max(sales)")

PATTERN_EXPRESSIONS = {
    "recent_zero_sales_28": "CASE WHEN row_number() OVER w >= 7 THEN coalesce(sum(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) OVER r28, 0.0) END",
    "sales_trend_28": "CASE WHEN count(sales) OVER r28 >= 14 THEN avg(step) OVER (w ROWS BETWEEN 27 PRECEDING AND 1 PRECEDING) END",
}
PATTERN_RATIOS = {
    "sales_cv_28": "sales_rolling_std_28 / greatest(sales_rolling_mean_28, 1e-6)",
    "sales_momentum_7_28": "CASE WHEN sales_rolling_mean_28 IS NOT NULL THEN sales_rolling_mean_7 / greatest(sales_rolling_mean_28, 1e-6) END",
    "intermittency_score_28": "recent_zero_sales_28 / 28",
}

CALENDAR = {
    "day_of_week": "cast(isodow(date) - 1 AS VARCHAR)",
    "month": "cast(month(date) AS VARCHAR)",
    "day_of_month": "cast(day(date) AS BIGINT)",
    "week_of_year": "cast(weekofyear(date) AS BIGINT)",
    "is_weekend": "cast(isodow(date) >= 6 AS BIGINT)",
    "is_month_start": "cast(day(date) = 1 AS BIGINT)",
    "is_month_end": "cast(date = last_day(date) AS BIGINT)",
    "quarter": "cast(quarter(date) AS VARCHAR)",
    "year_index": "cast(year(date) - (SELECT min(year(date)) FROM sales) AS BIGINT)",
}


def columns(named: dict[str, str], rounded: bool = False) -> str:
    return ", ".join(r(e, c) if rounded else f"{e} AS {c}" for c, e in named.items())


def expanding(keys: str, order: str, least: int, name: str) -> str:
    over = f"OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count(sales) {over} >= {least} THEN avg(sales) {over} END AS {name}"


HISTORY = ", ".join(
    [
        expanding("store", "item, date", 7, "store_historical_mean"),
        expanding("item", "store, date", 7, "item_historical_mean"),
        expanding("store, item", "date", 7, "store_item_historical_mean"),
        expanding("store, isodow(date)", "item, date", 3, "store_day_of_week_historical_mean"),
        expanding("item, isodow(date)", "store, date", 3, "item_day_of_week_historical_mean"),
        expanding("store, month(date)", "item, date", 3, "store_month_historical_mean"),
        expanding("item, month(date)", "store, date", 3, "item_month_historical_mean"),
    ]
)
HISTORY_NAMES = [
    f"{p}_historical_mean"
    for p in ("store", "item", "store_item", "store_day_of_week", "item_day_of_week", "store_month", "item_month")
]


def chrono(keys: str, least: int, name: str) -> str:
    over = f"OVER (PARTITION BY {keys} ORDER BY date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING)"
    return f"CASE WHEN count(sales) {over} >= {least} THEN sum(sales) {over} / count(sales) {over} END AS {name}"


CHRONO = ", ".join(
    [
        chrono("store", 7, "store_historical_mean"),
        chrono("item", 7, "item_historical_mean"),
        chrono("store, item", 7, "store_item_historical_mean"),
        chrono("store, isodow(date)", 3, "store_day_of_week_historical_mean"),
        chrono("item, isodow(date)", 3, "item_day_of_week_historical_mean"),
        chrono("store, month(date)", 3, "store_month_historical_mean"),
        chrono("item, month(date)", 3, "item_month_historical_mean"),
    ]
)

# Federal holidays of the years around the panel, by rule, plus observed days.
HOLIDAYS = """,
years AS (SELECT unnest(range((SELECT min(year(date)) - 1 FROM sales), (SELECT max(year(date)) + 3 FROM sales))) AS y),
firsts AS (SELECT y, m, make_date(y, m, 1) AS f FROM years, (SELECT unnest(range(1, 13)) AS m)),
rules AS (
  SELECT make_date(y, 1, 1) AS h FROM years
  UNION ALL SELECT make_date(y, 6, 19) FROM years WHERE y >= 2021
  UNION ALL SELECT make_date(y, 7, 4) FROM years
  UNION ALL SELECT make_date(y, 11, 11) FROM years
  UNION ALL SELECT make_date(y, 12, 25) FROM years
  UNION ALL SELECT f + cast((8 - isodow(f)) % 7 + 14 AS INT) FROM firsts WHERE m IN (1, 2)
  UNION ALL SELECT f + cast((8 - isodow(f)) % 7 AS INT) FROM firsts WHERE m = 9
  UNION ALL SELECT f + cast((8 - isodow(f)) % 7 + 7 AS INT) FROM firsts WHERE m = 10
  UNION ALL SELECT f + cast((11 - isodow(f)) % 7 + 21 AS INT) FROM firsts WHERE m = 11
  UNION ALL SELECT last_day(f) - cast(isodow(last_day(f)) - 1 AS INT) FROM firsts WHERE m = 5),
holidays AS (
  SELECT DISTINCT h FROM (
    SELECT h FROM rules UNION ALL SELECT h - 1 FROM rules WHERE isodow(h) = 6
    UNION ALL SELECT h + 1 FROM rules WHERE isodow(h) = 7)
  WHERE year(h) <= (SELECT max(year(date)) + 1 FROM sales)),
holiday_days AS (
  SELECT date, cast(cast(bool_or(h = date) AS INT) AS VARCHAR) AS is_us_holiday,
         min(abs(h - date)) AS days_to_nearest_us_holiday
  FROM (SELECT DISTINCT date FROM sales), holidays GROUP BY date)"""

ALL_FEATURES = (
    SALES
    + HOLIDAYS
    + f""",
stepped AS (SELECT *, sales - lag(sales) OVER (PARTITION BY store, item ORDER BY date) AS step FROM sales),
windowed AS (SELECT *, {columns(LAG_COLUMNS)}, {columns(ROLLING_COLUMNS)}, {columns(PATTERN_EXPRESSIONS)}
             FROM stepped {WINDOW}),
past AS (SELECT store, item, date, {HISTORY} FROM sales),
featured AS (
  SELECT date, store, item, sales, {columns(CALENDAR)},
         is_us_holiday, cast(days_to_nearest_us_holiday AS BIGINT) AS days_to_nearest_us_holiday,
         {", ".join(LAG_COLUMNS)}, {columns(LAG_RATIOS)}, {", ".join(ROLLING_COLUMNS)}, {", ".join(HISTORY_NAMES)},
         {", ".join(PATTERN_EXPRESSIONS)}, {columns(PATTERN_RATIOS)}
  FROM windowed JOIN past USING (store, item, date) JOIN holiday_days USING (date))"""
)

DERIVED = [*LAG_COLUMNS, *LAG_RATIOS, *ROLLING_COLUMNS, *HISTORY_NAMES, *PATTERN_COLUMNS]
FEATURE_SELECT = f"""SELECT {d("date", "date")}, store, item, sales, {", ".join(c for c in CALENDAR)},
  is_us_holiday, days_to_nearest_us_holiday, {", ".join(r(c, c) for c in DERIVED)} FROM featured"""

# ---- ridge in closed form -----------------------------------------------------------------------

# The levels that the panel of regions and part types can have in the categorical inputs.
RIDGE_LEVELS = {
    "store": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "item": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
    "day_of_week": [str(k) for k in range(7)],
    "month": [str(k) for k in range(1, 13)],
    "quarter": [str(k) for k in range(1, 5)],
    "is_us_holiday": ["0", "1"],
}
RIDGE_NUMBERS = [c for c in CALENDAR if c not in RIDGE_LEVELS] + ["days_to_nearest_us_holiday", *DERIVED]
RIDGE_SLOTS = [f"{c}_{v}" for c, values in RIDGE_LEVELS.items() for v in values] + RIDGE_NUMBERS
RIDGE_WIDTH = 1 + sum(map(len, RIDGE_LEVELS.values())) + len(RIDGE_NUMBERS)
_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in DERIVED)
_INPUTS = ["1.0", *[f"({c} = '{v}')::DOUBLE" for c, values in RIDGE_LEVELS.items() for v in values]]
_INPUTS += [f"(({c} - m_{c}) / s_{c})" for c in RIDGE_NUMBERS]
_PLACES = range(RIDGE_WIDTH)
_ROWS = ", ".join(
    f"[{', '.join(f'g[{max(i, j) * (max(i, j) + 1) // 2 + min(i, j) + 1}]' + (' + 1' if i == j > 0 else '') for j in _PLACES)}, b[{i + 1}]]"
    for i in _PLACES
)

# All weights at once by elimination: the matrix is positive definite, so pivots are taken in order.
RIDGE_ROWS = (
    ALL_FEATURES
    + f""",
complete AS MATERIALIZED (SELECT * FROM featured WHERE {_COMPLETE}),
known AS MATERIALIZED (SELECT * FROM complete WHERE date < (SELECT max(date) - 89 FROM complete))"""
)
RIDGE = (
    RIDGE_ROWS
    + f""",
scale AS (SELECT {", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in RIDGE_NUMBERS)} FROM known),
design AS MATERIALIZED (SELECT date, store, item, sales, {", ".join(f"{x} AS x{i}" for i, x in enumerate(_INPUTS))} FROM complete, scale),
learned AS (SELECT * FROM design WHERE date < (SELECT max(date) - 89 FROM complete)),
sums AS (SELECT [{", ".join(f"sum(x{i} * x{j})" for i in _PLACES for j in range(i + 1))}] AS g,
                [{", ".join(f"sum(x{i} * sales)" for i in _PLACES)}] AS b FROM learned),
solving AS (
  SELECT 1 AS k, [{_ROWS}] AS m FROM sums
  UNION ALL
  SELECT k + 1, list_transform(m, lambda row, i: CASE WHEN i = k THEN list_transform(row, lambda v: v / p[k])
           ELSE list_transform(range(1, {RIDGE_WIDTH + 2}), lambda j: row[j] - row[k] / p[k] * p[j]) END)
  FROM (SELECT k, m, m[k] AS p FROM solving) WHERE k <= {RIDGE_WIDTH}
),
weights AS (SELECT list_transform(m, lambda row: row[{RIDGE_WIDTH + 1}]) AS w FROM solving WHERE k = {RIDGE_WIDTH + 1})"""
)

# ---- evaluation pieces --------------------------------------------------------------------------


def metrics(actual: str = "sales", predicted: str = "prediction") -> str:
    error = f"abs({actual} - {predicted})"
    return ", ".join(
        [
            r(f"avg({error})", "mae"),
            r(f"sqrt(avg({error} * {error}))", "rmse"),
            r(f"avg({error} / greatest(abs({actual}), 1e-8))", "mape"),
            r(f"avg({error} / greatest((abs({actual}) + abs({predicted})) / 2, 1e-8))", "smape"),
        ]
    )


def naive(train: str, test: str, name: str) -> str:
    """Seasonal naive of one part of ``split`` against others."""
    return f""",
{name}_history AS (SELECT * FROM split WHERE split IN ({train})),
{name}_mean AS (SELECT store, item, avg(sales) AS m FROM {name}_history GROUP BY store, item),
{name} AS (
  SELECT t.store, t.item, t.date, t.sales, coalesce(h.sales, m.m) AS prediction
  FROM (SELECT * FROM split WHERE split = {test}) t
  LEFT JOIN {name}_history h ON h.store = t.store AND h.item = t.item AND h.date = t.date - 7
  LEFT JOIN {name}_mean m ON m.store = t.store AND m.item = t.item)"""


TEST_NAIVE = SPLIT + naive("'train', 'validation'", "'test'", "tested")
BOTH_NAIVE = TEST_NAIVE + naive("'train'", "'validation'", "validated")

ROLLED = f""",
rolled AS (SELECT s.*, {ROLLING_COLUMNS["sales_rolling_mean_7"]} AS m7 FROM split s {WINDOW}),
averaged AS (SELECT date, store, item, sales,
  coalesce(m7, (SELECT avg(m7) FROM rolled WHERE split = 'validation')) AS prediction
  FROM rolled WHERE split = 'validation')"""

FOLDS = """,
folds AS (SELECT cast(k AS BIGINT) AS fold, max_date - 111 + 28 * cast(k - 1 AS INT) AS test_start,
                 max_date - 111 + 28 * cast(k - 1 AS INT) + 27 AS test_end
          FROM cuts, (SELECT unnest(range(1, 4)) AS k)),
bounds AS (SELECT f.fold, f.test_start, f.test_end, max(CASE WHEN s.date < f.test_start THEN s.date END) AS train_end,
                  count(CASE WHEN s.date BETWEEN f.test_start AND f.test_end THEN 1 END) AS rows
           FROM folds f, sales s GROUP BY ALL)"""

BACKTEST = (
    SPLIT
    + FOLDS
    + f""",
rolled AS (SELECT s.*, {ROLLING_COLUMNS["sales_rolling_mean_7"]} AS m7 FROM sales s {WINDOW}),
tests AS (SELECT f.fold, f.test_start, t.* FROM folds f JOIN rolled t ON t.date BETWEEN f.test_start AND f.test_end),
means AS (SELECT f.fold, s.store, s.item, avg(s.sales) AS m FROM folds f JOIN sales s ON s.date < f.test_start
          GROUP BY ALL),
predicted AS (
  SELECT 'seasonal_naive_7' AS model, t.fold, t.sales, coalesce(h.sales, m.m) AS prediction
  FROM tests t LEFT JOIN sales h ON h.store = t.store AND h.item = t.item AND h.date = t.date - 7
       AND h.date < t.test_start
  LEFT JOIN means m ON m.fold = t.fold AND m.store = t.store AND m.item = t.item
  UNION ALL
  SELECT 'moving_average_7', t.fold, t.sales, coalesce(t.m7, avg(t.m7) OVER (PARTITION BY t.fold)) FROM tests t)"""
)

# ---- drift pieces -------------------------------------------------------------------------------

BUSINESS = LINES + """,
business AS (SELECT date, store, item, sum(l_quantity) AS sales, sum(l_extendedprice) / sum(l_quantity) AS price,
                    max(CASE WHEN l_discount >= 0.05 THEN 1.0 ELSE 0.0 END) AS promotion_flag,
                    strftime(date, '%Y-%m') AS sales_month FROM lines GROUP BY ALL),
sided AS (SELECT *, date < (SELECT max(date) - 89 FROM business) AS ref FROM business),
numbers AS (SELECT ref, feature, value FROM sided UNPIVOT (value FOR feature IN (sales, price, promotion_flag))),
q AS (SELECT feature, list_distinct(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS qs,
             min(value) AS lo, max(value) AS hi FROM numbers WHERE ref GROUP BY feature),
edges AS (SELECT feature, CASE WHEN len(qs) >= 3 THEN list_sort(qs)
            ELSE list_transform(range(0, 11), lambda i: lo + i * (hi + 1e-6 - lo) / 10) END AS es FROM q),
bins AS (SELECT feature, i, es[i] AS a, es[i + 1] AS b, i = len(es) - 1 AS final
         FROM (SELECT feature, es, unnest(range(1, len(es))) AS i FROM edges)),
hits AS (SELECT b.feature, b.i, count(CASE WHEN ref THEN 1 END) AS rn, count(CASE WHEN NOT ref THEN 1 END) AS cn
         FROM bins b JOIN numbers x ON x.feature = b.feature AND x.value >= b.a
              AND (x.value < b.b OR (b.final AND x.value = b.b)) GROUP BY ALL),
shares AS (SELECT feature, greatest(rn / sum(rn) OVER f, 1e-6) AS rp, greatest(cn / sum(cn) OVER f, 1e-6) AS cp
           FROM hits WINDOW f AS (PARTITION BY feature)),
psi AS (SELECT feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM shares GROUP BY feature),
numeric_drift AS (
  SELECT feature, avg(CASE WHEN ref THEN value END) AS reference_mean,
         avg(CASE WHEN NOT ref THEN value END) AS current_mean,
         (avg(CASE WHEN NOT ref THEN value END) - avg(CASE WHEN ref THEN value END))
           / stddev_samp(CASE WHEN ref THEN value END) AS standardized_mean_shift,
         any_value(psi) AS psi, 0.0 AS reference_missing_rate, 0.0 AS current_missing_rate
  FROM numbers JOIN psi USING (feature) GROUP BY feature),
levels AS (SELECT ref, feature, value FROM sided UNPIVOT (value FOR feature IN (store, item, sales_month))),
counted AS (SELECT feature, value, count(CASE WHEN ref THEN 1 END) AS rn, count(CASE WHEN NOT ref THEN 1 END) AS cn
            FROM levels GROUP BY ALL),
categorical_drift AS (
  SELECT feature, count(CASE WHEN rn > 0 THEN 1 END) AS reference_unique,
         count(CASE WHEN cn > 0 THEN 1 END) AS current_unique,
         sum(CASE WHEN rn = 0 THEN cn ELSE 0 END) / sum(cn) AS new_category_rate,
         0.0 AS reference_missing_rate, 0.0 AS current_missing_rate
  FROM counted GROUP BY feature),
findings AS (
  SELECT feature, 'psi' AS kind, abs(psi) AS value, 0.2 AS threshold,
         'Numeric distribution shifted by PSI threshold.' AS description FROM numeric_drift
  UNION ALL SELECT feature, 'mean_shift', abs(standardized_mean_shift), 2.0,
         'Numeric mean shifted relative to reference standard deviation.' FROM numeric_drift
  UNION ALL SELECT feature, 'new_category_rate', new_category_rate, 0.01,
         'Current data contains unseen categorical levels.' FROM categorical_drift)"""

NUMERIC_NAMES = ["reference_mean", "current_mean", "standardized_mean_shift", "psi"]
RATE_NAMES = ["reference_missing_rate", "current_missing_rate"]
NUMERIC_SELECT = ", ".join(r(c, c) for c in [*NUMERIC_NAMES, *RATE_NAMES])
CATEGORICAL_SELECT = ", ".join(
    [*[n(c, c) for c in ("reference_unique", "current_unique")], *[r(c, c) for c in ["new_category_rate", *RATE_NAMES]]]
)

DRIFT_SUMMARY = f"""
SELECT feature, 'numeric' AS feature_type, {NUMERIC_SELECT}, cast(NULL AS BIGINT) AS reference_unique,
  cast(NULL AS BIGINT) AS current_unique, cast(NULL AS DOUBLE) AS new_category_rate FROM numeric_drift
UNION ALL BY NAME
SELECT feature, 'categorical' AS feature_type, {CATEGORICAL_SELECT} FROM categorical_drift"""
DRIFT_FINDINGS = f"""
SELECT feature, kind, {r("value", "value")}, cast(threshold AS DOUBLE) AS threshold, 'warning' AS severity, description
FROM findings WHERE value >= threshold"""

# Every column of the feature table.
_TAIL = BUSINESS[BUSINESS.index("q AS (") :]
_NUMBERS = ["sales", *RIDGE_NUMBERS]
FEATURE_DRIFT = (
    ALL_FEATURES
    + f""",
sided AS (SELECT *, date < (SELECT max(date) - 89 FROM sales) AS ref FROM featured WHERE {_COMPLETE}),
cells AS (SELECT ref, feature, value FROM (SELECT ref, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMBERS)} FROM sided)
          UNPIVOT INCLUDE NULLS (value FOR feature IN ({", ".join(_NUMBERS)}))),
numbers AS (SELECT * FROM cells WHERE value IS NOT NULL),
missing AS (SELECT feature, avg(CASE WHEN ref THEN (value IS NULL)::INT END) AS rm,
                   avg(CASE WHEN NOT ref THEN (value IS NULL)::INT END) AS cm FROM cells GROUP BY feature),
"""
    + _TAIL.replace("FROM sided UNPIVOT (value FOR feature IN (store, item, sales_month))", f"FROM sided UNPIVOT (value FOR feature IN ({', '.join(RIDGE_LEVELS)}))")
    .replace("any_value(psi) AS psi, 0.0 AS reference_missing_rate, 0.0 AS current_missing_rate\n  FROM numbers JOIN psi USING (feature)",
             "any_value(psi) AS psi, any_value(rm) AS reference_missing_rate, any_value(cm) AS current_missing_rate\n"
             "  FROM numbers JOIN psi USING (feature) JOIN missing USING (feature)")
    .replace("/ stddev_samp(CASE WHEN ref THEN value END)", "/ coalesce(nullif(stddev_samp(CASE WHEN ref THEN value END), 0), 1)")
    .replace("  UNION ALL SELECT feature, 'new_category_rate'", """  UNION ALL SELECT feature, 'missing_rate_shift', abs(current_missing_rate - reference_missing_rate), 0.05,
         'Missing rate changed materially.' FROM numeric_drift
  UNION ALL SELECT feature, 'new_category_rate'""")
)

# ---- state and serving pieces -------------------------------------------------------------------

STATE = SALES + """,
tail AS (SELECT * FROM sales QUALIFY row_number() OVER (PARTITION BY store, item ORDER BY date DESC) <= 87),
kept AS (SELECT store, item, avg(sales) AS kept_mean, count(*) AS kept_days, min(date) AS first_kept,
                sum(sales) AS kept_sales, max(date) AS last FROM tail GROUP BY store, item),
store_means AS (SELECT store, avg(sales) AS store_mean FROM sales GROUP BY store),
item_means AS (SELECT item, avg(sales) AS item_mean FROM sales GROUP BY item),
series_means AS (SELECT store, item, avg(sales) AS series_mean FROM sales GROUP BY store, item)"""

REQUESTS = """,
requests AS (
  SELECT store, unnest([item, 'NEW ' || item]) AS item, last FROM kept),
asked AS (SELECT store, item, last + cast(unnest([-40, 1, 6, 45]) AS INT) AS forecast_date FROM requests)"""

GRID = """,
asked AS (SELECT store, item, (SELECT max(date) FROM sales) + cast(h AS INT) AS forecast_date, h AS horizon
          FROM kept, (SELECT unnest(range(1, 29)) AS h))"""


def served() -> str:
    """Serving features of ``asked`` by joining the kept days to each request."""
    lags = ", ".join(
        f"coalesce(max(CASE WHEN t.date = a.forecast_date - {k} THEN t.sales END), any_value(fallback)) AS sales_lag_{k}"
        for k in LAGS
    )
    stats = []
    for k in WINDOWS:
        inside = f"FILTER (WHERE back <= {k})"
        stats.append(f"coalesce(avg(t.sales) {inside}, any_value(fallback)) AS sales_rolling_mean_{k}")
        if k in SHAPE_WINDOWS:
            stats += [
                f"coalesce(quantile_cont(t.sales, 0.5) {inside}, any_value(fallback)) AS sales_rolling_median_{k}",
                f"coalesce(stddev_samp(t.sales) {inside}, 0.0) AS sales_rolling_std_{k}",
                f"coalesce(min(t.sales) {inside}, any_value(fallback)) AS sales_rolling_min_{k}",
                f"coalesce(max(t.sales) {inside}, any_value(fallback)) AS sales_rolling_max_{k}",
            ]
    return f""",
based AS (
  SELECT a.*, coalesce(kept_mean, g) AS fallback, coalesce(series_mean, g) AS series_mean,
         CASE WHEN kept_mean IS NULL THEN g ELSE store_mean END AS store_mean,
         CASE WHEN kept_mean IS NULL THEN g ELSE item_mean END AS item_mean
  FROM asked a CROSS JOIN (SELECT avg(sales) AS g FROM sales)
  LEFT JOIN kept USING (store, item) LEFT JOIN series_means USING (store, item)
  LEFT JOIN store_means USING (store) LEFT JOIN item_means USING (item)),
looked AS (
  SELECT a.*, t.date, t.sales, CASE WHEN t.date < a.forecast_date THEN row_number() OVER (
           PARTITION BY a.store, a.item, a.forecast_date, t.date < a.forecast_date ORDER BY t.date DESC) END AS back
  FROM based a LEFT JOIN tail t ON t.store = a.store AND t.item = a.item),
served AS (
  SELECT store, item, forecast_date, any_value(store_mean) AS store_mean, any_value(item_mean) AS item_mean,
         any_value(series_mean) AS series_mean, {lags.replace("a.forecast_date", "t.forecast_date")}, {", ".join(stats)},
         count(CASE WHEN back <= 28 AND t.sales = 0 THEN 1 END) AS recent_zero_sales_28,
         coalesce((max(t.sales) FILTER (WHERE back = 1)
            - arg_max(t.sales, back) FILTER (WHERE back <= 28)) / nullif(count(*) FILTER (WHERE back <= 28) - 1, 0), 0.0)
           AS sales_trend_28
  FROM looked t GROUP BY store, item, forecast_date)"""


SERVED = STATE + REQUESTS + served()

SERVING_CALENDAR = {
    c: e.replace("(date", "(forecast_date").replace("date =", "forecast_date =").replace("forecast_forecast_", "forecast_")
    for c, e in CALENDAR.items()
    if c != "year_index"
}
SERVING_HOLIDAYS = (
    HOLIDAYS.replace("max(year(date)) + 3", "max(year(date)) + 4")
    .replace("max(year(date)) + 1 FROM", "max(year(date)) + 2 FROM")
    .replace("SELECT DISTINCT date FROM sales)", "SELECT DISTINCT forecast_date AS date FROM asked)")
)
SERVING_SELECT = f"""
SELECT s.store, s.item, {d("s.forecast_date", "forecast_date")}, {columns(SERVING_CALENDAR)},
  cast(0 AS BIGINT) AS year_index, is_us_holiday, {n("days_to_nearest_us_holiday", "days_to_nearest_us_holiday")},
  {", ".join(r(f"sales_lag_{k}", f"sales_lag_{k}") for k in LAGS)},
  {r("sales_lag_7 - sales_lag_14", "sales_lag_delta_7_14")},
  {r("sales_lag_7 / greatest(sales_lag_28, 1e-6)", "sales_lag_ratio_7_28")},
  {r("(sales_lag_7 + sales_lag_14 + sales_lag_28) / 3", "sales_same_weekday_4wk_mean")},
  {", ".join(r(c, c) for c in ROLLING_COLUMNS)},
  {r("store_mean", "store_historical_mean")}, {r("item_mean", "item_historical_mean")},
  {r("series_mean", "store_item_historical_mean")},
  {r("store_mean", "store_day_of_week_historical_mean")}, {r("item_mean", "item_day_of_week_historical_mean")},
  {r("store_mean", "store_month_historical_mean")}, {r("item_mean", "item_month_historical_mean")},
  {r("cast(recent_zero_sales_28 AS DOUBLE)", "recent_zero_sales_28")},
  {r("sales_rolling_std_28 / greatest(sales_rolling_mean_28, 1e-6)", "sales_cv_28")},
  {r("sales_rolling_mean_7 / greatest(sales_rolling_mean_28, 1e-6)", "sales_momentum_7_28")},
  {r("sales_trend_28", "sales_trend_28")}, {r("recent_zero_sales_28 / 28.0", "intermittency_score_28")},
  0.0::DOUBLE AS price, 0.0::DOUBLE AS promotion_flag, 0.0::DOUBLE AS stockout_flag, 0.0::DOUBLE AS inventory_on_hand
FROM served s JOIN holiday_days h ON h.date = s.forecast_date WHERE s.item NOT LIKE 'NEW %'"""

BLEND = "greatest(0.0, (sales_lag_7 + sales_rolling_mean_28) / 2)"

# ---- lifecycle pieces ---------------------------------------------------------------------------

CANDIDATES = (
    BOTH_NAIVE
    + ROLLED
    + """,
scored AS (
  SELECT 'seasonal_naive_7' AS name, 1 AS version, sqrt(avg((sales - prediction) ** 2)) AS rmse FROM validated
  UNION ALL SELECT 'moving_average_7', 2, sqrt(avg((sales - prediction) ** 2)) FROM averaged),
hashed AS (SELECT md5(count(*) || '|' || min(date) || '|' || max(date)) AS h FROM sales),
candidates AS (
  SELECT version, name, rmse, h FROM scored, hashed
  UNION ALL SELECT 3, name, rmse, 'new-' || h FROM scored, hashed WHERE version = 1
  UNION ALL SELECT 4, name, NULL, h FROM scored, hashed WHERE version = 1)"""
)


def _verdict(c: str, m: str) -> str:
    """(promoted, reason) of a candidate row against a champion row, which may be all null."""
    gain = f"(({m}.rmse - {c}.rmse) / greatest({m}.rmse, 1e-8))"
    return f"""
          coalesce({c}.rmse IS NOT NULL AND ({m}.rmse IS NULL OR {c}.h <> {m}.h OR {gain} > 0.01), false) AS promoted,
          CASE WHEN {c}.rmse IS NULL THEN 'candidate missing metric rmse'
               WHEN {m}.rmse IS NULL THEN 'no current production champion'
               WHEN {c}.h <> {m}.h THEN 'candidate was trained on a new verified dataset version'
               WHEN {gain} > 0.01 THEN printf('rmse improved by %.2f%%', {gain} * 100)
               ELSE printf('rmse improvement %.2f%% below threshold 1.00%%', {gain} * 100) END AS reason"""


# Each version in turn against what is in production when it comes.
PROMOTIONS = f""",
steps AS (
  SELECT 0 AS version, NULL::INT AS before, NULL::INT AS live, false AS promoted, '' AS reason
  UNION ALL
  SELECT version, before, CASE WHEN promoted THEN version ELSE before END, promoted, reason FROM (
    SELECT c.version, s.live AS before, {_verdict("c", "m")}
    FROM steps s JOIN candidates c ON c.version = s.version + 1 LEFT JOIN candidates m ON m.version = s.live))"""


def _live() -> str:
    """Version 1 is judged without a champion, the others against version 1 and without any gain asked for."""
    verdict = _verdict("c", "m").replace("> 0.01", "> 0.0")
    return f""",
judged_at_once AS (
  SELECT c.version AS step, CASE WHEN promoted THEN c.version END AS live FROM (
    SELECT c.*, {verdict} FROM candidates c LEFT JOIN candidates m ON m.version = 1 AND c.version > 1) c WHERE promoted)"""


CORRELATIONS = SALES + ",\n" + """
lagged AS (SELECT s.*, k AS lag, x.sales AS past FROM
  (SELECT *, row_number() OVER (PARTITION BY store, item ORDER BY date) AS i FROM sales) s
  CROSS JOIN (SELECT unnest(range(1, 57)) AS k)
  JOIN (SELECT *, row_number() OVER (PARTITION BY store, item ORDER BY date) AS i FROM sales) x
  ON x.store = s.store AND x.item = s.item AND x.i = s.i - k)"""


def _group_stats(key: str) -> str:
    return f"""SELECT '{key}' AS level, {key} AS key, {r("avg(sales)", "mean_sales", 2)},
      {r("quantile_cont(sales, 0.5)", "median_sales", 2)}, {r("stddev_samp(sales)", "std_sales", 2)}
      FROM sales GROUP BY {key}"""


ORACLE: dict[str, str] = {
    "dataset_metadata": with_(DIRTY, f"""
        SELECT count(*) AS rows, {d("min(try_cast(date AS DATE))", "date_min")},
          {d("max(try_cast(date AS DATE))", "date_max")}, min(sales) AS target_min, max(sales) AS target_max,
          'date,store,item,sales' AS columns, count(DISTINCT store) AS store_count, count(DISTINCT item) AS item_count
        FROM dirty"""),
    "normalize_schema": with_(RAW, """
        SELECT date, store, item, try_cast(sales AS DOUBLE) AS sales,
          round(coalesce(try_cast(price AS DOUBLE), 0.0) + 1e-10, 6) + 0.0 AS price
        FROM raw WHERE try_cast(sales AS DOUBLE) IS NOT NULL"""),
    "coerce_numeric": with_(RAW, """
        SELECT date, store, item, try_cast(sales AS DOUBLE) AS sales, round(try_cast(price AS DOUBLE) + 1e-10, 6) + 0.0 AS price
        FROM raw"""),
    "chronological_split": with_(SPLIT, f"SELECT {d('date', 'date')}, store, item, sales, split FROM split"),
    "split_timeline": with_(SALES + CUTS, f"""
        SELECT {d("min_date", "min_date")}, {d("validation_start", "validation_start")},
          {d("test_start", "test_start")}, {d("max_date", "max_date")} FROM cuts"""),
    "split_windows": with_(SPLIT, f"""
        SELECT split, {d("min(date)", "start_date")}, {d("max(date)", "end_date")}, count(*) AS rows
        FROM split GROUP BY split"""),
    "dense_panel": with_(DENSE, f"SELECT {d('date', 'date')}, store, item, sales FROM dense"),
    "dq_duplicate_keys": with_(DIRTY, """
        SELECT date, store, item, count(*) AS rows FROM dirty GROUP BY ALL HAVING count(*) > 1"""),
    "dq_report": with_(DIRTY, """
        SELECT 'error' AS severity, 'duplicate_keys' AS "check", 'Duplicate date/store/item observations found' AS message
        WHERE EXISTS (SELECT 1 FROM dirty GROUP BY date, store, item HAVING count(*) > 1)
        UNION ALL SELECT 'error', 'target_missing', 'Sales contains missing values'
        WHERE EXISTS (SELECT 1 FROM dirty WHERE sales IS NULL)
        UNION ALL SELECT 'error', 'target_non_negative', 'Sales contains negative values'
        WHERE EXISTS (SELECT 1 FROM dirty WHERE sales < 0)
        UNION ALL SELECT 'error', 'date_parse', 'Some dates could not be parsed'
        WHERE EXISTS (SELECT 1 FROM dirty WHERE try_cast(date AS DATE) IS NULL)
        UNION ALL SELECT 'warning', 'missingness', printf('At least one column has %.1f%% missing values', p * 100)
        FROM (SELECT greatest(avg((date IS NULL)::INT), avg((store IS NULL)::INT), avg((item IS NULL)::INT),
                avg((sales IS NULL)::INT)) AS p FROM dirty) WHERE p > 0.05"""),
    "dq_shape": with_(SALES, """
        SELECT 'warning' AS severity, 'daily_continuity' AS "check",
          count(*) || ' store/item series have date gaps' AS message
        FROM (SELECT 1 FROM sales GROUP BY store, item HAVING count(DISTINCT date) <> max(date) - min(date) + 1)
        HAVING count(*) > 0
        UNION ALL SELECT 'warning', 'store_count', 'Dataset has fewer than 2 stores'
        FROM sales HAVING count(DISTINCT store) < 2
        UNION ALL SELECT 'warning', 'item_count', 'Dataset has fewer than 2 items'
        FROM sales HAVING count(DISTINCT item) < 2
        UNION ALL SELECT 'warning', 'history_length', 'Dataset has less than one year of history'
        FROM sales HAVING max(date) - min(date) < 365"""),
    "dq_missingness": with_(DIRTY, f"""
        SELECT 'date' AS "column", {r("avg((date IS NULL)::INT)", "missing_rate")} FROM dirty
        UNION ALL SELECT 'store', {r("avg((store IS NULL)::INT)")} FROM dirty
        UNION ALL SELECT 'item', {r("avg((item IS NULL)::INT)")} FROM dirty
        UNION ALL SELECT 'sales', {r("avg((sales IS NULL)::INT)")} FROM dirty"""),
    "dq_continuity": with_(SALES, f"""
        SELECT store, item, {d("min(date)", "first_date")}, {d("max(date)", "last_date")}, count(*) AS rows,
          count(DISTINCT date) AS distinct_days, {n("max(date) - min(date) + 1", "calendar_days")},
          {n("max(date) - min(date) + 1 - count(DISTINCT date)", "missing_days")}
        FROM sales GROUP BY store, item HAVING max(date) - min(date) + 1 <> count(DISTINCT date)"""),
    "dq_contract": with_(DIRTY + """,
        v AS (SELECT 'date_not_null' AS "check", count(*) AS violations FROM dirty WHERE try_cast(date AS DATE) IS NULL
          UNION ALL SELECT 'store_not_null', count(*) FROM dirty WHERE store IS NULL
          UNION ALL SELECT 'item_not_null', count(*) FROM dirty WHERE item IS NULL
          UNION ALL SELECT 'sales_numeric', count(*) FROM dirty WHERE sales IS NULL
          UNION ALL SELECT 'sales_non_negative', count(*) FROM dirty WHERE coalesce(sales < 0, true)
          UNION ALL SELECT 'unique_key', count(*) - count(DISTINCT (date, store, item)) FROM dirty)""", """
        SELECT "check", 'error' AS severity, cast(violations AS BIGINT) AS violations, violations = 0 AS passed FROM v"""),
    "verify_dataset": with_(SALES, """
        SELECT 'required_columns' AS name, true AS passed, 'All required columns present.' AS detail
        UNION ALL SELECT 'real_dataset_row_count', count(*) >= 40000,
          format('Rows={:,}; expected at least 40,000 rows.', count(*)) FROM sales
        UNION ALL SELECT 'store_count', count(DISTINCT store) = 5,
          'Stores=' || count(DISTINCT store) || '; expected 5.' FROM sales
        UNION ALL SELECT 'item_count', count(DISTINCT item) = 7,
          'Items=' || count(DISTINCT item) || '; expected 7.' FROM sales
        UNION ALL SELECT 'date_range', min(date) = DATE '1995-01-02' AND max(date) = DATE '2001-11-04',
          'Date range=' || min(date) || ' to ' || max(date) || '; expected 1995-01-02 to 2001-11-04.' FROM sales
        UNION ALL SELECT 'non_negative_sales', bool_and(coalesce(sales >= 0, false)), 'Sales are non-negative.' FROM sales"""),
    "verify_verdict": with_(SALES, """
        SELECT CASE WHEN ok THEN 'verified' ELSE 'not_verified' END AS status, ok AS passed, small AS likely_sample_data
        FROM (SELECT count(*) < 40000 AS small, count(*) >= 40000 AND count(DISTINCT store) = 5
          AND count(DISTINCT item) = 7 AND min(date) = DATE '1995-01-02' AND max(date) = DATE '2001-11-04'
          AND bool_and(sales >= 0) AS ok FROM sales)"""),
    "calendar_features": with_(SALES, f"""
        SELECT {columns(CALENDAR)}, '0' AS is_us_holiday, cast(999 AS BIGINT) AS days_to_nearest_us_holiday,
          {d("date", "date")}, store, item, sales FROM sales"""),
    "holiday_features": with_(SALES + HOLIDAYS, f"""
        SELECT {d("s.date", "date")}, store, item, is_us_holiday,
          {n("days_to_nearest_us_holiday", "days_to_nearest_us_holiday")}
        FROM sales s JOIN holiday_days h ON h.date = s.date"""),
    "lag_features": with_(SALES + f", lagged AS (SELECT *, {columns(LAG_COLUMNS)} FROM sales {WINDOW})", f"""
        SELECT {d("date", "date")}, store, item, sales, {", ".join(LAG_COLUMNS)}, {columns(LAG_RATIOS, True)}
        FROM lagged"""),
    "horizon_target": with_(SALES + """,
        ahead AS (SELECT date, store, item, lead(sales, 7) OVER w AS sales, lead(date, 7) OVER w AS forecast_date
          FROM sales WINDOW w AS (PARTITION BY store, item ORDER BY date))""", f"""
        SELECT {d("date", "date")}, store, item, sales, cast(7 AS BIGINT) AS forecast_horizon,
          {d("forecast_date", "forecast_date")} FROM ahead WHERE forecast_date IS NOT NULL"""),
    "rolling_features": with_(SALES + f", rolled AS (SELECT *, {columns(ROLLING_COLUMNS)} FROM sales {WINDOW})", f"""
        SELECT {d("date", "date")}, store, item, sales,
          {", ".join(r(c, c) for c in ROLLING_COLUMNS if "median" not in c)} FROM rolled"""),
    "rolling_median": with_(SALES + f", rolled AS (SELECT *, {columns(ROLLING_COLUMNS)} FROM sales {WINDOW})", f"""
        SELECT {d("date", "date")}, store, item,
          {", ".join(r(c, c) for c in ROLLING_COLUMNS if "median" in c)} FROM rolled"""),
    "history_means": with_(SALES + f", past AS (SELECT *, {HISTORY} FROM sales)", f"""
        SELECT {d("date", "date")}, store, item, sales, {", ".join(r(c, c) for c in HISTORY_NAMES)} FROM past"""),
    "history_means_chrono": with_(SALES + f", past AS (SELECT *, {CHRONO} FROM sales)", f"""
        SELECT {d("date", "date")}, store, item, sales, {", ".join(r(c, c) for c in HISTORY_NAMES)} FROM past"""),
    "demand_pattern": with_(
        DENSE
        + f""",
        stepped AS (SELECT *, sales - lag(sales) OVER (PARTITION BY store, item ORDER BY date) AS step FROM dense),
        windowed AS (SELECT *, {columns(ROLLING_COLUMNS)}, {columns(PATTERN_EXPRESSIONS)} FROM stepped {WINDOW}),
        done AS (SELECT *, {columns(PATTERN_RATIOS)} FROM windowed)""",
        f"SELECT {d('date', 'date')}, store, item, {', '.join(r(c, c) for c in PATTERN_COLUMNS)} FROM done",
    ),
    "build_features": with_(ALL_FEATURES, FEATURE_SELECT),
    "features_complete": with_(
        ALL_FEATURES, FEATURE_SELECT + " WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in DERIVED)
    ),
    "sales_summary": with_(SALES, f"""
        SELECT count(*) AS rows, {d("min(date)", "date_min")}, {d("max(date)", "date_max")},
          {r("avg(sales)", "mean_sales")}, {r("avg((sales = 0)::INT)", "zero_sales_rate")},
          count(DISTINCT store) AS store_count, count(DISTINCT item) AS item_count,
          {r("quantile_cont(sales, 0.5)", "median_sales")},
          {n("count(*) - count(DISTINCT (date, store, item))", "duplicate_key_count")},
          {n("count(*) * 4 - count(date) - count(store) - count(item) - count(sales)", "missing_value_count")}
        FROM sales"""),
    "daily_sales": with_(SALES, f"SELECT {d('date', 'date')}, sum(sales) AS total_sales FROM sales GROUP BY sales.date"),
    "dow_profile": with_(SALES, f"""
        SELECT {n("isodow(date) - 1", "position")}, any_value(dayname(date)) AS day_of_week, {r("avg(sales)", "mean_sales")}
        FROM sales GROUP BY isodow(date)"""),
    "month_profile": with_(SALES, f"""
        SELECT {n("month(date)", "month")}, {r("avg(sales)", "mean_sales")} FROM sales GROUP BY month(date)"""),
    "store_profile": with_(SALES, f"SELECT store, {r('avg(sales)', 'mean_sales')} FROM sales GROUP BY store"),
    "store_item_pivot": with_(SALES, "SELECT store, " + ", ".join(
        r(f"avg(sales) FILTER (WHERE item = '{i}')", i)
        for i in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + " FROM sales GROUP BY store"),
    "top_items": with_(SALES, f"""
        SELECT item, {r("avg(sales)", "mean_sales")} FROM sales GROUP BY item ORDER BY avg(sales) DESC, item LIMIT 3"""),
    "example_series": with_(SALES + """,
        best AS (SELECT store, item FROM sales GROUP BY ALL ORDER BY avg(sales) DESC, store, item LIMIT 1)""", f"""
        SELECT {d("date", "date")}, store, item, sales,
          {r("CASE WHEN count(sales) OVER f >= 28 THEN avg(sales) OVER f END", "trailing_mean_28")}
        FROM sales SEMI JOIN best USING (store, item)
        WINDOW f AS (PARTITION BY store, item ORDER BY sales.date ROWS BETWEEN 27 PRECEDING AND CURRENT ROW)"""),
    "lag_autocorrelation": with_(CORRELATIONS, f"""
        SELECT {n("lag", "lag")}, {r("avg(c)", "correlation")}
        FROM (SELECT lag, corr(sales, past) AS c FROM lagged GROUP BY lag, store, item) GROUP BY lag"""),
    "lag_correlation_pooled": with_(CORRELATIONS, f"""
        SELECT {n("lag", "lag")}, {r("corr(sales, past)", "correlation")} FROM lagged
        WHERE lag IN (1, 7, 14, 28, 56) GROUP BY lag"""),
    "panel_coverage": with_(SALES, f"""
        SELECT store, item, {d("min(date)", "first_date")}, {d("max(date)", "last_date")}, count(*) AS rows
        FROM sales GROUP BY store, item"""),
    "coverage_summary": with_(SALES + ", c AS (SELECT count(*) AS k FROM sales GROUP BY store, item)", f"""
        SELECT count(*) AS series, {r("avg(k)", "mean")}, {r("stddev_samp(k)", "std")}, min(k) AS min, max(k) AS max,
          {r("quantile_cont(k, 0.25)", "p25")}, {r("quantile_cont(k, 0.5)", "p50")},
          {r("quantile_cont(k, 0.75)", "p75")} FROM c"""),
    "group_stats": with_(SALES, f"{_group_stats('store')} UNION ALL {_group_stats('item')}"),
    "seasonal_naive": with_(TEST_NAIVE, f"""
        SELECT store, item, {d("date", "date")}, sales, {r("prediction", "prediction")} FROM tested"""),
    "regression_metrics": with_(TEST_NAIVE, f"SELECT {metrics()} FROM tested"),
    "moving_average_baseline": with_(SPLIT + ROLLED, f"""
        SELECT {d("date", "date")}, store, item, sales, {r("prediction", "prediction")} FROM averaged"""),
    "non_negative": with_(SALES + f", rolled AS (SELECT *, {columns(ROLLING_COLUMNS)} FROM sales {WINDOW})", f"""
        SELECT {d("date", "date")}, store, item, {r('''CASE WHEN sales_rolling_mean_7 IS NOT NULL
          THEN greatest(0.0, sales - sales_rolling_mean_7) END''', "excess")} FROM rolled"""),
    "leaderboard": with_(TEST_NAIVE + ROLLED, f"""
        SELECT 'seasonal_naive_7' AS model, 'test' AS split, {metrics()} FROM tested
        UNION ALL SELECT 'moving_average_7', 'validation', {metrics()} FROM averaged"""),
    "select_model": with_(BOTH_NAIVE + ROLLED, f"""
        SELECT * FROM (SELECT 'seasonal_naive_7' AS model, 'validation' AS split, {metrics()} FROM validated
        UNION ALL SELECT 'moving_average_7', 'validation', {metrics()} FROM averaged) ORDER BY rmse LIMIT 1"""),
    "sliced_metrics": with_(TEST_NAIVE + """,
        e AS (SELECT quantile_cont(sales, 1.0 / 3) AS a, quantile_cont(sales, 2.0 / 3) AS b FROM tested),
        sliced AS (SELECT *, unnest(['store=' || store, 'volume=' || CASE WHEN sales <= a THEN 'low'
          WHEN sales <= b THEN 'medium' ELSE 'high' END]) AS slice FROM tested, e)""", f"""
        SELECT slice, count(*) AS rows, {r("avg(abs(sales - prediction))", "mae")},
          {r("sqrt(avg((sales - prediction) ** 2))", "rmse")} FROM sliced GROUP BY slice"""),
    "prediction_interval": with_(BOTH_NAIVE + """,
        e AS (SELECT quantile_cont(sales - prediction, 0.05) AS a, quantile_cont(sales - prediction, 0.95) AS b
              FROM validated)""", f"""
        SELECT store, item, {d("date", "date")}, sales, {r("prediction", "prediction")},
          {r("greatest(0.0, prediction + a)", "prediction_p10")}, {r("greatest(0.0, prediction + b)", "prediction_p90")}
        FROM tested, e"""),
    "backtest_folds": with_(SPLIT + FOLDS, f"""
        SELECT fold, {d("train_end", "train_end")}, {d("test_start", "test_start")}, {d("test_end", "test_end")}, rows
        FROM bounds"""),
    "backtest_baseline": with_(BACKTEST, f"""
        SELECT model, fold, {d("any_value(train_end)", "train_end")}, {d("any_value(test_start)", "test_start")},
          {d("any_value(test_end)", "test_end")}, any_value(rows) AS rows, {metrics()}
        FROM predicted JOIN bounds USING (fold) GROUP BY model, fold"""),
    "psi": with_(BUSINESS, f"SELECT feature, {r('psi', 'psi')} FROM psi"),
    "numeric_drift": with_(BUSINESS, f"SELECT feature, {NUMERIC_SELECT} FROM numeric_drift"),
    "categorical_drift": with_(BUSINESS, f"SELECT feature, {CATEGORICAL_SELECT} FROM categorical_drift"),
    "new_categories": with_(BUSINESS, "SELECT feature, value, cn AS rows FROM counted WHERE rn = 0"),
    "drift_summary": with_(BUSINESS, DRIFT_SUMMARY),
    "drift_findings": with_(BUSINESS, DRIFT_FINDINGS),
    "drift_features": with_(FEATURE_DRIFT, DRIFT_SUMMARY),
    "drift_features_findings": with_(FEATURE_DRIFT, DRIFT_FINDINGS),
    "drift_status": with_(BUSINESS, """
        SELECT CASE WHEN count(*) > 0 THEN 'warning' ELSE 'ok' END AS status, count(*) AS finding_count
        FROM findings WHERE value >= threshold"""),
    "drift_split": with_(SALES, f"""
        SELECT {d("sales.date", "date")}, store, item, sales, CASE WHEN row_number() OVER (ORDER BY store, item, sales.date)
          <= floor(count(*) OVER () * (1 - 0.2)) THEN 'reference' ELSE 'current' END AS side FROM sales"""),
    "drift_split_by_date": with_(SALES + ", c AS (SELECT date, count(*) AS k FROM sales GROUP BY date),"
        " b AS (SELECT date, sum(k) OVER (ORDER BY date) - k AS before, sum(k) OVER () AS total FROM c)", f"""
        SELECT {d("s.date", "date")}, store, item, sales,
          CASE WHEN before < floor(total * (1 - 0.2)) THEN 'reference' ELSE 'current' END AS side
        FROM sales s JOIN b ON b.date = s.date"""),
    "state_means": with_(SALES, f"""
        SELECT 'series' AS level, store, item, {r("avg(sales)", "mean_sales")} FROM sales GROUP BY store, item
        UNION ALL SELECT 'store', store, NULL, {r("avg(sales)")} FROM sales GROUP BY store
        UNION ALL SELECT 'item', NULL, item, {r("avg(sales)")} FROM sales GROUP BY item
        UNION ALL SELECT 'global', NULL, NULL, {r("avg(sales)")} FROM sales"""),
    "state_tail": with_(STATE, f"SELECT store, item, {d('date', 'date')}, sales FROM tail"),
    "feature_state": with_(STATE, f"""
        SELECT store, item, kept_days, {d("first_kept", "first_kept")}, kept_sales,
          {r("series_mean", "series_mean")}, {r("store_mean", "store_mean")}, {r("item_mean", "item_mean")}
        FROM kept JOIN series_means USING (store, item) JOIN store_means USING (store) JOIN item_means USING (item)"""),
    "serving_features": with_(SERVED + SERVING_HOLIDAYS, SERVING_SELECT),
    "serving_cold_start": with_(SERVED, f"""
        SELECT s.store, s.item, {d("forecast_date", "forecast_date")}, {r("g", "sales_lag_7")},
          {r("g", "sales_rolling_mean_28")}, {r("m.store_mean", "store_historical_mean")},
          {r("g", "item_historical_mean")}, {r("g", "store_item_historical_mean")}
        FROM asked s JOIN store_means m USING (store) CROSS JOIN (SELECT avg(sales) AS g FROM sales)
        WHERE s.item LIKE 'NEW %'"""),
    "forecast_grid": with_(STATE + GRID + served(), f"""
        SELECT s.store, s.item, {d("s.forecast_date", "forecast_date")}, {n("horizon", "horizon")},
          cast(isodow(s.forecast_date) - 1 AS VARCHAR) AS day_of_week, {r("sales_lag_7", "sales_lag_7")},
          {r("sales_lag_28", "sales_lag_28")}, {r("sales_rolling_mean_7", "sales_rolling_mean_7")}
        FROM served s JOIN asked USING (store, item, forecast_date)"""),
    "forecast_next_days": with_(STATE + GRID + served(), f"""
        SELECT s.store, s.item, {d("s.forecast_date", "forecast_date")}, {n("horizon", "horizon")},
          {r(BLEND, "prediction")} FROM served s JOIN asked USING (store, item, forecast_date)"""),
    "forecast_series": with_(
        STATE + GRID.replace("range(1, 29)", "range(1, 61)").replace(
            "FROM kept, (", "FROM (SELECT * FROM kept WHERE store = 'ASIA' AND item = 'PROMO'), (") + served(), f"""
        SELECT s.store, s.item, {d("s.forecast_date", "forecast_date")}, {n("horizon", "horizon")},
          {r(BLEND, "prediction")} FROM served s JOIN asked USING (store, item, forecast_date)"""),
    "score_requests": with_(SERVED, f"""
        SELECT store, item, {d("forecast_date", "forecast_date")}, {r(BLEND, "prediction")} FROM served"""),
    "ridge_predictions": "WITH RECURSIVE" + with_(RIDGE, f"""
SELECT {d("date", "date")}, store, item, sales, {r(" + ".join(f"x{i} * w[{i + 1}]" for i in _PLACES), "prediction", 4)}
FROM design, weights WHERE date >= (SELECT max(date) - 89 FROM complete)""").removeprefix("WITH"),
    "native_importance": "WITH RECURSIVE" + with_(RIDGE, f"""
SELECT feature, {r("abs(w)", "importance")}, row_number() OVER (ORDER BY round(abs(w), 6) DESC, feature) AS rank FROM (
  SELECT unnest([{", ".join(f"'{s}'" for s in RIDGE_SLOTS)}]) AS feature, unnest(w[2:]) AS w FROM weights)""").removeprefix("WITH"),
    "ridge_optimality": with_(RIDGE_ROWS, """
SELECT '(intercept)' AS feature, CAST(NULL AS VARCHAR) AS level, 0.0::DOUBLE AS gap UNION ALL
""" + " UNION ALL ".join(
        [f"SELECT DISTINCT '{c}', {c}, 0.0::DOUBLE FROM known" for c in RIDGE_LEVELS]
        + [f"SELECT '{c}', CAST(NULL AS VARCHAR), 0.0::DOUBLE" for c in RIDGE_NUMBERS]
    )),
    "promotion_decision": with_(CANDIDATES, f"""
        SELECT {n("c.version", "candidate_version")}, {n("m.version", "previous_version")}, {_verdict("c", "m")}
        FROM candidates c, candidates m WHERE m.version = 2"""),
    "registry_status": "WITH RECURSIVE" + with_(CANDIDATES + _live(), f"""
        SELECT count(*) AS candidate_count, {n("max(version)", "latest_version")}, arg_max(name, version) AS latest_name,
          {n("(SELECT arg_max(live, step) FROM judged_at_once)", "production_version")}
        FROM candidates""").removeprefix("WITH"),
    "promotion_log": "WITH RECURSIVE" + with_(CANDIDATES + PROMOTIONS, f"""
        SELECT {n("version", "candidate_version")}, {n("before", "previous_version")}, promoted, reason
        FROM steps WHERE version > 0""").removeprefix("WITH"),
    "candidate_status": "WITH RECURSIVE" + with_(CANDIDATES + PROMOTIONS, f"""
        SELECT {n("c.version", "version")}, c.name,
          CASE WHEN c.version = (SELECT arg_max(live, version) FROM steps) THEN 'production'
               WHEN s.promoted THEN 'archived' ELSE 'candidate' END AS status
        FROM candidates c JOIN steps s ON s.version = c.version""").removeprefix("WITH"),
    "active_model": "WITH RECURSIVE" + with_(CANDIDATES + PROMOTIONS, f"""
        SELECT {n("version", "version")}, name, {r("rmse", "rmse")} FROM candidates
        WHERE version = (SELECT arg_max(live, version) FROM steps)""").removeprefix("WITH"),
    "register_candidate": with_(BOTH_NAIVE + ROLLED, f"""
        SELECT {n("5", "version")}, 'moving_average_7' AS name, md5(cast(k AS VARCHAR)) AS dataset_hash, k AS dataset_rows,
          {d("a", "dataset_start")}, {d("b", "dataset_end")},
          {r("(SELECT sqrt(avg((sales - prediction) ** 2)) FROM averaged)", "rmse")},
          {r("(SELECT avg(abs(sales - prediction)) FROM averaged)", "mae")}
        FROM (SELECT count(*) AS k, min(date) AS a, max(date) AS b FROM sales)"""),
    "stored_metrics": with_(TEST_NAIVE, f"SELECT {metrics()} FROM tested"),
    "table_fingerprint": with_(SALES, """
        SELECT count(*) AS rows, """ + ", ".join(
        f"cast(sum(cast(('0x' || substr(h, {8 * k + 1}, 8)) AS UBIGINT)::HUGEINT) AS VARCHAR) AS lane_{k}" for k in range(4)
    ) + " FROM (SELECT md5(concat_ws(',', " + ", ".join(
        f"concat(length({t}), ':', {t})" for t in ("cast(date AS VARCHAR)", "item", "cast(cast(sales AS DECIMAL(38, 10)) AS VARCHAR)", "store")
    ) + ")) AS h FROM sales)"),
}

_SERIES = "r_name AS store, p_type AS item"
_WIDE_SERIES = "cast(l_suppkey % 50 AS VARCHAR) AS store, p_brand AS item"
ORACLE |= {
    f"wide_{name}": ORACLE[name].replace(_SERIES, _WIDE_SERIES)
    for name in (
        "lag_features", "rolling_features", "history_means", "build_features", "drift_split", "feature_state",
        "forecast_next_days",
    )
}
