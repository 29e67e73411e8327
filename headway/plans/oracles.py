"""The registered queries as plain SQL on the same tables, computed another way."""

from __future__ import annotations


def _r(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"


def _halves(expression: str) -> str:
    """Four digits, exact halves upwards: through a decimal, where halves are exact."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 8)), 4) AS DOUBLE) + 0.0"


# Events with every kind of missing value the cleaning queries look at.
GAPPED = """
gapped AS (
  SELECT event_id, ts, user_id, nullif(event_type, 'view') AS event_type,
         CASE WHEN value <= 100 THEN value END AS value,
         CASE WHEN event_type <> 'error' THEN props END AS props
  FROM events)
"""


def _split(table: str, order: str) -> str:
    return f"""
numbered AS (SELECT *, row_number() OVER (ORDER BY {order}) AS rn FROM {table}),
sized AS (SELECT count(*) AS total FROM {table}),
parted AS (
  SELECT numbered.*,
         CASE WHEN rn <= floor(0.7::DOUBLE * total) THEN 'train'
              WHEN rn <= floor(0.7::DOUBLE * total) + floor(0.2::DOUBLE * total) THEN 'test'
              ELSE 'val' END AS split
  FROM numbered, sized)
"""


EVENT_SPLIT = _split("events", "ts, event_id")
ITEM_ORDER = "l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice"
ITEM_SPLIT = _split("lineitem", ITEM_ORDER)

CALENDAR = """
  CAST(hour({t}) AS BIGINT) AS "Hour",
  CAST(dayofweek({t}) + 1 AS BIGINT) AS "DayOfWeek",
  CAST(month({t}) AS BIGINT) AS "Month",
  CAST(weekofyear({t}) AS BIGINT) AS "WeekOfYear",
  CAST(hour({t}) BETWEEN 7 AND 9 AS BIGINT) AS "IsMorningPeak",
  CAST(hour({t}) BETWEEN 16 AND 18 AS BIGINT) AS "IsEveningPeak",
  CAST(dayofweek({t}) IN (0, 6) AS BIGINT) AS "IsWeekend",
  CAST(day({t}) AS BIGINT) AS "DayOfMonth",
  CAST(dayofyear({t}) AS BIGINT) AS "DayOfYear",
  CAST(CAST({t} AS DATE) = last_day({t}) AS BIGINT) AS "IsMonthEnd",
  CAST(day({t}) = 1 AS BIGINT) AS "IsMonthStart"
"""


def _cycle(name: str, value: str, period: int) -> str:
    angle = f"2 * pi() * ({value}) / {period}"
    return f'{_r(f"sin({angle})")} AS "{name}_sin", {_r(f"cos({angle})")} AS "{name}_cos"'


ITEM_COLUMNS = (
    "CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey, "
    "CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice"
)

# Least squares of value on hour (x) and day of month (z) by the normal equations.
OLS_EVENTS = f"""
{EVENT_SPLIT},
points AS (
  SELECT *, hour(ts)::DOUBLE AS x, day(ts)::DOUBLE AS z, value AS y FROM parted),
moments AS (
  SELECT avg(x) mx, avg(z) mz, avg(y) my, var_pop(x) vx, var_pop(z) vz,
         covar_pop(x, z) cxz, covar_pop(x, y) cxy, covar_pop(z, y) czy
  FROM points WHERE split = 'train'),
weights AS (
  SELECT mx, mz, my,
         (cxy * vz - czy * cxz) / (vx * vz - cxz * cxz) AS wx,
         (czy * vx - cxy * cxz) / (vx * vz - cxz * cxz) AS wz
  FROM moments),
fitted AS (
  SELECT points.*, my + wx * (x - mx) + wz * (z - mz) AS prediction FROM points, weights)
"""

PREDICTED = f"""
{OLS_EVENTS},
overall AS (SELECT avg(y) AS p_mean FROM fitted WHERE split = 'train'),
by_type AS (SELECT event_type, avg(y) AS p_type FROM fitted WHERE split = 'train' GROUP BY event_type),
by_hour AS (SELECT x, avg(y) AS p_hour FROM fitted WHERE split = 'train' GROUP BY x),
predicted AS (
  SELECT f.event_id, f.ts, f.split, f.value, f.prediction, p_mean,
         coalesce(p_type, p_mean) AS p_type, coalesce(p_hour, p_mean) AS p_hour
  FROM fitted f CROSS JOIN overall
  LEFT JOIN by_type USING (event_type) LEFT JOIN by_hour USING (x)),
long AS (
  SELECT 'Mean' AS model, 0 AS pos, event_id, split, value AS y, p_mean AS p FROM predicted
  UNION ALL SELECT 'ByType', 1, event_id, split, value, p_type FROM predicted
  UNION ALL SELECT 'ByHour', 2, event_id, split, value, p_hour FROM predicted
  UNION ALL SELECT 'LinearRegression', 3, event_id, split, value, prediction FROM predicted)
"""

ERRORS = """
  count(*) AS n, sqrt(avg((p - y) * (p - y))) AS rmse,
  CASE WHEN count(*) < 2 THEN NULL
       WHEN var_pop(y) > 0 THEN 1 - avg((p - y) * (p - y)) / var_pop(y)
       WHEN avg((p - y) * (p - y)) = 0 THEN 1.0 ELSE 0.0 END AS r2
"""

EVALUATED = f"""
{PREDICTED},
errors AS (SELECT model, pos, split, {ERRORS} FROM long GROUP BY model, pos, split),
evaluated AS (
  SELECT model AS "Model", pos,
         max(rmse) FILTER (split = 'train') AS "Train_RMSE",
         max(rmse) FILTER (split = 'test') AS "Test_RMSE",
         max(rmse) FILTER (split = 'val') AS "Val_RMSE",
         max(r2) FILTER (split = 'test') AS "Test_R2"
  FROM errors GROUP BY model, pos)
"""

TABLE_COLUMNS = ", ".join(
    ['"Model"', *[f'{_r(chr(34) + c + chr(34))} AS "{c}"' for c in ("Train_RMSE", "Test_RMSE", "Val_RMSE", "Test_R2")]]
)

ENSEMBLE = f"""
{EVALUATED},
members AS (SELECT "Model" AS model FROM evaluated ORDER BY "Test_RMSE" NULLS LAST, pos LIMIT 3),
ensemble AS (
  SELECT event_id, split, any_value(y) AS y, avg(p) AS p
  FROM long JOIN members USING (model) GROUP BY event_id, split)
"""

ENDS = f"""
{PREDICTED},
ends AS (SELECT split, min(y) AS lo, max(y) AS hi FROM (SELECT DISTINCT event_id, split, y FROM long) GROUP BY split),
steps AS (SELECT unnest(range(5)) AS i),
edges AS (
  SELECT split, i, CASE WHEN i = 4 THEN hi ELSE lo + i * ((hi - lo) / 4) END AS edge FROM ends, steps)
"""


def _digitize(value: str) -> str:
    return f"(SELECT count(*) FROM edges e WHERE e.split = long.split AND {value} >= e.edge)"


def _cut(value: str) -> str:
    inner = " ".join(f"WHEN {value} <= lo + {i} * ((hi - lo) / 4) THEN {i}" for i in (1, 2, 3))
    return f"CASE WHEN {value} < lo THEN NULL {inner} WHEN {value} <= hi THEN 4 END"


def _histogram_bin(value: str, lo: str, hi: str, bins: int) -> str:
    """Bin whose edges hold the value, found by comparing with the edges around the guess."""
    step = f"(({hi} - {lo}) / {bins})"
    guess = f"least(greatest(floor(({value} - {lo}) * ({bins} / ({hi} - {lo}))), 0), {bins - 1})"
    return (
        f"CAST(CASE WHEN {value} < {lo} + {guess} * {step} THEN {guess} - 1 "
        f"WHEN {guess} < {bins - 1} AND {value} >= {lo} + ({guess} + 1) * {step} THEN {guess} + 1 "
        f"ELSE {guess} END AS BIGINT)"
    )


def _grid_counts(x: str, y: str, bins: int = 20) -> str:
    return f"""
WITH {PREDICTED},
xy AS (SELECT {x} AS x, {y} AS y FROM predicted),
span AS (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM xy)
SELECT {_histogram_bin("x", "x0", "x1", bins)} AS x_bin, {_histogram_bin("y", "y0", "y1", bins)} AS y_bin,
       count(*) AS n
FROM xy, span GROUP BY 1, 2
"""


# Inverse normal distribution by Acklam's published rational approximation.
def _horner(coefficients: list[str], x: str) -> str:
    text = coefficients[0]
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c})"
    return text


_A = ["-3.969683028665376e+01", "2.209460984245205e+02", "-2.759285104469687e+02",
      "1.383577518672690e+02", "-3.066479806614716e+01", "2.506628277459239e+00"]
_B = ["-5.447609879822406e+01", "1.615858368580409e+02", "-1.556989798598866e+02",
      "6.680131188771972e+01", "-1.328068155288572e+01", "1.0"]
_C = ["-7.784894002430293e-03", "-3.223964580411365e-01", "-2.400758277161838e+00",
      "-2.549732539343734e+00", "4.374664141464968e+00", "2.938163982698783e+00"]
_D = ["7.784695709041462e-03", "3.224671290700398e-01", "2.445134137142996e+00",
      "3.754408661907416e+00", "1.0"]

QUANTILES = f"""
{PREDICTED},
residuals AS (SELECT event_id, p_type - value AS residual FROM predicted),
ranked AS (
  SELECT event_id, residual, row_number() OVER (ORDER BY residual, event_id) AS rn, count(*) OVER () AS n
  FROM residuals),
placed AS (
  SELECT *, CASE WHEN rn = n THEN pow(0.5, 1.0::DOUBLE / n) WHEN rn = 1 THEN 1 - pow(0.5, 1.0::DOUBLE / n)
                 ELSE (rn - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS q
  FROM ranked),
tails AS (
  SELECT *, q - 0.5::DOUBLE AS c, sqrt(-2 * ln(q)) AS lo, sqrt(-2 * ln(1 - q)) AS hi FROM placed),
quantiles AS (
  SELECT event_id, residual, rn,
    CASE WHEN q < 0.02425 THEN {_horner(_C, "lo")} / {_horner(_D, "lo")}
         WHEN q > 1 - 0.02425 THEN -({_horner(_C, "hi")} / {_horner(_D, "hi")})
         ELSE c * {_horner(_A, "(c * c)")} / {_horner(_B, "(c * c)")} END AS x
  FROM tails)
"""

# One feature (x = quantity) against price on the training rows.
ITEM_MOMENTS = f"""
{ITEM_SPLIT},
points AS (
  SELECT *, l_quantity AS x, l_linenumber::DOUBLE AS z, l_extendedprice AS y FROM parted),
m AS (
  SELECT count(*)::DOUBLE AS n, avg(x) mx, avg(z) mz, avg(y) my, var_pop(x) vx, var_pop(z) vz,
         covar_pop(x, z) cxz, covar_pop(x, y) cxy, covar_pop(z, y) czy, stddev_pop(y) sy
  FROM points WHERE split = 'train')
"""


def _one_feature(weight: str) -> str:
    return f"""
WITH {ITEM_MOMENTS},
w AS (SELECT m.*, {weight} AS wx FROM m),
scored AS (SELECT split, y, my + wx * (x - mx) AS p FROM points, w),
errors AS (SELECT split, {ERRORS} FROM scored GROUP BY split)
SELECT split, errors.n AS n, {_r("rmse", 4)} AS rmse, {_r("r2")} AS r2,
       {_r("wx", 4)} AS w_quantity, {_r("my - wx * mx", 4)} AS intercept
FROM errors, w
"""


def _two_features(penalty: str) -> str:
    return f"""
WITH {ITEM_MOMENTS},
d AS (SELECT m.*, vx + {penalty} AS ax, vz + {penalty} AS az FROM m),
w AS (
  SELECT d.*, (cxy * az - czy * cxz) / (ax * az - cxz * cxz) AS wx,
         (czy * ax - cxy * cxz) / (ax * az - cxz * cxz) AS wz FROM d),
scored AS (SELECT split, y, my + wx * (x - mx) + wz * (z - mz) AS p FROM points, w),
errors AS (SELECT split, {ERRORS} FROM scored GROUP BY split)
SELECT split, errors.n AS n, {_r("rmse", 4)} AS rmse, {_r("r2")} AS r2, {_r("wx", 4)} AS w_quantity,
       {_r("wz", 4)} AS w_linenumber, {_r("my - wx * mx - wz * mz", 4)} AS intercept
FROM errors, w
"""


def _soft(value: str, threshold: str) -> str:
    return f"(sign({value}) * greatest(abs({value}) - {threshold}, 0))"


def _elastic(penalty: str) -> str:
    shrunk = _soft("(cxy / sqrt(vx))", f"(0.8::DOUBLE * {penalty})")
    return f"{shrunk} / (1 + 0.2::DOUBLE * {penalty} / sy) / sqrt(vx)"


GRID_SEARCH = f"""
WITH {ITEM_MOMENTS},
grid AS (SELECT unnest([0.3::DOUBLE, 3.0::DOUBLE, 30.0::DOUBLE]) AS reg_param),
w AS (SELECT m.*, reg_param, {_elastic("reg_param")} AS wx FROM m, grid),
errors AS (
  SELECT reg_param, sqrt(avg(pow(my + wx * (x - mx) - y, 2))) AS rmse
  FROM points, w WHERE split = 'val' GROUP BY reg_param)
SELECT row_number() OVER (ORDER BY rmse) AS place, reg_param, {_r("rmse", 4)} AS rmse FROM errors
"""

# Every year predicted from the rows of all years before it.
ROLLING = f"""
points AS (SELECT year(l_shipdate) AS year, l_quantity AS x, l_extendedprice AS y FROM lineitem),
years AS (SELECT DISTINCT year FROM points),
m AS (
  SELECT years.year, count(*) AS n_train, avg(x) mx, avg(y) my, var_pop(x) vx, covar_pop(x, y) cxy, stddev_samp(x) sx, stddev_samp(y) sy
  FROM years JOIN points ON points.year < years.year GROUP BY years.year),
grid AS (SELECT unnest([0.3::DOUBLE, 3.0::DOUBLE, 30.0::DOUBLE]) AS reg_param),
w AS (
  SELECT m.*, reg_param, {_soft("cxy", "(0.8::DOUBLE * reg_param * sx)")} / (vx + 0.2::DOUBLE * reg_param * sx * sx / sy) AS wx
  FROM m, grid),
missed AS (
  SELECT reg_param, year, n_train, pow(my + wx * (x - mx) - y, 2) AS e FROM w JOIN points USING (year))
"""


def _two_weights(model: str, penalty: str) -> str:
    return f"""
SELECT '{model}' AS model, split, count(*) AS n, sqrt(avg(pow(my + wx * (x - mx) + wz * (z - mz) - y, 2))) AS rmse,
       any_value(wx) AS w_quantity, any_value(wz) AS w_linenumber, any_value(my - wx * mx - wz * mz) AS intercept
FROM points, (
  SELECT d.*, (cxy * az - czy * cxz) / (ax * az - cxz * cxz) AS wx, (czy * ax - cxy * cxz) / (ax * az - cxz * cxz) AS wz
  FROM (SELECT m.*, vx + {penalty} AS ax, vz + {penalty} AS az FROM m) d)
GROUP BY split"""


# Boosted stumps: in each round the best cut of all columns by running sums over their values.
STUMP_COLUMNS = {"l_quantity": "q", "l_discount": "d", "l_tax": "t", "l_linenumber": "k"}


def _stump_rounds(rounds: int) -> str:
    columns = ", ".join(f"{c}::DOUBLE AS {a}" for c, a in STUMP_COLUMNS.items())
    parts = [f"{ITEM_SPLIT}", f"state0 AS (SELECT split, {columns}, l_extendedprice AS y, 0.0::DOUBLE AS p FROM parted)"]
    for at in range(rounds):
        target, weight = ("y", "1.0::DOUBLE") if at == 0 else ("2 * (y - p)", "0.1::DOUBLE")
        values = " UNION ALL ".join(
            f"SELECT {i} AS f, {a} AS x, {target} AS r FROM state{at} WHERE split = 'train'" for i, a in enumerate(STUMP_COLUMNS.values())
        )
        own = " ".join(f"WHEN {i} THEN {a}" for i, a in enumerate(STUMP_COLUMNS.values()))
        parts += [
            f"middle{at} AS (SELECT avg({target}) AS m FROM state{at} WHERE split = 'train')",
            f"sums{at} AS (SELECT f, x, count(*)::DOUBLE AS n, sum(r - m) AS s FROM ({values}), middle{at} GROUP BY f, x)",
            f"running{at} AS (SELECT f, x, sum(n) OVER upto AS nl, sum(s) OVER upto AS sl, sum(n) OVER whole AS n, sum(s) OVER whole AS s "
            f"FROM sums{at} WINDOW upto AS (PARTITION BY f ORDER BY x), whole AS (PARTITION BY f))",
            f"best{at} AS (SELECT f, x AS cut, m + sl / nl AS lo, m + (s - sl) / (n - nl) AS hi, "
            f"(sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n) / n AS gain "
            f"FROM running{at}, middle{at} WHERE nl < n ORDER BY gain DESC, f, x LIMIT 1)",
            f"state{at + 1} AS (SELECT split, {', '.join(STUMP_COLUMNS.values())}, y, "
            f"p + {weight} * CASE WHEN CASE f {own} END <= cut THEN lo ELSE hi END AS p FROM state{at}, best{at})",
        ]
    cuts = " UNION ALL ".join(f"SELECT f, gain FROM best{at}" for at in range(rounds))
    return ",\n".join([*parts, f"cuts AS ({cuts})"])


def _stump_errors(rounds: int) -> str:
    return f"""
WITH {_stump_rounds(rounds)},
errors AS (SELECT split, {ERRORS} FROM state{rounds} GROUP BY split)
SELECT split, n, {_r("rmse", 4)} AS rmse, {_r("r2")} AS r2 FROM errors
"""


STUMP_NAMES = "(VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(STUMP_COLUMNS)) + ") names(f, feature)"

DAILY = """
means AS (SELECT o_orderpriority, avg(o_totalprice) AS prediction FROM orders GROUP BY 1),
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS actual, avg(prediction) AS predicted,
         avg(prediction - o_totalprice) AS error
  FROM orders JOIN means USING (o_orderpriority) GROUP BY 1)
"""

CORRELATED = """
series AS (
  SELECT row_number() OVER (ORDER BY day) AS t, error - avg(error) OVER () AS x FROM daily WHERE error IS NOT NULL),
base AS (SELECT sum(x * x) AS s0, count(*) AS n FROM series),
lags AS (SELECT unnest(range(31)) AS lag),
cor AS (
  SELECT lag, sum(a.x * b.x) / any_value(s0) AS r, any_value(n) AS n
  FROM lags CROSS JOIN base JOIN series a ON true JOIN series b ON b.t = a.t + lag GROUP BY lag)
"""

ITEM_NUMBERS = ("l_quantity", "l_discount", "l_tax", "l_linenumber", "l_extendedprice")
ITEM_FEATURES = ITEM_NUMBERS[:4]


def _partial(feature: str, column: str, weight: str, other: str, other_weight: str) -> str:
    return f"""
SELECT '{feature}' AS feature, i AS step, pt AS point, a + {weight} * pt + {other_weight} * {other} AS mean_prediction
FROM (SELECT i, CASE WHEN i = 19 THEN hi_{column} ELSE lo_{column} + i * ((hi_{column} - lo_{column}) / 19) END AS pt,
             w.*, test.* FROM (SELECT unnest(range(20)) AS i), w, test)
"""


ORACLES: dict[str, str] = {
    "source_report": """
SELECT c."column", c.type, n_rows
FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'),
             ('o_totalprice', 'double'), ('o_orderdate', 'timestamp'), ('o_orderpriority', 'string')) c("column", type),
     (SELECT count(*) AS n_rows FROM orders)
""",
    "null_profile": f"""
WITH {GAPPED}
""" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, count(*) AS n_rows FROM gapped"
        for c in ("event_id", "ts", "user_id", "event_type", "value", "props")
    ),
    "normalize_names": "SELECT event_id AS eventid, user_id AS userid, event_type AS eventtype, value FROM events",
    "cast_numeric": """
SELECT o_orderkey,
       TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS o_totalprice
FROM orders
""",
    "parse_time": """
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS parsed FROM events
""",
    "drop_required_nulls": f"""
WITH {GAPPED} SELECT event_id, event_type, value, props FROM gapped WHERE event_type IS NOT NULL AND value IS NOT NULL
""",
    "calendar_features": f"SELECT event_id, {CALENDAR.format(t='ts')} FROM events",
    "calendar_features_years": f"SELECT o_orderkey, {CALENDAR.format(t='o_orderdate')} FROM orders",
    "month_end_modes": """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) = last_day(o_orderdate) AS BIGINT) AS last_day,
       CAST(day(o_orderdate) BETWEEN 28 AND 31 AS BIGINT) AS late_days FROM orders
""",
    "cyclic_features": f"""
SELECT event_id, {_cycle("Hour", "hour(ts)", 24)}, {_cycle("DayOfWeek", "dayofweek(ts) + 1", 7)},
       {_cycle("Month", "month(ts)", 12)} FROM events
""",
    "epoch_seconds": "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s FROM events",
    "global_row_number": f"SELECT {ITEM_COLUMNS}, row_number() OVER (ORDER BY {ITEM_ORDER}) AS rn FROM lineitem",
    "chrono_split": f"WITH {EVENT_SPLIT} SELECT event_id, split FROM parted",
    "chrono_split_tied": f"WITH {ITEM_SPLIT} SELECT {ITEM_COLUMNS}, split FROM parted",
    "split_counts": f"WITH {EVENT_SPLIT} SELECT split, count(*) AS n FROM parted GROUP BY split",
    "hash_split": """
WITH placed AS (
  SELECT o_orderkey,
         CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM orders)
SELECT o_orderkey,
       CASE WHEN u < 0.7::DOUBLE THEN 'train' WHEN u < 0.7::DOUBLE + 0.201::DOUBLE THEN 'test' ELSE 'val' END AS split
FROM placed
""",
    "mean_impute": f"""
WITH {ITEM_SPLIT},
means AS (SELECT avg(nullif(l_discount, 0)) AS d, avg(nullif(l_tax, 0)) AS t FROM parted WHERE split = 'train')
SELECT {ITEM_COLUMNS}, {_r("coalesce(nullif(l_discount, 0), d)")} AS l_discount,
       {_r("coalesce(nullif(l_tax, 0), t)")} AS l_tax
FROM lineitem, means
""",
    "standard_scale": f"""
WITH {ITEM_SPLIT},
means AS (SELECT avg(nullif(l_discount, 0)) AS dm FROM parted WHERE split = 'train'),
filled AS (
  SELECT parted.*, l_quantity AS q, coalesce(nullif(l_discount, 0), dm) AS d, l_tax AS t, l_linenumber::DOUBLE AS l
  FROM parted, means),
s AS (
  SELECT avg(q) mq, avg(d) md, avg(t) mt, avg(l) ml,
         stddev_samp(q) sq, stddev_samp(d) sd, stddev_samp(t) st, stddev_samp(l) sl
  FROM filled WHERE split = 'train')
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice,
       {_r("(q - mq) / sq")} AS z_quantity, {_r("(d - md) / sd")} AS z_discount,
       {_r("(t - mt) / st")} AS z_tax, {_r("(l - ml) / sl")} AS z_linenumber
FROM filled, s
""",
    "inverse_scale": f"""
SELECT event_id, {_r("(value - (SELECT avg(value) FROM events)) / (SELECT stddev_samp(value) FROM events)")} AS z,
       {_r("value")} AS back FROM events
""",
    "categorical_index": """
WITH freq AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type),
indexed AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) - 1 AS index FROM freq)
SELECT event_id, index FROM events JOIN indexed USING (event_type)
""",
    "categorical_onehot": f"""
WITH {EVENT_SPLIT},
train AS (SELECT * FROM parted WHERE split = 'train' AND event_type <> 'error'),
freq AS (SELECT event_type, count(*) AS n FROM train GROUP BY event_type),
coded AS (SELECT event_type, row_number() OVER (ORDER BY n DESC, event_type) AS slot FROM freq),
spread AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM train)
SELECT event_id, {_r("(value - m) / s")} AS z, 1 + (SELECT count(*) FROM freq) AS slots,
       {", ".join(f"CASE WHEN slot = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS slot_{i}" for i in range(1, 5))}
FROM events LEFT JOIN coded USING (event_type), spread
""",
    "ols_metrics": f"""
WITH {OLS_EVENTS},
long AS (SELECT split, y, prediction AS p FROM fitted),
errors AS (SELECT split, {ERRORS}, pow(corr(y, p), 2) AS r2_corr FROM long GROUP BY split)
SELECT split, 'LinearRegression' AS model, n, {_r("rmse")} AS rmse, {_r("r2")} AS r2, {_r("r2_corr")} AS r2_corr FROM errors
""",
    "ols_predictions": f"""
WITH {OLS_EVENTS}
SELECT event_id, split, {_r("prediction")} AS prediction, {_r("prediction - value")} AS error FROM fitted
""",
    "least_squares_2d": _two_features("0"),
    "ridge_1d": _one_feature("cxy / (vx + 1.0::DOUBLE / n)"),
    "ridge_2d": _two_features("1.0::DOUBLE / n"),
    "lasso_1d": _one_feature(f"{_soft('cxy', '0.1::DOUBLE')} / vx"),
    "elastic_net_1d": _one_feature(_elastic("0.3::DOUBLE")),
    "grid_search": GRID_SEARCH,
    "rolling_folds": f"""
WITH {ROLLING} SELECT reg_param, year, any_value(n_train) AS n_train, count(*) AS n, {_r("sqrt(avg(e))", 4)} AS rmse
FROM missed GROUP BY reg_param, year
""",
    "rolling_search": f"""
WITH {ROLLING}, errors AS (SELECT reg_param, sqrt(avg(e)) AS rmse FROM missed GROUP BY reg_param)
SELECT row_number() OVER (ORDER BY rmse) AS place, reg_param, {_r("rmse", 4)} AS rmse FROM errors
""",
    "linear_family_2d": f"""
WITH {ITEM_MOMENTS}, every AS ({_two_weights("LinearRegression", "0")} UNION ALL {_two_weights("Ridge", "1.0::DOUBLE / n")})
SELECT model, split, n, {", ".join(f"{_r(c, 4)} AS {c}" for c in ("rmse", "w_quantity", "w_linenumber", "intercept"))} FROM every
""",
    "tree_stump": _stump_errors(1),
    "boosted_stumps": _stump_errors(5),
    "boosted_loop_stumps": _stump_errors(5),
    "feature_importance_stumps": f"""
WITH {_stump_rounds(5)}
SELECT feature, {_r("coalesce(sum(gain), 0) / (SELECT sum(gain) FROM cuts)")} AS importance
FROM {STUMP_NAMES} LEFT JOIN cuts USING (f) GROUP BY feature
""",
    "gain_importance_stumps": f"""
WITH {_stump_rounds(5)}
SELECT feature, count(*) AS n_splits, {_r("avg(gain) / 1e6", 4)} AS mean_gain,
       {_r("sum(gain) / (SELECT sum(gain) FROM cuts)")} AS gain_share
FROM {STUMP_NAMES} JOIN cuts USING (f) GROUP BY feature
""",
    "model_metrics": f"""
WITH {PREDICTED},
errors AS (SELECT model, split, {ERRORS}, pow(corr(y, p), 2) AS r2_corr, stddev_pop(p) AS sp FROM long GROUP BY model, split)
SELECT model, split, n, {_r("rmse")} AS rmse, {_r("r2")} AS r2,
       CASE WHEN model <> 'Mean' THEN {_r("r2_corr")} END AS r2_corr FROM errors
""",
    "evaluation_table": f"WITH {EVALUATED} SELECT {TABLE_COLUMNS} FROM evaluated",
    "metric_long": f"""
WITH {EVALUATED} SELECT model AS "Model", split, {_r("rmse")} AS rmse FROM errors
""",
    "model_ranking": f"""
WITH {EVALUATED} SELECT {TABLE_COLUMNS} FROM evaluated ORDER BY evaluated."Test_RMSE" NULLS LAST, pos LIMIT 3
""",
    "best_model": f"""
WITH {EVALUATED} SELECT "Model", {_r('"Test_RMSE"')} AS "Test_RMSE" FROM evaluated
WHERE pos = (SELECT pos FROM evaluated ORDER BY "Test_RMSE" NULLS LAST, pos LIMIT 1)
""",
    "ensemble_mean": f"WITH {ENSEMBLE} SELECT event_id, split, {_r('p')} AS ensemble FROM ensemble",
    "ensemble_vs_components": f"""
WITH {ENSEMBLE},
both_sides AS (
  SELECT model, y, p FROM long JOIN members USING (model) WHERE split = 'test'
  UNION ALL SELECT 'Ensemble_Top3', y, p FROM ensemble WHERE split = 'test'),
measured AS (SELECT model, {ERRORS} FROM both_sides GROUP BY model)
SELECT model AS "Model", {_r("rmse")} AS "Test_RMSE", {_r("r2")} AS "Test_R2" FROM measured
""",
    "bin_edges": f"WITH {ENDS} SELECT split, i AS edge_no, {_r('edge')} AS edge FROM edges",
    "bin_labels": f"""
WITH {ENDS},
text AS (SELECT split, i, CAST(CAST(CAST(edge AS VARCHAR) AS DECIMAL(30, 14)) AS DECIMAL(30, 2))::VARCHAR AS t FROM edges)
SELECT lower.split, lower.i + 1 AS bin, lower.t || '-' || upper.t AS label
FROM text lower JOIN text upper ON upper.split = lower.split AND upper.i = lower.i + 1
""",
    "confusion_digitize": f"""
WITH {ENDS},
binned AS (SELECT model, split, {_digitize("y")} AS actual_bin, {_digitize("p")} AS predicted_bin FROM long),
seen AS (SELECT model, split, actual_bin AS b FROM binned UNION SELECT model, split, predicted_bin FROM binned),
counts AS (SELECT model, split, actual_bin, predicted_bin, count(*) AS n FROM binned GROUP BY ALL)
SELECT a.model, a.split, a.b AS actual_bin, p.b AS predicted_bin, coalesce(n, 0) AS n
FROM seen a JOIN seen p USING (model, split)
LEFT JOIN counts c ON c.model = a.model AND c.split = a.split AND c.actual_bin = a.b AND c.predicted_bin = p.b
""",
    "confusion_cut": f"""
WITH {ENDS},
binned AS (
  SELECT model, split, {_cut("y")} AS actual_bin, {_cut("p")} AS predicted_bin FROM long JOIN ends USING (split)),
counts AS (
  SELECT model, split, actual_bin, predicted_bin, count(*) AS n FROM binned
  WHERE actual_bin IS NOT NULL AND predicted_bin IS NOT NULL GROUP BY ALL),
cells AS (
  SELECT DISTINCT model, split, a.i AS actual_bin, p.i AS predicted_bin
  FROM counts, steps a, steps p WHERE a.i > 0 AND p.i > 0)
SELECT model, split, CAST(actual_bin AS BIGINT) AS actual_bin, CAST(predicted_bin AS BIGINT) AS predicted_bin, coalesce(n, 0) AS n
FROM cells LEFT JOIN counts USING (model, split, actual_bin, predicted_bin)
""",
    "residual_histogram": f"""
WITH {PREDICTED},
res AS (SELECT p_type - value AS e FROM predicted),
span AS (SELECT min(e) AS e0, max(e) AS e1 FROM res),
counts AS (SELECT {_histogram_bin("e", "e0", "e1", 50)} AS bin, count(*) AS n FROM res, span GROUP BY 1)
SELECT i AS bin, {_r("e0 + i * ((e1 - e0) / 50)")} AS lo, {_r("e0 + (i + 1) * ((e1 - e0) / 50)")} AS hi, coalesce(n, 0) AS n
FROM (SELECT unnest(range(50)) AS i) CROSS JOIN span LEFT JOIN counts ON bin = i
""",
    "scatter_bins": _grid_counts("value", "prediction"),
    "residual_bins": _grid_counts("prediction", "prediction - value"),
    "qq_points": f"""
WITH {QUANTILES} SELECT event_id, {_r("residual")} AS residual, rn, {_r("x")} AS x FROM quantiles
""",
    "qq_line": f"""
WITH {QUANTILES} SELECT {_r("regr_slope(residual, x)", 5)} AS slope, {_r("regr_intercept(residual, x)", 5)} AS intercept,
       {_r("corr(residual, x)", 5)} AS r FROM quantiles
""",
    "qq_thin": f"""
WITH {QUANTILES},
ranks AS (
  SELECT CASE WHEN n <= 1000 THEN i + 1 ELSE 1 + i * (n - 1) // 999 END AS rn
  FROM (SELECT max(rn) AS n FROM quantiles), (SELECT unnest(range(1000)) AS i) WHERE i < n)
SELECT {_r("residual")} AS residual, rn, {_r("x")} AS x FROM quantiles JOIN ranks USING (rn)
""",
    "scatter_sample": f"""
WITH {PREDICTED}
SELECT {_r("value")} AS actual, {_r("prediction")} AS predicted, {_r("prediction - value")} AS residual
FROM predicted ORDER BY md5('42:' || event_id), event_id LIMIT 1000
""",
    "dependence_sample": """
WITH sampled AS (SELECT * FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 1000)
SELECT 'month' AS feature, CAST(month(o_orderdate) AS BIGINT) AS value, o_totalprice AS y FROM sampled
UNION ALL SELECT 'day', CAST(day(o_orderdate) AS BIGINT), o_totalprice FROM sampled
""",
    "correlation_matrix": "\nUNION ALL ".join(
        f"SELECT '{a}' AS f1, '{b}' AS f2, {_r(f'corr({a}, {b})')} AS corr FROM lineitem"
        for a in ITEM_NUMBERS for b in ITEM_NUMBERS
    ),
    "dependence_lines": "\nUNION ALL ".join(
        f"SELECT '{f}' AS feature, {_r(f'regr_slope(l_extendedprice, {f})', 4)} AS slope, "
        f"{_r(f'regr_intercept(l_extendedprice, {f})', 4)} AS intercept FROM lineitem"
        for f in ITEM_FEATURES
    ),
    "dependence_points": "\nUNION ALL ".join(
        f"SELECT l_extendedprice AS y, '{f}' AS feature, {f}::DOUBLE AS value FROM lineitem" for f in ITEM_FEATURES
    ),
    "partial_dependence": f"""
WITH {ITEM_MOMENTS},
v AS (
  SELECT m.*, (cxy * vz - czy * cxz) / (vx * vz - cxz * cxz) AS wx,
         (czy * vx - cxy * cxz) / (vx * vz - cxz * cxz) AS wz FROM m),
w AS (SELECT wx, wz, my - wx * mx - wz * mz AS a FROM v),
test AS (
  SELECT min(x) lo_x, max(x) hi_x, min(z) lo_z, max(z) hi_z, avg(x) AS mean_x, avg(z) AS mean_z
  FROM points WHERE split = 'test'),
lines AS ({_partial("l_quantity", "x", "wx", "mean_z", "wz")} UNION ALL {_partial("l_linenumber", "z", "wz", "mean_x", "wx")})
SELECT feature, step, {_r("point")} AS point, {_r("mean_prediction", 4)} AS mean_prediction FROM lines
""",
    "daily_errors": f"""
WITH {DAILY},
days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily)
SELECT CAST(day AS VARCHAR) AS day, {_halves("actual")} AS actual, {_halves("predicted")} AS predicted, {_halves("error")} AS error
FROM days LEFT JOIN daily USING (day)
""",
    "error_autocorrelation": f"""
WITH {DAILY},
{CORRELATED}
SELECT lag, {_r("r")} AS r,
       CASE WHEN lag = 0 THEN 0.0::DOUBLE ELSE {_r('''1.959963984540054::DOUBLE * sqrt((1 + 2 * coalesce(
         (SELECT sum(p.r * p.r) FROM cor p WHERE p.lag BETWEEN 1 AND cor.lag - 1), 0)) / n)''')} END AS band
FROM cor
""",
    # The Durbin-Levinson recursion over lists: phi of k + 1 from phi of k.
    "error_pacf": f"""
WITH RECURSIVE {DAILY},
{CORRELATED},
known AS (SELECT list(r ORDER BY lag) AS rs, any_value(n) AS n, least(count(*) - 1, CAST(ceil(any_value(n) / 2.0) AS BIGINT) - 1) AS last FROM cor),
steps AS (
  SELECT 1 AS k, [rs[2]] AS phi, rs[2] AS new FROM known
  UNION ALL
  SELECT k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - fresh * phi[k + 1 - j]), fresh), fresh
  FROM (
    SELECT k, phi, (rs[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rs[k + 2 - j])))
                   / (1 - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * rs[j + 1]))) AS fresh
    FROM steps, known WHERE k < last))
SELECT CAST(0 AS BIGINT) AS lag, 1.0::DOUBLE AS r, 0.0::DOUBLE AS band
UNION ALL SELECT CAST(k AS BIGINT), {_r("new")}, {_r("1.959963984540054::DOUBLE / sqrt(n)")} FROM steps, known
""",
    "malformed_report": """
WITH lines AS (
  SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'F' THEN 2 WHEN o_orderpriority = '1-URGENT' THEN 4 ELSE 3 END AS fields FROM orders)
SELECT CASE WHEN fields = 3 THEN 'row' ELSE 'reject' END AS kind, CAST(fields AS BIGINT) AS fields, count(*) AS n,
       min(key) AS "first", max(key) AS "last",
       (SELECT count(*) FROM lines other WHERE (other.fields = 3) = (lines.fields = 3)) AS counted
FROM lines GROUP BY fields
""",
    "sink_roundtrip": f"WITH {PREDICTED} SELECT event_id, value, {_r('p_type')} AS prediction FROM predicted",
    "evaluation_sink": f"WITH {EVALUATED} SELECT {TABLE_COLUMNS} FROM evaluated",
    "trip_run_linear": f"""
WITH {EVENT_SPLIT},
points AS (SELECT split, event_id, hour(ts)::DOUBLE AS x, day(ts)::DOUBLE AS z, value AS y FROM parted),
m AS (
  SELECT count(*)::DOUBLE - 1 AS k, avg(x) mx, avg(z) mz, avg(y) my, stddev_samp(x) sx, stddev_samp(z) sz, corr(x, z) AS c,
         covar_samp(x, y) / stddev_samp(x) AS bx, covar_samp(z, y) / stddev_samp(z) AS bz
  FROM points WHERE split = 'train'),
models AS (
  SELECT * FROM (VALUES ('LinearRegression', 0, 0.0::DOUBLE), ('Ridge_100', 1, 100.0::DOUBLE), ('Ridge_10000', 2, 10000.0::DOUBLE)) v("Model", pos, alpha)),
w AS (
  SELECT m.*, "Model", pos, k * (bx * (k + alpha) - k * c * bz) / ((k + alpha) * (k + alpha) - k * c * k * c) AS wx,
         k * (bz * (k + alpha) - k * c * bx) / ((k + alpha) * (k + alpha) - k * c * k * c) AS wz
  FROM m, models),
single AS (
  SELECT "Model", pos, event_id, split, y, my + wx * (x - mx) / sx + wz * (z - mz) / sz AS p FROM points, w),
scored AS (
  SELECT "Model", pos, split, y, p FROM single
  UNION ALL SELECT 'Ensemble_Top3', 3, split, any_value(y), avg(p) FROM single GROUP BY event_id, split),
errors AS (SELECT "Model", pos, split, {ERRORS} FROM scored GROUP BY "Model", pos, split),
evaluated AS (
  SELECT "Model", max(rmse) FILTER (split = 'train') AS "Train_RMSE", max(rmse) FILTER (split = 'test') AS "Test_RMSE",
         max(rmse) FILTER (split = 'val') AS "Val_RMSE", max(r2) FILTER (split = 'test') AS "Test_R2"
  FROM errors GROUP BY "Model", pos)
SELECT {TABLE_COLUMNS} FROM evaluated
""",
    "model_roundtrip": f"""
WITH {ITEM_MOMENTS},
w AS (
  SELECT m.*, (cxy * vz - czy * cxz) / (vx * vz - cxz * cxz) AS wx,
         (czy * vx - cxy * cxz) / (vx * vz - cxz * cxz) AS wz FROM m),
scored AS (SELECT split, y, my + wx * (x - mx) + wz * (z - mz) AS p FROM points, w),
errors AS (SELECT split, {ERRORS} FROM scored GROUP BY split)
SELECT split, n, {_r("rmse", 4)} AS rmse, {_r("r2")} AS r2 FROM errors
""",
}
