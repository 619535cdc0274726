"""SQL texts that solve the same models in closed form, for checking."""

from tallycast.operators.regression import GRID_L1_SHARE, GRID_STRENGTH

_PAIRS = (("h", "h"), ("h", "m"), ("h", "y"), ("m", "m"), ("m", "y"), ("y", "y"))
_COLUMN = {"h": "hour", "m": "minute", "y": "cumulative_votes"}


def _moments() -> str:
    names = ["CAST(count(*) AS DOUBLE) AS n"]
    names += [f"avg({c}) AS mean_{t}" for t, c in _COLUMN.items()]
    names += [f"covar_pop({_COLUMN[a]}, {_COLUMN[b]}) AS cov_{a}{b}" for a, b in _PAIRS]
    return ", ".join(names)


# Unpenalised fit per key by Cramer's rule, from a relation ``cumulative``.
OLS_SQL = f"""moments AS (SELECT key, {_moments()} FROM cumulative GROUP BY key),
slopes AS (SELECT *, (cov_hy * cov_mm - cov_my * cov_hm) / (cov_hh * cov_mm - cov_hm * cov_hm) AS hour_coef,
    (cov_my * cov_hh - cov_hy * cov_hm) / (cov_hh * cov_mm - cov_hm * cov_hm) AS minute_coef FROM moments),
ols AS (SELECT key, hour_coef, minute_coef, mean_y - hour_coef * mean_h - minute_coef * mean_m AS intercept,
    CAST(n AS BIGINT) AS n FROM slopes)"""

_GRID_VALUES = ", ".join(
    f"({i * len(GRID_L1_SHARE) + j}, {s}, {a})" for i, s in enumerate(GRID_STRENGTH) for j, a in enumerate(GRID_L1_SHARE)
)

# Penalised fits of a relation ``folded(key, fold, hour, minute, cumulative_votes)``. With two features the
# minimum is one of a few closed forms (both features kept with some signs, one, or none), so all are
# written out and the one with the smallest objective is taken. Fold -1 is the fit on all rows.
CV_SQL = f"""grid(grid, reg_param, elastic_net_param) AS (VALUES {_GRID_VALUES}),
held(fold) AS (VALUES (-1), (0), (1), (2), (3), (4)),
train AS (SELECT key, held.fold, {_moments()} FROM folded JOIN held ON folded.fold <> held.fold GROUP BY key, held.fold),
scaled AS (SELECT *, sqrt(cov_hh) AS sh, sqrt(cov_mm) AS sm, sqrt(cov_yy) AS sy,
    cov_hm / sqrt(cov_hh * cov_mm) AS g, cov_hy / sqrt(cov_hh * cov_yy) AS r1, cov_my / sqrt(cov_mm * cov_yy) AS r2 FROM train),
penalised AS (SELECT s.*, grid.*, reg_param / sy * elastic_net_param AS l1, reg_param / sy * (1 - elastic_net_param) AS l2
    FROM scaled s, grid),
signs(s1, s2) AS (VALUES (1, 1), (1, -1), (-1, 1), (-1, -1), (1, 0), (-1, 0), (0, 1), (0, -1), (0, 0)),
tried AS (SELECT p.*, CASE WHEN s1 = 0 THEN 0 WHEN s2 = 0 THEN (r1 - s1 * l1) / (1 + l2)
        ELSE ((r1 - s1 * l1) * (1 + l2) - (r2 - s2 * l1) * g) / ((1 + l2) * (1 + l2) - g * g) END AS b1,
    CASE WHEN s2 = 0 THEN 0 WHEN s1 = 0 THEN (r2 - s2 * l1) / (1 + l2)
        ELSE ((r2 - s2 * l1) * (1 + l2) - (r1 - s1 * l1) * g) / ((1 + l2) * (1 + l2) - g * g) END AS b2
    FROM penalised p, signs),
valued AS (SELECT *, 0.5 * (b1 * b1 + 2 * g * b1 * b2 + b2 * b2) - r1 * b1 - r2 * b2
    + l1 * (abs(b1) + abs(b2)) + 0.5 * l2 * (b1 * b1 + b2 * b2) AS objective FROM tried),
solved AS (SELECT key, fold, grid, any_value(reg_param) AS reg_param, any_value(elastic_net_param) AS elastic_net_param,
    arg_min(b1 * sy / sh, objective) AS hour_coef, arg_min(b2 * sy / sm, objective) AS minute_coef,
    arg_min(mean_y - b1 * sy / sh * mean_h - b2 * sy / sm * mean_m, objective) AS intercept FROM valued GROUP BY key, fold, grid),
fold_rmse AS (SELECT s.key, s.grid, s.fold, sqrt(avg(
    (cumulative_votes - hour_coef * hour - minute_coef * minute - intercept) ** 2)) AS rmse
    FROM solved s JOIN folded f ON f.key = s.key AND f.fold = s.fold GROUP BY 1, 2, 3),
scores AS (SELECT key, grid, avg(rmse) AS mean_rmse FROM fold_rmse GROUP BY 1, 2),
cv AS (SELECT s.key, s.grid, s.reg_param, s.elastic_net_param, mean_rmse, hour_coef, minute_coef, intercept
    FROM solved s JOIN scores USING (key, grid) WHERE s.fold = -1)"""


def ar_sql(source: str, by: str, order: str, lags: int) -> str:
    """Relations ``equations`` and ``phi(…, phi_1..phi_p)`` of a relation ``source(by…, order, total)``."""
    p = range(1, lags + 1)
    lag = ", ".join(f"lag(d, {i}) OVER w AS l{i}" for i in p)
    sums = [f"coalesce(sum(CAST(l{i} AS DOUBLE) * l{j}) FILTER (l{lags} IS NOT NULL), 0.0) AS g_{i}_{j}" for i in p for j in p if j >= i]
    sums += [f"coalesce(sum(CAST(l{i} AS DOUBLE) * d) FILTER (l{lags} IS NOT NULL), 0.0) AS r_{i}" for i in p]
    tail = ", ".join(["arg_max(d, {0}) AS t1"] + [f"arg_max(l{i}, {{0}}) AS t{i + 1}" for i in range(1, lags)]).format(order)
    out = f"""diffs AS (SELECT *, total - lag(total) OVER (PARTITION BY {by} ORDER BY {order}) AS d FROM {source}),
lagged AS (SELECT *, {lag} FROM diffs WINDOW w AS (PARTITION BY {by} ORDER BY {order})),
equations AS (SELECT {by}, count(l{lags}) AS n, {", ".join(sums)}, max({order}) AS last_ts,
    arg_max(CAST(total AS DOUBLE), {order}) AS last_value, {tail} FROM lagged GROUP BY {by})"""
    # Gaussian elimination, one relation per pivot; the Gram matrix is positive definite.
    m = {(i, j): f"g_{min(i, j)}_{max(i, j)}" for i in p for j in p} | {(i, lags + 1): f"r_{i}" for i in p}
    full = ", ".join(f"{m[i, j]} AS a0_{i}_{j}" for i in p for j in range(1, lags + 2))
    out += f",\nstep0 AS (SELECT *, {full} FROM equations)"
    for k in range(1, lags):
        cells = ", ".join(
            f"a{k - 1}_{i}_{j} - a{k - 1}_{i}_{k} / a{k - 1}_{k}_{k} * a{k - 1}_{k}_{j} AS a{k}_{i}_{j}"
            if i > k else f"a{k - 1}_{i}_{j} AS a{k}_{i}_{j}"
            for i in p for j in range(1, lags + 2)
        )
        out += f",\nstep{k} AS (SELECT *, {cells} FROM step{k - 1})"
    last, relation = lags - 1, f"step{lags - 1}"
    for i in reversed(p):
        known = "".join(f" - a{last}_{i}_{j} * phi_{j}" for j in range(i + 1, lags + 1))
        out += f",\nback{i} AS (SELECT *, (a{last}_{i}_{lags + 1}{known}) / a{last}_{i}_{i} AS phi_{i} FROM {relation})"
        relation = f"back{i}"
    return out + f",\nphi AS (SELECT * FROM {relation})"


def ar_forecast_sql(by: str, lags: int, horizon: int, minutes: int = 1) -> str:
    """Relation ``ahead(by…, step, ts, forecast)`` from ``phi``."""
    p = range(1, lags + 1)
    carried = ", ".join(f"phi_{i}" for i in p)
    new = " + ".join(f"phi_{i} * t{i}" for i in p)
    shift = "".join(f", t{i} AS t{i + 1}" for i in range(1, lags))
    start = ", ".join(f"CAST(t{i} AS DOUBLE) AS t{i}" for i in p)
    return f"""walk AS (WITH RECURSIVE w AS (
    SELECT {by}, 0 AS step, last_ts, last_value AS value, {carried}, {start} FROM phi
    UNION ALL
    SELECT {by}, step + 1, last_ts, value + {new}, {carried}, {new}{shift} FROM w WHERE step < {horizon}) SELECT * FROM w),
ahead AS (SELECT {by}, step, last_ts + to_minutes(step * {minutes}) AS ts, value AS forecast FROM walk WHERE step > 0)"""


def linear_sql(source: str, by: str, features: list[str], label: str) -> str:
    """Relation ``linear(by, n, c1..cd, intercept)``: least squares of a relation's label on its features, by elimination on covariances."""
    p, d = range(1, len(features) + 1), len(features)
    column = dict(zip(p, features)) | {d + 1: label}
    as_double = {i: f"CAST({c} AS DOUBLE)" for i, c in column.items()}
    means = ", ".join(f"avg({as_double[i]}) AS mean_{i}" for i in column)
    cells = ", ".join(f"covar_pop({as_double[i]}, {as_double[j]}) AS a0_{i}_{j}" for i in p for j in range(1, d + 2))
    out = f"step0 AS (SELECT {by}, count(*) AS n, {means}, {cells} FROM {source} GROUP BY {by})"
    for k in range(1, d):
        cells = ", ".join(
            f"a{k - 1}_{i}_{j} - a{k - 1}_{i}_{k} / a{k - 1}_{k}_{k} * a{k - 1}_{k}_{j} AS a{k}_{i}_{j}"
            if i > k else f"a{k - 1}_{i}_{j} AS a{k}_{i}_{j}"
            for i in p for j in range(1, d + 2)
        )
        out += f",\nstep{k} AS (SELECT *, {cells} FROM step{k - 1})"
    relation = f"step{d - 1}"
    for i in reversed(p):
        known = "".join(f" - a{d - 1}_{i}_{j} * c{j}" for j in range(i + 1, d + 1))
        out += f",\nback{i} AS (SELECT *, (a{d - 1}_{i}_{d + 1}{known}) / a{d - 1}_{i}_{i} AS c{i} FROM {relation})"
        relation = f"back{i}"
    return out + f",\nlinear AS (SELECT *, mean_{d + 1}{''.join(f' - c{i} * mean_{i}' for i in p)} AS intercept FROM {relation})"
