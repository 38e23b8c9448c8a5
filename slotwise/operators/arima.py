"""ARIMA order search whose training window grows with every origin.

Each origin is answered by a fit to *all* observations up to it, of every order of the grid, and no
row is read again for that: two-stage least squares (Hannan and Rissanen, 1982) needs an order's
regressors only through their cross products, and those are sums over rows. With
``z = (1, w_t, w_t-1, .. w_t-K)`` for the series (d = 0) and for its differences (d = 1), the sum of
``z z'`` up to an origin gives

* the long autoregression whose errors stand for the shocks: a system of its lags;
* the regression on lags and on lagged shocks: shocks are linear in ``z``, so their products are
  bilinear forms of the same sum;
* the residual sum of squares, hence AIC. All orders are compared on the same rows.

The sums are mergeable. A first pass adds them up per chunk of observations, running sums over these
summaries give what came before a chunk, and a second pass extends them to the origins within it.
A task holds one chunk, whatever the length of the series, and origins are solved side by side.

Missing slots are no observations; a forecast counts them as steps. Orders whose moving-average part
is not invertible are skipped. An origin is answered once ``least_rows`` observations are there.
"""

from __future__ import annotations

import sys
from itertools import product

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.chunks import CHUNK, Carry, carry, over_chunks
from slotwise.functions.timeslots import slot_start
from slotwise.operators.forecasts import is_origin, target_slots, with_figures
from slotwise.operators.grid import SLOT
from slotwise.params import SERIES, TS, Params
from slotwise.sources.staging import stage

# The helpers below travel with the tasks, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows whose products are summed at a time.
BLOCK = 4096
Order = tuple[int, int, int]


def orders_of(params: Params) -> list[Order]:
    return list(product(params.arima_p, params.arima_d, params.arima_q))


def lags_of(params: Params) -> int:
    """Lags in ``z``: those of the long autoregression, moved by the lags of the shocks."""
    return max(max(params.arima_p), params.arima_long + max(params.arima_q))


def least_rows(params: Params) -> int:
    """Observations that the long autoregression needs, with those before its first row."""
    return 2 * (params.arima_long + 1) + lags_of(params) + 1


def arima_forecasts(grid: DataFrame, target: str, params: Params) -> DataFrame:
    """Forecast of every origin by the order of lowest AIC among fits to all rows up to it."""
    h, lags = params.horizon, lags_of(params)
    reach = lags + 1
    if reach > params.span:
        raise ValueError("span must be at least as long as the lags")
    rows = with_figures(target_slots(grid, target, params), params)
    rows = over_chunks(
        rows, [SERIES], SLOT, params.span, lambda r, w: r.withColumn("y_true", F.lead("y", h).over(w)), 0, h
    )
    seen = {
        "_n": Carry("sum", "case when y is not null then 1L else 0L end"),
        "_at": Carry("last", f"case when y is not null then {SLOT} end"),
    }
    counted = carry(rows, [SERIES], SLOT, params.span, seen).withColumn("_origin", is_origin(params))
    used = counted.filter((F.col("y").isNotNull() | F.col("_origin")) & (F.col("_n") > 0)).withColumn("pos", F.col("_n") - 1)
    # Observations go to their chunk and, near its end, to the next one as the rows before it.
    own = f"cast(floor(pos / {params.span}D) as bigint)"
    late = f"case when y is not null and pmod(pos, {params.span}) >= {params.span - reach} then {own} + 1 end"
    copies = stage(
        used.selectExpr(
            SERIES, "pos", SLOT, "y - y_mean as y", "y_mean", "y_true", "_origin as is_origin", f"{SLOT} - _at as late",
            f"{own} as own", f"explode(array_compact(array({own}, {late}))) as {CHUNK}",
        )
    )
    key = copies.schema[SERIES].dataType.simpleString()
    orders, long = orders_of(params), params.arima_long

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        first, y, at = _observations(pdf)
        total = sum_products(y, lags, np.array([len(y) - 1]), first, None)[0] if len(at) else np.zeros((2, lags + 2, lags + 2))
        values = total.ravel()
        return pd.DataFrame(
            {SERIES: pdf[SERIES].iloc[0], CHUNK: pdf[CHUNK].iloc[0], "entry": np.arange(len(values)), "v": values}
        )

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        asked = left[left["is_origin"] & (left["own"] == left[CHUNK])].sort_values(SLOT)
        if not len(asked):
            return pd.DataFrame({c: [] for c in (SERIES, SLOT, "y_true", "y_pred", "p", "d", "q")})
        first, y, at = _observations(left)
        before = right["before"].iloc[0].reshape(2, lags + 2, lags + 2) if len(right) else None
        ends = asked["pos"].to_numpy() - int(at[0] if len(at) else 0)
        found = forecast(y, lags, ends, first, before, orders, long, h + asked["late"].to_numpy())
        out = asked[[SERIES, SLOT, "y_true"]].assign(
            y_pred=found[0] + asked["y_mean"].to_numpy(), p=found[1][:, 0], d=found[1][:, 1], q=found[1][:, 2]
        )
        return out[np.isfinite(found[0])]

    sums = copies.groupBy(SERIES, CHUNK).applyInPandas(add_up, f"`{SERIES}` {key}, {CHUNK} bigint, entry int, v double")
    before = carry(
        sums.withColumnRenamed(CHUNK, "_at"), [SERIES, "entry"], "_at", params.span, {"before": Carry("sum", "v")}, exclusive=True
    )
    state = before.groupBy(SERIES, F.col("_at").alias(CHUNK)).agg(
        F.expr("transform(sort_array(collect_list(struct(entry, coalesce(before, 0D) as before))), x -> x.before)").alias("before")
    )
    found = copies.groupBy(SERIES, CHUNK).cogroup(state.groupBy(SERIES, CHUNK)).applyInPandas(
        answer, f"`{SERIES}` {key}, {SLOT} bigint, y_true double, y_pred double, p int, d int, q int"
    )
    return found.withColumn("_target", F.col(SLOT) + h).select(
        SERIES, slot_start(SLOT, params.step).alias("origin"), slot_start("_target", params.step).alias(TS),
        F.lit("arima").alias("model"), "y_true", "y_pred", "p", "d", "q",
    )


def _observations(pdf: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The first own row of a chunk (a place in the values), the values in order, and their positions."""
    rows = pdf[pdf["y"].notna()].sort_values("pos")
    at = rows["pos"].to_numpy()
    return int((rows["own"] < rows[CHUNK]).sum()), rows["y"].to_numpy(float), at


def lagged_rows(y: np.ndarray, lags: int) -> np.ndarray:
    """``z`` of the values and of their differences, (rows, 2, lags + 2), from place lags + 1 on."""
    ahead = np.lib.stride_tricks.sliding_window_view(y, lags + 2)[:, ::-1]
    ones = np.ones((len(ahead), 1))
    return np.stack(
        [np.concatenate([ones, ahead[:, :-1]], axis=1), np.concatenate([ones, ahead[:, :-1] - ahead[:, 1:]], axis=1)], axis=1
    )


def sum_products(y: np.ndarray, lags: int, ends: np.ndarray, first: int, before: np.ndarray | None) -> np.ndarray:
    """Sums of ``z z'`` over the own rows up to each place of ``ends`` (ascending), and what is before."""
    out = np.zeros((len(ends), 2, lags + 2, lags + 2))
    total = np.zeros((2, lags + 2, lags + 2)) if before is None else before.copy()
    start = max(first, lags + 1)
    out[: np.searchsorted(ends, start)] = total
    for low in range(start, len(y), BLOCK):
        high = min(len(y), low + BLOCK)
        z = lagged_rows(y[low - lags - 1 : high], lags)
        a, b = np.searchsorted(ends, [low, high])
        if a == b:
            total = total + np.einsum("tdi,tdj->dij", z, z)
            continue
        running = np.cumsum(np.einsum("tdi,tdj->tdij", z, z), axis=0) + total
        out[a:b] = running[ends[a:b] - low]
        total = running[-1]
    return out


def _solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Stacked least squares from normal equations; directions without variation get no weight."""
    diagonal = np.sqrt(np.einsum("...ii->...i", a))
    scale = np.where(diagonal > 0, 1 / np.where(diagonal > 0, diagonal, 1), 0.0)
    scaled = a * scale[..., :, None] * scale[..., None, :]
    scaled = scaled + np.eye(a.shape[-1]) * np.where(diagonal > 0, 1e-12, 1.0)[..., None, :]
    return np.linalg.solve(scaled, (b * scale)[..., None])[..., 0] * scale


def search(sums: np.ndarray, orders: list[Order], long: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each stacked sum the order of lowest AIC (the first on a tie), its coefficients (constant, p
    lags, q shocks, zero where absent), the shock's weights on ``z``, and AIC by order."""
    n_origins, _, size, _ = sums.shape
    ps, qs = max(o[0] for o in orders), max(o[2] for o in orders)
    n = sums[:, 0, 0, 0]
    aic = np.full((n_origins, len(orders)), np.inf)
    coefs = np.zeros((n_origins, len(orders), 1 + ps + qs))
    shock = np.zeros((n_origins, 2, size))
    lag = [0, *range(2, long + 2)]
    for d in (0, 1):
        own = [k for k, o in enumerate(orders) if o[1] == d]
        if not own:
            continue
        s = sums[:, d]
        shock[:, d, 1] = 1.0
        if qs:
            shock[:, d, lag] = -_solve(s[:, lag][:, :, lag], s[:, lag, 1])
        # Rows: constant, lags, lagged shocks, and the value itself, as weights on z.
        terms = np.zeros((n_origins, 2 + ps + qs, size))
        terms[:, 0, 0] = 1.0
        for i in range(1, ps + 1):
            terms[:, i, 1 + i] = 1.0
        for j in range(1, qs + 1):
            terms[:, ps + j, 0] = shock[:, d, 0]
            terms[:, ps + j, 1 + j :] = shock[:, d, 1 : size - j]
        terms[:, -1, 1] = 1.0
        products = terms @ s @ terms.transpose(0, 2, 1)
        for k in own:
            p, _, q = orders[k]
            use = ([] if d else [0]) + list(range(1, p + 1)) + list(range(ps + 1, ps + q + 1))
            right = products[:, use, -1]
            found = _solve(products[:, use][:, :, use], right) if use else np.zeros((n_origins, 0))
            coefs[:, k, use] = found
            total = products[:, -1, -1]
            rest = np.maximum(total - (found * right).sum(axis=1), 1e-12 * total)
            variance = np.maximum(rest / np.maximum(n, 1), np.finfo(float).tiny)
            value = n * (np.log(2 * np.pi * variance) + 1.0) + 2 * (len(use) + 1)
            ma = coefs[:, k, 1 + ps : 1 + ps + q]
            aic[:, k] = np.where(_invertible(ma) & np.isfinite(value), value, np.inf)
    best = aic.argmin(axis=1)
    return best, coefs[np.arange(n_origins), best], shock, aic


def _invertible(ma: np.ndarray) -> np.ndarray:
    """Whether all roots of z^q + m1 z^(q-1) + .. lie within the unit circle."""
    q = ma.shape[1]
    if not q:
        return np.ones(len(ma), bool)
    companion = np.zeros((len(ma), q, q))
    companion[:, 0] = -np.nan_to_num(ma, nan=2.0, posinf=2.0, neginf=2.0)
    companion[:, range(1, q), range(q - 1)] = 1.0
    return np.abs(np.linalg.eigvals(companion)).max(axis=1) < 1.0


def forecast(
    y: np.ndarray, lags: int, ends: np.ndarray, first: int, before: np.ndarray | None, orders: list[Order], long: int, steps: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Value ``steps`` after the observation at each place of ``ends``, NaN without enough rows, and the order."""
    found = np.full(len(ends), np.nan)
    chosen = np.zeros((len(ends), 3), dtype=int)
    sums = sum_products(y, lags, ends, first, before)
    enough = np.flatnonzero((sums[:, 0, 0, 0] >= 2 * (long + 1)) & (ends >= lags + 1))
    if not len(enough):
        return found, chosen
    best, coef, shock, _ = search(sums[enough], orders, long)
    chosen[enough] = np.array(orders)[best]
    ps, qs = max(o[0] for o in orders), max(o[2] for o in orders)
    at, d = ends[enough], chosen[enough, 1]
    z = lagged_rows(y, lags)[at - lags - 1, d]
    weights = shock[np.arange(len(at)), d]
    past_w = [z[:, 1 + i] for i in range(ps)]
    past_e = []
    for j in range(qs):
        moved = np.zeros_like(weights)
        moved[:, 0] = weights[:, 0]
        moved[:, 1 + j :] = weights[:, 1 : weights.shape[1] - j]
        past_e.append((moved * z).sum(axis=1))
    level, value = y[at].copy(), np.zeros(len(at))
    wanted = steps[enough]
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(1, int(wanted.max()) + 1):
            value = coef[:, 0] + sum(coef[:, i] * w for i, w in enumerate(past_w, 1)) + sum(
                coef[:, 1 + ps + j] * e for j, e in enumerate(past_e)
            )
            past_w = [value, *past_w][:ps]
            past_e = [np.zeros(len(at)), *past_e][:qs]
            level = np.where(d == 1, level + value, value)
            found[enough] = np.where(wanted == k, level, found[enough])
    return found, chosen
