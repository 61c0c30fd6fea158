"""Forecasters, and their use on every series or window."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..keys import SERIES, TIME, micros_between, require_columns, same_keys
from .lagsums import BLOCK, block_sums, differences, lag_products, products_of

DEFAULT, FALLBACK = (1, 1, 1), (1, 1, 0)


def _lagged(values: np.ndarray, lags: list[int], start: int) -> np.ndarray:
    return np.column_stack([values[start - k : len(values) - k] for k in lags]) if lags else np.zeros((len(values) - start, 0))


def _least_squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(x, y, rcond=None)[0] if x.shape[1] else np.zeros(0)


def _solved(g: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least-squares coefficients by normal equations; the shortest where columns depend on each other."""
    if not len(b):
        return np.zeros(0)
    scale = np.sqrt(np.diag(g))
    scale = np.where(scale > 0, scale, 1.0)
    return np.linalg.pinv(g / np.outer(scale, scale), rcond=1e-13, hermitian=True) @ (b / scale) / scale


class Shape:
    """The lags of an order: of the regression, of the long autoregression before it, and the differences."""

    def __init__(self, order: tuple[int, int, int], seasonal: tuple[int, int, int, int] = (0, 0, 0, 0)) -> None:
        p, d, q = order
        sp, sd, sq, s = seasonal
        self.d, self.sd, self.s = d, sd if s else 0, s
        self.ar = [*range(1, p + 1), *(k * s for k in range(1, sp + 1) if s)]
        self.ma = [*range(1, q + 1), *(k * s for k in range(1, sq + 1) if s)]
        self.longest = max([0, *self.ar, *self.ma])
        self.long_ar = list(range(1, max(p, q) + 3)) if self.ma else []
        self.start = self.longest + len(self.long_ar)
        self.lost = d + self.sd * s
        self.centered = self.lost == 0
        self.least = len(self.ar) + len(self.ma) + 2

    def differences(self) -> np.ndarray:
        """(1 - B)^d (1 - B^s)^D by powers of B."""
        out = np.ones(1)
        for step, times in ((1, self.d), (self.s, self.sd)):
            for _ in range(times):
                out = np.convolve(out, np.concatenate([[1.0], np.zeros(step - 1), [-1.0]]))
        return out

    def differenced(self, values: np.ndarray) -> np.ndarray:
        w = values
        for _ in range(self.sd):
            w = w[self.s :] - w[: -self.s]
        return np.diff(w, self.d) if self.d else w


class Fitted:
    """An ARMA regression of a differenced series, by two least-squares steps.

    The first step takes residuals of a long autoregression in place of the
    unknown shocks; the second regresses on lags of the series and of those.
    """

    def __init__(self, values: np.ndarray, order: tuple[int, int, int], seasonal: tuple[int, int, int, int] = (0, 0, 0, 0)) -> None:
        shape = Shape(order, seasonal)
        values = np.asarray(values, dtype=float)
        w = shape.differenced(values)
        mean = w.mean() if shape.centered and len(w) else 0.0
        w, first = w - mean, len(shape.long_ar)
        if len(w) - shape.start < shape.least:
            raise ValueError("series too short for the order")
        design = _lagged(w, shape.long_ar, first)
        phi = _least_squares(design, w[first:])
        shocks = np.zeros(len(w))
        if shape.ma:
            shocks[first:] = w[first:] - design @ phi
        design = np.hstack([_lagged(w, shape.ar, shape.start), _lagged(shocks, shape.ma, shape.start)])
        self._end(values, shape, mean, phi, _least_squares(design, w[shape.start :]))

    @classmethod
    def of_sums(cls, shape: Shape, lags: tuple[int, ...], products: np.ndarray, head: np.ndarray, tail: np.ndarray, center: float) -> Fitted:
        """The same fit from a long series' lag products and its two ends.

        ``products``: of the differenced series, over all places that have the lag ``shape.start``.  Both
        regressions' normal equations are combinations of them, since their columns are combinations of
        lags; the first one also counts the earlier places that it reaches, from the head.
        """
        place = {k: i for i, k in enumerate(lags)}

        def columns(shifts: list[int], by: np.ndarray) -> np.ndarray:
            out = np.zeros((len(lags), len(shifts)))
            for j, shift in enumerate(shifts):
                for k, c in enumerate(by):
                    out[place[k + shift], j] += c
            return out

        own, phi, first = np.ones(1), np.zeros(0), len(shape.long_ar)
        if shape.ma:
            w = shape.differenced(head[: shape.lost + shape.start] - center)
            early = _lagged(w, [0, *shape.long_ar], first) if len(w) > first else np.zeros((0, first + 1))
            c = columns([0, *shape.long_ar], own)
            g = c.T @ products @ c + early.T @ early
            phi = _solved(g[1:, 1:], g[1:, 0])
        c = np.hstack([columns([0, *shape.ar], own), columns(shape.ma, np.concatenate([[1.0], -phi]))])
        g = c.T @ products @ c
        out = cls.__new__(cls)
        out._end(tail, shape, center if shape.centered else 0.0, phi, _solved(g[1:, 1:], g[1:, 0]))
        return out

    def _end(self, values: np.ndarray, shape: Shape, mean: float, phi: np.ndarray, beta: np.ndarray) -> None:
        """Take the coefficients and the shocks that they leave over the given values."""
        self.values, self.d, self.sd, self.s, self.ar, self.ma = values, shape.d, shape.sd, shape.s, shape.ar, shape.ma
        self.mean, self.beta = mean, beta
        self.w = w = shape.differenced(values) - mean
        first, start = len(shape.long_ar), shape.start
        self.shocks = np.zeros(len(w))
        if shape.ma:
            self.shocks[first:] = w[first:] - _lagged(w, shape.long_ar, first) @ phi
        residual = w[start:] - np.hstack([_lagged(w, shape.ar, start), _lagged(self.shocks, shape.ma, start)]) @ beta
        self.shocks[start:] = residual
        self.variance = float(np.mean(residual**2)) if len(residual) else 0.0
        if not np.all(np.isfinite(beta)):
            raise ValueError("no finite fit")

    def forecast(self, steps: int) -> np.ndarray:
        w, e = self.w.tolist(), self.shocks.tolist()
        for _ in range(steps):
            lags = [w[-k] if k <= len(w) else 0.0 for k in self.ar] + [e[-k] if k <= len(e) else 0.0 for k in self.ma]
            w.append(float(np.dot(self.beta, lags)) if lags else 0.0)
            e.append(0.0)
        out = np.array(w[len(self.w) :]) + self.mean
        levels = [self.values]
        for _ in range(self.sd):
            levels.append(levels[-1][self.s :] - levels[-1][: -self.s])
        ordinary = [levels[-1]]
        for _ in range(self.d):
            ordinary.append(np.diff(ordinary[-1]))
        for level in reversed(ordinary[:-1]):
            out = level[-1] + np.cumsum(out)
        for level in reversed(levels[:-1]):
            past = level[-self.s :].tolist()
            for v in out:
                past.append(past[-self.s] + v)
            out = np.array(past[self.s :])
        return out


def fit_arima(values: np.ndarray, order: tuple[int, int, int] = DEFAULT, seasonal: tuple[int, int, int, int] = (0, 0, 0, 0)) -> Fitted | None:
    """A fit of the order, else of (1, 1, 0), else None."""
    for o, s in ((order, seasonal), (FALLBACK, (0, 0, 0, 0))):
        try:
            return Fitted(values, o, s)
        except (ValueError, np.linalg.LinAlgError):
            continue
    return None


def arima(values: np.ndarray, steps: int, order: tuple[int, int, int] = DEFAULT, seasonal: tuple[int, int, int, int] = (0, 0, 0, 0)) -> np.ndarray:
    """Forecast of ``steps`` values; series too short for any fit repeat their last value."""
    values = np.asarray(values, dtype=float)
    values = values[np.isfinite(values)]
    fitted = fit_arima(values, order, seasonal)
    if fitted is None:
        return np.full(steps, values[-1] if len(values) else np.nan)
    return fitted.forecast(steps)


def arima_windows(x: np.ndarray, steps: int, order: tuple[int, int, int] = DEFAULT, seasonal: tuple[int, int, int, int] = (0, 0, 0, 0)) -> np.ndarray:
    """``arima`` of every row of ``x``: (rows, steps).

    Rows of an order without shocks and seasons are fitted together: their lag products are sums over the
    matrix, and the small systems are solved at once.  Other orders, and rows with gaps, go one by one.
    """
    x = np.asarray(x, dtype=float)
    shape = Shape(order, seasonal)
    together = not shape.ma and not shape.sd and len(shape.ar) == order[0] and x.shape[1] - shape.lost - shape.start >= shape.least
    whole = np.isfinite(x).all(axis=1) & together
    out = np.empty((len(x), steps))
    for i in np.flatnonzero(~whole):
        out[i] = arima(x[i], steps, order, seasonal)
    if not whole.any():
        return out
    v = x[whole]
    w = np.diff(v, shape.d, axis=1) if shape.d else v
    mean = w.mean(axis=1, keepdims=True) if shape.centered else np.zeros((len(w), 1))
    w, p = w - mean, order[0]
    lags = [w[:, p - k : w.shape[1] - k] for k in range(p + 1)]
    g = np.array([[np.einsum("ij,ij->i", a, b) for b in lags] for a in lags]).transpose(2, 0, 1)
    scale = np.sqrt(np.einsum("ijj->ij", g[:, 1:, 1:]))
    scale = np.where(scale > 0, scale, 1.0)
    inverse = np.linalg.pinv(g[:, 1:, 1:] / (scale[:, :, None] * scale[:, None, :]), rcond=1e-13, hermitian=True)
    beta = np.einsum("ijk,ik->ij", inverse, g[:, 1:, 0] / scale) / scale
    past = w[:, w.shape[1] - p :]
    made = np.empty((len(w), steps))
    for i in range(steps):
        made[:, i] = np.einsum("ij,ij->i", beta, past[:, ::-1])
        past = np.concatenate([past[:, 1:], made[:, i : i + 1]], axis=1) if p else past
    made += mean
    for d in range(shape.d - 1, -1, -1):
        made = np.diff(v, d, axis=1)[:, -1:] + np.cumsum(made, axis=1)
    out[whole] = made
    return out


class Trend:
    """Columns and penalties of an additive model: a piecewise-linear trend, daily, weekly and yearly waves.

    The bends of the trend are damped by ``prior``.
    """

    def __init__(self, n: int, step_seconds: int, first_second: float, daily: int = 4, weekly: int = 3, yearly: int = 0, changepoints: int = 25, prior: float = 0.05, level: float = 0.95) -> None:
        self.scale, self.step, self.first = max(n - 1, 1), step_seconds, first_second
        self.bends = np.linspace(0, 0.8 * self.scale, changepoints + 2)[1:-1] if n > changepoints + 2 else np.zeros(0)
        self.waves = [(k, period) for period, k_max in ((86_400, daily), (604_800, weekly), (31_557_600, yearly)) for k in range(1, k_max + 1)]
        self.penalty = np.concatenate([[0, 1e-8], np.full(len(self.bends), 1 / prior), np.full(2 * len(self.waves), 1e-2)]) + 1e-9
        self.z = {0.8: 1.2816, 0.9: 1.6449, 0.95: 1.96, 0.99: 2.5758}.get(level, 1.96)

    def columns(self, t: np.ndarray) -> np.ndarray:
        seconds = self.first + t * self.step
        waves = [f(2 * np.pi * k * seconds / period) for k, period in self.waves for f in (np.sin, np.cos)]
        return np.column_stack([np.ones(len(t)), t / self.scale, *[np.maximum(t - b, 0) / self.scale for b in self.bends], *waves])

    def sums(self, t: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Products of all columns and y, as a vector; those of parts of a series add up."""
        z = np.column_stack([self.columns(t), y])
        return (z.T @ z).ravel()

    def forecast(self, sums: np.ndarray, n: int, steps: int) -> np.ndarray:
        """(steps, 3): the ridge fit of the sums, and the normal interval of its residuals."""
        k = len(self.penalty)
        g = np.asarray(sums, dtype=float).reshape(k + 1, k + 1)
        beta = np.linalg.solve(g[:k, :k] + np.diag(self.penalty), g[:k, k])
        off = np.append(-beta, 1.0)
        rest = max(float(off @ g @ off) / n - float(g[0] @ off / n) ** 2, 0.0)
        future = self.columns(np.arange(n, n + steps)) @ beta
        spread = self.z * np.sqrt(rest)
        return np.column_stack([future, future - spread, future + spread])


def seasonal_trend(values: np.ndarray, steps: int, step_seconds: int = 15, first_second: float = 0.0, **params) -> np.ndarray:
    """(steps, 3): forecast, lower and upper bound of an additive model (``Trend``) of one array."""
    y = np.asarray(values, dtype=float)
    if not len(y):
        return np.full((steps, 3), np.nan)
    model, center = Trend(len(y), step_seconds, first_second, **params), y.mean()
    return model.forecast(model.sums(np.arange(len(y)), y - center), len(y), steps) + center


def _finite(df: DataFrame) -> DataFrame:
    """Rows with a finite value; a series without one has no row left, and no forecast."""
    require_columns(df, *SERIES, TIME, "value")
    value = F.col("value").cast("double")
    return df.filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")))


def _short(df: DataFrame, block: int) -> bool:
    """Whether no series has more rows than a block: then each is a group of its own, which is one shuffle."""
    return (df.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0) <= block


def _per_series(df: DataFrame, one, schema: str) -> DataFrame:
    """``one(frame of a series in time order)`` for each series, as rows of its key and ``schema``."""
    require_columns(df, *SERIES, TIME, "value")
    time = dict(df.dtypes)[TIME]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = one(pdf.sort_values(TIME).dropna(subset=["value"]))
        return out.assign(**{k: pdf[k].iat[0] for k in SERIES})

    fields = schema.replace("<time>", time)
    return df.select(*SERIES, TIME, F.col("value").cast("double")).groupBy(*SERIES).applyInPandas(run, f"metric_name string, container_name string, {fields}")


def forecast_series(df: DataFrame, steps: int, order: tuple[int, int, int] = DEFAULT, seasonal: tuple[int, int, int, int] = (0, 0, 0, 0), block: int = BLOCK) -> DataFrame:
    """(series, step, forecast): ARIMA of every series, however long.

    Where no series has more than ``block`` rows (a job counts them), each is fitted as it is.  Else the
    regressions come from lag products, added up over blocks of so many rows; after that a series is one
    row with its two ends, and those of fewer rows than these are fitted directly.
    """
    df = _finite(df)
    if _short(df, block):

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"step": np.arange(1, steps + 1), "forecast": arima(pdf["value"].to_numpy(), steps, order, seasonal)})

        return _per_series(df, one, "step int, forecast double")
    shape = Shape(order, seasonal)
    shifts = {0, *shape.ar, *shape.ma, *shape.long_ar, *(a + b for a in shape.ma for b in shape.long_ar)}
    lags = tuple(sorted(shifts | {shape.start}))
    keep = shape.lost + shape.start + shape.longest + shape.least + 8
    sums = lag_products(df, lags, keep, (tuple(shape.differences().tolist()),), block)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                head, tail = np.asarray(r.head, dtype=float), np.asarray(r.tail, dtype=float)
                if r.n <= keep:
                    out = arima(head, steps, order, seasonal)
                else:
                    out = Fitted.of_sums(shape, lags, np.asarray(r.products, dtype=float).reshape(len(lags), -1), head, tail, r.center).forecast(steps)
                yield pd.DataFrame({"metric_name": r.metric_name, "container_name": r.container_name, "step": np.arange(1, steps + 1), "forecast": out})

    return sums.mapInPandas(run, "metric_name string, container_name string, step int, forecast double")


def forecast_ar1_differences(df: DataFrame, steps: int) -> DataFrame:
    """(series, step, forecast) of order (1, 1, 0) with built-in functions: phi = sum(d d') / sum(d'²)."""
    from ..keys import in_series

    w = in_series(df)
    moved = df.withColumn("_d", F.col("value") - F.lag("value").over(w)).withColumn("_e", F.lag("_d").over(w))
    last = F.max_by(F.struct("value", "_d"), TIME)
    fit = moved.groupBy(*SERIES).agg(F.coalesce(F.try_divide(F.sum(F.col("_d") * F.col("_e")), F.sum(F.when(F.col("_d").isNotNull(), F.col("_e") * F.col("_e")))), F.lit(0.0)).alias("phi"), last.alias("last"))
    rows = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
    growth = F.aggregate(F.sequence(F.lit(1), F.col("step")), F.lit(0.0), lambda acc, k: acc + F.pow("phi", k))
    return rows.select(*SERIES, "step", (F.col("last.value") + F.coalesce("last._d", F.lit(0.0)) * growth).alias("forecast"))


def order_grid(max_p: int = 3, max_d: int = 2, max_q: int = 3) -> list[tuple[int, int, int]]:
    return list(product(range(max_p + 1), range(max_d + 1), range(max_q + 1)))


#: Lags that an order's prediction errors look back; all orders are compared on the rows that have them.
MEMORY = 32
CRITERIA = ("aic", "bic")


def _inverse(theta: np.ndarray, n: int) -> np.ndarray:
    """The first n + 1 powers of 1 / (1 + theta_1 B + theta_2 B^2 + ...)."""
    back, out = theta.tolist(), [1.0]
    for _ in range(n if back else 0):
        out.append(-sum(t * x for t, x in zip(back, reversed(out), strict=False)))
    return np.array(out) if back else np.eye(1, n + 1)[0]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two power series, as far as the second one goes."""
    return np.convolve(a, b)[: len(b)]


def _delayed(a: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([np.zeros(k), a[: len(a) - k]])


def _invertible(theta: np.ndarray) -> bool:
    """Whether every root of z^q + theta_1 z^(q-1) + ... is below 0.99, by Schur and Cohn's recursion on its scaled coefficients."""
    a = [t / 0.99**k for k, t in enumerate(theta.tolist(), 1)]
    while a:
        last = a.pop()
        if not abs(last) < 1:
            return False
        a = [(x - last * y) / (1 - last * last) for x, y in zip(a, reversed(a), strict=True)]
    return True


class Innovations:
    """One-step prediction errors of orders, as sums over a series' lag products.

    An order's error at t is a combination of the ``memory`` lags before it (the autoregressive form of
    the model), so the sum of its squares is a quadratic form of the products, and Gauss-Newton steps
    find the coefficients that make it least without another look at the series.  Every order counts the
    same rows: a difference does not change the error of predicting the next value.
    """

    def __init__(self, products: list[np.ndarray], n: int) -> None:
        """``products``: of the series, its first, second, ... difference, over ``n`` common rows."""
        self.products, self.n, self.memory = products, n, len(products[0]) - 1

    def variance(self, order: tuple[int, int, int]) -> tuple[float, np.ndarray]:
        """(mean squared error, coefficients phi and theta) of an order at its least."""
        p, d, q = order
        k, g = p + q, self.products[d]

        def series(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            inverse = _inverse(b[p:], self.memory)
            return inverse, _times(np.concatenate([[1.0], -b[:p]]), inverse)

        def moves(inverse: np.ndarray, pi: np.ndarray) -> np.ndarray:
            again = _times(pi, inverse)
            by = [_delayed(inverse, i) for i in range(1, p + 1)] + [_delayed(again, i) for i in range(1, q + 1)]
            return -np.column_stack(by)

        b = self._begin(order) if k else np.zeros(0)
        inverse, c = series(b)
        least = float(c @ g @ c)
        for _ in range(30 if k else 0):
            j = moves(inverse, c)
            slope = j.T @ g @ c
            step, left = -_solved(j.T @ g @ j, slope), least
            if -float(step @ slope) <= 1e-13 * least:  # halves of a step that promises nothing need no trial
                break
            for _ in range(12):
                new = b + step
                if _invertible(new[p:]) and (total := float((made := series(new))[1] @ g @ made[1])) < left:
                    b, (inverse, c), left = new, made, total
                    break
                step = step / 2
            if left >= least * (1 - 1e-11):
                break
            least = left
        return max(float(c @ g @ c), 0.0) / self.n, b

    def _begin(self, order: tuple[int, int, int]) -> np.ndarray:
        """Two least-squares steps, the shocks being those of a long autoregression."""
        p, d, q = order
        far = min(p + q + 4, self.memory - q)
        lag = lambda power, shift: _delayed(np.concatenate([power, np.zeros(self.memory + 1 - len(power))]), shift)
        shock = np.ones(1)
        if q:
            g = self.products[d][: far + 1, : far + 1]
            shock = np.concatenate([[1.0], -_solved(g[1:, 1:], g[1:, 0])])
        z = np.column_stack([lag(np.ones(1), i) for i in range(p + 1)] + [lag(shock, i) for i in range(1, q + 1)])
        g = z.T @ self.products[d] @ z
        b = _solved(g[1:, 1:], g[1:, 0])
        while not _invertible(b[p:]):
            b[p:] *= 0.9 ** np.arange(1, q + 1)
        return b

    def criterion(self, order: tuple[int, int, int], name: str = "aic") -> float:
        """n log(variance) plus a price for each coefficient, the variance and, without differences, the mean."""
        p, d, q = order
        floor = 1e-18 * float(self.products[0][0, 0]) / self.n
        price = 2.0 if name == "aic" else float(np.log(self.n))
        return self.n * float(np.log(max(self.variance(order)[0], floor, 1e-300))) + price * (p + q + 1 + (d == 0))


def best_order(found: Innovations, orders: list[tuple[int, int, int]], criterion: str = "aic") -> tuple[float | None, tuple[int, int, int]]:
    """The order of the least criterion, of equal ones the smallest; (None, (1, 1, 1)) where none can be fitted."""
    fitted = [(found.criterion(o, criterion), o) for o in sorted(orders) if found.n >= o[0] + o[2] + 3 and o[0] + o[2] < found.memory]
    return min((f for f in fitted if np.isfinite(f[0])), default=(None, DEFAULT))


def search_orders(df: DataFrame, orders: list[tuple[int, int, int]] | None = None, criterion: str = "aic", block: int = BLOCK) -> DataFrame:
    """(series, p, d, q, aic or bic): the order of the least criterion; (1, 1, 1) where none fits.

    Every order is judged by its one-step errors on the same rows, those that have ``MEMORY`` lags and
    the greatest d, so unit and differences do not favour an order.  The search sees lag products only,
    one small matrix a series; where a series has more than ``block`` rows (a job counts them), they are
    added up over blocks.  Series that are short for it look back over a quarter of their rows.
    """
    if criterion not in CRITERIA:
        raise ValueError(f"unknown criterion: {criterion}; one of {CRITERIA}")
    tried = sorted(orders or order_grid())
    most_d = max(o[1] for o in tried)
    powers = [Shape((0, d, 0)).differences() for d in range(most_d + 1)]
    lags = tuple(range(MEMORY + 1))
    keep = 4 * MEMORY + most_d

    def direct(values: np.ndarray) -> tuple[float | None, tuple[int, int, int]]:
        n = len(values)
        memory = MEMORY if n > keep else max(1, min(MEMORY, n // 4))
        products = [products_of(differences(values - values.mean(), p), tuple(range(memory + 1)), memory + most_d - len(p) + 1) for p in powers]
        left = n - memory - most_d
        return best_order(Innovations(products, left), tried, criterion) if left > 0 else (None, DEFAULT)

    def row(found: tuple[float | None, tuple[int, int, int]]) -> dict:
        return {"p": found[1][0], "d": found[1][1], "q": found[1][2], criterion: pd.array([found[0]], dtype="Float64")}

    fields = f"p int, d int, q int, {criterion} double"
    df = _finite(df)
    if _short(df, block):
        return _per_series(df, lambda pdf: pd.DataFrame(row(direct(pdf["value"].to_numpy(float)))), fields)
    sums = lag_products(df, lags, keep, tuple(tuple(p.tolist()) for p in powers), block)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                if r.n <= keep:
                    found = direct(np.asarray(r.head, dtype=float))
                else:
                    products = list(np.asarray(r.products, dtype=float).reshape(len(powers), len(lags), -1))
                    found = best_order(Innovations(products, r.n - MEMORY - most_d), tried, criterion)
                yield pd.DataFrame({"metric_name": [r.metric_name], "container_name": [r.container_name], **row(found)})

    return sums.mapInPandas(run, f"metric_name string, container_name string, {fields}")


def forecast_seasonal_trend(df: DataFrame, steps: int, step_seconds: int = 15, block: int = BLOCK, **params) -> DataFrame:
    """(series, timestamp, forecast, lower, upper) on the grid that starts after a series' last time.

    The fit needs only products of its columns; where a series has more than ``block`` rows (a job counts
    them), they are added up over blocks, and one row a series is solved.  Rows without a value are left out, and the others are taken as following
    each other at ``step_seconds``.
    """
    there = _finite(df)
    time = dict(df.dtypes)[TIME]
    if _short(there, block):

        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            out = seasonal_trend(pdf["value"].to_numpy(), steps, step_seconds, pdf[TIME].iat[0].timestamp(), **params)
            times = pd.date_range(pdf[TIME].iat[-1] + pd.Timedelta(seconds=step_seconds), periods=steps, freq=f"{step_seconds}s")
            return pd.DataFrame({TIME: times, "forecast": out[:, 0], "lower": out[:, 1], "upper": out[:, 2]})

        return _per_series(there, one, f"{TIME} <time>, forecast double, lower double, upper double")
    # the waves follow the clock: their phase at the first row is the same in every block
    ends = there.groupBy(*[F.col(k).alias(f"_{k}") for k in SERIES]).agg(F.min(F.col(TIME)).alias("first"), F.max(F.col(TIME)).alias("last"))
    micros = micros_between(F.lit("1970-01-01").cast(time), F.col("first"))

    def sums(at: np.ndarray, v: np.ndarray, n: int, center: float, start: int) -> np.ndarray:
        # phases are put in when the series' first time is known
        return Trend(n, step_seconds, 0.0, **params).sums(at, v - center)

    found = block_sums(there, sums, "products", 0, block).join(ends.withColumn("second", micros / 1_000_000), same_keys(list(SERIES), "_"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for r in pdf.itertuples(index=False):
                turn = _turned(Trend(r.n, step_seconds, 0.0, **params), r.second)
                g = np.asarray(r.products, dtype=float).reshape(len(turn) + 1, -1)
                whole = np.eye(len(g))
                whole[:-1, :-1] = turn
                out = Trend(r.n, step_seconds, r.second, **params).forecast(whole @ g @ whole.T, r.n, steps) + r.center
                times = pd.date_range(r.last + pd.Timedelta(seconds=step_seconds), periods=steps, freq=f"{step_seconds}s")
                yield pd.DataFrame({"metric_name": r.metric_name, "container_name": r.container_name, TIME: times, "forecast": out[:, 0], "lower": out[:, 1], "upper": out[:, 2]})

    chosen = found.select(*SERIES, "n", "center", "products", "second", "last")
    return chosen.mapInPandas(run, f"metric_name string, container_name string, {TIME} {time}, forecast double, lower double, upper double")


def _turned(model: Trend, second: float) -> np.ndarray:
    """The model's columns for waves that start at ``second``, as combinations of those that start at 0."""
    first = len(model.penalty) - 2 * len(model.waves)
    out = np.eye(len(model.penalty))
    for i, (k, period) in enumerate(model.waves):
        a, j = 2 * np.pi * k * second / period, first + 2 * i
        out[j : j + 2, j : j + 2] = [[np.cos(a), np.sin(a)], [-np.sin(a), np.cos(a)]]
    return out


def batch_score(df: DataFrame, models: dict[str, object], scalers: DataFrame, steps: int) -> DataFrame:
    """Scale, forecast and scale back every series by the model of its metric.

    ``models``: metric -> callable (values, steps); metrics without one are
    left out, none known raises.  ``scalers``: (feature, center, scale) with
    the metric as feature, one row a metric.
    """
    if not models:
        raise ValueError("unknown metric: no model is given")
    chosen = df.filter(F.col("metric_name").isin(*models))
    stats = scalers.select(F.col("feature").alias("metric_name"), "center", "scale")
    scaled = chosen.join(stats, "metric_name").withColumn("value", (F.col("value") - F.col("center")) / F.col("scale"))

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        metric = pdf["metric_name"].iat[0]
        return pd.DataFrame({"step": np.arange(1, steps + 1), "forecast": np.asarray(models[metric](pdf["value"].to_numpy(), steps), dtype=float)})

    out = _per_series(scaled, one, "step int, forecast double").join(stats, "metric_name")
    return out.select(*SERIES, "step", (F.col("forecast") * F.col("scale") + F.col("center")).alias("forecast"))
