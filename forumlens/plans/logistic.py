"""Binary logistic regressions that share one stored set of rows.

The estimator of ``pyspark.ml`` keeps a copy of the training rows for each fit and reads it
a dozen times.  Here all models of a wave are evaluated in the same pass: a task adds up the
loss and the gradient of each model over its rows in numpy, the sums of the tasks are added
slice by slice of the features, and the driver keeps what it kept before, the state of the
models.  Objective, start, step rule and limits are the estimator's (mean log loss, ridge
penalty on standardised coefficients, limited-memory quasi-Newton steps under the strong
Wolfe conditions), so the models are the same; tests hold them against the estimator.
"""

from __future__ import annotations

from collections.abc import Callable, Generator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame

MEMORY = 10              # steps that a model's curvature is taken from, as in the estimator
ENTRIES = 1 << 17        # entries of a block: 1.5 MB
BLOCK = {"weight": np.float64, "label": np.int32, "label_row": np.int32, "sizes": np.int32, "at": np.int32, "j": np.int32,
         "x": np.float64}
SLICES = 32              # groups in which the sums of the tasks are added


def blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (``labels``, ``n``, sparse ``features``) in blocks of about ``ENTRIES`` non-zero entries.

    A block has the features that occur in it (``at``) and its entries row by row (``j``: place in
    ``at``, ``x``: value), as numpy bytes, so that a pass stays within the block's few weights.
    """
    def packed(weight, labels, places, sizes, at, x):
        features, j = np.unique(at, return_inverse=True)
        return {"weight": weight, "label": labels, "label_row": places, "sizes": sizes, "at": features, "j": j, "x": x}

    def task(batches):
        for b in batches:
            field = lambda name: b.column(b.schema.get_field_index(name))
            f, own = field("features"), field("labels")
            ends, own_ends = f.field("indices").offsets.to_numpy(), own.offsets.to_numpy()
            at, x, label = f.field("indices").values.to_numpy(), f.field("values").values.to_numpy(), own.values.to_numpy()
            weight = field("n").to_numpy().astype(float)
            first = 0
            while first < b.num_rows:
                last = max(first + 1, int(np.searchsorted(ends, ends[first] + ENTRIES, "right")) - 1)
                last = min(last, first + ENTRIES, b.num_rows)
                of, own_of = slice(ends[first], ends[last]), slice(own_ends[first], own_ends[last])
                places = np.repeat(np.arange(last - first), np.diff(own_ends[first:last + 1]))
                block = packed(weight[first:last], label[own_of], places, np.diff(ends[first:last + 1]), at[of], x[of])
                yield pa.RecordBatch.from_pydict({c: pa.array([block[c].astype(t).tobytes()], pa.binary()) for c, t in BLOCK.items()})
                first = last

    return rows.mapInArrow(task, ", ".join(f"{c} binary" for c in BLOCK))


def in_blocks(rows: DataFrame, path: str) -> DataFrame:
    """The blocks of ``rows``, written to ``path`` in small row groups (a reader holds one) and read back."""
    blocks(rows).write.options(**{"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 4,
                                  "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}).parquet(path)
    return rows.sparkSession.read.parquet(path)


def summed(rows: DataFrame, shape: tuple[int, int], add: Callable) -> np.ndarray:
    """The array of ``shape`` to which ``add(array, block)`` adds all blocks.

    No more tasks than cores hold such an array, whatever the size of the rows; they are added in
    the order of the tasks."""
    cuts, types = np.linspace(0, shape[1], min(SLICES, shape[1]) + 1).astype(int), dict(BLOCK)

    def task(batches):
        total = np.zeros(shape)
        for b in batches:
            for k in range(b.num_rows):
                add(total, {c: np.frombuffer(b.column(at)[k].as_buffer(), types[c]) for at, c in enumerate(b.schema.names)})
        parts = [total[:, a:z].tobytes() for a, z in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(range(len(parts)), pa.int32()), "task": pa.array([TaskContext.get().partitionId()] * len(parts), pa.int32()),
            "sums": pa.array(parts, pa.binary())})

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("task")
        total = sum(np.frombuffer(s.as_py()) for s in group["sums"])
        return pa.table({"part": group["part"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    each = rows.select(*BLOCK).coalesce(rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(task, "part int, task int, sums binary")
    got = {r["part"]: r["sums"] for r in each.groupBy("part").applyInArrow(merge, "part int, sums binary").collect()}
    if not got:
        return np.zeros(shape)
    return np.hstack([np.frombuffer(got[k]).reshape(shape[0], -1) for k in range(len(cuts) - 1)])


def deviations(s: np.ndarray, ss: np.ndarray, n: float) -> np.ndarray:
    """Standard deviation of each feature from its sum and its sum of squares."""
    return np.sqrt(np.maximum(ss - s * s / n, 0.0) / (n - 1)) if n > 1 else np.zeros(len(s))


class SearchFailed(Exception):
    pass


Points = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


def _between(low, high) -> float:
    """The minimum of the cubic through two points (t, value, slope), kept off their ends."""
    (t0, f0, d0), (t1, f1, d1) = sorted((low, high), key=lambda p: p[0])
    a = d0 + d1 - 3 * (f0 - f1) / (t0 - t1)
    with np.errstate(invalid="ignore", divide="ignore"):
        b = np.sqrt(a * a - d0 * d1)
        t = t1 - (t1 - t0) * (d1 + b - a) / (d1 - d0 + 2 * b)
    least, most = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return least if t < least else most if t > most else t


def _step(x: np.ndarray, value: float, slope: float, way: np.ndarray, t: float):
    """A step along ``way`` under the strong Wolfe conditions; yields points, returns (x, value, gradient)."""
    def tried(t):
        at = x + way * t
        f, g = yield at
        return (t, f, float(g @ way)), (at, f, g)

    def enough(p):
        return abs(p[2]) <= 0.9 * abs(slope)

    if slope > 0:
        raise SearchFailed
    low, pair = (0.0, value, slope), None
    for i in range(10):
        p, found = yield from tried(t)
        if not np.isfinite(p[1]):
            t /= 2
            continue
        if p[1] > value + 1e-4 * t * slope or (p[1] >= low[1] and i > 0):
            pair = (low, p)
        elif enough(p):
            return found
        elif p[2] >= 0:
            pair = (p, low)
        if pair:
            break
        low, t = p, t * 1.5
    if not pair:
        raise SearchFailed
    low, high = pair
    for _ in range(10):
        p, found = yield from tried(_between(low, high))
        if p[1] > value + 1e-4 * p[0] * slope or p[1] >= low[1]:
            high = p
        elif enough(p):
            return found
        else:
            if p[2] * (high[0] - low[0]) >= 0:
                high = low
            low = p
    raise SearchFailed


def _direction(g: np.ndarray, past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient, scaled by the curvature of the last steps (newest first)."""
    way, shares = g.copy(), []
    scale = 1.0
    if past:
        s, y = past[0]
        if not s @ y >= 0:
            raise SearchFailed
        scale = (s @ y) / (y @ y)
    for s, y in past:
        shares.append((s @ way) / (s @ y))
        way -= shares[-1] * y
    way *= scale
    for (s, y), share in reversed(list(zip(past, shares))):
        way += (share - (y @ way) / (s @ y)) * s
    return -way


def minimised(x: np.ndarray, iterations: int, tolerance: float) -> Points:
    """Yields the points at which it wants (value, gradient); returns the last one it steps to."""
    value, g = yield x
    start, values, past, done, failed = value, [value], [], 0, False
    while done < iterations and np.linalg.norm(g) > max(tolerance * value, 1e-8):
        if len(values) > 1 and abs(value - max(values)) <= tolerance * start:
            break
        try:
            way = _direction(g, past)
            t = 1.0 if done else 1.0 / np.linalg.norm(way)
            new, value_, g_ = yield from _step(x, value, float(g @ way), way, t)
        except SearchFailed:
            if failed:
                break
            past, failed = [], True
            continue
        past = [(new - x, g_ - g), *past][:MEMORY]
        x, value, g, done, failed = new, value_, g_, done + 1, False
        values.append(value)
    return x


def _fitted(rows: DataFrame, keys: list[int], num_features: int, positive: np.ndarray, n: float,
            mean: np.ndarray, sd: np.ndarray, reg: float, iterations: int, tolerance: float) -> list[tuple[np.ndarray, float]]:
    """(coefficients, intercept) of the models ``keys``, all evaluated in the same passes."""
    sc = rows.sparkSession.sparkContext
    scale = np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0)

    def plain(at):
        return at[:-1] * scale, at[-1] - float((at[:-1] * scale) @ mean)

    searches, wanted, found = {}, {}, {}
    for k in keys:
        if 0 < positive[k] < n:
            first = np.zeros(num_features + 1)
            first[-1] = np.log(positive[k] / (n - positive[k]))
            searches[k] = minimised(first, iterations, tolerance)
            wanted[k] = next(searches[k])
        else:
            found[k] = np.zeros(num_features), np.inf if positive[k] else -np.inf
    while wanted:
        state = sc.broadcast([(k, *plain(at)) for k, at in wanted.items()])

        def add(total, block, state=state):
            n, x, at, j = block["weight"], block["x"], block["at"], block["j"].astype(np.intp)
            row = np.repeat(np.arange(len(n)), block["sizes"])
            for i, (k, w, b) in enumerate(state.value):
                yes = np.bincount(block["label_row"][block["label"] == k], minlength=len(n))
                z = np.bincount(row, w[at].take(j) * x, len(n)) + b
                e = np.exp(-np.abs(z))
                wrong = n * (np.where(z >= 0, 1.0, e) / (1.0 + e)) - yes
                total[i, at] += np.bincount(j, wrong.take(row) * x, len(at))
                total[i, -2:] += wrong.sum(), (n * (np.log1p(e) + np.maximum(z, 0.0)) - yes * z).sum()

        sums = summed(rows, (len(wanted), num_features + 2), add)
        state.unpersist()
        for s, (k, at) in zip(sums, list(wanted.items())):
            g = np.append((s[:-2] - mean * s[-2]) * scale / n + reg * at[:-1], s[-2] / n)
            try:
                wanted[k] = searches[k].send((s[-1] / n + reg / 2 * float(at[:-1] @ at[:-1]), g))
            except StopIteration as end:
                found[k] = plain(end.value)
                del wanted[k]
    return [found[k] for k in keys]


def fit_all(rows: DataFrame, k: int, num_features: int, at_once: int, reg: float, iterations: int,
            tolerance: float = 1e-6) -> list[LogisticRegressionModel]:
    """Models 0 to ``k`` - 1 of ``rows``, a stored table of ``blocks`` that every pass reads.

    A row counts ``n`` times and is positive for model i as often as i is in its ``labels``.
    Passes serve ``at_once`` models each."""
    def add(total, block):
        x, at, j = block["x"], block["at"], block["j"]
        weight = np.repeat(block["weight"], block["sizes"])
        total[0, at] += np.bincount(j, weight * x, len(at))
        total[1, at] += np.bincount(j, weight * x * x, len(at))
        total[0, num_features] += block["weight"].sum()
        total[0, num_features + 1:] += np.bincount(block["label"], minlength=k)

    s, ss = summed(rows, (2, num_features + 1 + k), add)
    n, positive = s[num_features], s[num_features + 1:]
    s, ss = s[:num_features], ss[:num_features]
    mean, sd = s / max(n, 1.0), deviations(s, ss, n)
    sc, models = rows.sparkSession.sparkContext, []
    make = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    for first in range(0, k, at_once):
        keys = list(range(first, min(k, first + at_once)))
        for i, (w, b) in zip(keys, _fitted(rows, keys, num_features, positive, n, mean, sd, reg, iterations, tolerance)):
            models.append(LogisticRegressionModel(make(f"logreg_{i}", _py2java(sc, Vectors.dense(w)), float(b))))
    return models
