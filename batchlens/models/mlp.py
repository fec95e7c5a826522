"""ReLU MLP regressor trained by rounds of local Adam.

Spark ML has no MLP regressor. The design rows are stored once, and kept as blocks of numbers (an Arrow batch each) in the workers' memory and on their
disks. In a round, a fixed number of tasks each stream their share of
the blocks, take Adam steps from the current state, and return state and row count; states are averaged by rows in
a sum by key of fixed-size chunks, and the driver receives the one averaged state. So a Python worker holds one block and
one state, and what is shuffled and collected depends on the model's size and WORKERS only. The same pass scores the
incoming weights on a hash-selected validation share, so a round is one job; all points of a grid train in the same
pass. Training stops when R2 on the validation share has not improved by ``tol`` for ``n_iter_no_change`` rounds.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from batchlens.models.base import PFX, PREDICTION, load_json, save_json, spread, with_features
from batchlens.operators.preprocess import FitStats, fit_stats
from batchlens.spec import TableSpec

SEED = 42
#: Tasks of a training round, whatever the input's size.
WORKERS = 32
CHUNK = 4096

# The reference's MLP grid and defaults.
MLP_GRID = {"hidden_layer_sizes": [(128, 64), (256, 128, 64)], "alpha": [1e-4, 1e-3], "learning_rate_init": [1e-3, 5e-4]}
MLP_DEFAULT = {
    "hidden_layer_sizes": (256, 128, 64),
    "alpha": 1e-4,
    "learning_rate_init": 5e-4,
    "batch_size": 256,
    "max_iter": 200,
    "n_iter_no_change": 15,
    "validation_fraction": 0.1,
    "tol": 1e-4,
}


def design(pdf: pd.DataFrame, st: FitStats) -> np.ndarray:
    """Numeric inputs then one-hot categories (train categories only; unseen -> all zeros)."""
    parts = [pdf[[PFX + c for c in st.numerical]].to_numpy(dtype=np.float64)] if st.numerical else []
    for c in st.categorical:
        cats = st.categories.get(c, [])
        col = pdf[PFX + c].to_numpy()
        parts.append(np.stack([(col == v) for v in cats], axis=1).astype(np.float64) if cats else np.zeros((len(pdf), 0)))
    return np.concatenate(parts, axis=1) if parts else np.zeros((len(pdf), 0))


def coded(pdf: pd.DataFrame, st: FitStats) -> tuple[np.ndarray, np.ndarray]:
    """The numeric inputs, and the places of the categories in their lists (-1 for one that is not there)."""
    numbers = pdf[[PFX + c for c in st.numerical]].to_numpy(dtype=np.float64)
    places = [pd.Index(st.categories.get(c, []), dtype=object).get_indexer(pdf[PFX + c].astype(object)) for c in st.categorical]
    return numbers, np.stack(places, axis=1).astype(np.int32) if places else np.zeros((len(pdf), 0), np.int32)


def decoded(numbers: np.ndarray, places: np.ndarray, st: FitStats) -> np.ndarray:
    """What ``design`` makes of the rows that were ``coded``."""
    widths = [len(st.categories.get(c, [])) for c in st.categorical]
    at = numbers.shape[1]
    out = np.zeros((len(numbers), at + sum(widths)))
    out[:, :at] = numbers
    for k, width in enumerate(widths):
        known = np.flatnonzero(places[:, k] >= 0)
        out[known, at + places[known, k]] = 1.0
        at += width
    return out


def init_weights(sizes: list[int], seed: int = SEED) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    ws = []
    for fan_in, fan_out in zip(sizes[:-1], sizes[1:]):
        bound = np.sqrt(6.0 / (fan_in + fan_out))
        ws.append(rng.uniform(-bound, bound, (fan_in, fan_out)))
        ws.append(rng.uniform(-bound, bound, fan_out))
    return ws


def forward(ws: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    acts = [x]
    h = x
    n_layers = len(ws) // 2
    for i in range(n_layers):
        h = h @ ws[2 * i]
        h += ws[2 * i + 1]
        if i < n_layers - 1:
            np.maximum(h, 0.0, out=h)
        acts.append(h)
    return h[:, 0], acts


class Adam:
    """Weights with their moments; ``steps`` takes mini-batch steps on squared loss + L2, in place."""

    def __init__(self, ws, m, v, t, params: dict):
        self.ws, self.m, self.v, self.t = ws, m, v, t
        self.lr, self.alpha, self.size = float(params["learning_rate_init"]), float(params["alpha"]), int(params["batch_size"])

    @classmethod
    def start(cls, ws, params):
        return cls([w.copy() for w in ws], [np.zeros_like(w) for w in ws], [np.zeros_like(w) for w in ws], 0.0, params)

    def steps(self, x: np.ndarray, y: np.ndarray, rng) -> None:
        order = rng.permutation(len(x))
        layers = len(self.ws) // 2
        room = [(np.empty_like(w), np.empty_like(w)) for w in self.ws]
        for at in range(0, len(x), self.size):
            pick = order[at : at + self.size]
            out, acts = forward(self.ws, x[pick])
            delta = ((out - y[pick]) / len(pick))[:, None]
            self.t += 1
            one, two = 1 - 0.9**self.t, 1 - 0.999**self.t
            for i in range(layers - 1, -1, -1):
                decay = self.alpha * self.ws[2 * i]
                decay /= len(pick)
                decay += acts[i].T @ delta
                grads = (decay, delta.sum(axis=0))
                if i > 0:
                    delta = delta @ self.ws[2 * i].T
                    delta *= acts[i] > 0
                for j, g in zip((2 * i, 2 * i + 1), grads):
                    w, m, v, (a, b) = self.ws[j], self.m[j], self.v[j], room[j]
                    m *= 0.9
                    m += np.multiply(g, 0.1, out=a)
                    v *= 0.999
                    np.multiply(g, 0.001, out=a)
                    a *= g
                    v += a
                    # w - lr * (m / one) / (sqrt(v / two) + 1e-8)
                    np.sqrt(np.divide(v, two, out=a), out=a)
                    a += 1e-8
                    np.divide(m, one, out=b)
                    b /= a
                    b *= self.lr
                    w -= b

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for part in (self.ws, self.m, self.v) for a in part] + [np.array([self.t])])

    @classmethod
    def from_flat(cls, flat: np.ndarray, like: list[np.ndarray], params: dict) -> "Adam":
        parts, at = [], 0
        for _ in range(3):
            own = []
            for w in like:
                own.append(flat[at : at + w.size].reshape(w.shape).copy())
                at += w.size
            parts.append(own)
        return cls(*parts, float(flat[at]), params)


def _pack(ws) -> bytes:
    buf = io.BytesIO()
    np.savez(buf, *ws)
    return buf.getvalue()


def _unpack(b: bytes) -> list[np.ndarray]:
    z = np.load(io.BytesIO(b))
    return [z[f"arr_{i}"] for i in range(len(z.files))]


@dataclass
class MLPModel:
    spec: TableSpec
    params: dict
    stats: FitStats
    weights: list[np.ndarray]
    kind: str = "mlp"

    @classmethod
    def fit(cls, df: DataFrame, spec: TableSpec, params: dict | None = None, max_rounds: int | None = None, stats: FitStats | None = None) -> "MLPModel":
        return train_together(df, spec, [params or {}], max_rounds, stats)[0]

    def continue_fit(self, df: DataFrame) -> "MLPModel":
        """One round over the new rows from the stored weights, with the stored preprocessing and no early stopping."""
        blocks = row_blocks(design_rows(df, self.stats, self.spec, 0.0), self.stats)
        state = Adam.start(self.weights, self.params)
        state, _ = one_round(blocks, {0: state}, self.stats, 0, True)
        return MLPModel(self.spec, self.params, self.stats, state[0].ws)

    def predict(self, df: DataFrame) -> DataFrame:
        st, packed = self.stats, _pack(self.weights)
        names = [PFX + c for c in st.numerical + st.categorical]

        @F.pandas_udf(DoubleType())
        def score(*cols: pd.Series) -> pd.Series:
            w = _unpack(packed)
            pdf = pd.DataFrame({n: c for n, c in zip(names, cols)})
            return pd.Series(forward(w, design(pdf, st))[0])

        exprs = with_features(df, st, "mlp")
        out = exprs.withColumn(PREDICTION, score(*[F.col(n) for n in names]))
        return out.drop(*names)

    def save(self, path: str) -> None:
        params = {**self.params, "hidden_layer_sizes": list(self.params["hidden_layer_sizes"])}
        save_json(path, {"kind": self.kind, "params": params, "stats": self.stats.to_json()}, _pack(self.weights))

    @classmethod
    def load(cls, path: str, spec: TableSpec) -> "MLPModel":
        m, weights = load_json(path)
        return cls(spec, m["params"], FitStats.from_json(m["stats"]), _unpack(weights))


def design_rows(df: DataFrame, st: FitStats, spec: TableSpec, validation: float) -> DataFrame:
    """Stored model inputs, target ``__y`` and validation flag ``__v`` of the rows with a target."""
    cols = [PFX + c for c in st.numerical + st.categorical]
    rows = with_features(df, st, "mlp").where(F.col(spec.target).isNotNull()).select(*cols, F.col(spec.target).cast("double").alias("__y"))
    bucket = F.pmod(F.xxhash64(*rows.columns), F.lit(1000))
    return spread(rows.withColumn("__v", bucket < int(validation * 1000)), "mlp-rows")


def row_blocks(frame: DataFrame, st: FitStats) -> RDD:
    """Inputs (as ``coded``), targets and validation flags of each Arrow batch of design rows, as bytes. Rounds read these instead of the rows."""

    def cut(batches):
        for pdf in batches:
            if len(pdf):
                parts = *coded(pdf, st), pdf["__y"].to_numpy(np.float64), pdf["__v"].to_numpy(bool)
                yield pd.DataFrame({c: [a.tobytes()] for c, a in zip("xpyv", parts)})

    return frame.coalesce(WORKERS).mapInPandas(cut, "x binary, p binary, y binary, v binary").rdd


def one_round(blocks: RDD, states: dict[int, Adam], st: FitStats, rnd: int, train: bool):
    """One job: (averaged states, validation figures by model) after each task has streamed its share of the rows."""
    sc = blocks.context
    sent = sc.broadcast({k: (s.flat(), [w.shape for w in s.ws], {"learning_rate_init": s.lr, "alpha": s.alpha, "batch_size": s.size}) for k, s in states.items()})

    def local(batches):
        own, figures = {}, {}
        for k, (flat, shapes, params) in sent.value.items():
            like = [np.empty(x) for x in shapes]
            own[k] = Adam.from_flat(flat, like, params)
            figures[k] = np.zeros(5)  # train rows, validation rows, squared errors, sum and squares of y
        before = {k: [w.copy() for w in a.ws] for k, a in own.items()}
        rng = np.random.default_rng(SEED + rnd)
        for block in batches:
            y, v = np.frombuffer(block["y"], np.float64), np.frombuffer(block["v"], bool)
            x, p = np.frombuffer(block["x"], np.float64), np.frombuffer(block["p"], np.int32)
            x = decoded(x.reshape(len(y), len(st.numerical)), p.reshape(len(y), len(st.categorical)), st)
            for k, a in own.items():
                if v.any():
                    e = forward(before[k], x[v])[0] - y[v]
                    figures[k][1:] += (v.sum(), (e * e).sum(), y[v].sum(), (y[v] ** 2).sum())
                if train and not v.all():
                    a.steps(x[~v], y[~v], rng)
                    figures[k][0] += (~v).sum()
        for k, a in own.items():
            flat = a.flat() * figures[k][0]
            parts = [flat[i : i + CHUNK] for i in range(0, len(flat), CHUNK)] if figures[k][0] else []
            yield (k, -1), figures[k]
            yield from (((k, i), part) for i, part in enumerate(parts))

    got = blocks.mapPartitions(local).reduceByKey(np.add).collect()  # at most WORKERS chunks of a key
    sent.unpersist()
    figures = {k: vec for (k, i), vec in got if i == -1}
    out = {}
    for k, s in states.items():
        parts = [vec for _, vec in sorted(((i, vec) for (o, i), vec in got if o == k and i >= 0), key=lambda p: p[0])]
        rows = figures[k][0] if k in figures else 0
        params = {"learning_rate_init": s.lr, "alpha": s.alpha, "batch_size": s.size}
        out[k] = Adam.from_flat(np.concatenate(parts) / rows, s.ws, params) if rows else s
    return out, figures


def _r2(f) -> float | None:
    if f is None or f[1] < 1:
        return None
    total = f[4] - f[3] ** 2 / f[1]
    return 1 - f[2] / total if total > 0 else (1.0 if f[2] == 0 else 0.0)


def _gains(f, top: float | None, params: dict) -> bool:
    """Whether these validation figures start the count of rounds without progress anew."""
    score = _r2(f)
    return score is None or top is None or score > top + float(params["tol"])


def train_together(df: DataFrame, spec: TableSpec, points: list[dict], max_rounds: int | None = None, stats: FitStats | None = None) -> list[MLPModel]:
    """A model for each parameter point, all trained in the same passes over the rows."""
    ps = [{**MLP_DEFAULT, **p} for p in points]
    st = stats or fit_stats(df, spec, scale=True)
    width = len(st.numerical) + sum(len(st.categories.get(c, [])) for c in st.categorical)
    blocks = row_blocks(design_rows(df, st, spec, float(ps[0]["validation_fraction"])), st).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _trained(blocks, spec, ps, st, width, max_rounds)
    finally:
        blocks.unpersist()


def _trained(blocks: RDD, spec: TableSpec, ps: list[dict], st: FitStats, width: int, max_rounds: int | None) -> list[MLPModel]:
    states = {k: Adam.start(init_weights([width, *p["hidden_layer_sizes"], 1]), p) for k, p in enumerate(ps)}
    best = {k: (None, s.ws, 0) for k, s in states.items()}  # R2, weights, rounds without progress
    running = dict(states)
    for rnd in range(max(int(max_rounds or p["max_iter"]) for p in ps) + 1):
        running = {k: s for k, s in running.items() if rnd <= int(max_rounds or ps[k]["max_iter"])}
        if not running:
            break
        last = {k for k in running if rnd == int(max_rounds or ps[k]["max_iter"])}
        closing = all(k in last or best[k][2] + 1 >= int(ps[k]["n_iter_no_change"]) for k in running)
        after, figures = one_round(blocks, running, st, rnd, not closing)
        # A pass that may be the last only scores, which is short; its steps are taken if a model goes on.
        if closing and any(k not in last and _gains(figures.get(k), best[k][0], ps[k]) for k in running):
            after, _ = one_round(blocks, running, st, rnd, True)
        for k, s in list(running.items()):
            score, (top, _, stale) = _r2(figures.get(k)), best[k]
            if score is None:
                best[k] = (None, s.ws, 0)
            elif _gains(figures[k], top, ps[k]):
                best[k] = (score, s.ws, 0)
            else:
                best[k] = (max(top, score), s.ws if score > top else best[k][1], stale + 1)
            if k in last or best[k][2] >= int(ps[k]["n_iter_no_change"]):
                del running[k]
            else:
                running[k] = after[k]
    return [MLPModel(spec, p, st, best[k][1]) for k, p in enumerate(ps)]


def search_mlp(sub: DataFrame, val: DataFrame, spec: TableSpec, g: dict | None = None, max_rounds: int | None = None):
    """Every grid point, trained together; the first in grid order wins a tie."""
    from batchlens.models.trees import grid
    from batchlens.operators.evaluate import metrics_dict

    points, best = grid(g or MLP_GRID), None
    for params, m in zip(points, train_together(sub, spec, points, max_rounds)):
        vm = metrics_dict(m.predict(val), spec.target)
        if vm is not None and (best is None or vm["rmse"] < best[1]["rmse"]):
            best = (params, vm)
    return best
