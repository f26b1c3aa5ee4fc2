"""A small decoder-only transformer in numpy: forward, gradients, AdamW, greedy generation.

Windows are rows (batch_id, input, target). A training step's gradient is the sum
over the batch's windows, computed in Arrow batches where the rows are; the
driver holds only parameters and one gradient (their size is fixed by the
configuration) and makes the update.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.sources.staging import session, staged

EPSILON = 1e-5


@dataclass(frozen=True)
class Config:
    vocab_size: int
    context_size: int = 512
    embedding_dim: int = 128
    proj_dim: int = 256
    n_heads: int = 8
    n_layers: int = 8

    def __post_init__(self):
        if self.proj_dim % self.n_heads:
            raise ValueError("proj_dim must be divisible by n_heads")

    def shapes(self) -> dict[str, tuple[int, ...]]:
        d, p = self.embedding_dim, self.proj_dim
        out = {"token": (self.vocab_size, d), "position": (self.context_size, d)}
        for k in range(self.n_layers):
            out |= {f"{k}.q": (p, d), f"{k}.k": (p, d), f"{k}.v": (p, d), f"{k}.o": (d, p), f"{k}.w1": (4 * d, d), f"{k}.w2": (d, 4 * d), f"{k}.g1": (d,), f"{k}.b1": (d,), f"{k}.g2": (d,), f"{k}.b2": (d,)}
        return out | {"g": (d,), "b": (d,), "out": (self.vocab_size, d)}

    def parameters(self) -> int:
        return sum(int(np.prod(s)) for s in self.shapes().values())


Parameters = dict[str, np.ndarray]


def init(config: Config, seed: int = 0) -> Parameters:
    """Scales start at one, shifts at zero, the rest uniform as wide as the inverse root of the inputs."""
    rng = np.random.default_rng(seed)
    out = {}
    for name, shape in config.shapes().items():
        kind = name.rpartition(".")[2]
        if len(shape) == 1:
            out[name] = np.ones(shape) if kind.startswith("g") else np.zeros(shape)
        elif kind in ("token", "position"):
            out[name] = rng.standard_normal(shape) * 0.1
        else:
            out[name] = rng.uniform(-1, 1, shape) / np.sqrt(shape[1])
    return out


def _norm(x, g, b):
    mean = x.mean(-1, keepdims=True)
    inverse = 1 / np.sqrt(x.var(-1, keepdims=True) + EPSILON)
    unit = (x - mean) * inverse
    return unit * g + b, (unit, inverse, g)


def _norm_back(dy, saved):
    unit, inverse, g = saved
    axes = tuple(range(dy.ndim - 1))
    du = dy * g
    dx = inverse * (du - du.mean(-1, keepdims=True) - unit * (du * unit).mean(-1, keepdims=True))
    return dx, (dy * unit).sum(axes), dy.sum(axes)


def _softmax(s):
    e = np.exp(s - s.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def forward(p: Parameters, c: Config, ids: np.ndarray, saved: list | None = None) -> np.ndarray:
    """Logits (B, T, V) of ids (B, T)."""
    rows, t = ids.shape
    if t > c.context_size:
        raise ValueError("more tokens than the context holds")
    h, size = c.n_heads, c.proj_dim // c.n_heads
    x = p["token"][ids] + p["position"][:t]
    mask = np.triu(np.full((t, t), -np.inf), 1)
    split = lambda y: y.reshape(rows, t, h, size).transpose(0, 2, 1, 3)
    for k in range(c.n_layers):
        n1, s1 = _norm(x, p[f"{k}.g1"], p[f"{k}.b1"])
        q, key, v = (split(n1 @ p[f"{k}.{w}"].T) for w in "qkv")
        prob = _softmax((q @ key.transpose(0, 1, 3, 2)) / np.sqrt(size) + mask)
        merged = (prob @ v).transpose(0, 2, 1, 3).reshape(rows, t, c.proj_dim)
        mid = x + merged @ p[f"{k}.o"].T
        n2, s2 = _norm(mid, p[f"{k}.g2"], p[f"{k}.b2"])
        wide = n2 @ p[f"{k}.w1"].T
        if saved is not None:
            saved.append((n1, s1, q, key, v, prob, merged, n2, s2, wide))
        x = mid + np.maximum(wide, 0) @ p[f"{k}.w2"].T
    n, s = _norm(x, p["g"], p["b"])
    if saved is not None:
        saved.append((n, s))
    return n @ p["out"].T


def losses(logits: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """-log p of each target, by log-sum-exp."""
    top = logits.max(-1)
    return top + np.log(np.exp(logits - top[..., None]).sum(-1)) - np.take_along_axis(logits, targets[..., None], -1)[..., 0]


def gradients(p: Parameters, c: Config, ids: np.ndarray, targets: np.ndarray) -> tuple[float, Parameters]:
    """The summed loss over all positions, and its gradient."""
    saved: list = []
    logits = forward(p, c, ids, saved)
    loss = float(losses(logits, targets).sum())
    d = _softmax(logits)
    np.put_along_axis(d, targets[..., None], np.take_along_axis(d, targets[..., None], -1) - 1, -1)
    flat = lambda y: y.reshape(-1, y.shape[-1])
    g: Parameters = {}
    n, s = saved.pop()
    g["out"] = flat(d).T @ flat(n)
    dx, g["g"], g["b"] = _norm_back(d @ p["out"], s)
    rows, t = ids.shape
    h, size = c.n_heads, c.proj_dim // c.n_heads
    join = lambda y: y.transpose(0, 2, 1, 3).reshape(rows, t, c.proj_dim)
    split = lambda y: y.reshape(rows, t, h, size).transpose(0, 2, 1, 3)
    for k in reversed(range(c.n_layers)):
        n1, s1, q, key, v, prob, merged, n2, s2, wide = saved[k]
        g[f"{k}.w2"] = flat(dx).T @ flat(np.maximum(wide, 0))
        dwide = (dx @ p[f"{k}.w2"]) * (wide > 0)
        g[f"{k}.w1"] = flat(dwide).T @ flat(n2)
        dmid, g[f"{k}.g2"], g[f"{k}.b2"] = _norm_back(dwide @ p[f"{k}.w1"], s2)
        dmid = dmid + dx
        g[f"{k}.o"] = flat(dmid).T @ flat(merged)
        dm = split(dmid @ p[f"{k}.o"])
        dprob = dm @ v.transpose(0, 1, 3, 2)
        ds = prob * (dprob - (dprob * prob).sum(-1, keepdims=True)) / np.sqrt(size)
        dn1 = 0
        for w, y in (("q", join(ds @ key)), ("k", join(ds.transpose(0, 1, 3, 2) @ q)), ("v", join(prob.transpose(0, 1, 3, 2) @ dm))):
            g[f"{k}.{w}"] = flat(y).T @ flat(n1)
            dn1 = dn1 + y @ p[f"{k}.{w}"]
        dn, g[f"{k}.g1"], g[f"{k}.b1"] = _norm_back(dn1, s1)
        dx = dmid + dn
    g["position"] = np.zeros_like(p["position"])
    g["position"][:t] = dx.sum(0)
    g["token"] = np.zeros_like(p["token"])
    np.add.at(g["token"], ids, dx)
    return loss, g


class AdamW:
    def __init__(self, rate: float = 1e-3, betas: tuple[float, float] = (0.9, 0.999), eps: float = 1e-8, decay: float = 0.01):
        self.rate, self.betas, self.eps, self.decay, self.t = rate, betas, eps, decay, 0
        self.m: Parameters = {}
        self.v: Parameters = {}

    def update(self, p: Parameters, g: Parameters) -> Parameters:
        self.t += 1
        a, b = self.betas
        out = {}
        for name, x in p.items():
            self.m[name] = a * self.m.get(name, 0.0) + (1 - a) * g[name]
            self.v[name] = b * self.v.get(name, 0.0) + (1 - b) * g[name] ** 2
            m, v = self.m[name] / (1 - a**self.t), self.v[name] / (1 - b**self.t)
            out[name] = x * (1 - self.rate * self.decay) - self.rate * m / (np.sqrt(v) + self.eps)
        return out


def _pack(g: Parameters) -> bytes:
    return np.concatenate([g[k].ravel() for k in sorted(g)]).astype(np.float64).tobytes()


def _unpack(data: bytes, like: Parameters) -> Parameters:
    flat, at, out = np.frombuffer(data, np.float64), 0, {}
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(name)
    if pa.types.is_binary(column.type):
        return np.array([np.frombuffer(x, np.uint8) for x in column.to_pylist()], np.int64)
    return np.array(column.to_pylist(), np.int64)


def batch_gradient(windows: DataFrame, p: Parameters, c: Config) -> tuple[float, int, Parameters]:
    """Summed loss, number of positions and summed gradient of some windows; a row per task reaches the driver."""
    shared = session(windows).sparkContext.broadcast(p)  # its size is the configuration's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, n, total = 0.0, 0, None
        for batch in batches:
            for a in range(0, batch.num_rows, 32):
                part = batch.slice(a, 32)
                x, y = _rows(part, "input"), _rows(part, "target")
                one, g = gradients(shared.value, c, x, y)
                loss, n = loss + one, n + y.size
                total = g if total is None else {k: total[k] + g[k] for k in g}
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([n], pa.int64()), pa.array([_pack(total)], pa.binary())], ["loss", "n", "g"])

    loss, n, total = 0.0, 0, np.zeros(sum(x.size for x in p.values()))
    for r in windows.select("input", "target").mapInArrow(run, "loss double, n long, g binary").toLocalIterator():
        loss, n, total = loss + r["loss"], n + r["n"], total + np.frombuffer(r["g"], np.float64)
    return loss, n, _unpack(total.tobytes(), p)


def evaluate(windows: DataFrame, p: Parameters, c: Config) -> DataFrame:
    """(batch_id, loss): the mean loss of each batch of windows."""
    shared = session(windows).sparkContext.broadcast(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 32):
                part = batch.slice(a, 32)
                loss = losses(forward(shared.value, c, _rows(part, "input")), _rows(part, "target"))
                yield pa.RecordBatch.from_arrays([part.column("batch_id"), pa.array(loss.mean(-1))], ["batch_id", "loss"])

    return windows.select("batch_id", "input", "target").mapInArrow(run, "batch_id long, loss double").groupBy("batch_id").agg(F.avg("loss").alias("loss"))


def train(train_windows: DataFrame, val_windows: DataFrame, p: Parameters, c: Config, epochs: int = 5, optimizer: AdamW | None = None, log_every: int = 100) -> tuple[Parameters, list[tuple[int, float, float]], list[tuple[int, float]]]:
    """Parameters, history rows (epoch, train_loss, val_loss) and a step log (step, loss) of every log_every-th step.

    Windows have batch_id; the epoch's loss is the unweighted mean of its batch
    means. A table without windows is an error.
    """
    optimizer = optimizer or AdamW()
    # In order of batch_id, a step reads the row groups of its batch and no others.
    train_windows = staged(train_windows.repartitionByRange("batch_id").sortWithinPartitions("batch_id"))
    n = train_windows.agg(F.max("batch_id")).first()[0]
    if n is None or val_windows.isEmpty():
        raise ValueError("no windows to train or validate on")
    history, log, step = [], [], 0
    for epoch in range(epochs):
        means = []
        order = np.random.default_rng(epoch).permutation(n + 1)
        for k in order.tolist():
            loss, count, g = batch_gradient(train_windows.filter(F.col("batch_id") == k), p, c)
            if not count:
                continue
            p = optimizer.update(p, {name: x / count for name, x in g.items()})
            means.append(loss / count)
            step += 1
            if step % log_every == 0:
                log.append((step, means[-1]))
        val = evaluate(val_windows, p, c).agg(F.avg("loss")).first()[0]
        history.append((epoch, float(np.mean(means)), val))
    return p, history, log


def generate(p: Parameters, c: Config, ids: list[int], length: int = 50, keep_last: bool = False) -> list[int]:
    """Greedy continuation; the lowest id of several best. Beyond the context it is an error, or the last ids are kept."""
    out = list(ids)
    if not out:
        raise ValueError("generation needs a prompt")
    for _ in range(length):
        seen = out[-c.context_size :] if keep_last else out
        out.append(int(forward(p, c, np.array([seen]))[0, -1].argmax()))
    return out


HISTORY = "epoch int, train_loss double, val_loss double"


def history_table(spark: SparkSession, history: list[tuple[int, float, float]]) -> DataFrame:
    return spark.createDataFrame(history, HISTORY)
