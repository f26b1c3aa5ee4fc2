"""Operator 6: a quality classifier as a sparse ensemble of rules over text statistics.

Statistics are Spark column expressions of the text alone. To fit, a bounded
sample of labelled rows (`SAMPLE` at most, the least by a hash of their id) is
brought to the driver as a row of numbers each; small regression trees are
boosted on them, every path of a tree becomes a conjunctive rule, and a lasso
logistic regression over the rules keeps few of them. The rules that stay are
compiled into one Spark column, so scoring all documents is a projection: no
shuffle, no Python.

Defined cases: a null text is the empty text, whose statistics are all 0 and
which has a score like any other; label rows without id or label are skipped, of
several for an id the greatest label counts, and of several texts of an id the
one with the least hash; without any labelled row
the score is 0.5, with one class only the share of that class; repeated rows are
scored alike; columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathe.llm.common import table, text_of

#: Labelled rows used to fit, at most.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, PENALTY, STEPS, CUT = 24, 3, 32, 0.3, 0.002, 400, 0.7

Condition = tuple[str, bool, float]  # statistic, whether it must exceed the threshold, threshold


def statistics(text: Column) -> dict[str, Column]:
    """The statistics of a text, 0 for the empty one."""
    n = F.length(text)
    words = F.regexp_count(text, F.lit(r"\S+"))
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    literal = lambda s: n - F.length(F.replace(text, F.lit(s), F.lit("")))
    return {
        "chars": n.cast("double"),
        "words": words.cast("double"),
        "lines": (literal("\n") + F.when(n > 0, 1).otherwise(0)).cast("double"),
        "word_length": share(n.cast("double"), words),
        "upper": share(count("[A-Z]"), n),
        "digits": share(count("[0-9]"), n),
        "marks": share(count("[#$%&*!|<>=_~^]"), words),
        "exclaimed": share(literal("!"), words),
        "bars": share(literal("|"), words),
        "starred": share(literal("*"), words),
        "stops": share(literal("."), words),
        "commas": share(literal(","), words),
        "capitalised": share(count(r"\b[A-Z][a-z]"), words),
        "distinct": share(F.size(F.array_distinct(F.split(F.replace(text, F.lit("\n"), F.lit(" ")), " "))).cast("double"), words),
    }


@dataclass(frozen=True)
class RuleModel:
    """Conjunctive rules with their weights; the score is the logistic of bias and the weights of the rules that hold."""

    bias: float = 0.0
    rules: tuple[tuple[Condition, ...], ...] = ()
    weights: tuple[float, ...] = field(default=())

    def column(self, statistic=F.col) -> Column:
        def holds(rule: tuple[Condition, ...]) -> Column:
            return reduce(lambda a, b: a & b, (statistic(s) > t if above else statistic(s) <= t for s, above, t in rule))

        z = reduce(lambda a, b: a + b, (F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights)), F.lit(self.bias))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree(bins: np.ndarray, edges: list[np.ndarray], rest: np.ndarray, rng: np.random.Generator) -> list[tuple[tuple[int, bool, float], ...]]:
    """Paths of a regression tree fitted to the rest, every inner node's and leaf's; fits by histograms."""
    paths: list[tuple] = []
    least = max(10, rest.size // 400)

    def grow(rows: np.ndarray, path: tuple) -> None:
        if path:
            paths.append(path)
        if len(path) == DEPTH or rows.size < 2 * least:
            return
        best = (1e-9, None, None)
        r = rest[rows]
        for f in rng.permutation(bins.shape[1])[: max(4, bins.shape[1] * 2 // 3)]:
            b = bins[rows, f]
            n, s = (np.cumsum(np.bincount(b, w, BINS))[:-1] for w in (None, r))
            m, t = rows.size - n, r.sum() - s
            ok = (n >= least) & (m >= least)
            gain = np.where(ok, s**2 / np.maximum(n, 1) + t**2 / np.maximum(m, 1) - r.sum() ** 2 / rows.size, 0)
            k = int(gain.argmax())
            if gain[k] > best[0] and k < edges[f].size:
                best = (gain[k], f, k)
        if best[1] is None:
            return
        f, k = int(best[1]), int(best[2])
        below = bins[rows, f] <= k
        grow(rows[below], (*path, (f, False, float(edges[f][k]))))
        grow(rows[~below], (*path, (f, True, float(edges[f][k]))))

    grow(rng.choice(rest.size, max(1, rest.size * 2 // 3), replace=False), ())
    return paths


def _holds(x: np.ndarray, path: tuple) -> np.ndarray:
    return np.logical_and.reduce([x[:, f] > t if above else x[:, f] <= t for f, above, t in path])


def fit_rows(x: np.ndarray, y: np.ndarray, names: list[str], seed: int = 1) -> RuleModel:
    """Fit to a matrix of statistics and labels 0 and 1."""
    if not y.size:
        return RuleModel()
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(rate / (1 - rate)))
    if y.min() == y.max():
        return RuleModel(bias)
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    z = np.full(y.size, bias)
    found: dict[tuple, np.ndarray] = {}
    for _ in range(TREES):
        rest = y - 1 / (1 + np.exp(-z))
        for path in _tree(bins, edges, rest, rng):
            held = _holds(x, path)
            if path not in found and 0 < held.sum() < y.size:
                found[path] = held
            if len(path) == DEPTH:
                z += RATE * np.where(held, 4 * rest[held].mean() if held.any() else 0.0, 0.0)
    paths = list(found)
    if not paths:
        return RuleModel(bias)
    # Lasso logistic regression by accelerated proximal steps; rules are scaled to unit deviation.
    a = np.stack([found[p] for p in paths], axis=1).astype(np.float32)
    deviation = a.std(axis=0)
    a /= deviation
    mean = a.mean(axis=0)
    v = rng.standard_normal(a.shape[1]).astype(np.float32)
    for _ in range(12):
        v = (a - mean).T @ ((a - mean) @ v)
        size = float(np.linalg.norm(v))
        v /= max(size, 1e-12)
    step = 4 * y.size / max(size, 1e-9)
    w, u, t, b = np.zeros(a.shape[1]), np.zeros(a.shape[1]), 1.0, bias
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-(a @ u.astype(np.float32) - float(mean @ u) + b)))
        g = ((a.T @ (p - y).astype(np.float32)) - mean * (p - y).sum()) / y.size
        new = u - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        b -= 2 * float((p - y).mean())
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        u, w = new + (old - 1) / t * (new - w), new
    kept = np.flatnonzero(np.abs(w) > 1e-4)
    rules = tuple(tuple((names[f], above, threshold) for f, above, threshold in paths[k]) for k in kept)
    return RuleModel(float(b - mean @ w), rules, tuple(float(w[k] / deviation[k]) for k in kept))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> RuleModel:
    """Fit to labelled documents; of more than `sample`, the least by a hash of their ids are taken."""
    usable = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).filter("id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    some = usable.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit("quality")), "id").limit(sample)  # the bound of what is broadcast
    parts = statistics(F.col("t"))
    found = docs.select(F.col(doc_id).alias("id"), text_of(text).alias("t")).join(F.broadcast(some), "id").select("id", "y", F.xxhash64("t").alias("h"), F.struct(*(c.alias(n) for n, c in parts.items())).alias("s"))
    one = found.groupBy("id").agg(F.any_value("y").alias("y"), F.min_by("s", "h").alias("s"))  # a row for each id of the sample
    rows = one.select("y", "s.*").toPandas()
    rows = rows.sort_values([*rows.columns]).to_numpy(np.float64)  # the same order whatever the tasks' order
    return fit_rows(rows[:, 1:], rows[:, 0], list(parts))


def score(docs: DataFrame, model: RuleModel, text: str = "text", out: str = "score") -> DataFrame:
    """Append the model's score to every row.

    The score is made where it stands: a filter on it is not pushed below, where
    it would evaluate the statistics anew for every condition of every rule.
    """
    docs = docs.drop(out)
    parts = statistics(text_of(text))
    inner = docs.select("*", F.struct(*(c.alias(n) for n, c in parts.items())).alias("__statistics"))
    scored = inner.select(*docs.columns, model.column(lambda s: F.col(f"__statistics.{s}")).alias("__made"))
    return scored.select(*docs.columns, F.explode(F.array("__made")).alias(out))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame) -> RuleModel:
    """The model of the query and the pipeline: fitted without the held-out rows."""
    return fit(docs, labels.filter(~held_out()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score and prediction. Tested by held-out accuracy and against a plain evaluation of the rules."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
