"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of the whole text are Spark column expressions.  On a bounded
sample of labelled rows (``max_rows``, first by a hash of the id) small
boosted trees are grown; every path from a root to a node becomes a
conjunctive rule; a lasso logistic regression keeps few rules and weighs
them; the kept rules are compiled into one Spark column expression, so
scoring stays inside the JVM.  Only the sample's statistics (``max_rows`` rows
of a dozen numbers) reach the driver.

Defined results: null text counts as empty; all statistics of an empty text
are 0 and it gets the score of those.  A null doc_id is never a training row
and is not held out.  Without labels of both classes every score is the share
of label 1 seen (0.5 without any).  Repeated rows score alike; a doc_id
labelled more than once takes the smallest label.  Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = ("n_words", "word_length", "upper", "digits", "symbols", "bars", "exclaims", "stops",
              "distinct_words", "line_words", "distinct_lines", "top_bytes")


def statistics(df: DataFrame) -> DataFrame:
    """Replaces ``text`` by the statistics; all other columns stay."""
    rest = [c for c in df.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))

    def without(pattern):
        return F.length(F.regexp_replace("text", pattern, ""))

    def number_of(piece):
        return F.length("text") - F.length(F.replace("text", F.lit(piece), F.lit("")))

    df = df.select(*rest, text.alias("text"))
    df = df.select(
        *rest, F.length("text").alias("_n"),
        F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "").alias("_words"),
        F.split("text", "\n", -1).alias("_lines"),
        without("[A-Z]+").alias("_upper"), without("[0-9]+").alias("_digits"),
        without(r"[^\x00-\x22\x27-\x29\x2C-\x2E\x30-\x3B\x3F-\x5A\x61-\x7A\x80-\x{10FFFF}]+").alias("_symbols"),
        number_of("|").alias("_bars"), number_of("!").alias("_exclaims"), number_of(".").alias("_stops"),
        F.octet_length("text").alias("_bytes"))
    df = df.select(*rest, "_n", "_upper", "_digits", "_symbols", "_bars", "_exclaims", "_stops", "_bytes",
                   F.size("_words").alias("_w"), F.size(F.array_distinct("_words")).alias("_dw"),
                   F.size("_lines").alias("_l"), F.size(F.array_distinct("_lines")).alias("_dl"))
    n, w, lines = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("_n", "_w", "_l"))

    def share(count, of):
        return (count / of).cast("double")

    length = F.col("_n")
    values = {
        "n_words": F.col("_w").cast("double"), "word_length": share(length, w),
        "upper": share(length - F.col("_upper"), n), "digits": share(length - F.col("_digits"), n),
        "symbols": share(length - F.col("_symbols"), n), "bars": share(F.col("_bars"), w),
        "exclaims": share(F.col("_exclaims"), w), "stops": share(F.col("_stops"), w),
        "distinct_words": share(F.col("_dw"), w), "line_words": share(F.col("_w"), lines),
        "distinct_lines": share(F.col("_dl"), lines), "top_bytes": share(F.col("_bytes") - length, n),
    }
    empty = F.col("_n") == 0
    return df.select(*rest, *[F.when(empty, 0.0).otherwise(values[k]).alias(k) for k in STATISTICS])


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds: (statistic, low, high), low < value <= high."""
    bounds: tuple

    def holds(self, columns: dict) -> np.ndarray:
        out = True
        for name, low, high in self.bounds:
            out = out & (columns[name] > low) & (columns[name] <= high)
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                out = out & (F.col(name) > F.lit(float(low)))
            if high < math.inf:
                out = out & (F.col(name) <= F.lit(float(high)))
        return out


@dataclass
class Ensemble:
    intercept: float
    rules: list  # (Rule, weight)

    def score(self) -> Column:
        """Probability of label 1, over the statistics' columns."""
        z = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            z = z + F.when(rule.column(), float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def _grow(binned, edges, residual, rows, depth, min_rows, path, rules):
    """One regression tree on the residuals; returns the fitted values of ``rows``."""
    fit = np.full(len(rows), residual[rows].mean() if len(rows) else 0.0)
    if depth == 0 or len(rows) < 2 * min_rows:
        return fit
    r, total = residual[rows], residual[rows].sum()
    best = (1e-9, None, None)
    for j, cuts in enumerate(edges):
        if not len(cuts):
            continue
        b = binned[rows, j]
        left = np.cumsum(np.bincount(b, minlength=len(cuts) + 1))[:-1]
        sums = np.cumsum(np.bincount(b, weights=r, minlength=len(cuts) + 1))[:-1]
        right = len(rows) - left
        ok = (left >= min_rows) & (right >= min_rows)
        if not ok.any():
            continue
        gain = np.where(ok, sums ** 2 / np.maximum(left, 1) + (total - sums) ** 2 / np.maximum(right, 1), -1)
        k = int(gain.argmax())
        gained = gain[k] - total ** 2 / len(rows)
        if gained > best[0]:
            best = (gained, j, k)
    _, j, k = best
    if j is None:
        return fit
    goes_left = binned[rows, j] <= k
    for side, bound in ((goes_left, (j, -math.inf, edges[j][k])), (~goes_left, (j, edges[j][k], math.inf))):
        here = [*path, bound]
        rules.append(tuple(here))
        fit[side] = _grow(binned, edges, residual, rows[side], depth - 1, min_rows, here, rules)
    return fit


def _merged(path) -> Rule:
    bounds: dict = {}
    for j, low, high in path:
        old = bounds.get(j, (-math.inf, math.inf))
        bounds[j] = (max(old[0], low), min(old[1], high))
    return Rule(tuple((STATISTICS[j], *bounds[j]) for j in sorted(bounds)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 24, depth: int = 3, rate: float = 0.4,
        l1: float = 5e-4, cuts: int = 48, steps: int = 400, seed: int = 7) -> Ensemble:
    """Rules from boosted trees, weighed by lasso logistic regression (FISTA)."""
    n = len(y)
    share = float(y.mean()) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Ensemble(math.log(share / (1 - share)), [])
    edges = []
    for j in range(x.shape[1]):
        q = np.unique(np.quantile(x[:, j], np.linspace(0, 1, cuts + 2)[1:-1]))
        edges.append(q[q < x[:, j].max()])
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    rng = np.random.default_rng(seed)
    z, paths = np.full(n, math.log(share / (1 - share))), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        residual = y - p
        rows = np.sort(rng.choice(n, max(1, n * 2 // 3), replace=False))
        found: list = []
        fitted = _grow(binned, edges, residual, rows, depth, max(5, n // 1000), [], found)
        paths += found
        z[rows] += rate * fitted / max(1e-3, float((p * (1 - p)).mean()))
        z = np.clip(z, -12, 12)
    rules = list(dict.fromkeys(map(_merged, paths)))
    columns = {name: x[:, j] for j, name in enumerate(STATISTICS)}
    m = np.stack([r.holds(columns) for r in rules], axis=1).astype(np.float32)
    informative = (m.mean(axis=0) > 0) & (m.mean(axis=0) < 1)
    rules, m = [r for r, k in zip(rules, informative, strict=True) if k], m[:, informative]
    a = np.hstack([np.ones((n, 1), np.float32), m])
    bound = 0.25 * float(np.linalg.norm(a, 2) ** 2) / n
    w = np.zeros(a.shape[1])
    w[0] = math.log(share / (1 - share))
    v, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a @ v.astype(np.float32)).astype(float)))
        new = v - (a.T @ (p - y).astype(np.float32)).astype(float) / n / bound
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - l1 / bound, 0)
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t_next * (new - w), new, t_next
    return Ensemble(float(w[0]), [(r, float(x)) for r, x in zip(rules, w[1:], strict=True) if abs(x) > 1e-6])


def train(docs: DataFrame, labels: DataFrame, train_rows: Column | None = None, max_rows: int = 20_000) -> Ensemble:
    """Fit on at most ``max_rows`` labelled documents.  ``labels`` has doc_id and quality."""
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.min("quality").cast("double").alias("_label")))
    if train_rows is not None:
        rows = rows.where(train_rows)
    chosen = rows.orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id").limit(max_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows ids
    seen = statistics(sample.select("doc_id", "_label", "text")).orderBy("doc_id").toPandas()
    return fit(seen[list(STATISTICS)].to_numpy(float), seen["_label"].to_numpy(float))


def score(docs: DataFrame, model: Ensemble) -> DataFrame:
    """(doc_id, score, statistics...) of every whole text."""
    return statistics(docs.select("doc_id", "text")).select("doc_id", model.score().alias("score"), *STATISTICS)
