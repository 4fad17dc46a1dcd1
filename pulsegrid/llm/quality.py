"""Quality classifier: a sparse rule ensemble compiled to Spark columns.

Statistics of the whole text are Spark column expressions. On a bounded
sample of labelled rows (``max_labels``, by hash of the key) small boosted
trees are grown over them; every tree path becomes a conjunctive rule, a
lasso logistic regression keeps few of the rules, and the kept rules become
one Spark column expression, so scoring is a projection of the scan.

Rows: a null or empty text has statistics 0 and a score; nulls among labels
are left out of the fit; without both labels in the sample the score is the
prior (ones + 1) / (labels + 2); repeated rows score alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import WORD, doc_remainder, spare_name

MAX_LABELS = 20_000
TREES, DEPTH, BINS, STEP, LASSO = 40, 3, 64, 0.3, 4e-4


def _lists(text: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    return {"t": t, "words": F.regexp_extract_all(F.lower(t), F.lit(WORD), F.lit(0)), "lines": F.split(t, "\n")}


def _counts(part: dict[str, Column]) -> dict[str, Column]:
    count = lambda pattern: F.regexp_count(part["t"], F.lit(pattern))
    return {
        "chars": F.char_length(part["t"]),
        "words": F.size(part["words"]),
        "distinct": F.size(F.array_distinct(part["words"])),
        "symbols": count(r"[^\p{L}\p{M}\p{N}\s.,;:!?'\"()\-]"),
        "marks": count(r"[!?]"),
        "capitals": count(r"\p{Lu}"),
        "digits": count(r"\p{N}"),
        "stops": count(r"[.,;:]"),
        "lines": F.size(part["lines"]),
        "distinct_lines": F.size(F.array_distinct(part["lines"])),
    }


def _shares(n: dict[str, Column]) -> dict[str, Column]:
    chars, words = (F.greatest(F.lit(1), n[c]) for c in ("chars", "words"))
    return {
        "chars": n["chars"].cast("double"),
        "words": n["words"].cast("double"),
        "word_chars": n["chars"] / words,
        "distinct_words": n["distinct"] / words,
        "word_richness": F.log1p(n["distinct"].cast("double")) / F.log1p(words.cast("double")),
        **{c: n[c] / chars for c in ("symbols", "marks", "capitals", "digits", "stops")},
        "distinct_lines": n["distinct_lines"] / n["lines"],
        "line_chars": n["chars"] / n["lines"],
    }


def statistics(text: Column) -> dict[str, Column]:
    """Name -> expression. Shares are of characters unless named otherwise."""
    return _shares(_counts(_lists(text)))


def _once(df: DataFrame, columns: dict[str, Column], name: str) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with the columns as a struct that comes out of a generator: what
    refers to them, a filter too, cannot repeat their expressions."""
    name = spare_name(df, name)
    out = df.select("*", F.explode(F.array(F.struct(*[e.alias(n) for n, e in columns.items()]))).alias(name))
    return out, {n: out[name][n] for n in columns}


Rule = tuple[tuple[str, float, float], ...]  # (statistic, above, up to) each


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, stat: dict[str, Column]) -> Column:
        total = F.lit(float(self.bias))
        for rule, weight in self.rules:
            holds = F.lit(True)
            for name, low, high in rule:
                if low > -np.inf:
                    holds = holds & (stat[name] > low)
                if high < np.inf:
                    holds = holds & (stat[name] <= high)
            total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _paths(x: np.ndarray, y: np.ndarray, names: list[str]) -> list[Rule]:
    """Rules from the paths of boosted trees on quantile bins."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)]
    f, rules = np.zeros(len(y)), {}

    def grow(rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, box: dict, depth: int) -> None:
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-3, None)
        if depth:
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                gs = np.cumsum(np.bincount(bins[j][rows], grad[rows], len(e) + 1))[:-1]
                hs = np.cumsum(np.bincount(bins[j][rows], hess[rows], len(e) + 1))[:-1]
                gain = gs ** 2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g ** 2 / (h + 1)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], j, at)
        if best[1] is None:
            f[rows] += STEP * g / (h + 1)
            return
        _, j, at = best
        low, high = box.get(j, (-np.inf, np.inf))
        left = bins[j][rows] <= at
        for part, side in ((left, (low, float(edges[j][at]))), (~left, (float(edges[j][at]), high))):
            inner = box | {j: side}
            rules[tuple((names[k], *inner[k]) for k in sorted(inner))] = None
            grow(rows[part], grad, hess, inner, depth - 1)

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-f))
        grow(np.arange(len(y)), y - p, p * (1 - p), {}, DEPTH)
    return list(rules)


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty by accelerated proximal steps."""
    n, m = r.shape
    bias, w = float(np.log((y.sum() + 1) / (n - y.sum() + 1))), np.zeros(m, np.float32)
    v = np.ones(m, np.float32)
    for _ in range(20):  # largest eigenvalue of the Gram matrix
        v = r.T @ (r @ v)
        v /= np.linalg.norm(v) + 1e-12
    size = 4 * n / (float(np.linalg.norm(r @ v)) ** 2 + n)
    wb, at, t = bias, w.copy(), 1.0
    for _ in range(rounds):
        gap = (1 / (1 + np.exp(-(r @ at + wb))) - y) / n
        new = at - size * (r.T @ gap)
        new = np.sign(new) * np.maximum(np.abs(new) - size * penalty, 0)
        new_bias = wb - size * float(gap.sum())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        at, wb = new + (t - 1) / nt * (new - w), new_bias + (t - 1) / nt * (new_bias - bias)
        w, bias, t = new.astype(np.float32), new_bias, nt
        at = at.astype(np.float32)
    return bias, w


def fit_rules(x: np.ndarray, y: np.ndarray, names: list[str]) -> RuleModel:
    if len(set(y.tolist())) < 2:
        p = (y.sum() + 1) / (len(y) + 2)
        return RuleModel(float(np.log(p / (1 - p))), ())
    rules = _paths(x, y, names)
    at = {n: j for j, n in enumerate(names)}
    held = np.stack([np.all([(x[:, at[n]] > a) & (x[:, at[n]] <= b) for n, a, b in rule], axis=0) for rule in rules], 1)
    _, keep = np.unique(held, axis=1, return_index=True)
    keep = [k for k in sorted(keep) if 0 < held[:, k].sum() < len(y)]
    bias, w = _lasso(held[:, keep].astype(np.float32), y, LASSO)
    return RuleModel(bias, tuple((rules[k], float(c)) for k, c in zip(keep, w, strict=True) if abs(c) > 1e-3))


def fit_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                max_labels: int = MAX_LABELS) -> RuleModel:
    """Learn from at most ``max_labels`` labelled rows whose crc32(key as
    text) mod 3 is not 1. Only their statistics reach the driver."""
    picked = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (doc_remainder(F.col(key), 3) != 1))
              .groupBy(F.col(key).alias("k")).agg(F.min(F.col(label).cast("double")).alias("y"))
              .orderBy(F.xxhash64("k"), "k").limit(max_labels))
    stats = statistics(F.col("t"))
    # repeated keys: one row each, whatever the number of copies
    rows = (docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(picked), "k")
            .groupBy("k").agg(F.min(F.struct("y", *[e.alias(n) for n, e in stats.items()])).alias("r")).select("r.*"))
    got = np.array(rows.collect(), float).reshape(-1, len(stats) + 1)  # at most max_labels rows
    got = got[np.lexsort(got.T)]
    return fit_rules(got[:, 1:], got[:, 0], list(stats))


def score_quality(docs: DataFrame, model: RuleModel, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score as column ``name`` (one of that name is
    replaced). Lists, counts and statistics are each computed once a row."""
    rows, lists = _once(docs, _lists(F.col(text)), "__lists")
    rows, counts = _once(rows, _counts(lists), "__counts")
    rows, stats = _once(rows, _shares(counts), "__stats")
    return rows.withColumn(name, model.score(stats)).select(*[c for c in docs.columns if c.lower() != name.lower()], name)
