"""Quality classifier: rules from tree paths over text statistics, lasso logistic weights, compiled into columns."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a model is fitted to, those with the smallest hashes of their id.
FIT_ROWS = 20_000

FEATURES = ("n_words", "mean_word", "upper_share", "digit_share", "symbol_share", "pipe_share", "distinct_share", "top_line_share", "symbol_words", "n_lines")


def statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """Statistics of whole texts, as columns of FEATURES beside ``keep``. A null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    staged = docs.select(*keep, text.alias("_t")).select(
        *keep, "_t", F.length("_t").cast("double").alias("_n"),
        F.filter(F.split("_t", r"\s+"), lambda w: w != "").alias("_w"), F.split("_t", "\n").alias("_l"))
    share = lambda part: F.when(F.col("_n") > 0, part / F.col("_n")).otherwise(0.0)
    left = lambda chars: F.col("_n") - F.length(F.translate("_t", chars, ""))
    words = F.size("_w").cast("double")
    return staged.select(
        *keep, words.alias("n_words"), F.when(words > 0, (F.col("_n") - words + 1) / words).otherwise(0.0).alias("mean_word"),
        share(left("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("upper_share"), share(left("0123456789")).alias("digit_share"),
        share(left("#$%&*!@^~<>{}[]=+_\\/")).alias("symbol_share"), share(left("|")).alias("pipe_share"),
        F.when(words > 0, F.size(F.array_distinct("_w")) / words).otherwise(0.0).alias("distinct_share"),
        (F.size(F.array_distinct("_l")) / F.size("_l")).cast("double").alias("top_line_share"),
        F.when(words > 0, F.size(F.filter("_w", lambda w: ~w.rlike("[A-Za-z\\u00c0-\\u024f]"))) / words).otherwise(0.0).alias("symbol_words"),
        F.size("_l").cast("double").alias("n_lines"))


@dataclass(frozen=True)
class Rule:
    """Conditions (feature, at most or over, bound) that must all hold."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for f, low, bound in self.conditions:
            out &= (x[:, f] <= bound) == low
        return out

    def column(self) -> Column:
        out = F.lit(True)
        for f, low, bound in self.conditions:
            c = F.col(FEATURES[f])
            out = out & ((c <= bound) if low else (c > bound))
        return out


@dataclass
class Model:
    intercept: float = 0.0
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def score(self) -> Column:
        """Probability of label 1 as a column over FEATURES."""
        odds = F.lit(self.intercept)
        for rule, weight in self.rules:
            odds = odds + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))

    def score_rows(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.intercept)
        for rule, weight in self.rules:
            odds += weight * rule.holds(x)
        return 1 / (1 + np.exp(-odds))


def _grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, bounds: list[np.ndarray], rng: np.random.Generator, depth: int, path: tuple, out: set[Rule]) -> None:
    """Split by the weighted Gini gain over some random features; every path below the root becomes a rule."""
    if path:
        out.add(Rule(tuple(sorted(path))))
    if depth == 0 or len(np.unique(y)) < 2 or len(y) < 10:
        return
    best = (1e-9, None)
    total, ones = weight.sum(), (weight * y).sum()
    gini = lambda w, o: np.where(w > 0, 2 * o * (w - o) / np.maximum(w, 1e-12), 0)
    for f in rng.choice(x.shape[1], size=max(2, x.shape[1] // 2), replace=False):
        if not len(bounds[f]):
            continue
        at = np.searchsorted(bounds[f], x[:, f], side="left")
        w = np.cumsum(np.bincount(at, weight, len(bounds[f]) + 1))[:-1]
        o = np.cumsum(np.bincount(at, weight * y, len(bounds[f]) + 1))[:-1]
        gain = gini(total, ones) - gini(w, o) - gini(total - w, ones - o)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], (int(f), float(bounds[f][k])))
    if best[1] is None:
        return
    f, bound = best[1]
    low = x[:, f] <= bound
    for side, mask in ((True, low), (False, ~low)):
        _grow(x[mask], y[mask], weight[mask], bounds, rng, depth - 1, (*path, (f, side, bound)), out)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, rounds: int = 600, seed: int = 7) -> Model:
    """Rules of random trees, weighted by logistic regression with an absolute penalty (proximal gradient).

    Both classes weigh the same. With rows of one class or none the score is that of no knowledge, 0.5.
    """
    if len(np.unique(y)) < 2:
        return Model()
    rng = np.random.default_rng(seed)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    bounds = [np.unique(np.quantile(c, np.linspace(0.01, 0.99, 64), method="inverted_cdf")) for c in x.T]
    bounds = [(b + np.array([v.min() if len(v := c[c > t]) else t for t in b])) / 2 for b, c in zip(bounds, x.T, strict=True)]
    rules: set[Rule] = set()
    for _ in range(trees):
        rows = rng.integers(0, len(y), min(len(y), 4000))
        _grow(x[rows], y[rows], weight[rows], bounds, rng, depth, (), rules)
    listed, columns, seen = [], [], set()
    for rule in sorted(rules, key=lambda r: (len(r.conditions), r.conditions)):
        held = rule.holds(x)
        if 0 < held.sum() < len(y) and (packed := np.packbits(held).tobytes()) not in seen:
            seen.add(packed)
            listed.append(rule)
            columns.append(held)
    if not listed:
        return Model()
    z = np.column_stack(columns).astype(np.float64)
    w, b, wide, t = np.zeros(z.shape[1]), 0.0, np.zeros(z.shape[1]), 1.0
    step = 4 / max(1e-9, np.linalg.norm(np.sqrt(weight)[:, None] * np.column_stack([z, np.ones(len(z))]), 2) ** 2)
    ahead_b = 0.0
    for _ in range(rounds):
        error = weight * (1 / (1 + np.exp(-(z @ wide + ahead_b))) - y)
        new = wide - step * (z.T @ error)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = ahead_b - step * error.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wide, ahead_b = new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b)
        w, b, t = new, new_b, t_new
    return Model(float(b), [(r, float(v)) for r, v in zip(listed, w, strict=True) if v])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit to at most ``rows`` labelled rows outside the held-out third; labels other than 0 and 1 are left out.

    Only rows up to the ``rows``-th smallest hash have their texts read into statistics.
    """
    order = F.xxhash64("doc_id")
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("_quality"), order.alias("_h"))
    last = docs.select("doc_id").join(known, "doc_id").select("_h").orderBy("_h").limit(rows).agg(F.max("_h")).head()[0]
    if last is None:
        return Model()
    texts = docs.select("doc_id", "text").filter(order <= last).join(known.filter(F.col("_h") <= last), "doc_id")
    stats = statistics(texts, "_quality", "_h").select(*FEATURES, "_quality", "_h")
    data = np.array(stats.orderBy("_h", "_quality", *FEATURES).limit(rows).drop("_h").collect(), dtype=float).reshape(-1, len(FEATURES) + 1)
    return fit(data[:, :-1], data[:, -1])


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs``; only statistics of the text are inputs.

    Null and empty texts are scored as empty; rows that repeat give a row each; a null doc_id is never held out.
    """
    scored = train(docs, labels, rows).score()
    return statistics(docs, "doc_id").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with their columns; rows that repeat are judged alike."""
    model = train(docs, labels, rows)
    # Statistics beside the row itself, so that nothing is joined and columns that share their names don't matter.
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text")
    # A filter on a task's number stays above the projection that makes it. Pushed below, it would work out the
    # statistics anew for every rule that names them.
    scored = statistics(packed, "_row").select("_row", model.score().alias("_score"), F.spark_partition_id().alias("_task"))
    return scored.filter((F.col("_score") >= 0.5) & (F.col("_task") >= 0)).select("_row.*")
