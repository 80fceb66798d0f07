"""Quality scores by a sparse rule ensemble over statistics of a text.

Statistics are Spark columns over the whole text. Boosted trees on them give conjunctive rules, one for each path from
the root to a node; a logistic regression with a lasso penalty weighs the rules and drops most. What is left is compiled
into one Spark expression, so scoring is a scan with no Python in it. The fit is on the driver, from the statistics (not
the texts) of at most ``sample`` labelled rows, those with the least hash of their doc_id; that bound is a parameter.
Labels are learned only from rows whose crc32(doc_id as text) mod 5 is not 0. The label table, lang, source and doc_id
are never inputs of a score.

Null texts count as empty and get a score like any other. Repeated documents get equal scores. A doc_id with several
labels counts with the least, one with several texts is fitted once. Without labels, or with labels of one kind, the score is that kind's smoothed share.
An empty table gives an empty result. Other columns pass through :func:`score` and :func:`keep`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
SAMPLE = 20_000
THRESHOLD = 0.3
TREES = 24
DEPTH = 3
LEAF = 10
BINS = 32
SHRINKAGE = 0.3
LASSO = 0.002
STEPS = 400

STATISTICS = (
    "n_words", "mean_word", "distinct_words", "capitals", "symbols", "bangs", "stops", "commas", "digits", "line_length", "distinct_lines",
)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from the fit; false without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``_stats`` of ``STATISTICS``, all of them doubles."""
    body = F.coalesce(F.col(text), F.lit(""))
    cut = docs.withColumn("_body", body).withColumn("_words", F.split(F.trim("_body"), "\\s+")).withColumn("_lines", F.split("_body", "\n"))
    size = F.greatest(F.length("_body"), F.lit(1))
    words = F.size("_words")
    count = lambda pattern: F.regexp_count("_body", F.lit(pattern))
    values = {
        "n_words": words,
        "mean_word": size / words,
        "distinct_words": F.size(F.array_distinct("_words")) / words,
        "capitals": count(r"\p{Lu}") / size,
        "symbols": count(r"[#$%&*|<>{}\[\]^~=+@/\\_]") / size,
        "bangs": count("!") / words,
        "stops": count("[.?]") / words,
        "commas": count("[,;:]") / words,
        "digits": count("[0-9]") / size,
        "line_length": size / F.size("_lines"),
        "distinct_lines": F.size(F.array_distinct("_lines")) / F.size("_lines"),
    }
    # The rules read each statistic many times. A generator's output can't be inlined into them, or into a filter on the score.
    row = F.struct(*[values[k].cast("double").alias(k) for k in STATISTICS])
    return cut.withColumn("_stats", F.explode_outer(F.array(row))).drop("_body", "_words", "_lines")


#: A condition: place of the statistic, whether it is to exceed the bound, and the bound.
Condition = tuple[int, bool, float]


@dataclass(frozen=True)
class Rules:
    """Conjunctions of conditions with their weights, and the intercept."""

    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self, stats: str = "_stats") -> Column:
        """The score as a Spark expression."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            met = F.lit(True)
            for at, above, bound in rule:
                value = F.col(f"{stats}.{STATISTICS[at]}")
                met = met & (value > bound if above else value <= bound)
            total = total + F.when(met, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total += weight * _met(x, rule)
        return 1 / (1 + np.exp(-total))


def _met(x: np.ndarray, rule: tuple[Condition, ...]) -> np.ndarray:
    met = np.ones(len(x), bool)
    for at, above, bound in rule:
        met &= (x[:, at] > bound) == above
    return met


def _paths(x: np.ndarray, places: np.ndarray, bounds: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray) -> list[tuple[tuple[Condition, ...], float]]:
    """Paths to all nodes but the root of one boosted tree, and the step of those that end in a leaf (else 0)."""
    found = []

    def grow(rows: np.ndarray, rule: tuple[Condition, ...]) -> None:
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = (1e-6, 0, 0)
        if len(rule) < DEPTH and len(rows) >= 2 * LEAF:
            for at in range(x.shape[1]):
                k = len(bounds[at]) + 1
                if k < 2:
                    continue
                own = places[rows, at]
                gs, hs, n = (np.bincount(own, w, k).cumsum()[:-1] for w in (gradient[rows], hessian[rows], None))
                gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                gain[(n < LEAF) | (len(rows) - n < LEAF)] = 0
                cut = int(gain.argmax())
                best = max(best, (float(gain[cut]), -at, -cut))
        if best[0] <= 1e-6:
            if rule:
                found.append((rule, float(-g / (h + 1))))
            return
        at, cut = -best[1], -best[2]
        if rule:
            found.append((rule, 0.0))
        below = places[rows, at] <= cut
        for side, above in ((rows[below], False), (rows[~below], True)):
            grow(side, (*rule, (at, above, float(bounds[at][cut]))))

    grow(np.arange(len(x)), ())
    return found


def fit(x: np.ndarray, y: np.ndarray) -> Rules:
    """A rule ensemble for statistics ``x`` (a row each) and labels ``y`` (0 or 1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    if len(y) < 2 * LEAF or y.min() == y.max():
        return Rules((), (), intercept)
    bounds = [np.unique(np.round(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]), 6)) for column in x.T]
    places = np.stack([np.searchsorted(b, column, side="left") for b, column in zip(bounds, x.T, strict=True)], axis=1)
    score, rules = np.full(len(y), intercept), {}
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        for rule, step in _paths(x, places, bounds, p - y, p * (1 - p)):
            rules[tuple(sorted(rule))] = None
            if step:
                score += SHRINKAGE * step * _met(x, rule)
    kept = list(rules)
    met = np.stack([_met(x, r) for r in kept], axis=1).astype(np.float64)
    scale = np.maximum(met.std(axis=0), 0.05)  # rules of any support pay alike, but for the rarest
    z = (met - met.mean(axis=0)) / scale
    w, b, ahead, t = np.zeros(len(kept)), intercept, None, 1.0
    rate = 4 * len(y) / (np.linalg.norm(z, 2) ** 2 + len(y))
    ahead = (w.copy(), b)
    for _ in range(STEPS):  # accelerated proximal gradient
        p = 1 / (1 + np.exp(-(z @ ahead[0] + ahead[1])))
        new = ahead[0] - rate * (z.T @ (p - y)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - rate * LASSO, 0)
        new_b = ahead[1] - rate * (p - y).mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = (new + (t - 1) / t_new * (new - w), new_b + (t - 1) / t_new * (new_b - b))
        w, b, t = new, new_b, t_new
    weights = w / scale
    chosen = np.flatnonzero(w)
    return Rules(tuple(kept[i] for i in chosen), tuple(round(float(weights[i]), 9) for i in chosen), float(b - weights @ met.mean(axis=0)))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Rules:
    """Fit on the labelled documents; ``sample`` bounds the labels that are joined and the rows that are fitted.

    A doc_id counts once, by the least of its rows' statistics, however many rows have it.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").where("doc_id is not null and quality is not null")
    one = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("_label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    once = statistics(rows).groupBy("doc_id").agg(F.min(F.struct("_label", "_stats.*")).alias("_row"))
    table = once.select("_row.*").toPandas()  # numbers of at most ``sample`` documents
    table = table.sort_values(list(table.columns))
    return fit(table[list(STATISTICS)].to_numpy(np.float64), (table["_label"].to_numpy() > 0).astype(np.float64))


def score(docs: DataFrame, rules: Rules) -> DataFrame:
    """``docs`` with ``score`` between 0 and 1; a clashing column is replaced."""
    return statistics(docs).withColumn("score", rules.column()).drop("_stats")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``threshold`` on) of every row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), learn(docs, labels))
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with the columns that they had."""
    scored = statistics(docs).withColumn("_score", learn(docs, labels).column())
    return scored.where(F.col("_score") >= threshold).select(docs.columns)
