"""Quality scores by a sparse ensemble of rules over text statistics.

Statistics of every whole text are measured once.  On a bounded,
hash-chosen sample of labelled rows (``max_rows``), boosted shallow trees are
grown; every path from a root to a node is a rule, a conjunction of
conditions on statistics.  A logistic regression with a lasso penalty weighs
the rules, most of which get no weight, and those that remain are compiled
into one Spark column expression that scores all rows.

Defined results: a null text counts as empty and is scored from its
statistics, all 0; a null label is not learned; if nothing or only one class
can be learned, every score is that class's share among the labels (0.5
without labels); repeated rows repeat their scores; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from kiln.llm.text_stats import STATISTICS

#: (statistic, upper bound?, threshold): statistic <= threshold, or >.
Condition = tuple[str, bool, float]
_SPLIT = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+\dEe.]+)\)")


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions; the score is the logistic function of their sum."""

    intercept: float
    weighted: tuple[tuple[tuple[Condition, ...], float], ...] = ()

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for conditions, weight in self.weighted:
            total = total + F.when(_holds(conditions), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _holds(conditions: tuple[Condition, ...]) -> Column:
    out = F.lit(True)
    for statistic, upper, threshold in conditions:
        out = out & ((F.col(statistic) <= threshold) if upper else (F.col(statistic) > threshold))
    return out


def paths(described: str, statistics: list[str]) -> set[tuple[Condition, ...]]:
    """The conjunctions of a tree's description: one for each node below the
    root, bounds on the same statistic and side merged."""
    found, open_ = set(), []
    for line in described.splitlines():
        if m := _SPLIT.match(line):
            indent, feature, sign, threshold = len(m[1]), int(m[3]), m[4], float(m[5])
            open_ = [o for o in open_ if o[0] < indent] + [(indent, statistics[feature], sign == "<=", threshold)]
            bounds: dict[tuple[str, bool], float] = {}
            for _, statistic, upper, t in open_:
                key = statistic, upper
                bounds[key] = t if key not in bounds else (min if upper else max)(bounds[key], t)
            found.add(tuple(sorted((s, u, t) for (s, u), t in bounds.items())))
    return found


def learn(labelled: DataFrame, label: str, max_rows: int = 20_000, trees: int = 12, depth: int = 3, penalty: float = 0.002) -> Rules:
    """Rules for ``label`` (0 or 1) from a frame with the statistics and a
    ``doc_id``, by whose hash about ``max_rows`` rows are taken."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    labelled = labelled.filter(F.col(label).isin(0, 1))
    shares = {int(r[label]): r["n"] for r in labelled.groupBy(label).agg(F.count("*").alias("n")).collect()}  # two rows
    n = sum(shares.values())
    if len(shares) < 2:
        share = min(max(shares.get(1, 0) / n, 1e-6), 1 - 1e-6) if n else 0.5
        return Rules(math.log(share / (1 - share)))
    if n > max_rows:
        labelled = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))
    sample = labelled.select(*STATISTICS, F.col(label).cast("double").alias("_label")).coalesce(4).persist()
    try:
        vectors = VectorAssembler(inputCols=STATISTICS, outputCol="_statistics").transform(sample)
        grown = GBTClassifier(featuresCol="_statistics", labelCol="_label", maxDepth=depth, maxIter=trees, maxBins=64, stepSize=0.3, seed=7).fit(vectors)
        rules = sorted(set().union(*(paths(t.toDebugString, STATISTICS) for t in grown.trees)))
        held = F.array(*(_holds(r).cast("double") for r in rules))
        lasso = LogisticRegression(featuresCol="_rules", labelCol="_label", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=100)
        fitted = lasso.fit(sample.select("_label", array_to_vector(held).alias("_rules")))
        weights = fitted.coefficients.toArray()
        return Rules(float(fitted.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w))
    finally:
        sample.unpersist()
