"""Boosted trees with Newton leaves, L1 and L2 penalties, and early stopping with patience.

Spark's regression trees are the weak learners; the boosting around them is a loop of Spark jobs:

* A tree is fitted to ``-g / h`` with weight ``h``, the gradient and curvature of the logistic loss at the margins so far.
* One aggregation gives the sums ``G`` and ``H`` of every leaf (at most ``2 ** depth`` rows reach the driver).  The leaf's weight is
  ``-soft(G, alpha) / (H + lambda)``, where ``soft`` draws ``G`` towards 0 by ``alpha``: the penalised Newton step.
* The same aggregation gives the loss of the hold-out rows before this tree.  After ``patience`` trees without a lower loss the
  ensemble is cut at its best length.  A tree without any weight ends the loop too: the next one would be the same.

Margins are expressions over the trees' leaf numbers; every ``CUT`` trees they are written to the shared folder, so plans stay short
and a lost executor costs at most that many trees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footlight.session import materialise

PATIENCE = 20
CUT = 10
# Rows per partition of a training table, by their number of feature values.
PART = 4 << 20
# Feature values of a training table that one task holds, if many fits are dealt to tasks (see ``fits``): 100 MB, and about 250 bytes a row beside.
VALUES = 12 << 20
# Curvature below this would make a row's target as large as its inverse.
LEAST_H = 1e-6
# A smaller gain is rounding: the rows of the node agree in their target.
LEAST_GAIN = 1e-12


def soft(total: float, alpha: float) -> float:
    """``total`` drawn towards 0 by ``alpha``."""
    return math.copysign(max(abs(total) - alpha, 0.0), total)


def leaf_weight(g: float, h: float, alpha: float, lam: float) -> float:
    return -soft(g, alpha) / (h + lam) if h + lam > 0 else 0.0


def margin_term(leaf: str, weights: list[float], rate: float) -> str:
    """SQL for the share of one tree in the margin."""
    return f"{rate!r}D * element_at(array({', '.join(f'{w!r}D' for w in weights)}), int({leaf}) + 1)"


@dataclass
class Boosted:
    """Trees, the weights of their leaves, and the hold-out loss before each tree and after the last."""

    rate: float
    start: float = 0.0
    trees: list[DecisionTreeRegressionModel] = field(default_factory=list)
    weights: list[list[float]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def cut(self, length: int) -> Boosted:
        return Boosted(self.rate, self.start, self.trees[:length], self.weights[:length], self.losses)

    def stages(self) -> list[Transformer]:
        """Stages that add ``predicted_prob``; they can be saved within a pipeline."""
        out: list[Transformer] = [SQLTransformer(statement=f"SELECT *, {self.start!r}D AS _margin FROM __THIS__")]
        for first in range(0, len(self.trees), CUT):
            part = self.trees[first : first + CUT]
            names = [f"_leaf_{first + i}" for i in range(len(part))]
            out += [tree.copy().setPredictionCol("").setLeafCol(name) for tree, name in zip(part, names)]
            terms = [margin_term(name, w, self.rate) for name, w in zip(names, self.weights[first:])]
            out.append(SQLTransformer(statement=f"SELECT * EXCEPT (_margin, {', '.join(names)}), _margin + {' + '.join(terms)} AS _margin FROM __THIS__"))
        out.append(SQLTransformer(statement="SELECT * EXCEPT (_margin), 1D / (1D + exp(-_margin)) AS predicted_prob FROM __THIS__"))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return PipelineModel(stages=self.stages()).transform(df)

    @property
    def importances(self) -> list[float]:
        """Mean of the trees' own importances; trees without a split have none."""
        each = [t.featureImportances.toArray() for t in self.trees]
        total = sum(each) if each else []
        whole = float(sum(total)) if each else 0.0
        return [float(v) / whole for v in total] if whole else [0.0 for _ in total]


def best_length(losses: list[float], patience: int) -> int | None:
    """Trees to keep, once ``patience`` more have not lowered the loss; ``losses[i]`` is that of ``i`` trees."""
    if len(losses) < 2:
        return None
    best = _best(losses)
    return best if len(losses) - 1 - best >= patience else None


def _best(losses: list[float]) -> int:
    """The number of trees, one at least, with the lowest loss, the fewest of equals."""
    return min(range(1, len(losses)), key=lambda i: losses[i])


def _sized(df: DataFrame) -> DataFrame:
    """Fewer partitions where a training table is small for those it has."""
    row = df.agg(F.count(F.lit(1)), F.max(F.size(F.col("_values")))).first()
    return df.drop("_values").coalesce(1 + (row[0] or 0) * (row[1] or 0) // PART)


def fit(
    rows: DataFrame,
    rounds: int,
    rate: float,
    depth: int,
    alpha: float = 0.0,
    lam: float = 0.0,
    holdout: str | None = None,
    patience: int = PATIENCE,
    bins: int = 32,
    min_gain: float = 0.0,
    min_rows: int = 1,
    subsample: float = 1.0,
    seed: int = 42,
) -> Boosted:
    """Boosted trees for ``rows`` (features, label 0/1); rows whose ``holdout`` column is true decide when to stop.

    Without hold-out rows all ``rounds`` are made.  Without training rows there are no trees.
    """
    held = F.coalesce(F.col(holdout), F.lit(False)) if holdout else F.lit(False)
    data = rows.select("features", F.col("label").cast("double").alias("label"), held.alias("_held"), F.lit(0.0).alias("_margin"))
    data = materialise(_sized(data.withColumn("_values", vector_to_array("features"))), "boosting")
    p = 1 / (1 + F.exp(-F.col("_margin")))
    h = F.greatest(p * (1 - p), F.lit(LEAST_H))
    loss = F.log1p(F.exp(-F.abs("_margin"))) + F.greatest(F.col("_margin"), F.lit(0.0)) - F.col("label") * F.col("_margin")
    counts = data.groupBy("_held").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = {r["_held"]: r["n"] for r in counts}
    out = Boosted(rate)
    if not sizes.get(False):
        return out
    learner = DecisionTreeRegressor(
        featuresCol="features", labelCol="_target", weightCol="_h", predictionCol="", leafCol="_leaf", maxDepth=depth, maxBins=bins,
        minInfoGain=max(min_gain, LEAST_GAIN), minInstancesPerNode=min_rows, seed=seed,
    )
    for m in range(rounds):
        marked = data.withColumns({"_g": p - F.col("label"), "_h": h})
        training = marked.where(~F.col("_held")).withColumn("_target", -F.col("_g") / F.col("_h"))
        if subsample < 1:
            training = training.where(F.pmod(F.xxhash64(F.hash("features"), "label", F.lit(seed + m)), F.lit(1 << 20)) < int(subsample * (1 << 20)))
            if training.isEmpty():
                continue
        tree = learner.fit(training)
        sums = tree.transform(marked).groupBy("_leaf").agg(
            F.sum(F.when(~F.col("_held"), F.col("_g"))).alias("g"),
            F.sum(F.when(~F.col("_held"), F.col("_h"))).alias("h"),
            F.sum(F.when(F.col("_held"), loss)).alias("loss"),
        ).collect()
        if sizes.get(True):
            out.losses.append(sum(r["loss"] or 0.0 for r in sums) / sizes[True])
            found = best_length(out.losses, patience)
            if found is not None:
                return out.cut(found)
        own = {int(r["_leaf"]): leaf_weight(r["g"] or 0.0, r["h"] or 0.0, alpha, lam) for r in sums}
        weights = [own.get(i, 0.0) for i in range(max(own) + 1)]
        # A leaf that no row reaches has no weight, but may have the largest number.
        weights += [0.0] * ((tree.numNodes + 1) // 2 - len(weights))
        if not any(weights) and subsample == 1:
            break
        out.trees.append(tree)
        out.weights.append(weights)
        data = tree.transform(data).withColumn("_margin", F.col("_margin") + F.expr(margin_term("_leaf", weights, rate))).drop("_leaf")
        if len(out.trees) % CUT == 0:
            data = materialise(data, "boosting")
    if sizes.get(True) and len(out.losses) == len(out.trees):
        out.losses.append(data.where("_held").agg(F.avg(loss)).first()[0])
    return out.cut(_best(out.losses)) if len(out.losses) > 1 else out
