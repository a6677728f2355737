"""Binary classification metrics: confusion counts, cost, PR and ROC curves.

Curves take one pass over the scored rows: each row is assigned the number of
thresholds at or below its score (its histogram cell), the histogram has at most
thresholds + 1 cells, and precision/recall at every threshold are reverse
cumulative sums of it — never one pass per threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.relational import with_prefix_sums


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def confusion_counts(df: DataFrame, label, pred) -> DataFrame:
    y, p = _c(label), _c(pred)
    return df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                  F.count_if((y == -1) & (p == 1)).alias("fp"),
                  F.count_if((y == -1) & (p == -1)).alias("tn"),
                  F.count_if((y == 1) & (p == -1)).alias("fn"))


def binary_metrics(df: DataFrame, label, pred) -> DataFrame:
    c = confusion_counts(df, label, pred)
    n = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return c.select(
        n.cast("bigint").alias("n"),
        ((F.col("tp") + F.col("tn")) / n).alias("accuracy"),
        (F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0))).alias("precision"),
        (F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))).alias("recall"),
        "tp", "fp", "tn", "fn")


def threshold_cell(score, thresholds: list[float]) -> Column:
    """Number of thresholds ≤ score, for ascending equally spaced ``thresholds``: an
    arithmetic guess corrected by exact comparison with the literal thresholds."""
    s = _c(score)
    m = len(thresholds)
    lo, step = thresholds[0], (thresholds[-1] - thresholds[0]) / (m - 1)
    t = F.array(*[F.lit(float(v)) for v in thresholds])
    guess = F.least(F.greatest(F.floor((s - F.lit(lo)) / F.lit(step)) + 1, F.lit(0)), F.lit(m))
    guess = guess.cast("int")
    up = F.when((guess < m) & (s >= F.element_at(t, guess + 1)), guess + 1).otherwise(guess)
    return F.when((up > 0) & (s < F.element_at(t, F.greatest(up, F.lit(1)))), up - 1).otherwise(up)


def pr_curve(df: DataFrame, score, label, thresholds: list[float]):
    """Rows (threshold, tp, fp, n_pos) for predicting +1 when score ≥ threshold."""
    hist = (df.select(threshold_cell(score, thresholds).alias("cell"), _c(label).alias("y"))
            .groupBy("cell").agg(F.count_if(F.col("y") == 1).alias("pos"),
                                 F.count_if(F.col("y") != 1).alias("neg"))).collect()
    pos = {r["cell"]: r["pos"] for r in hist}
    neg = {r["cell"]: r["neg"] for r in hist}
    n_pos = sum(pos.values())
    out = []
    m = len(thresholds)
    tp = fp = 0
    for i in range(m - 1, -1, -1):       # predicted positive at t_i ⇔ cell > i
        tp += pos.get(i + 1, 0)
        fp += neg.get(i + 1, 0)
        out.append((thresholds[i], tp, fp, n_pos))
    return list(reversed(out))


def roc_points(df: DataFrame, score, label) -> DataFrame:
    """ROC over distinct scores (descending): cumulative TPR/FPR and the trapezoid AUC.

    Grouped counts per distinct score, then distributed prefix sums along the score
    order (no single-partition window)."""
    g = (df.select(_c(score).alias("score"), _c(label).alias("y")).groupBy("score")
         .agg(F.count_if(F.col("y") == 1).cast("double").alias("p"),
              F.count_if(F.col("y") != 1).cast("double").alias("q")))
    tot = g.agg(F.sum("p").alias("P"), F.sum("q").alias("N")).collect()[0]
    pre = with_prefix_sums(g, [F.desc("score")], {"cp": F.col("p"), "cq": F.col("q")}, "i")
    pts = pre.select("i", "score", "cp", "cq", (F.col("cp") / F.lit(tot["P"])).alias("tpr"),
                     (F.col("cq") / F.lit(tot["N"])).alias("fpr"))
    prev = pts.select((F.col("i") + 1).alias("i"), F.col("cp").alias("cp0"),
                      F.col("cq").alias("cq0"))
    j = pts.join(prev, "i", "left").na.fill({"cp0": 0.0, "cq0": 0.0})
    # trapezoids on integer counts: the numerator is an exact integer, divided once
    num = j.agg(F.sum(((F.col("cq") - F.col("cq0")) * (F.col("cp") + F.col("cp0")))
                      .cast("bigint"))).collect()[0][0]
    auc = float(num) / (2.0 * tot["P"] * tot["N"])
    return pts.drop("cp", "cq"), auc
