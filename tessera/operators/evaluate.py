"""Splitting, tuning and evaluation (V*, C16).

Metrics are single aggregations.  ROC / PR curves pre-aggregate by distinct
score, then take distributed running sums (``ordered.running_sums``) instead
of a global window.
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordered import running_sums

# ------------------------------------------------------------------ splits


def hash_unit(*keys, seed: int = 7):
    """Deterministic number in [0, 1) from the keys' text.

    The first 8 hex digits of md5('seed|key|key..'): every bit depends on
    every character, and other engines compute the same number.
    """
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def hash_split(df: DataFrame, key: str, fractions: list[float], seed: int = 7,
               name: str = "split") -> DataFrame:
    """V1: label rows 0..len(fractions)-1 by cumulative fraction of the key's
    hash (e.g. [0.6, 0.2, 0.2]).  Rows are labelled, never dropped."""
    u = hash_unit(key, seed=seed)
    expr, acc = F.lit(len(fractions) - 1), sum(fractions[:-1])
    for i in range(len(fractions) - 2, -1, -1):
        expr = F.when(u < round(acc, 12), F.lit(i)).otherwise(expr)
        acc -= fractions[i]
    return df.withColumn(name, expr)


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """V1 (random): Spark ``randomSplit``."""
    return df.randomSplit(weights, seed)


def stratified_split(df: DataFrame, key: str, label: str, test_frac: float, seed: int = 7) -> DataFrame:
    """V2: per class hash split: the class is part of the hashed text, so every
    class is split at the same ratio independently."""
    return df.withColumn("is_test", hash_unit(label, key, seed=seed) < test_frac)


def undersample(df: DataFrame, key: str, label: str, majority, keep_frac: float, seed: int = 7) -> DataFrame:
    """Keep all minority rows and ``keep_frac`` of the majority class."""
    return df.where((F.col(label) != F.lit(majority)) | (hash_unit(key, seed=seed) < keep_frac))


# ----------------------------------------------------------------- metrics


def confusion_counts(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """V8: TP, FP, FN, TN in one aggregation."""
    y, p = F.col(label) == positive, F.col(pred) == positive
    return df.agg(F.sum((y & p).cast("bigint")).alias("tp"), F.sum((~y & p).cast("bigint")).alias("fp"),
                  F.sum((y & ~p).cast("bigint")).alias("fn"), F.sum((~y & ~p).cast("bigint")).alias("tn"))


def precision_recall_f1(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """V9: P = TP / predicted positive, R = TP / actual positive, F1; 0 when undefined."""
    c = confusion_counts(df, label, pred, positive)
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return c.select("*", p.alias("precision"), r.alias("recall"), f1.alias("f1"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision, recall, F1, support; plus ``macro avg`` and
    ``weighted avg`` rows (support-weighted).  Zero division gives 0."""
    lab = df.groupBy(F.col(label).alias("cls")).agg(F.count(F.lit(1)).alias("support"))
    prd = df.groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("n_pred"))
    tp = df.where(F.col(label) == F.col(pred)).groupBy(F.col(label).alias("cls")).agg(
        F.count(F.lit(1)).alias("tp"))
    j = (lab.join(prd, "cls", "full").join(tp, "cls", "left")
         .fillna({"support": 0, "n_pred": 0, "tp": 0}))
    p = F.coalesce(F.try_divide(F.col("tp"), F.col("n_pred")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    per = j.select(F.col("cls").cast("string").alias("cls"), p.alias("precision"), r.alias("recall"),
                   F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1"),
                   F.col("support").cast("bigint").alias("support"))
    tot = F.sum("support")
    macro = per.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("cls"),
                       (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"), tot.alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """V11."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def roc_curve(df: DataFrame, label: str, score: str) -> tuple[DataFrame, DataFrame]:
    """(points, auc).  One point per distinct score (desc) plus the
    origin; AUC by trapezoids using each point's predecessor, which is the
    running sum minus the point's own counts."""
    g = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("tp"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("fp"))
    P, N = g.agg(F.sum("tp"), F.sum("fp")).first()
    c = running_sums(g, [F.col("score").desc()], ["tp", "fp"])
    pts = c.select("score", (F.col("cum_fp") / N).alias("fpr"), (F.col("cum_tp") / P).alias("tpr"),
                   ((F.col("cum_fp") - F.col("fp")) / N).alias("fpr_prev"),
                   ((F.col("cum_tp") - F.col("tp")) / P).alias("tpr_prev"))
    auc = pts.agg(F.sum((F.col("fpr") - F.col("fpr_prev")) * (F.col("tpr") + F.col("tpr_prev")) / 2).alias("auc"))
    return pts.select("score", "fpr", "tpr"), auc


def pr_curve(df: DataFrame, label: str, score: str) -> tuple[DataFrame, DataFrame]:
    """Precision / recall per distinct score, first point (0, 1);
    area by trapezoids over recall."""
    g = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("tp"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("fp"))
    P = g.agg(F.sum("tp")).first()[0]
    c = running_sums(g, [F.col("score").desc()], ["tp", "fp"])
    prev_tp = F.col("cum_tp") - F.col("tp")
    prev_all = prev_tp + F.col("cum_fp") - F.col("fp")
    pts = c.select("score", (F.col("cum_tp") / P).alias("recall"),
                   (F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))).alias("precision"),
                   (prev_tp / P).alias("recall_prev"),
                   F.when(prev_all == 0, F.lit(1.0)).otherwise(prev_tp / prev_all).alias("precision_prev"))
    area = pts.agg(F.sum((F.col("recall") - F.col("recall_prev")) *
                         (F.col("precision") + F.col("precision_prev")) / 2).alias("pr_auc"))
    return pts.select("score", "recall", "precision"), area


def regression_metrics(df: DataFrame, label: str, pred: str, n_features: int) -> DataFrame:
    """MAE, MSE, RMSE, R2 and adjusted R2 = 1 - (1 - R2)(n - 1)/(n - p - 1)."""
    e = F.col(label) - F.col(pred)
    m = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
               F.var_pop(label).alias("var_y"))
    r2 = 1 - F.col("mse") / F.col("var_y")
    return m.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"), r2.alias("r2"),
                    (1 - (1 - r2) * (F.col("n") - 1) / (F.col("n") - n_features - 1)).alias("adj_r2"))


def split_mae(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MAE of under-estimates (y >= pred) and over-estimates apart."""
    e = F.col(label) - F.col(pred)
    return df.agg(F.avg(F.when(e >= 0, e)).alias("mae_under"), F.avg(F.when(e < 0, -e)).alias("mae_over"),
                  F.count(F.when(e >= 0, 1)).alias("n_under"), F.count(F.when(e < 0, 1)).alias("n_over"))


class MacroF1Evaluator(Evaluator, Params):
    """V5: macro-averaged F1 (Spark's ``f1`` metric is support-weighted)."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self.labelCol = Param(self, "labelCol", "label column")
        self.predictionCol = Param(self, "predictionCol", "prediction column")
        self._setDefault(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        rep = classification_report(dataset, self.getOrDefault(self.labelCol),
                                    self.getOrDefault(self.predictionCol))
        return float(rep.where(F.col("cls") == "macro avg").first()["f1"])

    def isLargerBetter(self) -> bool:
        return True


def undersample_sweep(train: DataFrame, test: DataFrame, key: str, label: str, majority, fractions: list[float],
                      fit, positive=1) -> DataFrame:
    """For each kept fraction of the majority class, fit on the reduced
    training rows and report recall, precision and F1 on the test rows.
    ``fit(rows)`` returns a model with a ``prediction`` column."""
    rows = []
    for f in fractions:
        kept = undersample(train, key, label, majority, f)
        m = precision_recall_f1(fit(kept).transform(test), label, "prediction", positive).first()
        rows.append((float(f), kept.count(), float(m["precision"]), float(m["recall"]), float(m["f1"])))
    return train.sparkSession.createDataFrame(rows, "fraction double, n_train long, precision double, recall double, f1 double")


def model_comparison(spark, rows: list[tuple]) -> DataFrame:
    """Metric rows per model, sorted by the first metric."""
    df = spark.createDataFrame(rows, "model string, metric_1 double, metric_2 double")
    return df.orderBy("metric_1")
