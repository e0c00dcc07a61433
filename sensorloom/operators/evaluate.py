"""Flags, severity and evaluation of scored windows.

Inputs carry ``anomaly_score`` (below 0 = anomaly) and, for evaluation, ``label`` 0/1 and
``flag`` 0/1. Charts are not drawn; the tables behind them are here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.columns import equal_width_bin, ratio_or_zero
from sensorloom.operators.ordered import arrange, running_sum
from sensorloom.operators.quality import unplaced
from sensorloom.session import freeze


def flag_anomalies(scored: DataFrame) -> DataFrame:
    flag = F.coalesce((F.col("anomaly_score") < 0).cast("int"), F.lit(0))
    return scored.withColumn("anomaly_prediction", flag).withColumn("is_anomaly", flag == 1)


def severity(scored: DataFrame) -> DataFrame:
    """Scores on a 0-100 scale over the whole batch; equal scores give 50.

    ``severity_score`` grows with the score, i.e. towards normal; ``severity_high_is_bad`` is
    the reversed scale.
    """
    ends = scored.agg(F.min("anomaly_score").alias("_low"), F.max("anomaly_score").alias("_high"))
    low, high = ends.first() or (None, None)
    if low is None or high <= low:
        fixed = F.lit(50)
        return scored.withColumn("severity_score", fixed).withColumn("severity_high_is_bad", fixed)
    share = (F.col("anomaly_score") - F.lit(low)) / F.lit(high - low)
    return scored.withColumns(
        {
            "severity_score": (share * 100).cast("int"),
            "severity_high_is_bad": ((1 - share) * 100).cast("int"),
        }
    )


def predictions(scored: DataFrame) -> DataFrame:
    table = severity(flag_anomalies(scored))
    return table.select(
        "entity_id",
        "window_start",
        "window_center",
        "window_end",
        "anomaly_prediction",
        "anomaly_score",
        "is_anomaly",
        "severity_score",
        "severity_high_is_bad",
    )


def detection_summary(flagged: DataFrame) -> DataFrame:
    n = F.count(F.lit(1))
    found = F.count_if(F.col("anomaly_prediction") == 1)
    return flagged.agg(
        n.alias("n_windows"),
        found.alias("n_anomalies"),
        F.try_divide(found * F.lit(100.0), n).alias("anomaly_rate_pct"),
        F.min("anomaly_score").alias("min_score"),
        F.max("anomaly_score").alias("max_score"),
    )


def confusion(labelled: DataFrame) -> DataFrame:
    cell = lambda y, f: F.count_if((F.col("label") == y) & (F.col("flag") == f))
    return labelled.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def precision_recall(matrix: DataFrame) -> DataFrame:
    """Precision, recall and F1 of a confusion matrix; 0 where undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return matrix.withColumns(
        {
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def _by_score(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("anomaly_score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def _cumulated(labelled: DataFrame, partitions: int | None) -> DataFrame:
    """Rows per distinct score with running counts from the most anomalous score upwards."""
    # Placing samples its input first: the counts are written, so that they are not made twice.
    placed = arrange(freeze(_by_score(labelled), "scores"), [], ["anomaly_score"], partitions)
    return unplaced(running_sum(placed, [], {"tp": F.col("pos"), "fp": F.col("neg")}))


def roc_auc(labelled: DataFrame, partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve with low scores as positive; null for a single class.

    Each score contributes its positives times the normals above it, ties counting half.
    """
    steps = _cumulated(labelled, partitions)
    totals = steps.agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2.0)).alias("wrong"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return totals.select((F.lit(1.0) - F.try_divide(F.col("wrong"), pairs)).alias("roc_auc"))


def roc_points(labelled: DataFrame, partitions: int | None = None) -> DataFrame:
    """False and true positive rate at every distinct score used as threshold."""
    ends = labelled.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    n_pos, n_neg = float(ends[0]), float(ends[1])
    return _cumulated(labelled, partitions).select(
        F.col("anomaly_score").alias("threshold"),
        F.try_divide(F.col("fp"), F.lit(n_neg)).alias("fpr"),
        F.try_divide(F.col("tp"), F.lit(n_pos)).alias("tpr"),
    )


def evaluation(labelled: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row: confusion matrix, precision, recall, F1 and ROC-AUC."""
    matrix = precision_recall(confusion(labelled))
    auc = roc_auc(labelled, partitions).first()[0]
    return matrix.withColumn("roc_auc", F.lit(auc).cast("double"))


def histogram(df: DataFrame, col: str, by: str, bins: int) -> DataFrame:
    """Equal-width histogram per class over the range of that class; only filled bins."""
    ends = df.groupBy(by).agg(F.min(col).alias("_low"), F.max(col).alias("_high"))
    placed = df.join(ends, by).withColumn("bin", equal_width_bin(F.col(col), F.col("_low"), F.col("_high"), bins))
    width = (F.col("_high") - F.col("_low")) / bins
    counted = placed.groupBy(by, "_low", "_high", "bin").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(by, "bin", (F.col("_low") + F.col("bin") * width).alias("bin_start"), "n")


def run_summary(features: DataFrame, readings: DataFrame) -> DataFrame:
    """Series with features and series in total."""
    done = features.agg(F.count_distinct("entity_id").alias("n_successful")).first()[0]
    total = readings.agg(F.count_distinct("entity_id").alias("n_entities"))
    return total.withColumn("n_successful", F.lit(done).cast("bigint"))
