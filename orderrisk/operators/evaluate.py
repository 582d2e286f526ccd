"""Evaluation of a score against a 0/1 label.

Everything starts from one distributed aggregate, the counts of both labels per distinct score.
Rule scores take a few dozen values and probabilities at four decimals at most 10,001, so the
cumulative window runs over a small table. Raw probabilities may be all different: ``ranked`` takes
ranges of scores side by side instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.numbers import count_where, ratio_or_zero
from orderrisk.session import cut_lineage

# Distinct scores of a range that one task ranks.
RANGE_ROWS = 1 << 18


def score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(score).alias("threshold"))
        .agg(
            count_where(F.col(label) == 1).alias("pos"),
            count_where(F.col(label) == 0).alias("neg"),
        )
    )


def cumulate(counts: DataFrame) -> DataFrame:
    """Adds, per threshold, true and false positives at or above it, and both label totals; for scores with few values."""
    upto = Window.orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    return counts.select(
        "threshold",
        "pos",
        "neg",
        F.sum("pos").over(upto).alias("tp"),
        F.sum("neg").over(upto).alias("fp"),
        F.sum("pos").over(whole).alias("all_pos"),
        F.sum("neg").over(whole).alias("all_neg"),
    )


def ranked(counts: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """:func:`cumulate` in two levels, for any number of distinct scores; also ``inside``.

    Scores are dealt over ranges of about ``range_rows`` by a range shuffle and written with their range. Sums within a range
    start from those of the ranges above it, and the scores beside a range's ends are carried over, so that
    ``inside`` (no end of a straight stretch of the curve) is known without a window over everything.
    """
    counts = cut_lineage(counts)
    pieces = counts.count() // range_rows + 1
    dealt = counts.repartitionByRange(pieces, F.col("threshold").desc())
    dealt = cut_lineage(dealt.withColumn("_range", F.spark_partition_id()))
    sides = F.struct("pos", "neg")
    # One row a range.
    ranges = dealt.groupBy("_range").agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"), F.max_by(sides, "threshold").alias("_first")
    )
    order = Window.orderBy("_range")
    above, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    known = ranges.select(
        "_range",
        F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_p_above"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n_above"),
        F.sum("_p").over(whole).alias("all_pos"),
        F.sum("_n").over(whole).alias("all_neg"),
        F.lead("_first").over(order).alias("_after"),
        (F.row_number().over(order) > 1).alias("_below_another"),
    )
    down = Window.partitionBy("_range").orderBy(F.col("threshold").desc())
    upto = down.rowsBetween(Window.unboundedPreceding, 0)
    following = F.coalesce(F.lead(sides).over(down), F.col("_after"))
    inside = (F.col("_below_another") | (F.row_number().over(down) > 1)) & (following == sides)
    return dealt.join(known, "_range").select(
        "threshold",
        "pos",
        "neg",
        (F.sum("pos").over(upto) + F.col("_p_above")).alias("tp"),
        (F.sum("neg").over(upto) + F.col("_n_above")).alias("fp"),
        "all_pos",
        "all_neg",
        F.coalesce(inside, F.lit(False)).alias("inside"),
    )


def _precision() -> Column:
    return ratio_or_zero(F.col("tp"), F.col("tp") + F.col("fp"))


def _recall() -> Column:
    return ratio_or_zero(F.col("tp"), F.col("all_pos"))


def _f1(tp: Column, flagged: Column, positives: Column) -> Column:
    return ratio_or_zero(tp * 2, flagged + positives)


def threshold_sweep(cum: DataFrame) -> DataFrame:
    """Precision, recall, F1 and share flagged when flagging at or above each distinct score."""
    flagged = F.col("tp") + F.col("fp")
    rows = F.col("all_pos") + F.col("all_neg")
    return cum.select(
        "threshold",
        _precision().alias("precision"),
        _recall().alias("recall"),
        _f1(F.col("tp"), flagged, F.col("all_pos")).alias("f1"),
        (flagged / rows * 100).alias("flagged_pct"),
    )


def best_threshold(sweep: DataFrame, current: float = fixed.FLAG_AT) -> DataFrame:
    """The row of the highest F1 (lowest threshold on ties) and the row at the current threshold."""
    names = sweep.columns
    row = F.struct(*names)
    best = F.max_by(row, F.struct(F.col("f1"), -F.col("threshold")))
    here = F.max(F.when(F.col("threshold") == current, row))
    both = sweep.agg(best.alias("best"), here.alias("current"))
    lines = [
        F.struct(F.lit(choice).alias("choice"), *[F.col(choice)[n].alias(n) for n in names])
        for choice in ("best", "current")
    ]
    return both.select(F.inline(F.array(*lines)))


def roc_curve(cum: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """False and true positive rate per threshold, from (0, 0).

    Points inside a straight stretch add nothing to the curve and are dropped by default; the first
    and the last threshold always stay.
    """
    points = cum
    if drop_intermediate and "inside" in cum.columns:
        points = cum.where("not inside")
    elif drop_intermediate:
        down = Window.orderBy(F.col("threshold").desc())
        next_pos, next_neg = F.lead("pos").over(down), F.lead("neg").over(down)
        inside = F.lag("pos").over(down).isNotNull()
        straight = inside & (next_pos == F.col("pos")) & (next_neg == F.col("neg"))
        points = cum.withColumn("_straight", F.coalesce(straight, F.lit(False))).where("not _straight")
    curve = points.select(
        F.col("threshold").cast("double").alias("threshold"),
        ratio_or_zero(F.col("fp"), F.col("all_neg")).alias("fpr"),
        ratio_or_zero(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    origin = cum.agg(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return curve.unionByName(origin)


def pr_curve(cum: DataFrame) -> DataFrame:
    """Precision and recall per threshold, ending at precision 1 and recall 0 (no threshold)."""
    recall = F.when(F.col("all_pos") == 0, F.lit(1.0)).otherwise(_recall())
    curve = cum.select(
        F.col("threshold").cast("double").alias("threshold"),
        _precision().alias("precision"),
        recall.alias("recall"),
    )
    end = cum.agg(
        F.max(F.lit(None).cast("double")).alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def _auc_sum() -> Column:
    """Twice the number of (positive, negative) pairs in order, ties as half; exact."""
    wide = "decimal(19,0)"
    return F.sum(F.col("neg").cast(wide) * (F.col("tp") * 2 - F.col("pos")).cast(wide))


def _auc(pairs: Column, positives: Column, negatives: Column) -> Column:
    both = positives.cast("double") * negatives.cast("double") * 2
    return pairs.cast("double") / F.nullif(both, F.lit(0.0))


def _ap_sum() -> Column:
    return F.sum(F.col("pos").cast("double") * _precision())


def roc_auc(cum: DataFrame) -> DataFrame:
    base = cum.agg(_auc_sum().alias("pairs"), F.max("all_pos").alias("p"), F.max("all_neg").alias("n"))
    return base.select(_auc(F.col("pairs"), F.col("p"), F.col("n")).alias("roc_auc"))


def average_precision(cum: DataFrame) -> DataFrame:
    """Steps of recall times precision (no trapezoids)."""
    base = cum.agg(_ap_sum().alias("s"), F.max("all_pos").alias("p"))
    value = F.col("s") / F.nullif(F.col("p").cast("double"), F.lit(0.0))
    return base.select(F.round(value, 9).alias("avg_precision"))


def ranking_metrics(cum: DataFrame) -> DataFrame:
    """AUC and average precision in one row, from one pass over the counts."""
    base = cum.agg(
        _auc_sum().alias("pairs"),
        _ap_sum().alias("s"),
        F.max("all_pos").alias("p"),
        F.max("all_neg").alias("n"),
    )
    return base.select(
        _auc(F.col("pairs"), F.col("p"), F.col("n")).alias("roc_auc"),
        F.round(F.col("s") / F.nullif(F.col("p").cast("double"), F.lit(0.0)), 9).alias("avg_precision"),
    )


def confusion(df: DataFrame, pred: str, label: str) -> DataFrame:
    def cell(truth: int, guess: int) -> Column:
        return count_where((F.col(label) == truth) & (F.col(pred) == guess))

    return df.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_at(counts: DataFrame, threshold: float) -> DataFrame:
    """The confusion counts of flagging at or above a threshold, from the counts per score."""
    flagged = F.col("threshold") >= threshold

    def cell(side: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(side))), F.lit(0)).cast("bigint")

    return counts.agg(
        cell("neg", ~flagged).alias("tn"),
        cell("neg", flagged).alias("fp"),
        cell("pos", ~flagged).alias("fn"),
        cell("pos", flagged).alias("tp"),
    )


def classification_report(cells: DataFrame) -> DataFrame:
    """Per class precision, recall, F1 and support; accuracy; macro and weighted means."""
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    n0, n1, rows = tn + fp, fn + tp, tn + fp + fn + tp
    zero = [ratio_or_zero(tn, tn + fn), ratio_or_zero(tn, n0), _f1(tn, tn + fn, n0)]
    one = [ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, n1), _f1(tp, tp + fp, n1)]
    macro = [(a + b) / 2 for a, b in zip(zero, one, strict=True)]
    weighted = [(a * n0 + b * n1) / F.nullif(rows, F.lit(0)) for a, b in zip(zero, one, strict=True)]
    none = F.lit(None).cast("double")
    table = [
        ("Legit", zero, n0),
        ("Fraud", one, n1),
        ("accuracy", [none, none, ratio_or_zero(tn + tp, rows)], rows),
        ("macro avg", macro, rows),
        ("weighted avg", weighted, rows),
    ]
    lines = [
        F.struct(
            F.lit(name).alias("class"),
            values[0].alias("precision"),
            values[1].alias("recall"),
            values[2].alias("f1"),
            support.alias("support"),
        )
        for name, values, support in table
    ]
    return cells.select(F.inline(F.array(*lines)))


def hard_label_metrics(cells: DataFrame) -> DataFrame:
    """F1, precision and recall of the positive class."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return cells.select(
        _f1(tp, tp + fp, tp + fn).alias("fraud_f1"),
        ratio_or_zero(tp, tp + fp).alias("fraud_precision"),
        ratio_or_zero(tp, tp + fn).alias("fraud_recall"),
    )


def baseline_summary(counts: DataFrame, threshold: float = fixed.FLAG_AT) -> DataFrame:
    """Fraud rate, AUC, average precision, and F1, precision, recall at the threshold: one row."""
    cum = cumulate(counts)
    flagged = F.col("threshold") >= threshold
    base = cum.agg(
        _auc_sum().alias("pairs"),
        _ap_sum().alias("s"),
        F.max("all_pos").alias("p"),
        F.max("all_neg").alias("n"),
        F.coalesce(F.sum(F.when(flagged, F.col("pos"))), F.lit(0)).alias("hit"),
        F.coalesce(F.sum(F.when(flagged, F.col("neg"))), F.lit(0)).alias("false"),
    )
    p, hit = F.col("p"), F.col("hit")
    marked = hit + F.col("false")
    return base.select(
        (p / F.nullif(p + F.col("n"), F.lit(0))).alias("fraud_rate"),
        F.lit(threshold).alias("threshold"),
        _auc(F.col("pairs"), p, F.col("n")).alias("roc_auc"),
        F.round(F.col("s") / F.nullif(p.cast("double"), F.lit(0.0)), 9).alias("avg_precision"),
        _f1(hit, marked, p).alias("fraud_f1"),
        ratio_or_zero(hit, marked).alias("fraud_precision"),
        ratio_or_zero(hit, p).alias("fraud_recall"),
    )
