"""Evaluation of binary scores and predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.constants import REVIEW_GRID, SWEEP_GRID
from riskloom.functions.numbers import confidence, custom_rank, is_close, ratio_or_zero
from riskloom.operators.running import percentiles, running_sums
from riskloom.session import materialize

COUNTS = ["tp", "fp", "fn", "tn"]
EXACT = "decimal(38,0)"


def _confusion(label: Column, pred: Column) -> list[Column]:
    return [
        F.count_if((label == 1) & (pred == 1)).alias("tp"), F.count_if((label == 0) & (pred == 1)).alias("fp"),
        F.count_if((label == 1) & (pred == 0)).alias("fn"), F.count_if((label == 0) & (pred == 0)).alias("tn"),
    ]


def confusion(df: DataFrame, label: str = "alert_flag", pred: str = "student_pred", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*_confusion(F.col(label), F.col(pred)))


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from the four counts; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    return counts.withColumns({
        "accuracy": ratio_or_zero(tp + tn, tp + fp + fn + tn),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    })


def binary_metrics(df: DataFrame, label: str = "alert_flag", pred: str = "student_pred", by: Sequence[str] = ()) -> DataFrame:
    return rates(confusion(df, label, pred, by))


# --- ranking quality ------------------------------------------------------------


def score_steps(df: DataFrame, label: str = "alert_flag", score: str = "student_score", by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: positives and negatives there and from the top down to it."""
    steps = df.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    # Read several times below (cut points, bucket totals, rows): the scores behind it are computed once.
    steps = materialize(steps, "score-steps")
    return running_sums(steps, ["pos", "neg"], score, by, descending=True)


def ranking_metrics(df: DataFrame, label: str = "alert_flag", score: str = "student_score", by: Sequence[str] = ()) -> DataFrame:
    """ROC AUC (ties count half) and average precision; null with one class."""
    steps = score_steps(df, label, score, by)
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "pos_upto", "neg_upto"))
    # Twice the pairs won, as whole numbers: exact in any order.
    won = neg.cast(EXACT) * (2 * (tp - pos) + pos).cast("decimal(20,0)")
    sums = steps.groupBy(*by).agg(
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
        F.sum(won).cast("double").alias("_won"),
        F.sum(pos * (tp / (tp + fp))).alias("_ap"),
    )
    p, n = F.col("_p"), F.col("_n")
    both = (p > 0) & (n > 0)
    return sums.select(
        *by,
        F.when(both, F.col("_won") / (2 * p.cast("double") * n.cast("double"))).alias("roc_auc"),
        F.when(both, F.col("_ap") / p).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, label: str = "alert_flag", score: str = "student_score", by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, label, score, by).select(*by, "roc_auc")


def average_precision(df: DataFrame, label: str = "alert_flag", score: str = "student_score", by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(df, label, score, by).select(*by, "pr_auc")


def pr_curve(df: DataFrame, label: str = "alert_flag", score: str = "student_score", by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall with every distinct score as threshold."""
    steps = score_steps(df, label, score, by)
    totals = df.groupBy(*by).agg(F.count_if(F.col(label) == 1).alias("_p"))
    rows = steps.join(totals, list(by)) if by else steps.withColumn("_p", totals.scalar())
    return rows.select(
        *by, F.col(score).alias("threshold"),
        (F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))).alias("precision"),
        ratio_or_zero(F.col("pos_upto"), F.col("_p")).alias("recall"),
    )


# --- thresholds ----------------------------------------------------------------


def grid_points(grid: tuple[float, float, int]) -> list[float]:
    """Unrounded ``start + i * step``; the comparison uses these values."""
    start, step, n = grid
    return [start + i * step for i in range(n)]


def _passed(value: Column, points: Sequence[float]) -> Column:
    """How many points of an ascending grid a value reaches."""
    total = F.lit(0)
    for p in points:
        total = total + (value >= F.lit(p)).cast("int")
    return total


def threshold_sweep(
    df: DataFrame, grid: tuple[float, float, int] = SWEEP_GRID, label: str = "alert_flag",
    score: str = "student_score", by: Sequence[str] = (), ranking: bool = True,
) -> DataFrame:
    """Metrics at every threshold of a grid.

    Rows are reduced to counts per (grid points reached, label) in one pass;
    the thresholds are applied to that handful of counts.
    """
    points = grid_points(grid)
    reached = df.groupBy(*by, _passed(F.col(score), points).alias("_k"), F.col(label).alias("_y")).agg(
        F.count(F.lit(1)).alias("_c"))
    names = F.array(*[F.lit(round(p, 2)) for p in points])
    spread = reached.select(*by, "_k", "_y", "_c", F.posexplode(names).alias("_i", "threshold"))
    pred = (F.col("_i") < F.col("_k"))
    y, c = F.col("_y"), F.col("_c")

    def total(cond: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, c)), F.lit(0)).alias(name)

    counts = spread.groupBy(*by, "threshold").agg(
        total((y == 1) & pred, "tp"), total((y == 0) & pred, "fp"),
        total((y == 1) & ~pred, "fn"), total((y == 0) & ~pred, "tn"))
    out = rates(counts)
    if not ranking:
        return out
    quality = ranking_metrics(df, label, score, by)
    if by:
        return out.join(quality, list(by))
    both = quality.select(F.struct("roc_auc", "pr_auc")).scalar()
    return out.withColumn("_q", both).select("*", "_q.roc_auc", "_q.pr_auc").drop("_q")


def review_zone(
    df: DataFrame, grid: Sequence[float] = REVIEW_GRID, label: str = "alert_flag",
    pred: str = "student_pred", score: str = "student_score",
) -> DataFrame:
    """Share of rows confident enough to go without review, and their quality."""
    points = sorted(grid)
    reached = df.groupBy(
        _passed(confidence(score), points).alias("_k"), F.col(label).alias("_y"), F.col(pred).alias("_p"),
    ).agg(F.count(F.lit(1)).alias("_c"))
    spread = reached.select("*", F.posexplode(F.array(*[F.lit(float(p)) for p in points])).alias("_i", "review_threshold"))
    auto = F.col("_i") < F.col("_k")
    c = F.col("_c")

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, c)), F.lit(0))

    def cell(y: int, p: int) -> Column:
        return total(auto & (F.col("_y") == y) & (F.col("_p") == p))

    counts = spread.groupBy("review_threshold").agg(
        F.sum(c).alias("_n"), total(auto).alias("_auto"),
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))
    some = F.col("_auto") > 0
    return rates(counts).select(
        "review_threshold",
        (F.col("_auto") / F.col("_n")).alias("coverage"),
        ((F.col("_n") - F.col("_auto")) / F.col("_n")).alias("review_rate"),
        (F.col("fp") + F.col("fn")).alias("auto_errors"),
        *[F.when(some, F.col(m)).alias(f"auto_{m}") for m in ("precision", "recall", "f1")],
    )


# --- errors ---------------------------------------------------------------------


def quartile_edges(df: DataFrame, column: str) -> list[float]:
    """Minimum, quartiles and maximum (linear), equal edges merged."""
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    probs = {f"q{i}": i / 4 for i in range(5)}
    row = percentiles(materialize(values, "value-counts"), probs).first()
    return sorted({q for q in row or () if q is not None})


def error_rate_by_quartile(
    df: DataFrame, length: str = "text_length", label: str = "alert_flag", pred: str = "student_pred",
    score: str = "student_score",
) -> DataFrame:
    """Errors per quarter of the length; bins closed on the right, the first on both sides."""
    edges = quartile_edges(df, length)
    inner = edges[1:-1]
    spot = F.lit(0)
    for e in inner:
        spot = spot + (F.col(length) > F.lit(e)).cast("int")
    wrong = (F.col(label) != F.col(pred)).cast("int")
    lows = F.array(*[F.lit(float(e)) for e in edges]) if edges else F.array(F.lit(None).cast("double"))
    stats = df.filter(F.col(length).isNotNull()).groupBy(spot.alias("length_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(wrong).alias("errors"), F.avg(wrong).alias("error_rate"),
        F.avg(score).alias("mean_score"))
    return stats.withColumns({
        "low": F.try_element_at(lows, F.col("length_bin") + 1),
        "high": F.coalesce(F.try_element_at(lows, F.col("length_bin") + 2), F.element_at(lows, -1)),
    })


def error_rate_by(df: DataFrame, column: str, label: str = "alert_flag", pred: str = "student_pred") -> DataFrame:
    wrong = (F.col(label) != F.col(pred)).cast("int")
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.sum(wrong).alias("errors"), F.avg(wrong).alias("error_rate"))
        .orderBy(F.desc("errors"), F.desc("error_rate"), column)
    )


def error_kind(label: str = "alert_flag", pred: str = "student_pred") -> Column:
    y, p = F.col(label), F.col(pred)
    return (
        F.when((y == 1) & (p == 1), "tp").when((y == 0) & (p == 1), "fp")
        .when((y == 1) & (p == 0), "fn").when((y == 0) & (p == 0), "tn")
    )


def error_sets(df: DataFrame, label: str = "alert_flag", pred: str = "student_pred") -> dict[str, DataFrame]:
    marked = df.withColumn("error_kind", error_kind(label, pred))
    return {k: marked.filter(F.col("error_kind") == k).drop("error_kind") for k in COUNTS}


def error_counts(df: DataFrame, column: str = "risk_type_4cls", label: str = "alert_flag", pred: str = "student_pred") -> DataFrame:
    kinds = df.withColumn("error_kind", error_kind(label, pred)).filter(F.col("error_kind").isin("fp", "fn"))
    return kinds.groupBy("error_kind", column).agg(F.count(F.lit(1)).alias("count"))


def worst_errors(df: DataFrame, k: int = 10, label="alert_flag", pred="student_pred", score="student_score",
                 key: str = "sample_id") -> DataFrame:
    """Most confident mistakes: false positives with the highest and false
    negatives with the lowest scores."""
    sets = error_sets(df, label, pred)
    fp = sets["fp"].orderBy(F.desc(score), key).limit(k).withColumn("error_kind", F.lit("fp"))
    fn = sets["fn"].orderBy(F.asc(score), key).limit(k).withColumn("error_kind", F.lit("fn"))
    return fp.unionByName(fn)


def classification_report(df: DataFrame, label: str = "alert_flag", pred: str = "student_pred") -> DataFrame:
    """Precision, recall, F1 and support per class with macro and weighted means, and the accuracy as `f1` of a row of its own."""
    cells = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("n"))
    y, p, n = F.col(label).cast("string"), F.col(pred).cast("string"), F.col("n")
    hit = F.when(y == p, n).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(y.alias("class"), n.alias("support"), none.alias("predicted"), hit.cast("long").alias("tp")),
        F.struct(p.alias("class"), none.alias("support"), n.alias("predicted"), none.alias("tp")),
    )
    sums = cells.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    per_class = sums.select(
        "class",
        ratio_or_zero(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio_or_zero(F.col("tp"), F.col("support")).alias("recall"),
        ratio_or_zero(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )
    metrics = ("precision", "recall", "f1")
    macro = per_class.agg(
        F.lit("macro avg").alias("class"), *[F.avg(m).alias(m) for m in metrics], F.sum("support").alias("support"))
    weighted = per_class.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in metrics],
        F.sum("support").alias("support"))
    nothing = F.lit(None).cast("double")
    accuracy = sums.agg(
        F.lit("accuracy").alias("class"), nothing.alias("precision"), nothing.alias("recall"),
        ratio_or_zero(F.sum("tp"), F.sum("support")).alias("f1"), F.sum("support").alias("support"))
    return per_class.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def answer_metrics(df: DataFrame, label: str = "alert_flag", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """Metrics over readable answers (-1 is unreadable), with the counts of both."""
    readable = F.col(pred) != -1
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(readable).alias("n_valid"),
        F.count_if(~readable).alias("n_parse_errors"), *_confusion(F.col(label), F.col(pred)))
    some = F.col("n_valid") > 0
    return rates(counts).select(
        *by, "n_total", "n_valid", "n_parse_errors",
        *[F.when(some, F.col(m)).alias(m) for m in ("accuracy", "precision", "recall", "f1")])


def labeller_disagreement(df: DataFrame, zero: str = "zero_shot_pred", few: str = "few_shot_pred",
                          label: str = "alert_flag", key: str = "sample_id") -> DataFrame:
    """Review list: labeller against data, and the two labellers against each other."""
    y, z, f = F.col(label), F.col(zero), F.col(few)
    reasons = F.array_compact(F.array(
        F.when((y == 0) & (z == 1), "labeller_false_positive"),
        F.when((y == 1) & (z == 0), "labeller_false_negative"),
        F.when((z != f), "labellers_differ"),
    ))
    return df.select(key, F.explode(reasons).alias("reason"))


def match_metrics(df: DataFrame, found: str, truth: str, missing: str) -> DataFrame:
    """Precision, recall and F1 of a found value against the true one.

    ``missing`` is the value that stands for "nothing found".
    """
    has_f = F.coalesce(F.col(found) != missing, F.lit(False))
    has_t = F.coalesce(F.col(truth) != missing, F.lit(False))
    same = has_f & has_t & F.coalesce(F.col(found) == F.col(truth), F.lit(False))
    c = df.agg(F.count_if(same).alias("tp"), F.count_if(has_f & ~same).alias("fp"), F.count_if(has_t & ~same).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.withColumns({
        "precision": ratio_or_zero(tp, tp + fp), "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn)})


# --- tables of metric rows ----------------------------------------------------------

BEST_FIRST = ("f1", "recall", "precision")


def _rank_key(cols: Sequence[str], tie: Sequence[str]) -> Column:
    """Ordering value: larger metrics first, then the smaller tie values."""
    return F.struct(*[F.col(c).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[(-F.col(c)).alias(f"t{i}") for i, c in enumerate(tie)])


def best_grid_row(df: DataFrame, by: Sequence[str] = (), tie: Sequence[str] = (), metrics: Sequence[str] = BEST_FIRST) -> DataFrame:
    """The row with the best metrics per group. An aggregate, not a sort."""
    row = F.struct(*[F.col(c) for c in df.columns])
    best = df.groupBy(*by).agg(F.max_by(row, _rank_key(metrics, tie)).alias("_best"))
    return best.select("_best.*")


def union_metrics(first: DataFrame, *others: DataFrame) -> DataFrame:
    out = first
    for o in others:
        out = out.unionByName(o, allowMissingColumns=True)
    return out


def dedupe_metrics(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """First of equal rows in the order of ``order``."""
    w = Window.partitionBy(*key).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def add_if_absent(df: DataFrame, fallback: DataFrame, key: str = "model") -> DataFrame:
    """Fallback rows only for models that have no row yet."""
    absent = fallback.join(df.select(key).distinct(), key, "left_anti")
    return df.unionByName(absent, allowMissingColumns=True)


def melt_metrics(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(values), "metric", "value")


def keep_best_run(df: DataFrame, model: str = "model", order: str = "row_id") -> DataFrame:
    """Per model: the run with the best valid F1, its threshold on valid and
    test, one row per data set."""
    num = df.withColumns({"_f1": F.col("f1").try_cast("double"), "_t": F.col("threshold").try_cast("double")})
    best = (
        num.filter((F.col("dataset") == "valid") & F.col("_f1").isNotNull())
        .groupBy(model).agg(F.max_by("_t", F.struct("_f1", -F.col(order))).alias("_best_t"))
    )
    kept = num.join(best, model).filter(is_close("_t", "_best_t") & F.col("dataset").isin("valid", "test"))
    w = Window.partitionBy(model, "dataset").orderBy(F.desc("_f1"), order)
    return kept.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_f1", "_t", "_best_t")


def custom_order(df: DataFrame, ranks: Mapping[str, Mapping[str, int]], then: Sequence[str] = ()) -> DataFrame:
    """Sort by name → rank dictionaries, unknown names last."""
    return df.orderBy(*[custom_rank(c, m) for c, m in ranks.items()], *then)


def prefer_model(metrics: DataFrame, challenger: str, incumbent: str, metric: str = "f1") -> DataFrame:
    """One row with the model to use: the challenger if it is at least as good."""
    m, v = F.col("model"), F.col(metric)
    new = F.max(F.when(m == challenger, v))
    old = F.max(F.when(m == incumbent, v))
    return metrics.agg(new.alias("challenger"), old.alias("incumbent")).withColumn(
        "selected", F.when(F.col("challenger") >= F.col("incumbent"), challenger).otherwise(incumbent))


def tag_dataset(df: DataFrame, dataset: str, scheme: Column, selected: float, default: float = 0.5) -> DataFrame:
    """Summary columns: data set, scheme, and the threshold its name implies."""
    return df.withColumn("dataset", F.lit(dataset)).withColumn("scheme", scheme).withColumn(
        "threshold", F.when(F.contains(F.col("scheme"), F.lit("selected")), F.lit(selected)).otherwise(F.lit(default)))


# --- ranking and product measures ----------------------------------------------------


def precision_at_k(df: DataFrame, k: int, label: str = "alert_flag", score: str = "student_score", key: str = "sample_id") -> DataFrame:
    """Share of positives among the ``k`` highest scores."""
    top = df.select(label, score, key).orderBy(F.desc(score), key).limit(k)
    return top.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("precision_at_k"))


def coverage_by(df: DataFrame, column: str, label: str = "alert_flag", pred: str = "student_pred") -> DataFrame:
    """Per bank or type: found share of the positives, false alerts among all alerts."""
    c = confusion(df, label, pred, [column])
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return c.select(
        column, *COUNTS, ratio_or_zero(tp, tp + fn).alias("coverage"),
        ratio_or_zero(fp, tp + fp).alias("false_alert_rate"))


def news_reduction_rate(df: DataFrame, flag: str = "alert_flag", by: Sequence[str] = ()) -> DataFrame:
    n, alerts = F.count(F.lit(1)), F.count_if(F.col(flag) == 1)
    return df.groupBy(*by).agg(n.alias("n_all"), alerts.alias("n_alerts"), ((n - alerts) / n).alias("reduction_rate"))


def alert_sla(df: DataFrame, arrived: str, alerted: str, minutes: int = 15) -> DataFrame:
    """Share of risk items alerted within the limit; never alerted counts as late."""
    in_time = F.coalesce(F.col(alerted) <= F.col(arrived) + F.make_dt_interval(mins=F.lit(minutes)), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(in_time).alias("in_time"),
                  F.avg(in_time.cast("double")).alias("sla_share"))


def acceptance_gates(measures: DataFrame, gates: Mapping[str, float]) -> DataFrame:
    """(metric, value) rows against the smallest accepted value of each metric."""
    limits = F.create_map(*[x for k, v in gates.items() for x in (F.lit(k), F.lit(float(v)))])
    return measures.withColumn("required", F.try_element_at(limits, F.col("metric"))).withColumn(
        "passed", F.col("value") >= F.col("required"))


def useful_feedback_rate(df: DataFrame, useful: str, by: Sequence[str] = (), required: float = 0.70) -> DataFrame:
    """Share of cards the reader called useful, against the stop rule."""
    n, good = F.count(F.lit(1)), F.count_if(F.col(useful) == 1)
    return df.groupBy(*by).agg(
        n.alias("cards"), good.alias("useful"), (good / n).alias("useful_rate"), ((good / n) >= required).alias("accepted"))
