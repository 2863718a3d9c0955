"""Evaluation queries over scored, labelled rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import numbers as N
from riskloom.operators import evaluation as E
from riskloom.operators import teacher as TE
from riskloom.plans.adapters import UNKNOWN, Views
from riskloom.plans.oracle import with_views
from riskloom.plans.profile_queries import rounded
from riskloom.plans.registry import query

RATES = ("accuracy", "precision", "recall", "f1")
RANKS = ("roc_auc", "pr_auc")
SPLITS = ["valid", "test"]

_CM = """count(*) FILTER ({y} = 1 AND {p} = 1) AS tp, count(*) FILTER ({y} = 0 AND {p} = 1) AS fp,
  count(*) FILTER ({y} = 1 AND {p} = 0) AS fn, count(*) FILTER ({y} = 0 AND {p} = 0) AS tn"""
_RATES = """round(CASE WHEN tp + fp + fn + tn = 0 THEN 0 ELSE (tp + tn) / (tp + fp + fn + tn) END, 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS "precision",
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1"""


def cm(y="alert_flag", p="student_pred") -> str:
    return _CM.format(y=y, p=p)


def ranks_sql(source: str, score: str = "student_score", by: str = "") -> str:
    """ROC AUC and average precision from running sums over distinct scores."""
    part = f"PARTITION BY {by}" if by else ""
    g = f"{by}, " if by else ""
    gb = f"GROUP BY {by}" if by else ""
    return f"""
SELECT {g}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN round(sum(neg * (2 * (tp - pos) + pos))::DOUBLE / (2 * sum(pos) * sum(neg)), 6) END AS roc_auc,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN round(sum(pos * (tp / (tp + fp))) / sum(pos), 6) END AS pr_auc
FROM (SELECT {g}pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (
    SELECT {g}{score} AS s, count(*) FILTER (alert_flag = 1) AS pos, count(*) FILTER (alert_flag = 0) AS neg
    FROM {source} GROUP BY {g}{score})
  WINDOW w AS ({part} ORDER BY s DESC)) {gb}"""


def grid_sql(start: float, n: int) -> str:
    return f"grid AS (SELECT i, {start}::DOUBLE + i * 0.05::DOUBLE AS t FROM (SELECT unnest(range({n})) AS i))"


@query("AG14", with_views(f"SELECT split, {cm()} FROM v_scored GROUP BY split", "v_scored"))
def confusion(v: Views):
    return E.confusion(v.scored, by=["split"])


@query("AG15", with_views(
    f"SELECT split, tp, fp, fn, tn, {_RATES} FROM (SELECT split, {cm()} FROM v_scored GROUP BY split)", "v_scored"))
def binary_metrics(v: Views):
    return rounded(E.binary_metrics(v.scored, by=["split"]), *RATES)


@query("AG16", with_views(f"SELECT split, roc_auc FROM ({ranks_sql('v_scored', by='split')})", "v_scored"))
def roc_auc(v: Views):
    return rounded(E.roc_auc(v.scored, by=["split"]), "roc_auc")


@query("AG17", with_views(f"SELECT split, pr_auc FROM ({ranks_sql('v_scored', by='split')})", "v_scored"))
def average_precision(v: Views):
    return rounded(E.average_precision(v.scored, by=["split"]), "pr_auc")


@query("AG16 AG17", with_views(ranks_sql("v_scored", "second_score"), "v_scored"))
def ranking_metrics(v: Views):
    return rounded(E.ranking_metrics(v.scored, score="second_score"), *RANKS)


@query("AG18", with_views("""
SELECT s AS threshold, round(tp / (tp + fp), 6) AS "precision", round(tp / (SELECT count(*) FROM v_scored WHERE alert_flag = 1), 6) AS recall
FROM (SELECT s, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM (
    SELECT second_score AS s, count(*) FILTER (alert_flag = 1) AS pos, count(*) FILTER (alert_flag = 0) AS neg FROM v_scored GROUP BY 1)
  WINDOW w AS (ORDER BY s DESC))""", "v_scored"))
def pr_curve(v: Views):
    return rounded(E.pr_curve(v.scored, score="second_score"), "precision", "recall")


_SWEEP = f"""
SELECT round(t, 2) AS threshold, tp, fp, fn, tn, {_RATES}, r.roc_auc, r.pr_auc
FROM (SELECT t, {{cm}} FROM (SELECT * FROM v_scored {{where}}) CROSS JOIN grid GROUP BY t)
CROSS JOIN ({{ranks}}) r"""


@query("AG19", with_views(
    _SWEEP.format(cm=cm(p="CAST(second_score >= t AS INTEGER)"), where="", ranks=ranks_sql("v_scored", "second_score")),
    "v_scored", extra=grid_sql(0.3, 13)))
def threshold_sweep(v: Views):
    return rounded(E.threshold_sweep(v.scored, score="second_score"), *RATES, *RANKS)


@query("AG19", with_views(
    _SWEEP.format(cm=cm(p="CAST(student_score >= t AS INTEGER)"), where="", ranks=ranks_sql("v_scored")),
    "v_scored", extra=grid_sql(0.1, 17)))
def threshold_sweep_wide(v: Views):
    return rounded(E.threshold_sweep(v.scored, (0.10, 0.05, 17)), *RATES, *RANKS)


@query("AG20", with_views(f"""
SELECT t AS review_threshold, round(a / n, 6) AS coverage, round((n - a) / n, 6) AS review_rate, fp + fn AS auto_errors,
  CASE WHEN a > 0 THEN "precision" END AS auto_precision, CASE WHEN a > 0 THEN recall END AS auto_recall, CASE WHEN a > 0 THEN f1 END AS auto_f1
FROM (SELECT *, {_RATES} FROM (
  SELECT t, count(*) AS n, count(*) FILTER (c) AS a, count(*) FILTER (c AND alert_flag = 1 AND p = 1) AS tp,
    count(*) FILTER (c AND alert_flag = 0 AND p = 1) AS fp, count(*) FILTER (c AND alert_flag = 1 AND p = 0) AS fn,
    count(*) FILTER (c AND alert_flag = 0 AND p = 0) AS tn
  FROM (SELECT t, alert_flag, CAST(second_score >= 0.5 AS INTEGER) AS p, greatest(second_score, 1 - second_score) >= t AS c
    FROM v_scored CROSS JOIN (SELECT unnest([0.55, 0.60, 0.65, 0.70, 0.75, 0.80]::DOUBLE[]) AS t)) GROUP BY t))""", "v_scored"))
def review_zone(v: Views):
    flagged = v.scored.withColumn("p", (F.col("second_score") >= 0.5).cast("int"))
    return rounded(E.review_zone(flagged, pred="p", score="second_score"),
                   "coverage", "review_rate", "auto_precision", "auto_recall", "auto_f1")


@query("AG21", with_views("""
SELECT CAST(b AS INTEGER) AS length_bin, count(*) AS n, CAST(sum(e) AS BIGINT) AS errors, round(avg(e), 6) AS error_rate,
  round(avg(student_score), 6) AS mean_score, q[CAST(b AS INTEGER) + 1] AS low, q[CAST(b AS INTEGER) + 2] AS high
FROM (SELECT student_score, CAST(alert_flag <> student_pred AS INTEGER) AS e, q,
    (text_length > q[2])::INT + (text_length > q[3])::INT + (text_length > q[4])::INT AS b
  FROM v_scored CROSS JOIN (SELECT quantile_cont(text_length::DOUBLE, [0, 0.25, 0.5, 0.75, 1]) AS q FROM v_scored))
GROUP BY b, q""", "v_scored"))
def error_rate_by_quartile(v: Views):
    return rounded(E.error_rate_by_quartile(v.scored), "error_rate", "mean_score")


@query("AG22", with_views("""
SELECT source, count(*) AS n, CAST(sum(CAST(alert_flag <> student_pred AS INTEGER)) AS BIGINT) AS errors,
  round(avg(CAST(alert_flag <> student_pred AS INTEGER)), 6) AS error_rate FROM v_scored GROUP BY source""", "v_scored"))
def error_rate_by_source(v: Views):
    return rounded(E.error_rate_by(v.scored, "source"), "error_rate")


@query("AG23 AG5", with_views("""
SELECT CASE WHEN alert_flag = 0 THEN 'fp' ELSE 'fn' END AS error_kind, risk_type_4cls, count(*) AS "count"
FROM v_scored WHERE alert_flag <> student_pred GROUP BY 1, 2""", "v_scored"))
def error_counts(v: Views):
    return E.error_counts(v.scored)


_ERROR_COLUMNS = ["sample_id", "title", "entity_norm", "text_fragment", "alert_flag", "student_pred", "student_score",
                  "risk_type_4cls", "source", "published_year", "published_month", "text_length"]


@query("AG23", with_views(
    f"SELECT {', '.join(_ERROR_COLUMNS)} FROM v_scored WHERE alert_flag = 1 AND student_pred = 0", "v_scored"))
def false_negatives(v: Views):
    return E.error_sets(v.scored)["fn"].select(*_ERROR_COLUMNS)


@query("AG23", with_views(
    f"SELECT {', '.join(_ERROR_COLUMNS)} FROM v_scored WHERE alert_flag = 0 AND CAST(second_score >= 0.5 AS INTEGER) = 1", "v_scored"))
def false_positives(v: Views):
    flagged = v.scored.withColumn("p", (F.col("second_score") >= 0.5).cast("int"))
    return E.error_sets(flagged, pred="p")["fp"].select(*_ERROR_COLUMNS)


@query("TK5", with_views("""
SELECT sample_id, alert_flag, p, second_score, error_kind FROM (
  SELECT *, row_number() OVER (PARTITION BY error_kind ORDER BY CASE WHEN error_kind = 'fp' THEN -second_score ELSE second_score END, sample_id) AS rn
  FROM (SELECT *, CAST(second_score >= 0.5 AS INTEGER) AS p,
      CASE WHEN alert_flag = 0 AND second_score >= 0.5 THEN 'fp' WHEN alert_flag = 1 AND second_score < 0.5 THEN 'fn' END AS error_kind FROM v_scored)
  WHERE error_kind IS NOT NULL) WHERE rn <= 10""", "v_scored"))
def worst_errors(v: Views):
    flagged = v.scored.select("sample_id", "alert_flag", "second_score", (F.col("second_score") >= 0.5).cast("int").alias("p"))
    return E.worst_errors(flagged, pred="p", score="second_score")


def _class_rows(table: str, y: str, p: str) -> str:
    return f"""
cells AS (SELECT CAST({y} AS VARCHAR) AS y, CAST({p} AS VARCHAR) AS p FROM {table}),
classes AS (SELECT c AS class, (SELECT count(*) FROM cells WHERE y = c AND p = c) AS tp,
    (SELECT count(*) FROM cells WHERE p = c) AS predicted, (SELECT count(*) FROM cells WHERE y = c) AS support
  FROM (SELECT y AS c FROM cells UNION SELECT p FROM cells)),
report AS (SELECT class, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS "precision",
  CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
  CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp / (predicted + support) END AS f1, support FROM classes)"""


_REPORT = """SELECT class, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
SELECT * FROM report UNION ALL
SELECT 'accuracy', NULL, NULL, sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM classes UNION ALL
SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM report UNION ALL
SELECT 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
  CAST(sum(support) AS BIGINT) FROM report)"""


@query("AG24", with_views(_REPORT, "v_scored", extra=_class_rows("v_scored", "alert_flag", "student_pred")))
def classification_report(v: Views):
    return rounded(E.classification_report(v.scored), "precision", "recall", "f1")


@query("AG24 SP14", with_views(_REPORT, "v_scored", extra="guess AS (SELECT risk_type_4cls, CASE WHEN student_pred = 0 THEN 'no_risk' "
       "WHEN text_length % 2 = 0 THEN 'cyber_risk' ELSE 'operational_risk' END AS g FROM v_scored),"
       + _class_rows("guess", "risk_type_4cls", "g")))
def multiclass_report(v: Views):
    guess = F.when(F.col("student_pred") == 0, "no_risk").when(F.col("text_length") % 2 == 0, "cyber_risk").otherwise("operational_risk")
    return rounded(E.classification_report(v.scored.withColumn("g", guess), "risk_type_4cls", "g"), "precision", "recall", "f1")


_PREDS = r"""preds AS (SELECT sample_id, alert_flag,
  coalesce(TRY_CAST(regexp_extract(zero_shot_answer, '\b([01])\b', 1) AS INTEGER), -1) AS zero_shot_pred,
  coalesce(TRY_CAST(regexp_extract(few_shot_answer, '\b([01])\b', 1) AS INTEGER), -1) AS few_shot_pred FROM v_answers)"""


def _preds(v: Views):
    return v.answers.select(
        "sample_id", "alert_flag", N.parse_binary_answer("zero_shot_answer").alias("zero_shot_pred"),
        N.parse_binary_answer("few_shot_answer").alias("few_shot_pred"))


@query("AG25", with_views(" UNION ALL ".join(f"""
SELECT '{m}' AS model, n_total, n_valid, n_total - n_valid AS n_parse_errors, {_RATES}
FROM (SELECT count(*) AS n_total, count(*) FILTER ({c} <> -1) AS n_valid, {cm(p=c)} FROM preds)"""
    for m, c in (("zero shot", "zero_shot_pred"), ("few shot", "few_shot_pred"))), "v_answers", extra=_PREDS))
def answer_metrics(v: Views):
    long = _preds(v).select("alert_flag", F.inline(F.array(
        F.struct(F.lit("zero shot").alias("model"), F.col("zero_shot_pred").alias("pred")),
        F.struct(F.lit("few shot").alias("model"), F.col("few_shot_pred").alias("pred")))))
    return rounded(E.answer_metrics(long, by=["model"]), *RATES)


@query("SP16", with_views("""
SELECT sample_id, 'labeller_false_positive' AS reason FROM preds WHERE alert_flag = 0 AND zero_shot_pred = 1 UNION ALL
SELECT sample_id, 'labeller_false_negative' FROM preds WHERE alert_flag = 1 AND zero_shot_pred = 0 UNION ALL
SELECT sample_id, 'labellers_differ' FROM preds WHERE zero_shot_pred <> few_shot_pred""", "v_answers", extra=_PREDS))
def labeller_disagreement(v: Views):
    return E.labeller_disagreement(_preds(v))


# --- tables of metric rows -----------------------------------------------------------

_RUNS = f"""
long AS (SELECT 'student a' AS model, split AS dataset, alert_flag, student_score AS s FROM v_scored WHERE split <> 'train'
  UNION ALL SELECT 'student b', split, alert_flag, second_score FROM v_scored WHERE split <> 'train'),
{grid_sql(0.3, 13)},
runs AS (SELECT CAST(row_number() OVER (ORDER BY model, dataset, threshold) AS INTEGER) AS row_id, * FROM (
  SELECT model, dataset, round(t, 2) AS threshold, tp, fp, fn, tn, {_RATES}
  FROM (SELECT model, dataset, t, {_CM.format(y='alert_flag', p='CAST(s >= t AS INTEGER)')} FROM long CROSS JOIN grid GROUP BY ALL)))"""
_RUN_COLUMNS = "row_id, model, dataset, threshold, tp, fp, fn, tn, accuracy, \"precision\", recall, f1"


def _long(v: Views):
    rows = v.scored.filter(F.col("split") != "train")
    return rows.select(F.col("split").alias("dataset"), "alert_flag", F.inline(F.array(
        F.struct(F.lit("student a").alias("model"), F.col("student_score").alias("s")),
        F.struct(F.lit("student b").alias("model"), F.col("second_score").alias("s")))))


def _runs(v: Views):
    """Metric rows of two models on two data sets at 13 thresholds: 52 rows at any scale."""
    from pyspark.sql import Window
    rows = rounded(E.threshold_sweep(_long(v), score="s", by=["model", "dataset"], ranking=False), *RATES)
    number = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("model", "dataset", "threshold"))
    return rows.withColumn("row_id", number)


@query("ST1 TX12", with_views(f"SELECT {_RUN_COLUMNS} FROM runs", "v_scored", extra=_RUNS))
def metric_runs(v: Views):
    return _runs(v)


@query("ST1", with_views("""
SELECT 'valid' AS dataset, model, NULL::DOUBLE AS threshold, f1 FROM runs WHERE dataset = 'valid' UNION ALL
SELECT 'test', model, threshold, f1 FROM runs WHERE dataset = 'test'""", "v_scored", extra=_RUNS))
def union_metrics(v: Views):
    runs = _runs(v)
    valid = runs.filter("dataset = 'valid'").select("dataset", "model", "f1")
    return E.union_metrics(runs.filter("dataset = 'test'").select("dataset", "model", "threshold", "f1"), valid)


@query("TK4", with_views(f"""
SELECT {_RUN_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY f1 DESC, recall DESC, "precision" DESC, threshold) AS rn
  FROM runs WHERE dataset = 'valid') WHERE rn = 1""", "v_scored", extra=_RUNS))
def best_grid_row(v: Views):
    return E.best_grid_row(_runs(v).filter("dataset = 'valid'"), ["model"], tie=["threshold"])


@query("TK6", with_views(f"""
SELECT {_RUN_COLUMNS} FROM runs JOIN (SELECT model, arg_max(threshold, (f1, -row_id)) AS best FROM runs WHERE dataset = 'valid' GROUP BY model)
USING (model) WHERE abs(threshold - best) < 1e-6""", "v_scored", extra=_RUNS))
def keep_best_run(v: Views):
    return E.keep_best_run(_runs(v))


@query("TK7", with_views(f"SELECT {_RUN_COLUMNS} FROM runs", "v_scored", extra=_RUNS))
def custom_order(v: Views):
    ranks = {"model": {"student b": 0, "student a": 1}, "dataset": {"valid": 0, "test": 1}}
    return E.custom_order(_runs(v), ranks, ["threshold"])


@query("TK8", with_views("""
SELECT b AS challenger, a AS incumbent, CASE WHEN b >= a THEN 'student b' ELSE 'student a' END AS selected
FROM (SELECT max(f1) FILTER (model = 'student a') AS a, max(f1) FILTER (model = 'student b') AS b FROM runs WHERE dataset = 'valid')""",
    "v_scored", extra=_RUNS))
def prefer_model(v: Views):
    return E.prefer_model(_runs(v).filter("dataset = 'valid'"), "student b", "student a")


@query("ST2", with_views("""
SELECT min(row_id) AS row_id, model, dataset, f1 FROM runs GROUP BY model, dataset, f1""", "v_scored", extra=_RUNS))
def dedupe_metrics(v: Views):
    rows = _runs(v).select("row_id", "model", "dataset", "f1")
    return E.dedupe_metrics(rows, ["model", "dataset", "f1"], "row_id")


@query("ST3", with_views("""
SELECT model, dataset, f1 FROM runs WHERE model = 'student a' UNION ALL SELECT model, dataset, recall FROM runs WHERE model = 'student b'""",
    "v_scored", extra=_RUNS))
def add_if_absent(v: Views):
    runs = _runs(v)
    fallback = runs.select("model", "dataset", F.col("recall").alias("f1"))
    return E.add_if_absent(runs.filter("model = 'student a'").select("model", "dataset", "f1"), fallback)


@query("ST4", with_views("""
SELECT model, dataset, threshold, unnest(['precision', 'recall']) AS metric, unnest(["precision", recall]) AS value FROM runs""",
    "v_scored", extra=_RUNS))
def melt_metrics(v: Views):
    return E.melt_metrics(_runs(v), ["model", "dataset", "threshold"], ["precision", "recall"])


@query("PR27 TX12", with_views("""
SELECT row_id, dataset, model || CASE WHEN threshold = 0.5 THEN ' selected' ELSE ' plain' END AS scheme,
  CASE WHEN threshold = 0.5 THEN 0.65 ELSE 0.5 END::DOUBLE AS threshold, f1 FROM runs WHERE dataset = 'valid'""", "v_scored", extra=_RUNS))
def tag_dataset(v: Views):
    rows = _runs(v).filter("dataset = 'valid'")
    scheme = F.concat("model", F.when(F.col("threshold") == 0.5, " selected").otherwise(" plain"))
    return E.tag_dataset(rows, "valid", scheme, 0.65).select("row_id", "dataset", "scheme", "threshold", "f1")


_SELECTED = f"""
best AS (SELECT model, arg_max(threshold, (f1, recall, "precision", -threshold)) AS best FROM runs WHERE dataset = 'valid' GROUP BY model)
SELECT model, dataset, threshold, tp, fp, fn, tn, accuracy, "precision", recall, f1 FROM runs JOIN best USING (model) WHERE threshold = best"""


@query("TX12 TX11 TK4", with_views(
    _SELECTED.split("\nSELECT", 1)[1].join(["SELECT", ""]), "v_scored", extra=_RUNS + "," + _SELECTED.split("\nSELECT", 1)[0]))
def frozen_threshold_test(v: Views):
    """Threshold chosen on valid only, then applied unchanged to valid and test."""
    long = _long(v)
    sweep = E.threshold_sweep(long.filter("dataset = 'valid'"), score="s", by=["model"], ranking=False)
    chosen = E.best_grid_row(rounded(sweep, *RATES), ["model"], tie=["threshold"]).select("model", "threshold")
    flagged = long.join(F.broadcast(chosen), "model").withColumn(
        "pred", (F.col("s") >= F.col("threshold")).cast("int"))
    return rounded(E.binary_metrics(flagged, pred="pred", by=["model", "dataset", "threshold"]), *RATES)


@query("SP9", with_views("""
SELECT 50 AS k, count(*) AS n, round(avg(alert_flag), 6) AS precision_at_k
FROM (SELECT alert_flag FROM v_scored ORDER BY student_score DESC, sample_id LIMIT 50)""", "v_scored"))
def precision_at_k(v: Views):
    return rounded(E.precision_at_k(v.scored, 50), "precision_at_k")


@query("SP9", with_views(f"""
SELECT entity_norm, tp, fp, fn, tn, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS coverage,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE fp / (tp + fp) END, 6) AS false_alert_rate
FROM (SELECT entity_norm, {cm()} FROM v_scored GROUP BY entity_norm)""", "v_scored"))
def coverage_by_entity(v: Views):
    return rounded(E.coverage_by(v.scored, "entity_norm"), "coverage", "false_alert_rate")


@query("SP7", with_views("""
SELECT batch_id, count(*) AS n_all, count(*) FILTER (alert_flag = 1) AS n_alerts,
  round((count(*) - count(*) FILTER (alert_flag = 1)) / count(*), 6) AS reduction_rate FROM v_predictions GROUP BY batch_id""", "v_predictions"))
def news_reduction_rate(v: Views):
    return rounded(E.news_reduction_rate(v.predictions, by=["batch_id"]), "reduction_rate")


@query("SP8", """
SELECT count(*) AS n, count(*) FILTER (done <= ts + INTERVAL 15 MINUTE) AS in_time,
  round(avg(CAST(coalesce(done <= ts + INTERVAL 15 MINUTE, false) AS INTEGER)), 6) AS sla_share
FROM (SELECT ts, CASE WHEN event_id % 7 <> 0 THEN ts + to_minutes(CAST(event_id % 40 AS INTEGER)) END AS done FROM events WHERE event_type = 'error')""")
def alert_sla(v: Views):
    e = v.table("events").filter("event_type = 'error'")
    i = F.col("event_id")
    done = F.when(i % 7 != 0, F.col("ts") + F.make_dt_interval(mins=(i % 40).cast("int")))
    return rounded(E.alert_sla(e.withColumn("done", done), "ts", "done"), "sla_share")


@query("SP15", with_views(f"""
SELECT metric, value, required, value >= required AS passed FROM (
  SELECT unnest(['precision', 'recall', 'f1']) AS metric, unnest(["precision", recall, f1]) AS value, unnest([0.7, 0.7, 0.8]::DOUBLE[]) AS required
  FROM (SELECT {_RATES} FROM (SELECT {cm()} FROM v_scored)))""", "v_scored"))
def acceptance_gates(v: Views):
    m = rounded(E.binary_metrics(v.scored), "precision", "recall", "f1")
    rows = E.melt_metrics(m, [], ["precision", "recall", "f1"])
    return E.acceptance_gates(rows, {"precision": 0.7, "recall": 0.7, "f1": 0.8})


@query("SP15", """
SELECT source, count(*) AS cards, count(*) FILTER (quality = 1) AS useful, round(count(*) FILTER (quality = 1) / count(*), 6) AS useful_rate,
  count(*) FILTER (quality = 1) / count(*) >= 0.7 AS accepted FROM labels JOIN documents USING (doc_id) GROUP BY source""")
def useful_feedback_rate(v: Views):
    rows = v.table("labels").join(v.table("documents").select("doc_id", "source"), "doc_id")
    return rounded(E.useful_feedback_rate(rows, "quality", ["source"]), "useful_rate")


@query("SP17", with_views(f"""
SELECT tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS "precision",
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1
FROM (SELECT count(*) FILTER (f AND t AND entity_norm = truth) AS tp, count(*) FILTER (f AND NOT (t AND entity_norm = truth)) AS fp,
    count(*) FILTER (t AND NOT (f AND entity_norm = truth)) AS fn
  FROM (SELECT *, entity_norm <> '{UNKNOWN}' AS f, truth <> '{UNKNOWN}' AS t FROM (
    SELECT entity_norm, CASE WHEN id % 5 = 0 THEN 'Northbank' WHEN id % 13 = 0 THEN '{UNKNOWN}' ELSE entity_norm END AS truth FROM v_resolved)))""",
    "v_resolved"))
def entity_match_f1(v: Views):
    i = F.col("id")
    truth = F.when(i % 5 == 0, "Northbank").when(i % 13 == 0, UNKNOWN).otherwise(F.col("entity_norm"))
    return rounded(E.match_metrics(v.resolved.withColumn("truth", truth), "entity_norm", "truth", UNKNOWN), "precision", "recall", "f1")


# --- teacher labels against the data --------------------------------------------------


@query("JN2 PR12", with_views("""
SELECT sample_id, alert_flag, teacher_label, teacher_confidence FROM v_labelled JOIN v_teacher USING (sample_id)
WHERE split = 'train' AND teacher_label IN (0, 1) AND teacher_confidence IS NOT NULL""", "v_labelled", "v_teacher"))
def attach_teacher_strict(v: Views):
    train = v.labelled.filter("split = 'train'").select("sample_id", "alert_flag")
    return TE.attach_teacher(train, v.teacher, "inner")


@query("JN3", with_views("""
SELECT split, count(*) FILTER (teacher_label IN (0, 1) AND teacher_confidence IS NOT NULL) AS n_valid, count(*) AS n_total,
  round(count(*) FILTER (teacher_label IN (0, 1) AND teacher_confidence IS NOT NULL) / count(*), 6) AS coverage
FROM v_labelled LEFT JOIN (SELECT * FROM v_teacher WHERE sample_id % 4 <> 0) USING (sample_id) GROUP BY split""", "v_labelled", "v_teacher"))
def teacher_coverage(v: Views):
    some = v.teacher.filter(F.col("sample_id") % 4 != 0)
    joined = TE.attach_teacher_all(v.labelled.select("sample_id", "split"), some)
    return rounded(TE.teacher_coverage(joined, ["split"]), "coverage")


@query("JN3", with_views("""
SELECT sample_id, alert_flag, teacher_label, teacher_confidence FROM v_labelled LEFT JOIN (SELECT * FROM v_teacher WHERE sample_id % 4 <> 0) USING (sample_id)
WHERE teacher_label IN (0, 1) AND teacher_confidence IS NOT NULL""", "v_labelled", "v_teacher"))
def attach_teacher_left(v: Views):
    some = v.teacher.filter(F.col("sample_id") % 4 != 0)
    return TE.attach_teacher(v.labelled.select("sample_id", "alert_flag"), some, "left")


@query("JN4", with_views("""
SELECT s.sample_id, s.alert_flag, s.student_pred, s.student_score, t.teacher_label AS teacher_label_v1, t.teacher_confidence AS teacher_confidence_v1
FROM v_scored s LEFT JOIN v_teacher t USING (sample_id) WHERE s.alert_flag <> s.student_pred""", "v_scored", "v_teacher"))
def attach_teacher_to_errors(v: Views):
    wrong = v.scored.filter(F.col("alert_flag") != F.col("student_pred")).select(
        "sample_id", "alert_flag", "student_pred", "student_score")
    return TE.attach_teacher_all(wrong, v.teacher, suffix="_v1")


@query("TX7", with_views("""
SELECT sample_id, unnest([1, 0]) AS label, unnest([round(y, 6), round(1 - y, 6)]) AS weight FROM (
  SELECT sample_id, least(greatest((1 - 0.3) * alert_flag + 0.3 * CASE WHEN teacher_label = 1 THEN least(teacher_confidence, 0.9999::DOUBLE) ELSE greatest(1 - teacher_confidence, 0.0001::DOUBLE) END, 0.0001::DOUBLE), 0.9999::DOUBLE) AS y
  FROM v_labelled JOIN v_teacher USING (sample_id) WHERE split = 'train' AND teacher_label IN (0, 1))""", "v_labelled", "v_teacher"))
def expand_soft_rows(v: Views):
    train = v.labelled.filter("split = 'train'").select("sample_id", "alert_flag")
    soft = TE.with_soft_labels(TE.attach_teacher(train, v.teacher, validate=False), 0.3)
    return rounded(TE.expand_soft_rows(soft).select("sample_id", "label", "weight"), "weight")


@query("AG5 PR12", with_views("SELECT teacher_label, count(*) AS \"count\" FROM v_teacher GROUP BY teacher_label", "v_teacher"))
def teacher_label_counts(v: Views):
    from riskloom.operators.profile import value_distribution
    return value_distribution(v.teacher, "teacher_label", dropna=False)
