"""Results, jobs, ledger and subscriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import ledger as G
from riskloom.operators import results as R
from riskloom.operators import scoring as S
from riskloom.plans.adapters import Views
from riskloom.plans.oracle import with_views
from riskloom.plans.registry import query

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_STAMP = "%Y-%m-%d %H:%M:%S.%f"
INSTANT = "2024-01-15 12:00:00"


def stamped(df, *cols):
    return df.withColumns({c: F.date_format(c, STAMP) for c in cols})


def _st(c: str, out: str | None = None) -> str:
    return f"strftime({c}, '{_STAMP}') AS {out or c.split('.')[-1]}"


@query("JN1 TK1", with_views("""
SELECT i.id AS news_item_id, i.batch_id, i.user_id, i.title, i.entity_norm, i.text_fragment, p.risk_score, p.alert_flag, p.model_name, p.threshold
FROM v_resolved i JOIN v_predictions p ON p.news_item_id = i.id ORDER BY risk_score DESC, news_item_id""", "v_resolved", "v_predictions"))
def results_join(v: Views):
    return R.results(v.resolved, v.predictions)


@query("JN1 JN11", with_views("""
SELECT i.id AS news_item_id, i.batch_id, i.user_id, i.title, i.entity_norm, i.text_fragment, p.risk_score, p.alert_flag, p.model_name, p.threshold
FROM v_resolved i JOIN v_predictions p ON p.news_item_id = i.id WHERE i.batch_id = 'src3' AND i.user_id = 3""", "v_resolved", "v_predictions"))
def results_of_batch(v: Views):
    return R.results(v.resolved, v.predictions, "src3", 3)


@query("JN11", with_views("SELECT * FROM v_batches WHERE user_id = 7", "v_batches"))
def owned_batches(v: Views):
    return R.owned(v.batches, 7)


@query("PR25 TK2", with_views("""
SELECT id, id AS batch_id, user_id, original_filename, original_filename AS filename, status, total_items, processed_items,
  strftime(created_at, '%Y-%m-%d %H:%M') AS created_at, coalesce(strftime(processed_at, '%Y-%m-%d %H:%M'), '-') AS processed_at,
  coalesce(error_message, '-') AS error_message FROM v_batches ORDER BY created_at DESC""", "v_batches"))
def job_view(v: Views):
    return R.job_view(v.batches)


@query("TK2", with_views(f"""
SELECT id, user_id, CAST(amount AS DOUBLE) AS amount, transaction_type, {_st('created_at')} FROM v_ledger""", "v_ledger"))
def recent_transactions(v: Views):
    rows = v.ledger.withColumn("amount", F.col("amount").cast("double"))
    return stamped(S.recent_first(rows), "created_at")


@query("TK3", with_views(f"""
SELECT user_id, id, status, {_st('created_at')}, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS rn FROM v_batches) WHERE rn <= 5""", "v_batches"))
def latest_batches(v: Views):
    return stamped(R.latest_n(v.batches, 5), "created_at").select("user_id", "id", "status", "created_at", "rank")


@query("AG29", with_views("""
SELECT b.batch_id, count(i.id) AS total_items, count(p.news_item_id) AS processed_items,
  CASE WHEN count(p.news_item_id) = 0 THEN 'queued' WHEN count(p.news_item_id) < count(i.id) THEN 'processing' ELSE 'completed' END AS status
FROM (SELECT DISTINCT batch_id FROM v_items) b LEFT JOIN v_items i ON i.batch_id = b.batch_id
LEFT JOIN (SELECT * FROM v_predictions WHERE batch_id <> 'src1' AND (batch_id <> 'src2' OR news_item_id % 3 = 0)) p ON p.news_item_id = i.id
GROUP BY b.batch_id""", "v_items", "v_predictions"))
def batch_progress(v: Views):
    partly = v.predictions.filter((F.col("batch_id") != "src1") & ((F.col("batch_id") != "src2") | (F.col("news_item_id") % 3 == 0)))
    return R.batch_progress(v.items.select("batch_id").distinct(), v.items, partly)


@query("SR4", with_views(f"""
SELECT batch_id, status, {_st('ts', 'changed_at')}, CASE WHEN status IN ('completed', 'failed') THEN {_st('closed', 'x').split(' AS ')[0]} END AS processed_at,
  CASE WHEN status = 'failed' THEN error_message END AS error_message, n_events
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY batch_id) AS n_events,
    max(CASE WHEN status IN ('completed', 'failed') THEN ts END) OVER (PARTITION BY batch_id) AS closed FROM v_job_events) WHERE rn = 1""",
    "v_job_events"))
def job_lifecycle(v: Views):
    return stamped(R.job_lifecycle(v.job_events), "changed_at", "processed_at")


@query("SR6", """
SELECT event_id, CASE WHEN event_id % 4 <> 1 AND event_id % 4 <> 2 THEN event_id END AS batch_id,
  CASE WHEN event_id % 4 IN (1, 2) THEN 'message must contain integer batch_id' END AS error FROM events""")
def parse_control_message(v: Views):
    i = F.col("event_id")
    text = i.cast("string")
    body = (
        F.when(i % 4 == 0, F.concat(F.lit('{"batch_id": '), text, F.lit("}")))
        .when(i % 4 == 1, F.concat(F.lit('{"batch_id": "'), text, F.lit('"}')))
        .when(i % 4 == 2, F.concat(F.lit("batch "), text))
        .otherwise(F.concat(F.lit('{"kind": "score", "batch_id": '), text, F.lit(', "retry": 0}'))))
    return R.parse_control_message(v.table("events").select("event_id", body.alias("body"))).drop("body")


@query("PR28", f"""
SELECT event_id, user_id, 'Базовый' AS plan_name, {_st('ts', 'starts_at')}, {_st('ts + INTERVAL 30 DAY', 'ends_at')}
FROM events WHERE event_type = 'purchase'""")
def subscription_period(v: Views):
    bought = v.table("events").filter("event_type = 'purchase'")
    return stamped(G.subscription_period(bought, at="ts"), "starts_at", "ends_at").select(
        "event_id", "user_id", "plan_name", "starts_at", "ends_at")


@query("AG27", with_views("""
SELECT user_id, CAST(sum(amount) AS DOUBLE) AS balance, count(*) AS transactions,
  count(*) FILTER (transaction_type = 'subscription_purchase') AS purchases FROM v_ledger
WHERE NOT (transaction_type = 'top_up' AND amount <= 0) GROUP BY user_id""", "v_ledger"))
def ledger_balance(v: Views):
    return G.ledger_balance(G.ledger_rows(v.ledger))


@query("AG27", with_views("""
SELECT id, user_id, CAST(sum(amount) OVER (PARTITION BY user_id ORDER BY created_at, id) AS DOUBLE) AS balance_after FROM v_ledger""", "v_ledger"))
def running_balance(v: Views):
    return G.running_balance(v.ledger).select("id", "user_id", F.col("balance_after").cast("double").alias("balance_after"))


@query("AG27", with_views("""
SELECT id, user_id, CAST(b - amount AS DOUBLE) AS balance_before FROM (
  SELECT *, sum(amount) OVER (PARTITION BY user_id ORDER BY created_at, id) AS b FROM v_ledger)
WHERE transaction_type = 'subscription_purchase' AND b - amount < -amount""", "v_ledger"))
def overdrawn_purchases(v: Views):
    return G.overdrawn_purchases(v.ledger).select("id", "user_id", F.col("balance_before").cast("double").alias("balance_before"))


@query("JN9", with_views("""
SELECT u.user_id, u.id, EXISTS (SELECT 1 FROM v_subscriptions s WHERE s.user_id = u.user_id AND s.starts_at <= u.created_at
  AND s.ends_at >= u.created_at) AS entitled FROM v_uploads u""", "v_uploads", "v_subscriptions"))
def entitled_uploads(v: Views):
    return G.entitled_uploads(v.uploads, v.subscriptions).drop("created_at")


@query("JN10", with_views(f"""
SELECT u.user_id, u.id, m.sub AS subscription_id, {_st('m.e', 'ends_at')} FROM v_uploads u LEFT JOIN (
  SELECT u.id, arg_max(s.id, (s.ends_at, s.starts_at, s.id)) AS sub, max(s.ends_at) AS e FROM v_uploads u JOIN v_subscriptions s
    ON s.user_id = u.user_id AND s.starts_at <= u.created_at AND s.ends_at >= u.created_at GROUP BY u.id) m ON m.id = u.id""",
    "v_uploads", "v_subscriptions"))
def active_subscription_asof(v: Views):
    out = G.active_subscription_asof(v.uploads, v.subscriptions, at="created_at")
    return stamped(out, "ends_at").select("user_id", "id", "subscription_id", "ends_at")


@query("AG26 JN10 TK3", with_views(f"""
SELECT b.user_id, b.n AS batch_count, coalesce(p.n, 0) AS processed_news, l.ids AS latest_batches, {_st('s.e', 'active_until')}
FROM (SELECT user_id, count(*) AS n FROM v_batches GROUP BY user_id) b
LEFT JOIN (SELECT user_id, count(*) AS n FROM v_predictions GROUP BY user_id) p ON p.user_id = b.user_id
LEFT JOIN (SELECT user_id, string_agg(id, ',' ORDER BY rn) AS ids FROM (
  SELECT user_id, id, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, id DESC) AS rn FROM v_batches) WHERE rn <= 5 GROUP BY user_id) l
  ON l.user_id = b.user_id
LEFT JOIN (SELECT user_id, max(ends_at) AS e FROM v_subscriptions WHERE starts_at <= TIMESTAMP '{INSTANT}' AND ends_at >= TIMESTAMP '{INSTANT}' GROUP BY user_id) s
  ON s.user_id = b.user_id""", "v_batches", "v_predictions", "v_subscriptions"))
def user_dashboard(v: Views):
    out = G.user_dashboard(v.batches, v.predictions, v.subscriptions, F.lit(INSTANT).cast("timestamp_ntz"))
    return stamped(out, "active_until")


@query("SP6", with_views("""
SELECT news_item_id, entity_norm, risk_score, CAST(day AS VARCHAR) AS day, CAST(rn AS INTEGER) AS rank FROM (
  SELECT id AS news_item_id, entity_norm, risk_score, CAST(published_at AS DATE) AS day,
    row_number() OVER (PARTITION BY published_at, entity_norm ORDER BY risk_score DESC, id) AS rn
  FROM v_scored_items WHERE alert_flag = 1 AND published_at >= '2002-06-01' AND published_at < '2004-06-01') WHERE rn <= 3""", "v_scored_items"))
def daily_digest(v: Views):
    rows = v.scored_items.withColumn("at", F.col("published_at").cast("date")).withColumnRenamed("id", "news_item_id")
    out = R.digest_of_day(rows, "at", 3, since="2002-06-01", until="2004-06-01")
    return out.select("news_item_id", "entity_norm", "risk_score", F.col("day").cast("string").alias("day"), "rank")
