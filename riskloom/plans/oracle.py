"""The adapter views as SQL, for the independent check."""

from __future__ import annotations

from riskloom.constants import ALERT_THRESHOLD, BASE_SCORE, KEYWORD_MODEL, MAX_SCORE, UNKNOWN_ENTITY
from riskloom.plans.adapters import ALIASES, FAMILIES, STATUS_OF, WEIGHTS


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) for x in r) + ")" for r in rows)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SPACE = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]"
NOT_SPACE = r"[^\s\p{Z}\x0B\x1C-\x1F\x{85}]"
WORD = r"[\p{L}\p{N}_]{2,}"


def _labelled(split_on: str) -> str:
    return f"""
SELECT r.id AS sample_id, md5(r.title) AS event_group_id,
  CASE WHEN ('0x' || substr({split_on}, 1, 7))::BIGINT % 20 < 14 THEN 'train'
       WHEN ('0x' || substr({split_on}, 1, 7))::BIGINT % 20 < 17 THEN 'valid' ELSE 'test' END AS split,
  r.text_fragment, r.title, r.entity_norm, k.found_risk_keywords, r.source,
  CAST(year(CAST(r.published_at AS DATE)) AS INTEGER) AS published_year,
  CAST(month(CAST(r.published_at AS DATE)) AS INTEGER) AS published_month,
  l.toxic AS alert_flag,
  CASE WHEN l.toxic = 0 THEN 'no_risk' WHEN l.quality = 0 THEN 'cyber_risk' ELSE 'operational_risk' END AS risk_type_4cls
FROM v_resolved r JOIN labels l ON l.doc_id = r.id JOIN v_keywords k ON k.id = r.id"""


_TEXTS = """
SELECT r.id AS sample_id, r.title, r.entity_norm, r.text_fragment,
  CASE WHEN ('0x' || substr(md5(md5(r.title)), 1, 7))::BIGINT % 20 < 14 THEN 'train'
       WHEN ('0x' || substr(md5(md5(r.title)), 1, 7))::BIGINT % 20 < 17 THEN 'valid' ELSE 'test' END AS split
FROM v_resolved r"""

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "aliases(entity, alias, rnk)": ((), "VALUES " + _values(
        (_q(e), _q(a), i) for i, (e, xs) in enumerate(ALIASES.items()) for a in xs)),
    "terms(term, weight, ord)": ((), "VALUES " + _values(
        (_q(t), f"CAST({w} AS DECIMAL(6,2))", i) for i, (t, w) in enumerate(WEIGHTS.items()))),
    "families(family, term, ord)": ((), "VALUES " + _values(
        (_q(f), _q(t), i) for i, (f, ts) in enumerate(FAMILIES.items()) for t in ts)),
    "v_items": ((), """
SELECT doc_id AS id, source AS batch_id, doc_id % 10 AS user_id, source, CAST(NULL AS VARCHAR) AS url,
  strftime(DATE '2002-01-01' + CAST(doc_id % 6800 AS INTEGER), '%Y-%m-%d') AS published_at,
  split_part(text, chr(10), 1) AS title, text AS text_fragment, CAST(NULL AS VARCHAR) AS entity_norm
FROM documents"""),
    "v_matched": (("aliases", "v_items"), """
SELECT id, entity FROM (
  SELECT i.id, a.entity, row_number() OVER (
    PARTITION BY i.id ORDER BY strpos(lower(i.title || ' ' || i.text_fragment), a.alias), a.rnk) AS rn
  FROM v_items i JOIN aliases a ON contains(lower(i.title || ' ' || i.text_fragment), a.alias)) WHERE rn = 1"""),
    "v_resolved": (("v_items", "v_matched"), f"""
SELECT i.* REPLACE (coalesce(m.entity, {_q(UNKNOWN_ENTITY)}) AS entity_norm)
FROM v_items i LEFT JOIN v_matched m ON m.id = i.id"""),
    "v_keywords": (("v_items", "terms"), """
SELECT i.id, coalesce(string_agg(t.term, ';' ORDER BY t.ord), '') AS found_risk_keywords
FROM v_items i LEFT JOIN terms t ON contains(lower(i.title || ' ' || i.text_fragment), t.term) GROUP BY i.id"""),
    "v_scored_items": (("v_resolved", "terms"), f"""
SELECT r.*, s.score, s.score AS risk_score, CAST(s.score >= {ALERT_THRESHOLD} AS INTEGER) AS alert_flag,
  CAST({ALERT_THRESHOLD} AS DOUBLE) AS threshold, {_q(KEYWORD_MODEL)} AS model_name
FROM v_resolved r JOIN (
  SELECT r2.id, CAST(least({MAX_SCORE}, {BASE_SCORE} + coalesce(sum(t.weight), 0)) AS DOUBLE) AS score
  FROM v_resolved r2 LEFT JOIN terms t
    ON contains(lower(r2.title || chr(10) || r2.entity_norm || chr(10) || r2.text_fragment), t.term)
  GROUP BY r2.id) s ON s.id = r.id"""),
    "v_predictions": (("v_scored_items",), """
SELECT id AS news_item_id, batch_id, user_id, risk_score, alert_flag, model_name, threshold FROM v_scored_items"""),
    "v_labelled": (("v_resolved", "v_keywords"), _labelled("md5(md5(r.title))")),
    "v_labelled_leaky": (("v_resolved", "v_keywords"), _labelled("md5(CAST(r.id AS VARCHAR))")),
    "v_texts": (("v_resolved",), _TEXTS),
    "v_teacher": ((), """
SELECT doc_id AS sample_id,
  CAST(CASE WHEN doc_id % 37 = 0 THEN -1 WHEN doc_id % 10 = 0 THEN 1 - toxic ELSE toxic END AS INTEGER) AS teacher_label,
  CASE WHEN doc_id % 37 <> 0 THEN (55 + (doc_id % 9) * 5) / CAST(100 AS DOUBLE) END AS teacher_confidence
FROM labels"""),
    "v_teacher_raw": ((), """
SELECT doc_id AS sample_id,
  CASE WHEN doc_id % 37 = 0 THEN 'no answer {label'
       WHEN doc_id % 5 = 0 THEN 'Answer:' || chr(10) || body || chr(10) || 'Done.' ELSE body END AS raw
FROM (SELECT doc_id, '{"label": ' ||
    CASE WHEN doc_id % 43 = 0 THEN '2' WHEN doc_id % 41 = 0 THEN lab || '.7' WHEN doc_id % 7 = 0 THEN '"' || lab || '"' ELSE lab END ||
    ', "confidence": ' || CASE WHEN doc_id % 47 = 0 THEN '"high"' ELSE '0.' || CAST(55 + (doc_id % 9) * 5 AS VARCHAR) END || '}' AS body
  FROM (SELECT doc_id, CAST(CASE WHEN doc_id % 10 = 0 THEN 1 - toxic ELSE toxic END AS VARCHAR) AS lab FROM labels))"""),
    "v_scored": (("v_labelled", "v_predictions"), """
SELECT l.*, p.risk_score AS student_score, p.alert_flag AS student_pred,
  CAST(length(l.text_fragment) AS INTEGER) AS text_length,
  round((l.alert_flag * 20 + length(l.text_fragment) % 97) / CAST(120 AS DOUBLE), 6) AS second_score
FROM v_labelled l JOIN v_predictions p ON p.news_item_id = l.sample_id"""),
    "v_ledger": ((), """
SELECT event_id AS id, user_id,
  CASE WHEN event_type = 'purchase' THEN -CAST(value AS DECIMAL(20,2)) ELSE CAST(value AS DECIMAL(20,2)) END AS amount,
  CASE WHEN event_type = 'purchase' THEN 'subscription_purchase' ELSE 'top_up' END AS transaction_type, ts AS created_at
FROM events WHERE event_type IN ('signup', 'purchase')"""),
    "v_subscriptions": ((), """
SELECT event_id AS id, user_id, ts AS starts_at, ts + INTERVAL 1 DAY AS ends_at FROM events WHERE event_type = 'purchase'"""),
    "v_uploads": ((), "SELECT event_id AS id, user_id, ts AS created_at FROM events WHERE event_type = 'click'"),
    "v_job_events": ((), "SELECT user_id AS batch_id, event_id, ts, CASE event_type "
        + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in STATUS_OF.items())
        + " END AS status, CASE WHEN event_type = 'error' THEN 'error ' || event_id END AS error_message FROM events"),
    "v_batches": ((), """
SELECT event_id AS id, user_id, 'news_' || event_id || '.csv' AS original_filename,
  CASE event_id % 3 WHEN 0 THEN 'queued' WHEN 1 THEN 'completed' ELSE 'failed' END AS status,
  event_id % 50 + 1 AS total_items, CASE WHEN event_id % 3 = 1 THEN event_id % 50 + 1 ELSE 0 END AS processed_items,
  ts AS created_at,
  CASE WHEN event_id % 3 <> 0 THEN ts + to_minutes(CAST(event_id % 30 AS INTEGER)) END AS processed_at,
  CASE WHEN event_id % 3 = 2 THEN 'scoring failed' END AS error_message
FROM events WHERE event_type = 'click'"""),
    "v_answers": ((), """
SELECT doc_id AS sample_id, toxic AS alert_flag,
  CASE WHEN doc_id % 11 = 0 THEN 'cannot say'
       ELSE 'Answer: ' || CAST(CASE WHEN doc_id % 8 = 0 THEN 1 - toxic ELSE toxic END AS VARCHAR) || '.' END AS zero_shot_answer,
  CASE WHEN doc_id % 13 = 0 THEN '10 out of 10'
       ELSE CAST(CASE WHEN doc_id % 6 = 0 THEN 1 - toxic ELSE toxic END AS VARCHAR) END AS few_shot_answer
FROM labels"""),
}


def with_views(final: str, *needs: str, extra: str = "") -> str:
    """The query ``final`` with every view it needs, in order of dependency.

    ``extra`` are further common table expressions, separated by commas.
    """
    by_name = {k.split("(")[0]: (k, deps, body) for k, (deps, body) in VIEWS.items()}
    order: list[str] = []

    def visit(name: str) -> None:
        for d in by_name[name][1]:
            visit(d)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    parts = [f"{by_name[n][0]} AS ({by_name[n][2].strip()})" for n in order]
    if extra:
        parts.append(extra.strip())
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final.strip()
