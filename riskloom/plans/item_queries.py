"""Items, entities, scores, teacher labels: projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import numbers as N
from riskloom.functions import text as T
from riskloom.operators import items as I
from riskloom.operators import scoring as S
from riskloom.operators import teacher as TE
from riskloom.plans.adapters import ALIASES, FAMILIES, TEAMS, UNKNOWN, WEIGHTS, Views
from riskloom.plans.oracle import NOT_SPACE, SPACE, with_views
from riskloom.plans.registry import query
from riskloom.sources.csv_files import align_optional_columns, null_tokens, results_table, split_valid_rejected

PROMPT = "Is there a risk for the bank? Answer as JSON.\n\nText:\n{text}\n"


@query("PR6 PR7 PR1 PR9 PR10 TK1", with_views(
    "SELECT news_item_id, batch_id, user_id, title, entity_norm, risk_score, alert_flag, model_name, threshold FROM "
    "(SELECT id AS news_item_id, * FROM v_scored_items) ORDER BY risk_score DESC, news_item_id", "v_scored_items"))
def risk_scoring(v: Views):
    """Flagship: raw items to ranked risk results."""
    scored = v.scored_items.withColumnRenamed("id", "news_item_id")
    return S.rank_by_risk(scored.select(
        "news_item_id", "batch_id", "user_id", "title", "entity_norm", "risk_score", "alert_flag", "model_name", "threshold"))


@query("IO2", with_views(
    "SELECT event_id, CASE WHEN event_type NOT IN ('null', 'NA', 'error') THEN event_type END AS event_type, "
    "CASE WHEN props NOT IN ('null', 'NA', 'error') THEN props END AS props FROM events"))
def null_token_cleaning(v: Views):
    df = v.table("events").select("event_id", "event_type", "props")
    return null_tokens(df, tokens=["null", "NA", "error"])


@query("IO4", with_views(
    "SELECT title, text_fragment, source, url, published_at, entity_norm FROM v_items", "v_items"))
def aligned_columns(v: Views):
    return align_optional_columns(v.items.drop("url", "entity_norm").withColumn("extra", F.lit(1)))


# Some titles and texts are blanked by a rule, so that there are rejects.
_BLANKED = """v_blanked AS (SELECT id, CASE WHEN id % 17 = 0 THEN NULL WHEN id % 19 = 0 THEN chr(9) || ' ' ELSE title END AS title,
 CASE WHEN id % 23 = 0 THEN '' ELSE text_fragment END AS text_fragment FROM v_items)"""


def _blanked(v: Views):
    i = F.col("id")
    return v.items.select(
        "id", F.when(i % 17 == 0, None).when(i % 19 == 0, "\t ").otherwise(F.col("title")).alias("title"),
        F.when(i % 23 == 0, "").otherwise(F.col("text_fragment")).alias("text_fragment"))


@query("IO5", with_views(f"""
SELECT id, concat_ws(';', CASE WHEN NOT regexp_matches(coalesce(title, ''), '{NOT_SPACE}') THEN 'title' END,
  CASE WHEN NOT regexp_matches(coalesce(text_fragment, ''), '{NOT_SPACE}') THEN 'text_fragment' END) AS reject_reason
FROM v_blanked
WHERE NOT regexp_matches(coalesce(title, ''), '{NOT_SPACE}') OR NOT regexp_matches(coalesce(text_fragment, ''), '{NOT_SPACE}')""",
    "v_items", extra=_BLANKED))
def rejected_rows(v: Views):
    return split_valid_rejected(_blanked(v))[1].select("id", "reject_reason")


@query("IO5", with_views(f"""
SELECT id, title, text_fragment FROM v_blanked
WHERE regexp_matches(coalesce(title, ''), '{NOT_SPACE}') AND regexp_matches(coalesce(text_fragment, ''), '{NOT_SPACE}')""",
    "v_items", extra=_BLANKED))
def valid_rows(v: Views):
    return split_valid_rejected(_blanked(v))[0]


@query("IO7", with_views(
    "SELECT title, entity_norm, text_fragment, risk_score, alert_flag, model_name, threshold FROM v_scored_items",
    "v_scored_items"))
def results_export(v: Views):
    return results_table(v.scored_items.withColumnRenamed("id", "news_item_id"))


@query("PR1", with_views(
    "SELECT id, title || chr(10) || entity_norm || chr(10) || text_fragment AS model_text FROM v_resolved", "v_resolved"))
def model_text(v: Views):
    return v.resolved.select("id", T.model_text().alias("model_text"))


@query("PR2", with_views(
    "SELECT id, title || ' ' || text_fragment || ' ' || entity_norm AS model_text FROM v_resolved", "v_resolved"))
def model_text_spaced(v: Views):
    return v.resolved.select("id", T.model_text_spaced().alias("model_text"))


@query("PR3", with_views(
    "SELECT id, replace(lower(title || ' ' || text_fragment), 'ё', 'е') AS compare_text FROM v_items", "v_items"))
def compare_text(v: Views):
    return v.items.select("id", T.compare_text(T.title_and_fragment()).alias("compare_text"))


@query("PR4", with_views(f"""
SELECT id, CAST(length(title) AS INTEGER) AS title_chars, CAST(length(text_fragment) AS INTEGER) AS text_fragment_chars,
  CAST(len(regexp_extract_all(title, '{NOT_SPACE}+')) AS INTEGER) AS title_words,
  CAST(len(regexp_extract_all(text_fragment, '{NOT_SPACE}+')) AS INTEGER) AS text_fragment_words
FROM v_items""", "v_items"))
def text_lengths(v: Views):
    return I.text_lengths(v.items).select("id", "title_chars", "text_fragment_chars", "title_words", "text_fragment_words")


@query("PR5", with_views("""
SELECT sample_id, array_to_string(list_sort(list_filter(string_split(found_risk_keywords, ';'), lambda x: trim(x) <> '')), '|') AS keywords,
  CAST(len(list_filter(string_split(found_risk_keywords, ';'), lambda x: trim(x) <> '')) AS INTEGER) AS keyword_count
FROM v_labelled""", "v_labelled"))
def keyword_lists(v: Views):
    return v.labelled.select(
        "sample_id", F.array_join(F.array_sort(T.keyword_array("found_risk_keywords")), "|").alias("keywords"),
        T.keyword_count("found_risk_keywords").alias("keyword_count"))


@query("PR6", with_views(
    "SELECT i.id, m.entity AS entity_match FROM v_items i LEFT JOIN v_matched m ON m.id = i.id", "v_matched"))
def match_entity(v: Views):
    return I.match_entity(v.items, ALIASES).select("id", "entity_match")


@query("PR7", with_views(f"""
SELECT i.id, coalesce(nullif(trim(CASE WHEN i.id % 6 = 0 THEN '  Givenbank ' WHEN i.id % 6 = 1 THEN '  ' END), ''), m.entity, '{UNKNOWN}') AS entity_norm
FROM v_items i LEFT JOIN v_matched m ON m.id = i.id""", "v_matched"))
def resolve_entity(v: Views):
    given = F.when(F.col("id") % 6 == 0, "  Givenbank ").when(F.col("id") % 6 == 1, "  ")
    return I.resolve_entity(v.items.withColumn("entity_norm", given), ALIASES).select("id", "entity_norm")


@query("PR8", with_views("""
SELECT id, batch_id, user_id, nullif(CASE WHEN id % 4 = 0 THEN '' ELSE source END, '') AS source, url, published_at,
  title, text_fragment, entity_norm FROM v_resolved""", "v_resolved"))
def normalise_items(v: Views):
    blanked = v.resolved.withColumn("source", F.when(F.col("id") % 4 == 0, "").otherwise(F.col("source")))
    return I.normalise_items(blanked)


@query("PR9", with_views("SELECT id, score FROM v_scored_items", "v_scored_items"))
def keyword_risk_score(v: Views):
    return S.keyword_risk_score(v.resolved, WEIGHTS).select("id", "score")


@query("PR10", with_views(
    "SELECT news_item_id, batch_id, user_id, risk_score, alert_flag, model_name, threshold FROM v_predictions",
    "v_predictions"))
def apply_threshold(v: Views):
    return v.predictions


@query("PR11", with_views("SELECT sample_id, split, alert_flag FROM v_labelled WHERE split = 'valid'", "v_labelled"))
def split_filter(v: Views):
    return v.labelled.filter(F.col("split") == "valid").select("sample_id", "split", "alert_flag")


@query("PR12", with_views(
    "SELECT * FROM v_teacher WHERE teacher_label IN (0, 1) AND teacher_confidence IS NOT NULL", "v_teacher"))
def valid_teacher_rows(v: Views):
    return TE.valid_teacher_rows(v.teacher)


_SOFT = "CASE WHEN teacher_label = 1 THEN teacher_confidence ELSE 1 - teacher_confidence END"


@query("PR13", with_views(f"""
SELECT sample_id, round(least(greatest({_SOFT}, 0.0001::DOUBLE), 0.9999::DOUBLE), 6) AS teacher_soft_y,
  round(least(greatest({_SOFT}, 0::DOUBLE), 1::DOUBLE), 6) AS soft_y_unit
FROM v_teacher WHERE teacher_label IN (0, 1) AND teacher_confidence IS NOT NULL""", "v_teacher"))
def teacher_soft_label(v: Views):
    return TE.valid_teacher_rows(v.teacher).select(
        "sample_id", F.round(N.teacher_soft_label(), 6).alias("teacher_soft_y"),
        F.round(N.teacher_soft_label(floor=0.0), 6).alias("soft_y_unit"))


@query("PR14 JN2", with_views(f"""
SELECT l.sample_id, l.alert_flag, round(least(greatest(0.5 * l.alert_flag + 0.5 * {_SOFT}, 0.0001::DOUBLE), 0.9999::DOUBLE), 6) AS soft_y
FROM v_labelled l JOIN v_teacher t ON t.sample_id = l.sample_id
WHERE teacher_label IN (0, 1) AND teacher_confidence IS NOT NULL AND split = 'train'""", "v_labelled", "v_teacher"))
def blend_soft_label(v: Views):
    train = v.labelled.filter(F.col("split") == "train").select("sample_id", "alert_flag")
    joined = TE.attach_teacher(train, v.teacher, validate=False)
    return TE.with_soft_labels(joined, 0.5).select("sample_id", "alert_flag", F.round("soft_y", 6).alias("soft_y"))


@query("PR15", with_views("""
SELECT sample_id, CASE WHEN why = 'ok' THEN lab ELSE -1 END AS teacher_label,
  CASE WHEN why = 'ok' THEN least(greatest(conf, 0), 1) END AS teacher_confidence, why AS teacher_reason
FROM (SELECT *, CASE WHEN j IS NULL THEN 'no json' WHEN lab IS NULL OR lab NOT IN (0, 1) THEN 'bad label' WHEN conf IS NULL THEN 'bad confidence' ELSE 'ok' END AS why
  FROM (SELECT sample_id, j, CAST(trunc(TRY_CAST(j->>'label' AS DOUBLE)) AS INTEGER) AS lab, TRY_CAST(j->>'confidence' AS DOUBLE) AS conf
    FROM (SELECT sample_id, TRY_CAST(nullif(regexp_extract(raw, '\\{.*\\}', 0, 's'), '') AS JSON) AS j FROM v_teacher_raw)))""",
    "v_teacher_raw"))
def parse_teacher_json(v: Views):
    return TE.parse_teacher_json(v.teacher_raw).select("sample_id", "teacher_label", "teacher_confidence", "teacher_reason")


@query("PR16", with_views(r"""
SELECT sample_id, coalesce(TRY_CAST(regexp_extract(zero_shot_answer, '\b([01])\b', 1) AS INTEGER), -1) AS zero_shot_pred,
  coalesce(TRY_CAST(regexp_extract(few_shot_answer, '\b([01])\b', 1) AS INTEGER), -1) AS few_shot_pred
FROM v_answers""", "v_answers"))
def parse_binary_answer(v: Views):
    return v.answers.select(
        "sample_id", N.parse_binary_answer("zero_shot_answer").alias("zero_shot_pred"),
        N.parse_binary_answer("few_shot_answer").alias("few_shot_pred"))


_PROMPT_SQL = "'" + PROMPT.replace("{text}", "' || x || '") + "'"


@query("PR17", with_views(f"""
SELECT sample_id, {_PROMPT_SQL} AS prompt
FROM (SELECT sample_id, title || chr(10) || entity_norm || chr(10) || text_fragment AS x FROM v_labelled)""", "v_labelled"))
def build_prompts(v: Views):
    return TE.build_prompts(v.labelled, PROMPT, T.model_text())


@query("PR18", with_views(
    "SELECT sample_id, teacher_label, teacher_confidence, 'v1' AS teacher_prompt_version, '' AS teacher_response_raw, "
    "'' AS teacher_reason FROM v_teacher", "v_teacher"))
def normalise_teacher_schema(v: Views):
    raw = v.teacher.withColumnsRenamed({"teacher_label": "label", "teacher_confidence": "confidence"})
    return TE.normalise_teacher_schema(raw, "v1")


@query("PR19", """
SELECT vec_id, round(1 / (1 + exp(-(CAST(embedding[2] AS DOUBLE) - CAST(embedding[1] AS DOUBLE)))), 6) AS two_logits,
  round(1 / (1 + exp(-CAST(embedding[1] AS DOUBLE))), 6) AS one_logit FROM embeddings""")
def positive_score(v: Views):
    e = F.col("embedding").cast("array<double>")
    return v.table("embeddings").select(
        "vec_id", F.round(N.positive_score(F.slice(e, 1, 2)), 6).alias("two_logits"),
        F.round(N.positive_score(F.slice(e, 1, 1)), 6).alias("one_logit"))


@query("PR20", with_views(
    "SELECT news_item_id, round(greatest(risk_score, 1 - risk_score), 6) AS confidence FROM v_predictions", "v_predictions"))
def confidence(v: Views):
    return v.predictions.select("news_item_id", F.round(N.confidence("risk_score"), 6).alias("confidence"))


@query("PR22", """
SELECT doc_id, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' ELSE lang END AS lang FROM documents""")
def display_name(v: Views):
    return v.table("documents").select("doc_id", N.display_name("lang", {"en": "English", "fr": "French"}).alias("lang"))


@query("PR23", with_views("""
SELECT id AS news_item_id, title, entity_norm, substr(text_fragment, 1, 350) AS preview, length(text_fragment) > 350 AS has_more,
  printf('%.3f', risk_score) AS score_text, CASE WHEN alert_flag = 1 THEN 'risk' ELSE 'no risk' END AS label_text
FROM v_scored_items""", "v_scored_items"))
def result_card(v: Views):
    return I.result_card(v.scored_items.withColumnRenamed("id", "news_item_id"))


@query("PR24", with_views(
    "SELECT batch_id, count(*) AS total, count(*) FILTER (alert_flag = 1) AS alerts, count(*) FILTER (alert_flag = 1) AS shown "
    "FROM v_predictions GROUP BY batch_id", "v_predictions"))
def alert_totals(v: Views):
    return I.alert_totals(v.predictions, ["batch_id"], alerts_only=True)


@query("PR24", with_views("SELECT * FROM v_predictions WHERE alert_flag = 1", "v_predictions"))
def only_alerts(v: Views):
    return I.only_alerts(v.predictions)


@query("PR26", """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END AS DOUBLE) AS number,
  coalesce(abs(value - (value + (event_id % 3) * 0.000004::DOUBLE)) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(value + (event_id % 3) * 0.000004::DOUBLE), false) AS close
FROM events""")
def numeric_coercion(v: Views):
    i, x = F.col("event_id"), F.col("value")
    return v.table("events").select(
        "event_id", N.numeric_or_null(F.when(i % 5 == 0, "n/a").otherwise(i.cast("string"))).alias("number"),
        N.is_close(x, x + (i % 3) * F.lit(0.000004)).alias("close"))


@query("SP18", with_views("""
SELECT id, CAST(year(CAST(published_at AS DATE)) AS INTEGER) AS published_year, CAST(month(CAST(published_at AS DATE)) AS INTEGER) AS published_month
FROM v_items""", "v_items"))
def publication_parts(v: Views):
    return I.publication_parts(v.items).select("id", "published_year", "published_month")


@query("SP2", with_views("SELECT id, found_risk_keywords FROM v_keywords", "v_keywords"))
def find_risk_keywords(v: Views):
    return S.find_risk_keywords(v.items, list(WEIGHTS), T.title_and_fragment()).select("id", "found_risk_keywords")


_RISK_TYPE = """v_typed AS (
SELECT k.id, k.found_risk_keywords, coalesce(min_by(f.family, f.ord), 'no_risk') AS risk_type
FROM v_keywords k LEFT JOIN families f ON list_contains(string_split(k.found_risk_keywords, ';'), f.term) GROUP BY ALL)"""


@query("SP3", with_views("SELECT id, risk_type FROM v_typed", "v_keywords", "families", extra=_RISK_TYPE))
def classify_risk_type(v: Views):
    found = S.find_risk_keywords(v.items, list(WEIGHTS), T.title_and_fragment())
    return S.classify_risk_type(found, FAMILIES).select("id", "risk_type")


FACTORS = {"model": 0.5, "entity": 0.2, "negativity": 0.2, "source_trust": 0.1}


@query("SP4", with_views("""
SELECT id, round(least(greatest(0.5 * score + 0.2 * (entity_norm <> 'Не определено')::INT + 0.2 * (score > 0.12)::INT
  + 0.1 * (id % 10) / 10.0, 0), 1)::DOUBLE, 6) AS risk_score_v1
FROM v_scored_items""", "v_scored_items"))
def explainable_risk_score(v: Views):
    factors = v.scored_items.withColumns({
        "model": F.col("score"), "entity": (F.col("entity_norm") != UNKNOWN).cast("double"),
        "negativity": (F.col("score") > 0.12).cast("double"), "source_trust": (F.col("id") % 10) / 10.0})
    return S.explainable_risk_score(factors, FACTORS).select("id", F.round("risk_score_v1", 6).alias("risk_score_v1"))


@query("SP5", with_views("""
SELECT s.id AS news_item_id, s.entity_norm, t.risk_type, s.risk_score, replace(t.found_risk_keywords, ';', ',') AS reasons,
  CASE t.risk_type WHEN 'cyber_risk' THEN 'security' WHEN 'operational_risk' THEN 'operations' ELSE 'monitoring' END AS team
FROM v_scored_items s JOIN v_typed t ON t.id = s.id WHERE s.alert_flag = 1""",
    "v_scored_items", "v_keywords", "families", extra=_RISK_TYPE))
def alert_card(v: Views):
    found = S.find_risk_keywords(v.scored_items, list(WEIGHTS), T.title_and_fragment())
    typed = S.classify_risk_type(found, FAMILIES).withColumnRenamed("id", "news_item_id")
    return S.alert_card(typed, TEAMS, "monitoring").withColumn("reasons", F.array_join("reasons", ","))


@query("SP1", with_views(f"""
SELECT id, title, entity_norm, sentence, fragment AS text_fragment FROM (
  SELECT s.id, s.title, m.entity_norm, CAST(m.sentence AS INTEGER) AS sentence,
    array_to_string(list_slice(s.sents, greatest(m.sentence - 1, 1), m.sentence + 1), ' ') AS fragment
  FROM m JOIN s ON s.id = m.id)
WHERE len(regexp_extract_all(fragment, '{NOT_SPACE}+')) >= 5""", "v_items", "aliases", extra=f"""
s AS (SELECT id, title, list_filter(list_transform(regexp_extract_all(text_fragment, '[^.!?\n]+[.!?]*'),
    lambda x: regexp_replace(x, '^{SPACE}+|{SPACE}+$', '', 'g')), lambda x: x <> '') AS sents FROM v_items),
u AS (SELECT id, unnest(sents) AS sent, generate_subscripts(sents, 1) AS pos FROM s),
m AS (SELECT u.id, a.entity AS entity_norm, min(u.pos) AS sentence FROM u JOIN aliases a ON contains(lower(u.sent), a.alias) GROUP BY ALL)"""))
def extract_mentions(v: Views):
    return I.extract_mentions(v.items, ALIASES)
