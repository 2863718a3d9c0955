"""Profiling and leakage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import text as T
from riskloom.operators import items as I
from riskloom.operators import leakage as L
from riskloom.operators import profile as P
from riskloom.operators import sampling as SA
from riskloom.plans.adapters import Views
from riskloom.plans.oracle import NOT_SPACE, WORD, with_views
from riskloom.plans.registry import query

CHECKS = {
    "sample_id": ["sample_id"],
    "text_fragment": ["text_fragment"],
    "title + text_fragment + entity_norm": ["title", "text_fragment", "entity_norm"],
}
RISKS = ["no_risk", "cyber_risk", "operational_risk"]
LANGS = ["en", "fr", "de", "es"]
_LABELLED_COLUMNS = ["sample_id", "event_group_id", "split", "text_fragment", "title", "entity_norm",
                     "found_risk_keywords", "source", "published_year", "published_month", "alert_flag", "risk_type_4cls"]


def rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("AG1", with_views("""
SELECT unnest(['rows', 'columns', 'positive_rows', 'positive_share', 'first_year', 'last_year',
               'unique_sample_id', 'unique_event_group_id', 'unique_source']) AS metric,
  unnest([n::DOUBLE, 12::DOUBLE, p::DOUBLE, round(p / n, 6), a::DOUBLE, b::DOUBLE, s::DOUBLE, g::DOUBLE, o::DOUBLE]) AS value
FROM (SELECT count(*) AS n, count(*) FILTER (alert_flag = 1) AS p, min(published_year) AS a, max(published_year) AS b,
  count(DISTINCT sample_id) AS s, count(DISTINCT event_group_id) AS g, count(DISTINCT source) AS o FROM v_labelled)""",
    "v_labelled"))
def dataset_summary(v: Views):
    return rounded(P.dataset_summary(v.labelled, ["sample_id", "event_group_id", "source"]), "value")


_TYPES = {"sample_id": "bigint", "published_year": "int", "published_month": "int", "alert_flag": "int"}


@query("AG2", with_views(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{_TYPES.get(c, 'string')}' AS dtype,
  count(*) FILTER ({c} IS NULL OR NOT regexp_matches(CAST({c} AS VARCHAR), '{NOT_SPACE}')) AS missing_or_empty,
  count(DISTINCT {c}) + CAST(count(*) FILTER ({c} IS NULL) > 0 AS BIGINT) AS unique_values FROM v_labelled"""
    for c in _LABELLED_COLUMNS), "v_labelled"))
def column_profile(v: Views):
    return P.column_profile(v.labelled)


@query("AG3", with_views("""
SELECT unnest(['sample_id', 'text_fragment', 'title + text_fragment + entity_norm']) AS "check",
  unnest([n - a, n - b, n - c]) AS "count"
FROM (SELECT count(*) AS n, count(DISTINCT sample_id) AS a, count(DISTINCT text_fragment) AS b,
  count(DISTINCT (title, text_fragment, entity_norm)) AS c FROM v_labelled)""", "v_labelled"))
def duplicate_counts(v: Views):
    return P.duplicate_counts(v.labelled, CHECKS)


@query("AG4", with_views("""
SELECT sample_id, split, event_group_id, text_fragment, copies FROM (
  SELECT *, count(*) OVER (PARTITION BY text_fragment) AS copies FROM v_labelled) WHERE copies > 1""", "v_labelled"))
def duplicate_rows(v: Views):
    rows = v.labelled.select("sample_id", "split", "event_group_id", "text_fragment")
    return P.duplicate_rows(rows, ["text_fragment"], ["text_fragment", "sample_id"])


@query("AG5", with_views("""
SELECT risk_type_4cls, count(*) AS "count", round(count(*) / (SELECT count(*) FROM v_labelled), 6) AS share
FROM v_labelled GROUP BY 1""", "v_labelled"))
def value_distribution(v: Views):
    return rounded(P.value_distribution(v.labelled, "risk_type_4cls", share=True), "share").orderBy(F.desc("count"))


@query("AG5", "SELECT lang, count(*) AS \"count\" FROM documents GROUP BY lang")
def source_distribution(v: Views):
    return P.value_distribution(v.table("documents"), "lang", dropna=False)


@query("AG6", "SELECT source, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in LANGS)
       + " FROM documents GROUP BY source")
def crosstab(v: Views):
    return P.crosstab(v.table("documents"), "source", "lang", LANGS)


@query("AG7", with_views("""
SELECT coalesce(split, 'All') AS split, count(*) FILTER (alert_flag = 0) AS "0", count(*) FILTER (alert_flag = 1) AS "1",
  count(*) AS "All" FROM v_labelled GROUP BY ROLLUP (split)""", "v_labelled"))
def crosstab_margins(v: Views):
    return P.crosstab_margins(v.labelled, "split", "alert_flag", [0, 1])


@query("AG8", with_views("""
SELECT source, round(count(*) FILTER (alert_flag = 0) / count(*), 3) AS "0", round(count(*) FILTER (alert_flag = 1) / count(*), 3) AS "1"
FROM v_labelled GROUP BY source""", "v_labelled"))
def crosstab_share(v: Views):
    return P.crosstab_share(v.labelled, "source", "alert_flag", [0, 1])


@query("SP18 AG6", with_views("""
SELECT published_year, count(*) FILTER (alert_flag = 0) AS "0", count(*) FILTER (alert_flag = 1) AS "1"
FROM v_labelled GROUP BY published_year""", "v_labelled"))
def temporal_drift(v: Views):
    return P.temporal_drift(v.labelled)


_STATS = """round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, min(x) AS min, quantile_cont(x, 0.25) AS p25,
  quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS p75, max(x) AS max"""
_LENGTHS = f"""lens AS (
  SELECT alert_flag, unnest(['title_len', 'text_len', 'text_words', 'risk_keyword_count']) AS "column",
    unnest([length(title)::DOUBLE, length(text_fragment)::DOUBLE, len(regexp_extract_all(text_fragment, '{NOT_SPACE}+'))::DOUBLE,
      len(list_filter(string_split(found_risk_keywords, ';'), lambda x: x <> ''))::DOUBLE]) AS x FROM v_labelled)"""


def _lengths(v: Views):
    return v.labelled.select(
        "alert_flag", T.char_count("title").alias("title_len"), T.char_count("text_fragment").alias("text_len"),
        T.word_count("text_fragment").alias("text_words"), T.keyword_count("found_risk_keywords").alias("risk_keyword_count"))


LENGTHS = ["title_len", "text_len", "text_words", "risk_keyword_count"]


@query("AG9", with_views(f'SELECT "column", count(*) AS "count", {_STATS} FROM lens GROUP BY "column"', "v_labelled", extra=_LENGTHS))
def describe_numeric(v: Views):
    return rounded(P.describe_numeric(_lengths(v), LENGTHS), "mean", "std")


@query("AG10", with_views(
    f'SELECT alert_flag, "column", count(*) AS "count", {_STATS} FROM lens GROUP BY alert_flag, "column"', "v_labelled", extra=_LENGTHS))
def grouped_stats(v: Views):
    return rounded(P.grouped_stats(_lengths(v), LENGTHS, ["alert_flag"]), "mean", "std")


@query("AG11", with_views("""
SELECT split, count(*) AS rows, round(avg(alert_flag), 6) AS positive_rate, count(DISTINCT event_group_id) AS event_groups
FROM v_labelled GROUP BY split""", "v_labelled"))
def split_summary(v: Views):
    return rounded(P.split_summary(v.labelled), "positive_rate")


@query("AG11", with_views(
    'SELECT split, alert_flag, count(*) AS "count" FROM v_labelled GROUP BY split, alert_flag', "v_labelled"))
def target_by_split(v: Views):
    return P.target_by_split(v.labelled)


_LEAK = """SELECT '{name}' AS "check", count(*) AS leaking_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows
FROM (SELECT count(*) AS n FROM v_labelled_leaky GROUP BY {cols} HAVING count(DISTINCT split) > 1)"""


@query("AG12", with_views(" UNION ALL ".join(
    _LEAK.format(name=n, cols=", ".join(c)) for n, c in CHECKS.items()), "v_labelled_leaky"))
def cross_split_leaks(v: Views):
    return L.cross_split_leaks(v.labelled_leaky, CHECKS)


@query("JN5", with_views("""
SELECT sample_id, split, event_group_id, text_fragment FROM v_labelled_leaky WHERE text_fragment IN (
  SELECT text_fragment FROM v_labelled_leaky GROUP BY text_fragment HAVING count(DISTINCT split) > 1)""", "v_labelled_leaky"))
def rows_for_leaking_keys(v: Views):
    rows = v.labelled_leaky.select("sample_id", "split", "event_group_id", "text_fragment")
    return L.rows_for_keys(rows, ["text_fragment"])


@query("JN8 ST5", with_views("""
SELECT a.split AS left_split, b.split AS right_split, count(*) AS overlap
FROM (SELECT DISTINCT event_group_id, split FROM v_labelled_leaky) a
JOIN (SELECT DISTINCT event_group_id, split FROM v_labelled_leaky) b ON a.event_group_id = b.event_group_id AND a.split < b.split
GROUP BY 1, 2""", "v_labelled_leaky"))
def split_key_overlap(v: Views):
    return L.split_key_overlap(v.labelled_leaky, "event_group_id")


@query("AG13", with_views("""
SELECT keyword, count(*) AS "count" FROM (SELECT unnest(string_split(found_risk_keywords, ';')) AS keyword FROM v_labelled)
WHERE keyword <> '' GROUP BY keyword""", "v_labelled"))
def keyword_frequency(v: Views):
    return P.keyword_frequency(v.labelled)


_TOKENS = f"""SELECT word, count(*) AS "count" FROM (
  SELECT unnest(regexp_extract_all(lower(title || ' ' || text_fragment), '{WORD}')) AS word FROM v_labelled {{where}})
GROUP BY word ORDER BY 2 DESC, word LIMIT 30"""


@query("AG13", with_views(_TOKENS.replace("{where}", ""), "v_labelled"))
def top_words(v: Views):
    return P.top_words(v.labelled, T.title_and_fragment())


@query("AG13", with_views(_TOKENS.replace("{where}", "WHERE alert_flag = 1"), "v_labelled"))
def top_words_alerts(v: Views):
    return P.top_words(v.labelled, T.title_and_fragment(), where=F.col("alert_flag") == 1)


@query("AG28", """
WITH x AS (SELECT length(text) AS n FROM documents), b AS (SELECT min(n)::DOUBLE AS lo, (max(n) - min(n)) / 30.0::DOUBLE AS w FROM x),
c AS (SELECT CAST(least(floor((n - lo) / w), 29) AS INTEGER) AS bin, count(*) AS n FROM x, b GROUP BY 1)
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * w, 6) AS left_edge, coalesce(c.n, 0) AS "count"
FROM (SELECT unnest(range(30)) AS bin) g CROSS JOIN b LEFT JOIN c ON c.bin = g.bin""")
def histogram(v: Views):
    docs = v.table("documents").select(F.length("text").alias("n"))
    return rounded(P.histogram(docs, "n"), "left_edge")


@query("PR21", with_views("""
SELECT sample_id, alert_flag, risk_type_4cls FROM (SELECT * REPLACE (CASE WHEN sample_id % 9 = 0 THEN 1 - alert_flag ELSE alert_flag END AS alert_flag)
  FROM v_labelled) WHERE alert_flag <> CAST(risk_type_4cls <> 'no_risk' AS INTEGER)""", "v_labelled"))
def target_mismatches(v: Views):
    return P.target_mismatches(_noisy(v)).select("sample_id", "alert_flag", "risk_type_4cls")


def _noisy(v: Views):
    """Labels with some flags turned over, so that the rules find something."""
    flag = F.col("alert_flag")
    return v.labelled.withColumn("alert_flag", F.when(F.col("sample_id") % 9 == 0, 1 - flag).otherwise(flag))


_RULES = {
    "no_risk_but_alert": "risk_type_4cls = 'no_risk' AND alert_flag = 1",
    "risk_but_no_alert": "risk_type_4cls <> 'no_risk' AND alert_flag = 0",
    "alert_without_keywords": "alert_flag = 1 AND found_risk_keywords = ''",
    "no_alert_with_keywords": "alert_flag = 0 AND found_risk_keywords <> ''",
}


@query("PR21", with_views(" UNION ALL ".join(
    f"SELECT '{n}' AS \"check\", count(*) FILTER ({c}) AS rows, min(sample_id) FILTER ({c}) AS first_example, "
    f"array_to_string(list_slice(list(sample_id ORDER BY sample_id) FILTER ({c}), 1, 5), ',') AS examples FROM noisy"
    for n, c in _RULES.items()), "v_labelled", extra="""noisy AS (
SELECT * REPLACE (CASE WHEN sample_id % 9 = 0 THEN 1 - alert_flag ELSE alert_flag END AS alert_flag) FROM v_labelled)"""))
def rule_checks(v: Views):
    return P.rule_checks(_noisy(v)).withColumn("examples", F.array_join(F.col("examples").cast("array<string>"), ","))


@query("SM1", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 30")
def sample_rows(v: Views):
    return SA.sample_n(v.table("documents").select("doc_id", "lang"), 30, "doc_id")


@query("SM2", with_views("""
SELECT sample_id, alert_flag, entity_norm FROM (
  SELECT *, row_number() OVER (PARTITION BY alert_flag ORDER BY md5(sample_id || ':42'), sample_id) AS rn
  FROM v_labelled WHERE split = 'train') WHERE rn <= 3""", "v_labelled"))
def stratified_few_shot(v: Views):
    return SA.stratified_few_shot(v.labelled.select("sample_id", "split", "alert_flag", "entity_norm"), 3).drop("split")


@query("SM2 PR17", with_views("""
SELECT sample_id, unnest([0, 1]) AS turn, unnest(['user', 'assistant']) AS role,
  unnest(['Fragment: ' || title || ' ' || text_fragment || ' ' || entity_norm, CAST(alert_flag AS VARCHAR)]) AS content FROM (
  SELECT *, row_number() OVER (PARTITION BY alert_flag ORDER BY md5(sample_id || ':42'), sample_id) AS rn
  FROM v_labelled WHERE split = 'train') WHERE rn <= 3""", "v_labelled"))
def few_shot_messages(v: Views):
    from riskloom.operators.teacher import few_shot_messages as messages
    picked = SA.stratified_few_shot(v.labelled, 3).withColumn("model_text", T.model_text_spaced())
    return messages(picked, "Fragment: ")


@query("SP11", """
SELECT doc_id, CASE WHEN h < 14 THEN 'train' WHEN h < 17 THEN 'valid' ELSE 'test' END AS split
FROM (SELECT doc_id, ('0x' || substr(md5(md5(text)), 1, 7))::BIGINT % 20 AS h FROM documents)""")
def group_aware_split(v: Views):
    docs = v.table("documents").select("doc_id", F.md5("text").alias("event_group_id"))
    return L.group_aware_split(docs).select("doc_id", "split")


@query("SP12", with_views("""
SELECT id, title, text_fragment, entity_norm FROM (
  SELECT *, row_number() OVER (PARTITION BY title, text_fragment, entity_norm ORDER BY id) AS rn FROM v_resolved) WHERE rn = 1""",
    "v_resolved"))
def drop_exact_duplicates(v: Views):
    rows = v.resolved.select("id", "title", "text_fragment", "entity_norm")
    return L.drop_exact_duplicates(rows, ["title", "text_fragment", "entity_norm"], "id")


@query("SP13", with_views("""
SELECT sample_id, alert_flag FROM (
  SELECT *, row_number() OVER (PARTITION BY alert_flag ORDER BY md5(sample_id || ':42')) AS rn FROM v_labelled WHERE split = 'train')
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM v_labelled WHERE split = 'train' GROUP BY alert_flag))""", "v_labelled"))
def balance_train(v: Views):
    return L.balance_train(v.labelled.select("sample_id", "split", "alert_flag")).drop("split")


@query("IO3 IO4", with_views(
    "SELECT sample_id, split, alert_flag, risk_type_4cls FROM v_labelled", "v_labelled"))
def declared_labelled_set(v: Views):
    from riskloom.sources.csv_files import require_columns
    need = ["sample_id", "title", "text_fragment", "entity_norm", "alert_flag", "split"]
    return require_columns(v.labelled, need).select("sample_id", "split", "alert_flag", "risk_type_4cls")


@query("PR4 AG10", with_views(f"""
SELECT sample_id, CAST(length(text_fragment) AS INTEGER) AS text_fragment_chars,
  CAST(len(regexp_extract_all(text_fragment, '{NOT_SPACE}+')) AS INTEGER) AS text_fragment_words FROM v_labelled""", "v_labelled"))
def fragment_lengths(v: Views):
    return I.text_lengths(v.labelled, ["text_fragment"]).select("sample_id", "text_fragment_chars", "text_fragment_words")
