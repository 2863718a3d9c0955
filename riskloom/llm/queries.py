"""The operators applied to whole tables with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import licenses, packing, warc
from riskloom.llm.alignment import Tokenizers, align_tokenizers
from riskloom.llm.common import WHITE
from riskloom.llm.decontaminate import leaks
from riskloom.llm.exact_dedup import exact_groups
from riskloom.llm.html_text import main_texts
from riskloom.llm.languages import predict_languages
from riskloom.llm.near_dup import near_duplicates
from riskloom.llm.periods import collapse_runs
from riskloom.llm.quality import quality_scores
from riskloom.llm.sharding import assign_shards
from riskloom.llm.toxicity import toxicity_scores
from riskloom.session import scratch_path

TOKENIZER, RANKS, PIECES = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> packing.Vocabulary:
    import public_tokenizers

    return packing.Vocabulary(public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def document_path() -> Column:
    """Documents carry no path, so the query lays them out as a tree of files: source / language / folder / file.

    Every tenth document plays a licence file: every hundredth that of its source, the others that of their language.
    """
    i = F.col("doc_id")
    name = F.concat(F.lit("LICENSE-"), i.cast("string"))
    return F.when(i % 100 == 0, F.concat_ws("/", "source", name)).when(
        i % 10 == 0, F.concat_ws("/", "source", "lang", name)).otherwise(
        F.concat_ws("/", "source", "lang", F.concat(F.lit("b"), (i % 64).cast("string")), F.concat(i.cast("string"), F.lit(".txt"))))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), document_path().alias("path"), "text")
    return licenses.license_scan(files).withColumnRenamed("file_id", "doc_id")


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path, with_payload=False).where("kind = 'record'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary())


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = Tokenizers(*vocabulary(), public_tokenizers.path(PIECES))
    return align_tokenizers(_table(spark, sf_dir, "documents"), files).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def planted_runs(doc_id: Column, text: Column) -> Column:
    """The text; of every tenth document (by checksum of the id) the words from some place on repeat with some period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        """A lambda's argument is computed once; an expression used inside a lambda would be, for every element."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        g = F.floor(h / 10)
        law = F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).alias("p"))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.when(n > 0, bound(law, lambda s: F.array_join(F.transform(
            places, lambda i: F.get(words, F.when(i < s["a"], i).otherwise(s["a"] + (i - s["a"]) % s["p"]).cast("int"))), " "))).otherwise("")

    words = F.filter(F.split(F.coalesce(text, F.lit("")), WHITE), lambda w: w != "")
    return F.when(h % 10 == 0, bound(words, repeated)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = collapse_runs(docs.select("doc_id", planted_runs(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(_table(spark, sf_dir, "documents"))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


def _license_units_sql(name: str, units: str, templates: dict[str, list[str]]) -> str:
    """CTEs that end in `scored_<name>` (doc_id, license, score): units (doc_id, unit, body) against the templates."""
    rows, squares, unseen = licenses.template_weights(templates)
    values = ", ".join(f"('{n}', {i}, '{w}', CAST({v!r} AS DOUBLE))" for n, i, w, v in rows)
    known = ", ".join(f"('{w}', CAST({v!r} AS DOUBLE))" for w, v in squares.items())
    return f"""
t_{name}(license, notice, w, weight) AS (VALUES {values}),
k_{name}(w, square) AS (VALUES {known}),
units_{name} AS ({units}),
words_{name} AS (SELECT doc_id, unit, unnest(list_distinct(regexp_extract_all(body, '{licenses.TERM}'))) AS w FROM units_{name}
  WHERE regexp_matches(body, '[a-z0-9]')),
valued_{name} AS (SELECT x.*, coalesce(k.square, {round(unseen * unseen, 9)!r}) AS square FROM words_{name} x LEFT JOIN k_{name} k ON x.w = k.w),
norms_{name} AS (SELECT doc_id, unit, sqrt(sum(square)) AS norm FROM valued_{name} GROUP BY ALL),
dots_{name} AS (SELECT doc_id, unit, license, notice, sum(sqrt(square) * weight) AS dot
  FROM valued_{name} v JOIN t_{name} t ON v.w = t.w GROUP BY ALL),
scored_{name} AS (SELECT doc_id, license, round(dot / norm, 6) AS score FROM dots_{name} JOIN norms_{name} USING (doc_id, unit)
  WHERE round(dot / norm, 6) >= {licenses.THRESHOLD}),"""


def _license_sql() -> str:
    def pieces(cut: str) -> str:
        return f"SELECT doc_id, unnest({cut}) AS body, generate_subscripts({cut}, 1) AS unit FROM files"

    lines = _license_units_sql("line", pieces("string_split(lower(text), chr(10))"), licenses.TEMPLATES)
    blocks = _license_units_sql(
        "block", pieces(r"regexp_split_to_array(lower(text), '\n[^a-z0-9]*\n')"), licenses.blocks_of(licenses.TEMPLATES, licenses.HEADERS))
    whole = _license_units_sql(
        "whole", "SELECT doc_id, 1 AS unit, lower(text) AS body FROM files WHERE doc_id % 10 = 0", licenses.full_texts())
    return f"""
WITH files AS (
  SELECT doc_id, coalesce(text, '') AS text,
    CASE WHEN doc_id % 100 = 0 THEN concat_ws('/', source, 'LICENSE-' || doc_id)
         WHEN doc_id % 10 = 0 THEN concat_ws('/', source, lang, 'LICENSE-' || doc_id)
         ELSE concat_ws('/', source, lang, 'b' || (doc_id % 64), doc_id || '.txt') END AS path
  FROM documents),{lines}{blocks}{whole}
scored AS (SELECT * FROM scored_line UNION ALL SELECT * FROM scored_block UNION ALL SELECT * FROM scored_whole),
own AS (SELECT doc_id, license, score FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1),
place AS (SELECT doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, doc_id % 10 = 0 AS named FROM files),
holders AS (SELECT dir, license, score FROM place JOIN own USING (doc_id) WHERE named
            QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
nearest AS (SELECT p.dir, h.dir AS license_dir, h.license, h.score FROM (SELECT DISTINCT dir FROM place) p JOIN holders h
            ON p.dir = h.dir OR starts_with(p.dir, h.dir || '/') OR h.dir = ''
            QUALIFY row_number() OVER (PARTITION BY p.dir ORDER BY length(h.dir) DESC) = 1)
SELECT p.doc_id, p.path, coalesce(o.license, n.license) AS license, coalesce(o.score, n.score) AS score,
  CASE WHEN o.license IS NOT NULL THEN 'header' WHEN n.license IS NOT NULL THEN 'directory' ELSE 'none' END AS origin,
  CASE WHEN o.license IS NULL THEN n.license_dir END AS license_dir
FROM place p LEFT JOIN own o USING (doc_id) LEFT JOIN nearest n ON p.dir = n.dir"""


_EXACT_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": _pipeline,
    **{f.__name__: f for f in (
        op1_license_scan, op2_site_style_tree, op3_exact_dedup, op4_template_decontamination, op5_quality,
        op6_minhash_near_dedup, op7_hash_tree_sharding, op8_warc, op9_toxicity, op10_best_fit_packing,
        op11_tokenizer_alignment, op12_periodic_runs, op13_ppm_language)},
}

ORACLE: dict[str, str] = {"op1_license_scan": _license_sql(), "op3_exact_dedup": _EXACT_SQL}
