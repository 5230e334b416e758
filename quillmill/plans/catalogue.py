"""The query catalogue: every operator over the driver's tables, with DuckDB SQL that checks it.

The tables stand for the layers: documents are the recognised texts (doc_id the image, source the dataset), pages the
raw objects, conversations and events rows with a key and a time, orders and customers rows to merge.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fuzzy, text
from ..functions.text import strings
from ..operators import audit, corpus, funnel, gates, lexicon, recognise, rows, snapshots
from ..operators.values import FUNCTION_WORDS, KEPT_PHRASES, SCRAPS, Topic, TopicRules
from ..sources import files, keys
from ..sources.store import TableStore
from ..streaming import increment
from .layers import Layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# Stand-ins for the word lists, from frequent words of the tables.
STOP = ("the", "and", "que", "der", "die", "les", "est", "las", "und", "of", "an", "on")
EXTRA_STOP = ("that", "with", "for", "from", "von", "das", "pour", "dans", "con", "por")
RULES = TopicRules(
    version="v1",
    topics=(
        Topic("sound", ("eron", "thnd", "and the"), ("ther", "nder", "sch"), ("ent", "ly", "heit"), 3, 8),
        Topic("sight", ("lichkeit", "ciónmente"), ("ment", "ado"), ("eau", "osas"), 2, 6),
        Topic("taste", ("anth", "keit"),),
        Topic("touch", ("aux", "tion"), ("oi", "ier"), ("ou", "ai"), 1, 4, False),
    ),
    good_bad=("nothe",),
    positives=("isnd", "thing", "une"),
    negatives=("zung", "stha", "queen"),
    negations=("x", "y"),
    weak=frozenset({"tion", "keit"}),
    negation_aware=frozenset({"aux", "eron"}),
)


def sql_list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", "source", F.col("text").alias("extracted_text"), text.clean_text(F.col("text")).alias("cleaned_text"))


def tokens(spark: SparkSession, d: str) -> DataFrame:
    return cleaned(spark, d).select("doc_id", "source", text.split_tokens(F.col("cleaned_text")).alias("tokens"))


def _nested(f: str, expr: str, pairs) -> str:
    return reduce(lambda e, p: f"{f}({e}, '{p[0]}', '{p[1]}')", pairs, expr)


_KEPT = [(p, f"__wl{i}__") for i, p in enumerate(KEPT_PHRASES)]
SQL_CLEAN = rf"""
clean0 AS (
  SELECT doc_id, source, text, {_nested("replace", rf"regexp_replace(lower(regexp_replace(regexp_replace(coalesce(text, ''), '{text.EMOJI}', ' ', 'g'), '[^\p{{L}}\p{{N}}\s_]', ' ', 'g')), '\s+', ' ', 'g')", _KEPT)} AS t FROM documents
), clean AS (
  SELECT doc_id, source, text, {_nested("replace", rf"array_to_string(list_filter(string_split(t, ' '), lambda x: x <> '' AND x NOT IN ({sql_list(SCRAPS)}) AND NOT regexp_full_match(x, '\p{{Nd}}+')), ' ')", [(b, a) for a, b in _KEPT])} AS cleaned_text FROM clean0
)"""
SQL_TOKENS = rf"""{SQL_CLEAN}, word AS (
  SELECT doc_id, source, w, min(pos) AS pos FROM (
    SELECT doc_id, source, unnest(p) AS w, generate_subscripts(p, 1) AS pos FROM (SELECT doc_id, source, string_split(cleaned_text, ' ') AS p FROM clean))
  WHERE length(w) >= 2 AND NOT regexp_full_match(w, '\p{{Nd}}+|[a-z]{{1,2}}') AND w NOT IN ({sql_list(FUNCTION_WORDS)}) GROUP BY ALL
), tok AS (SELECT doc_id, source, list(w ORDER BY pos) AS tokens FROM word GROUP BY ALL)"""
SQL_TFIDF = """
stat AS (SELECT w AS keyword, count(*) AS total_tf, count(DISTINCT doc_id) AS doc_frequency FROM {word} GROUP BY w),
tfidf AS (
  SELECT keyword, total_tf, doc_frequency, n AS corpus_doc_count, round(ln((n + 1.0) / (doc_frequency + 1.0)), 6) AS idf,
    round(total_tf * ln((n + 1.0) / (doc_frequency + 1.0)), 6) AS tfidf_score
  FROM stat, (SELECT count(DISTINCT doc_id) AS n FROM {word}))"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# corpus statistics -------------------------------------------------------------------------------------------------------


@query("tfidf_keywords", f"WITH {SQL_TOKENS}, {SQL_TFIDF.format(word='word')} SELECT * FROM tfidf")
def tfidf_keywords(spark, d):
    return _rounded(corpus.tfidf(tokens(spark, d), "doc_id", "tokens"), "idf", "tfidf_score")


@query("tfidf_top", f"WITH {SQL_TOKENS}, {SQL_TFIDF.format(word='word')} SELECT * FROM tfidf ORDER BY tfidf_score DESC, total_tf DESC, keyword LIMIT 100")
def tfidf_top(spark, d):
    return corpus.top(tfidf_keywords(spark, d), "tfidf_score", 100, F.col("total_tf").desc(), "keyword")


@query("tfidf_by_dataset", f"WITH {SQL_TOKENS}, one AS (SELECT * FROM word WHERE source = 'src3'), {SQL_TFIDF.format(word='one')} SELECT * FROM tfidf")
def tfidf_by_dataset(spark, d):
    rows_ = text.in_dataset(tokens(spark, d).withColumnRenamed("source", "dataset_id"), "SRC3")
    return _rounded(corpus.tfidf(rows_, "doc_id", "tokens"), "idf", "tfidf_score")


@query(
    "tfidf_repeats",
    rf"""WITH {SQL_CLEAN}, w AS (SELECT doc_id, unnest(string_split(cleaned_text, ' ')) AS w FROM clean), word AS (SELECT * FROM w WHERE w <> ''), {SQL_TFIDF.format(word='word')}
    SELECT * FROM tfidf""",
)
def tfidf_repeats(spark, d):
    rows_ = cleaned(spark, d).select("doc_id", text.keep_tokens(text.parts(F.col("cleaned_text")), noise_filter=False, dedupe=False).alias("tokens"))
    return _rounded(corpus.tfidf(rows_, "doc_id", "tokens", repeats=True), "idf", "tfidf_score")


SQL_PAIRS = f"""WITH {SQL_TOKENS}, pair AS (
  SELECT tokens[i] AS word1, tokens[i + 1] AS word2 FROM (SELECT tokens, unnest(range(1, len(tokens))) AS i FROM tok WHERE len(tokens) >= 2)
), pairs AS (SELECT word1, word2, count(*) AS bigram_count FROM pair GROUP BY ALL)"""


@query("bigram_counts", f"{SQL_PAIRS} SELECT * FROM pairs")
def bigram_counts(spark, d):
    return corpus.bigram_counts(tokens(spark, d), "tokens")


@query(
    "phrase_pmi",
    f"""{SQL_PAIRS}, total AS (SELECT sum(bigram_count)::BIGINT AS n FROM pairs),
    a AS (SELECT word1, sum(bigram_count) AS n1 FROM pairs GROUP BY 1), b AS (SELECT word2, sum(bigram_count) AS n2 FROM pairs GROUP BY 1)
    SELECT word1, word2, word1 || ' ' || word2 AS phrase, bigram_count, round(ln((bigram_count / n::DOUBLE) / ((n1 / n::DOUBLE) * (n2 / n::DOUBLE))), 6) AS pmi_score,
      n AS total_bigrams FROM pairs JOIN a USING (word1) JOIN b USING (word2), total WHERE bigram_count >= 2""",
)
def phrase_pmi(spark, d):
    return _rounded(corpus.phrase_pmi(tokens(spark, d), "tokens", 2), "pmi_score")


SQL_PMI = ORACLE_SQL["phrase_pmi"]


@query("phrase_top", f"SELECT * FROM ({SQL_PMI}) ORDER BY pmi_score DESC, bigram_count DESC, phrase LIMIT 100")
def phrase_top(spark, d):
    return corpus.top(phrase_pmi(spark, d), "pmi_score", 100, F.col("bigram_count").desc(), "phrase")


@query("gold_preview", f"WITH {SQL_TOKENS}, {SQL_TFIDF.format(word='word')} SELECT * FROM tfidf ORDER BY tfidf_score DESC, keyword LIMIT 50")
def gold_preview(spark, d):
    return rows.preview(tfidf_keywords(spark, d), 50, "keyword")


@query("top_tokens", f"WITH {SQL_TOKENS} SELECT w AS token, count(*) AS n FROM word GROUP BY 1 ORDER BY n DESC, token LIMIT 50")
def top_tokens(spark, d):
    return corpus.top_tokens(tokens(spark, d), "tokens")


# cleaning and lexicon ----------------------------------------------------------------------------------------------------


@query("clean_text", f"WITH {SQL_CLEAN} SELECT doc_id, cleaned_text FROM clean")
def clean_text(spark, d):
    return cleaned(spark, d).select("doc_id", "cleaned_text")


@query("clean_lengths", f"WITH {SQL_CLEAN} SELECT source, sum(length(text))::BIGINT AS chars, sum(length(cleaned_text))::BIGINT AS kept_chars FROM clean GROUP BY 1")
def clean_lengths(spark, d):
    lengths = [F.sum(F.length(c).cast("long")).alias(a) for c, a in (("extracted_text", "chars"), ("cleaned_text", "kept_chars"))]
    return cleaned(spark, d).groupBy("source").agg(*lengths)


def _filtered(spark, d, stop):
    return tokens(spark, d).select("doc_id", F.array_join(lexicon.filter_tokens(F.col("tokens"), stop), " ").alias("tokens"))


def _filtered_sql(stop) -> str:
    return f"""WITH {SQL_TOKENS} SELECT d.doc_id, coalesce(x.tokens, '') AS tokens FROM documents d LEFT JOIN
      (SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS tokens FROM word WHERE w NOT IN ({sql_list(stop)}) GROUP BY 1) x USING (doc_id)"""


@query("analytics_tokens", _filtered_sql(STOP))
def analytics_tokens(spark, d):
    return _filtered(spark, d, STOP)


@query("exploration_tokens", _filtered_sql(STOP + EXTRA_STOP))
def exploration_tokens(spark, d):
    return _filtered(spark, d, lexicon.merge(STOP, EXTRA_STOP))


@query(
    "stopword_effective",
    f"""WITH {SQL_TOKENS}, stop AS (SELECT w FROM word GROUP BY w ORDER BY count(*) DESC, w LIMIT 300),
    protected AS (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark) SELECT w AS term FROM stop WHERE w NOT IN (SELECT w FROM protected)""",
)
def stopword_effective(spark, d):
    stop = corpus.top_tokens(tokens(spark, d), "tokens", 300).select(F.col("token").alias("term"))
    protected = table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("term"))
    return rows.skip_known(stop, protected, ["term"])


@query(
    "lexicon_hash",
    "SELECT sha256(string_agg(w, chr(10) ORDER BY encode(w))) AS lexicon_hash FROM (SELECT DISTINCT trim(lower(unnest(string_split(text, ' ')))) AS w FROM benchmark) WHERE w <> ''",
)
def lexicon_hash(spark, d):
    return lexicon.content_hash_of(table(spark, d, "benchmark").select(F.explode(F.split("text", " ")).alias("w")), "w")


SQL_KEPT = """(SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS tokens FROM word WHERE w NOT IN ({stop}) GROUP BY 1)"""


@query(
    "lexicon_columns",
    f"""WITH {SQL_TOKENS} SELECT d.doc_id, coalesce(a.tokens, '') AS analytics_tokens, coalesce(e.tokens, '') AS tfidf_exploration_tokens FROM documents d
    LEFT JOIN {SQL_KEPT.format(stop=sql_list(STOP))} a USING (doc_id) LEFT JOIN {SQL_KEPT.format(stop=sql_list(STOP + EXTRA_STOP))} e USING (doc_id)""",
)
def lexicon_columns(spark, d):
    lex = lexicon.Lexicon("docs", STOP, tuple(lexicon.merge(STOP, EXTRA_STOP)))
    both = lexicon.with_lexicon_tokens(tokens(spark, d), lex)
    return both.select("doc_id", *[F.array_join(c, " ").alias(c) for c in ("analytics_tokens", "tfidf_exploration_tokens")])


LINES = ("# stop words", "The", "", "  and  # often", "the", "una")


@query("stopword_lines", "SELECT * FROM (VALUES ('file', 0, 'the'), ('file', 1, 'and'), ('file', 2, 'una'), ('effective', 0, 'the'), ('effective', 1, 'una')) t(kind, pos, term)")
def stopword_lines(spark, d):
    """A list written as a file, read back through Spark, and what is left of it without protected words."""
    at = files.shared_folder(spark)
    files.write_text(spark, f"{at}/words.txt", "\n".join(LINES))
    _, words = lexicon.read_first(spark, lexicon.candidates([f"{at}/{{dataset_id}}.txt", f"{at}/words.txt"], "none", None))
    rows_ = [(k, i, w) for k, ws in (("file", words), ("effective", lexicon.effective(words, ["And"]))) for i, w in enumerate(ws)]
    files.delete(spark, at)
    return spark.createDataFrame(rows_, "kind string, pos int, term string")


# rows --------------------------------------------------------------------------------------------------------------------


@query(
    "latest_per_key",
    "SELECT user_id, event_id, ts, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
)
def latest_per_key(spark, d):
    events = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return rows.latest_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")])


@query("latest_turn", "SELECT conv_id, turn, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS r FROM conversations) WHERE r = 1")
def latest_turn(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return rows.latest_per_key(turns, ["conv_id"], [F.col("turn"), F.col("role"), F.col("text")])


@query(
    "silver_source_rows",
    r"""WITH b AS (SELECT '/raw/images/' || event_type || '/' || user_id AS image_path, * FROM events WHERE event_id % 7 <> 0)
    SELECT image_path, trim(event_type || ' ') AS extracted_text, ts AS latest_ingestion_timestamp, regexp_extract(image_path, '/raw/images/([^/]+)/', 1) AS dataset_id
    FROM (SELECT *, row_number() OVER (PARTITION BY image_path ORDER BY ts DESC, event_id DESC) AS r FROM b) WHERE r = 1""",
)
def silver_source_rows(spark, d):
    e = table(spark, d, "events")
    bronze = e.select(
        F.concat(F.lit("/raw/images/"), "event_type", F.lit("/"), "user_id").alias("image_path"),
        F.when(F.col("event_id") % 7 != 0, F.concat("event_type", F.lit(" "))).alias("extracted_text"),
        F.col("ts").alias("ingestion_timestamp"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("file_hash"),
    )
    return rows.prepare_for_silver(bronze).drop("file_hash")


@query("bronze_duplicates", "SELECT count(*) AS duplicate_groups, coalesce(sum(c - 1), 0)::BIGINT AS extra_rows, coalesce(sum(c), 0)::BIGINT AS duplicate_rows FROM (SELECT count(*) AS c FROM documents GROUP BY sha256(text)) WHERE c > 1")
def bronze_duplicates(spark, d):
    return rows.duplicate_groups(table(spark, d, "documents").select(F.sha2("text", 256).alias("file_hash")), ["file_hash"])


@query("dedup_keep_latest", "SELECT max(doc_id) AS doc_id, sha256(text) AS file_hash FROM documents GROUP BY 2")
def dedup_keep_latest(spark, d):
    hashed = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("file_hash"))
    return rows.latest_per_key(hashed, ["file_hash"], [F.col("doc_id")])


@query("append_skip_anti", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def append_skip_anti(spark, d):
    return rows.skip_known(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), ["doc_id"])


@query("missing_raw_anti", "SELECT page_id, url FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)")
def missing_raw_anti(spark, d):
    return rows.skip_known(table(spark, d, "pages").select("page_id", "url"), table(spark, d, "labels").select(F.col("doc_id").alias("page_id")), ["page_id"])


@query(
    "ingest_status",
    """SELECT page_id, url, x.doc_id IS NOT NULL AS in_bronze, CASE WHEN length(x.text) > 160 THEN substr(x.text, 1, 160) || '…' ELSE x.text END AS preview
    FROM pages LEFT JOIN (SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) x ON x.doc_id = page_id""",
)
def ingest_status(spark, d):
    bronze = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left_semi").select(F.col("doc_id").alias("page_id"), "text")
    return rows.ingest_status(table(spark, d, "pages").select("page_id", "url"), bronze, "page_id", "text")


def _halves(spark, d):
    """A source and a target to merge: all documents; the labelled ones, some changed, stale, blank or of another version."""
    base = cleaned(spark, d).select(
        F.col("doc_id").cast("string").alias("image_path"), "doc_id", "extracted_text", "cleaned_text", F.col("source").alias("source_bucket"), F.col("source").alias("dataset_id"),
        F.to_timestamp(F.lit("2026-01-01 00:00:00")).alias("at"),
    )
    target = base.join(table(spark, d, "labels"), "doc_id", "left_semi").select(
        "image_path", F.when(F.col("doc_id") % 10 == 1, "old").otherwise(F.col("extracted_text")).alias("extracted_text"),
        F.when(F.col("doc_id") % 10 == 2, "").otherwise(F.col("cleaned_text")).alias("cleaned_text"), "source_bucket", F.upper("dataset_id").alias("dataset_id"),
        F.when(F.col("doc_id") % 10 == 4, F.expr("timestamp_micros(0)")).otherwise(F.col("at")).alias("ingestion_timestamp"),
        F.when(F.col("doc_id") % 10 != 5, strings(["x"])).alias("tokens"), F.when(F.col("doc_id") % 10 != 7, "v2").alias("silver_transform_version"),
    )
    return base.withColumnRenamed("at", "latest_ingestion_timestamp").drop("doc_id"), target


@query(
    "change_detect",
    f"""WITH {SQL_CLEAN} SELECT doc_id::VARCHAR AS image_path, doc_id NOT IN (SELECT doc_id FROM labels) AS is_new FROM clean
    WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR doc_id % 10 IN (2, 4, 5, 7) OR (doc_id % 10 = 1 AND text <> 'old') OR trim(cleaned_text) = ''""",
)
def change_detect(spark, d):
    source, target = _halves(spark, d)
    return rows.changed_rows(source, target, "v2").select("image_path", "is_new")


@query(
    "upsert_by_key",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
      CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'new' END AS note FROM customer""",
)
def upsert_by_key(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    more = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    source = c.filter("c_mktsegment in ('BUILDING', 'MACHINERY')").withColumn("c_acctbal", more).withColumn("note", F.lit("new"))
    return rows.upserted(c.filter("c_mktsegment <> 'MACHINERY'"), source, ["c_custkey"]).drop("c_mktsegment")


@query("archive_before_merge", "SELECT o_orderkey, o_totalprice, 'pre_merge' AS archive_reason FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def archive_before_merge(spark, d):
    source = table(spark, d, "lineitem").filter("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return rows.archived(table(spark, d, "orders"), source, ["o_orderkey"]).select("o_orderkey", "o_totalprice", "archive_reason")


@query("delete_by_condition", "SELECT event_id FROM events WHERE NOT coalesce(value > 50 AND event_type = 'click', false)")
def delete_by_condition(spark, d):
    return rows.without(table(spark, d, "events"), (F.col("value") > 50) & (F.col("event_type") == "click")).select("event_id")


@query("delete_older_than_latest", "SELECT event_id, day FROM (SELECT event_id, CASE WHEN value >= 5 THEN date_trunc('day', ts) END AS day FROM events) WHERE day IS NULL OR day >= (SELECT max(date_trunc('day', ts)) FROM events WHERE value >= 5)")
def delete_older_than_latest(spark, d):
    events = table(spark, d, "events").select("event_id", F.when(F.col("value") >= 5, F.date_trunc("day", "ts")).cast("timestamp_ntz").alias("day"))
    return rows.latest_batch_only(events, "day")


@query("dataset_scoped_replace", "SELECT event_type AS dataset_id, event_id FROM events WHERE event_type <> 'click' UNION ALL SELECT 'click', -event_id FROM events WHERE event_type = 'click' AND value > 20")
def dataset_scoped_replace(spark, d):
    events = table(spark, d, "events").select(F.col("event_type").alias("dataset_id"), "event_id", "value")
    old, new = events.drop("value"), events.filter("dataset_id = 'click' and value > 20").select("dataset_id", (-F.col("event_id")).alias("event_id"))
    return rows.dataset_replaced(old, new, "click")


@query("bronze_preview", "SELECT event_id, user_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') || ' （台北）' AS ingestion_timestamp FROM events ORDER BY ts DESC, event_id LIMIT 20")
def bronze_preview(spark, d):
    return rows.preview(table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ingestion_timestamp")), 20, "event_id")


NAMED = ("FRANCE", " CHINA ", "FRANCE", "", "NATION_3")


@query("images_named", "SELECT n_name AS image_path, n_nationkey, how FROM nation, (VALUES ('filter'), ('join')) h(how) WHERE n_name IN ('FRANCE', 'CHINA', 'NATION_3')")
def images_named(spark, d):
    named = table(spark, d, "nation").select(F.col("n_name").alias("image_path"), "n_nationkey")
    return rows.of_images(named, NAMED).withColumn("how", F.lit("filter")).unionByName(rows.of_images(named, NAMED, few=1).withColumn("how", F.lit("join")))


@query("store_merge", ORACLE_SQL["upsert_by_key"] + " UNION ALL SELECT c_custkey, 'archived', c_acctbal, 'pre_merge' FROM customer WHERE c_mktsegment = 'BUILDING'")
def store_merge(spark, d):
    """A merge through the table store: written, merged with its history kept, read back."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    more = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    source = c.filter("c_mktsegment in ('BUILDING', 'MACHINERY')").withColumn("c_acctbal", more).withColumn("note", F.lit("new"))
    store = TableStore(spark, files.shared_folder(spark))
    store.write("t", c.filter("c_mktsegment <> 'MACHINERY'"), "overwrite")
    store.write("t", source, "merge", ["c_custkey"], history="h")
    store.vacuum("t")
    old = store.read("h").select("c_custkey", F.lit("archived").alias("c_name"), "c_acctbal", F.col("archive_reason").alias("note"))
    return store.read("t").select("c_custkey", "c_name", "c_acctbal", "note").unionByName(old)


def _layers(spark, d) -> Layers:
    """Parts as recognised images: their kind is the dataset, name and brand the text."""
    store = TableStore(spark, files.shared_folder(spark))
    bronze = table(spark, d, "part").select(
        F.concat(F.lit("/raw/images/"), F.lower("p_type"), F.lit("/"), F.col("p_partkey")).alias("image_path"), F.sha2("p_name", 256).alias("file_hash"), F.lower("p_type").alias("dataset_id"),
        F.concat_ws(" ", "p_name", "p_brand").alias("extracted_text"), F.lit("s").alias("ocr_signature"), F.to_timestamp(F.lit("2026-01-01")).alias("ingestion_timestamp"), F.lit("b").alias("source_bucket"),
    )
    store.overwrite("bronze", bronze)
    layers = Layers(store)
    layers.silver()
    return layers


SQL_PART = r"""part_text AS (SELECT '/raw/images/' || lower(p_type) || '/' || p_partkey AS image_path, lower(p_type) AS dataset_id,
  list_filter(string_split(lower(regexp_replace(p_name || ' ' || p_brand, '[^\p{L}\p{N}_]+', ' ', 'g')), ' '), lambda x: x <> '' AND NOT regexp_full_match(x, '\p{Nd}+')) AS words FROM part)"""


@query("etl_silver", f"WITH {SQL_PART} SELECT image_path, dataset_id, array_to_string(words, ' ') AS cleaned_text, array_to_string(list_filter(words, lambda x: length(x) > 2 AND x NOT IN ({sql_list(FUNCTION_WORDS)})), ' ') AS tokens FROM part_text")
def etl_silver(spark, d):
    return _layers(spark, d).store.read("silver").select("image_path", "dataset_id", "cleaned_text", F.array_join("tokens", " ").alias("tokens"))


@query("etl_gold", f"WITH {SQL_PART}, word AS (SELECT DISTINCT image_path AS doc_id, unnest(words) AS w FROM part_text WHERE dataset_id = 'economy'), {SQL_TFIDF.format(word='word')} SELECT * FROM tfidf")
def etl_gold(spark, d):
    layers = _layers(spark, d)
    layers.gold("economy")
    table_ = layers.store.read("tfidf_keywords").filter("dataset_id = 'economy'")
    return _rounded(table_.drop("analyzed_at", "dataset_id"), "idf", "tfidf_score")


# gates -------------------------------------------------------------------------------------------------------------------

LEAST = 60
SQL_STATUS = rf"""SELECT doc_id, CASE WHEN trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) = '' THEN 'empty' WHEN starts_with(trim(text), 'OCR_ERROR_') THEN 'ocr_error'
  WHEN length(trim(regexp_replace(text, '\s+', ' ', 'g'))) < {LEAST} THEN 'too_short' WHEN regexp_matches(text, '(?i)\bbare\b') THEN 'noise' ELSE 'ok' END AS ocr_status FROM documents"""


def _tagged(spark, d):
    return gates.with_status(table(spark, d, "documents").select("doc_id", F.col("text").alias("extracted_text")), least=LEAST)


@query("quarantine_status", SQL_STATUS)
def quarantine_status(spark, d):
    return _tagged(spark, d).select("doc_id", "ocr_status")


@query("quarantine_counts", f"SELECT ocr_status, count(*) AS n FROM ({SQL_STATUS}) GROUP BY 1")
def quarantine_counts(spark, d):
    return gates.status_counts(_tagged(spark, d))


@query("quarantine_rejects", f"SELECT doc_id::VARCHAR AS image_path, text AS extracted_text, ocr_status, source AS dataset_id, 'bronze' AS bronze_source_path FROM ({SQL_STATUS}) JOIN documents USING (doc_id) WHERE ocr_status <> 'ok'")
def quarantine_rejects(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("image_path"), F.col("text").alias("extracted_text"), F.col("source").alias("dataset_id"))
    return gates.rejected(gates.with_status(docs, least=LEAST), "bronze").drop("quarantined_at")


@query(
    "row_metrics",
    rf"""WITH {SQL_TOKENS} SELECT c.doc_id::VARCHAR AS image_path, length(c.text) AS extracted_len, length(c.cleaned_text) AS cleaned_len, len(t) AS token_count,
      round(CASE WHEN length(c.text) > 0 THEN length(c.cleaned_text) / length(c.text)::DOUBLE ELSE 1.0 END, 6) AS char_retention,
      round(CASE WHEN length(c.cleaned_text) > 0 THEN coalesce(list_sum(list_transform(t, lambda x: length(x))), 0) / length(c.cleaned_text)::DOUBLE ELSE 0.0 END, 6) AS token_char_coverage,
      len(list_filter(t, lambda x: length(x) = 1)) AS len1_token_count, len(list_filter(t, lambda x: length(x) > 10)) AS long_token_count,
      regexp_matches(c.cleaned_text, '(?i)\d{{4,}}|\?{{3,}}|<\s*html|&[a-z]+;') AS has_noise,
      len(list_filter(string_split(c.cleaned_text, ' '), lambda x: regexp_full_match(x, '\p{{Nd}}+'))) > 0 AS has_digit_token
    FROM (SELECT c.*, coalesce(tok.tokens, []) AS t FROM clean c LEFT JOIN tok USING (doc_id)) c""",
)
def row_metrics(spark, d):
    silver = cleaned(spark, d).select(F.col("doc_id").cast("string").alias("image_path"), "extracted_text", "cleaned_text", text.split_tokens(F.col("cleaned_text")).alias("tokens"))
    out = _rounded(gates.row_metrics(silver), "char_retention", "token_char_coverage")
    return out.withColumns({c: F.col(c).cast("long") for c in ("extracted_len", "cleaned_len", "token_count", "len1_token_count", "long_token_count")})


SQL_SUMMARY = f"SELECT count(*) AS total_rows, count(*) FILTER (ocr_status = 'ok') AS ok_rows, count(*) FILTER (ocr_status <> 'ok') AS reject_rows, coalesce(count(*) FILTER (ocr_status <> 'ok') / count(*)::DOUBLE, 0.0) AS reject_rate FROM ({SQL_STATUS})"


@query("quarantine_summary", SQL_SUMMARY)
def quarantine_summary(spark, d):
    return gates.quarantine_summary(_tagged(spark, d))


@query("melt_decision", f"SELECT total_rows, reject_rows, CASE WHEN total_rows <= 0 THEN 'pass' WHEN reject_rate >= 0.3 THEN 'hard' WHEN reject_rate > 0.02 THEN 'soft' ELSE 'pass' END AS level FROM ({SQL_SUMMARY})")
def melt_decision(spark, d):
    return quarantine_summary(spark, d).select("total_rows", "reject_rows", gates.melt_column(F.col("total_rows"), F.col("reject_rate"), soft=0.02).alias("level"))


def _silver(spark, d):
    """Documents as silver rows, keyed so that some keys repeat and some are null."""
    key = F.when(F.col("doc_id") % 97 != 0, F.col("doc_id") - F.when(F.col("doc_id") % 50 == 1, 1).otherwise(0)).cast("string")
    return cleaned(spark, d).select(key.alias("image_path"), "extracted_text", "cleaned_text", text.split_tokens(F.col("cleaned_text")).alias("tokens"))


SQL_METRICS = rf"""WITH {SQL_TOKENS}, s AS (
  SELECT CASE WHEN c.doc_id % 97 <> 0 THEN c.doc_id - CASE WHEN c.doc_id % 50 = 1 THEN 1 ELSE 0 END END AS k, c.text, c.cleaned_text, coalesce(t.tokens, []) AS tokens
  FROM clean c LEFT JOIN tok t USING (doc_id))
SELECT count(*) AS total_rows, count(*) FILTER (k IS NULL) AS null_image_path_rows, count(*) FILTER (text IS NULL) AS null_extracted_text_rows,
  count(*) FILTER (cleaned_text IS NULL) AS null_cleaned_text_rows, count(*) FILTER (regexp_matches(cleaned_text, '(?i)\d{{4,}}|\?{{3,}}|<\s*html|&[a-z]+;')) AS noise_cleaned_text_rows,
  count(*) FILTER (len(list_filter(string_split(cleaned_text, ' '), lambda x: regexp_full_match(x, '\p{{Nd}}+'))) > 0) AS pure_digit_token_in_cleaned_rows,
  sum(len(tokens))::BIGINT AS total_token_instances, sum(len(list_filter(tokens, lambda x: length(x) = 1)))::BIGINT AS len1_token_instances,
  sum(len(list_filter(tokens, lambda x: length(x) > 10)))::BIGINT AS long_token_instances, round(avg(CASE WHEN trim(cleaned_text) = '' THEN 1.0 ELSE 0.0 END), 6) AS empty_cleaned_text_ratio,
  round(avg(CASE WHEN len(tokens) > 0 THEN 1.0 ELSE 0.0 END), 6) AS nonempty_tokens_ratio,
  round(avg(CASE WHEN length(trim(text)) = 0 THEN 1.0 ELSE length(trim(cleaned_text))::DOUBLE / length(trim(text)) END), 6) AS avg_char_retention,
  (SELECT coalesce(sum(c), 0)::BIGINT FROM (SELECT count(*) AS c FROM s WHERE k IS NOT NULL GROUP BY k) WHERE c > 1) AS duplicate_image_path_rows FROM s"""


@query("silver_quality_metrics", SQL_METRICS)
def silver_quality_metrics(spark, d):
    return _rounded(gates.quality_metrics(_silver(spark, d)), "empty_cleaned_text_ratio", "nonempty_tokens_ratio", "avg_char_retention")


@query(
    "silver_quality_checks",
    f"""WITH m AS ({SQL_METRICS}) SELECT unnest(['duplicates', 'nulls', 'noise', 'digits', 'long_tokens', 'retention']) AS check_name,
      unnest([duplicate_image_path_rows = 0, null_image_path_rows + null_extracted_text_rows + null_cleaned_text_rows = 0, noise_cleaned_text_rows <= 0.001 * total_rows,
      pure_digit_token_in_cleaned_rows = 0, long_token_instances <= 0.005 * total_token_instances, avg_char_retention >= 0.15]) AS passed FROM m""",
)
def silver_quality_checks(spark, d):
    checks = {
        "duplicates": "duplicate_image_path_rows = 0", "nulls": "null_image_path_rows + null_extracted_text_rows + null_cleaned_text_rows = 0",
        "noise": "noise_cleaned_text_rows <= 0.001 * total_rows", "digits": "pure_digit_token_in_cleaned_rows = 0",
        "long_tokens": "long_token_instances <= 0.005 * total_token_instances", "retention": "avg_char_retention >= 0.15",
    }
    each = F.array(*[F.struct(F.lit(k).alias("check_name"), F.expr(v).alias("passed")) for k, v in checks.items()])
    return silver_quality_metrics(spark, d).select(F.explode(each).alias("c")).select("c.*")


@query("noise_rows", rf"SELECT doc_id FROM documents WHERE regexp_matches(text, '{text.NOISE}')")
def noise_rows(spark, d):
    return table(spark, d, "documents").filter(text.is_noise(F.col("text"))).select("doc_id")


# topics ------------------------------------------------------------------------------------------------------------------


def _sql_topics() -> str:
    """The exact funnel over joined tokens, rule by rule."""
    any_ = lambda xs: "(" + " OR ".join(xs) + ")" if xs else "false"
    held = lambda t: f"contains(s, '{t}') OR contains(j, '{t}')"
    neg = "".join(RULES.negations)
    stated = lambda ts: f"regexp_matches(j, '(^|[^{neg}])({'|'.join(ts)})')"
    all_negatives = list(dict.fromkeys([*RULES.negatives, *[n for t in RULES.topics if t.anchors for n in t.negatives]]))
    negative = any_([*[f"contains(j, '{p}')" for p in RULES.good_bad], stated(all_negatives)])
    cases = []
    for t in RULES.topics:
        aware = [p for p in t.phrases if p in RULES.negation_aware]
        weak = [p for p in t.phrases if p in RULES.weak and p not in RULES.negation_aware]
        plain = [p for p in t.phrases if p not in RULES.weak and p not in RULES.negation_aware]
        yes = [any_([held(p) for p in plain]), f"({any_([held(p) for p in weak])} AND negative)", *([stated(aware)] if aware else [])]
        if t.anchors:
            a, n = "|".join(t.anchors), "|".join(t.negatives)
            near = f"regexp_matches(j, '({a}).{{0,{t.char_gap}}}({n})|({n}).{{0,{t.char_gap}}}({a})')"
            is_anchor = any_([f"contains(w, '{x}') OR contains('{x}', w)" for x in t.anchors])
            pos = lambda test: f"list_filter(list_transform(tokens, lambda w, i: CASE WHEN {test} THEN i END), lambda i: i IS NOT NULL)"
            bad = pos(f"w IN ({sql_list(t.negatives)})")
            words = f"len(list_filter({pos(is_anchor)}, lambda i: len(list_filter({bad}, lambda k: abs(i - k) <= {t.word_gap})) > 0)) > 0"
            yes.append(f"({any_([held(x) for x in t.anchors])} AND {any_([held(x) for x in t.negatives])} AND ({words} OR {near}))")
        cases.append(f"CASE WHEN {' OR '.join(yes)} THEN '{t.name}' END")
    return f"""WITH {SQL_TOKENS}, j AS (SELECT doc_id, tokens, array_to_string(tokens, ' ') AS s, array_to_string(tokens, '') AS j FROM tok),
      n AS (SELECT *, {negative} AS negative FROM j), t AS (SELECT doc_id, list_filter([{", ".join(cases)}], lambda x: x IS NOT NULL) AS topics FROM n)"""


def _topics(spark, d):
    return tokens(spark, d).select("doc_id", funnel.exact_topics(F.col("tokens"), RULES).alias("topics"))


@query("topic_labels_exact", f"{_sql_topics()} SELECT d.doc_id, coalesce(array_to_string(t.topics, ','), '') AS topics FROM documents d LEFT JOIN t USING (doc_id)")
def topic_labels_exact(spark, d):
    return _topics(spark, d).select("doc_id", F.array_join("topics", ",").alias("topics"))


@query("topic_frequency_exact", f"{_sql_topics()} SELECT topic, count(*) AS frequency FROM (SELECT unnest(topics) AS topic FROM t) GROUP BY 1")
def topic_frequency_exact(spark, d):
    return funnel.topic_frequency(_topics(spark, d), "topics")


def _sql_review() -> str:
    """Sentiment, recalled and unconfirmed topics without fuzzy matching, on top of the topics."""
    held = lambda t: f"contains(s, '{t}') OR contains(j, '{t}')"
    seeds = funnel.Funnel(RULES).seeds
    recalled = ", ".join(f"CASE WHEN {' OR '.join(held(x) for x in seeds[t.name])} THEN '{t.name}' END" for t in RULES.topics)
    return f"""{_sql_topics()}, r AS (SELECT doc_id, negative, {" OR ".join(held(p) for p in RULES.positives)} AS positive, list_filter([{recalled}], lambda x: x IS NOT NULL) AS recalled FROM n)
    SELECT d.doc_id, CASE WHEN r.negative OR len(t.topics) > 0 THEN 'negative' WHEN r.positive THEN 'positive' ELSE 'neutral' END AS sentiment, coalesce(array_to_string(t.topics, ','), '') AS topics,
      coalesce(array_to_string(r.recalled, ','), '') AS candidates, coalesce(array_to_string(list_filter(r.recalled, lambda x: NOT list_contains(t.topics, x)), ','), '') AS filtered_out
    FROM documents d LEFT JOIN t USING (doc_id) LEFT JOIN r USING (doc_id)"""


@query("review_analysis_exact", _sql_review())
def review_analysis_exact(spark, d):
    """The whole funnel, its Arrow form, with fuzzy matching off."""
    a = tokens(spark, d).select("doc_id", funnel.analysis(F.col("tokens"), rules=RULES, fuzzy=False).alias("a"))
    lists = {"topics": "a.pain_topics", "candidates": "a.pain_candidates", "filtered_out": "a.filtered_out"}
    return a.select("doc_id", "a.sentiment", *[F.array_join(c, ",").alias(n) for n, c in lists.items()])


def _analysed(spark, d):
    turns = table(spark, d, "conversations").select("conv_id", "turn", text.split_tokens(text.clean_text(F.col("text"))).alias("tokens"))
    return turns.select("conv_id", "turn", funnel.analysis(F.col("tokens"), rules=RULES).alias("a"))


@query("topic_frequency_fuzzy")
def topic_frequency_fuzzy(spark, d):
    return funnel.topic_frequency(_analysed(spark, d), "a.pain_topics")


@query("review_sentiment")
def review_sentiment(spark, d):
    return _analysed(spark, d).select(
        "conv_id", "turn", "a.sentiment", F.array_join("a.pain_topics", ",").alias("topics"), F.array_join("a.filtered_out", ",").alias("filtered_out")
    )


@query("fuzzy_ratio")
def fuzzy_ratio(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    return p.select("p_partkey", fuzzy.ratio_column(F.col("p_name"), F.col("p_type")).alias("ratio"), fuzzy.ratio_column(F.col("p_name"), F.col("p_type"), True).alias("partial"))


# snapshots, audits, freshness --------------------------------------------------------------------------------------------


def _series(spark, d):
    e = table(spark, d, "events")
    return e.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("snapshot_at"), (F.col("user_id") % 3).cast("string").alias("dataset_id"), F.col("event_type").alias("topic")).agg(
        F.count(F.lit(1)).alias("frequency"), F.concat(F.lit("v"), F.max(F.col("event_id") % 2)).alias("release_lexicon_version")
    )


SQL_SERIES = "SELECT date_trunc('day', ts) AS snapshot_at, (user_id % 3)::VARCHAR AS dataset_id, event_type AS topic, count(*) AS frequency, 'v' || max(event_id % 2) AS release_lexicon_version FROM events GROUP BY 1, 2, 3"


@query("snapshot_latest", f"WITH s AS ({SQL_SERIES}) SELECT * FROM s WHERE (dataset_id, snapshot_at) IN (SELECT dataset_id, max(snapshot_at) FROM s GROUP BY 1)")
def snapshot_latest(spark, d):
    return snapshots.latest(_series(spark, d))


@query("snapshot_list", f"SELECT DISTINCT snapshot_at FROM ({SQL_SERIES}) ORDER BY 1 DESC LIMIT 10")
def snapshot_list(spark, d):
    return snapshots.listed(_series(spark, d), 10)


@query("snapshot_at_time", f"WITH s AS ({SQL_SERIES}) SELECT * FROM s WHERE snapshot_at = (SELECT max(snapshot_at) FROM s) - INTERVAL 2 DAY")
def snapshot_at_time(spark, d):
    """The snapshot nearest to a time that is half a second off the wanted one."""
    s = _series(spark, d).withColumn("snapshot_at", F.col("snapshot_at").cast("timestamp"))
    wanted = s.agg((F.max("snapshot_at") - F.expr("interval 2 days") + F.expr("interval 500 milliseconds")).alias("_w"))
    near = s.crossJoin(F.broadcast(wanted))
    return snapshots.at_time(near, F.col("_w")).drop("_w").withColumn("snapshot_at", F.col("snapshot_at").cast("timestamp_ntz"))


@query("snapshot_compare", f"SELECT * FROM ({SQL_SERIES}) WHERE snapshot_at IN (SELECT DISTINCT snapshot_at FROM ({SQL_SERIES}) ORDER BY 1 DESC LIMIT 2)")
def snapshot_compare(spark, d):
    s = _series(spark, d)
    return s.join(F.broadcast(snapshots.listed(s, 2)), "snapshot_at", "left_semi")


@query("snapshot_changes", f"SELECT *, lag(frequency) OVER w AS previous, frequency - coalesce(lag(frequency) OVER w, 0) AS change FROM ({SQL_SERIES}) WINDOW w AS (PARTITION BY dataset_id, topic ORDER BY snapshot_at)")
def snapshot_changes(spark, d):
    return snapshots.changes(_series(spark, d))


@query("snapshot_release", f"SELECT * FROM ({SQL_SERIES}) WHERE release_lexicon_version = 'v1'")
def snapshot_release(spark, d):
    return snapshots.of_release(_series(spark, d), version="v1", content_hash="not a column")


@query("release_latest", f"WITH s AS (SELECT * FROM ({SQL_SERIES}) WHERE release_lexicon_version = 'v1') SELECT * FROM s WHERE (dataset_id, snapshot_at) IN (SELECT dataset_id, max(snapshot_at) FROM s GROUP BY 1)")
def release_latest(spark, d):
    return snapshots.latest_of_release(_series(spark, d), version="v1")


@query(
    "audit_findings",
    """SELECT * FROM (VALUES ('runtime.silver_version', 'FAIL'), ('runtime.rule_version', 'PASS'), ('gold.exploration_note', 'PASS'), ('gold.release_lexicon_hash_missing', 'WARN')) t(check_id, level)
    UNION ALL SELECT CASE WHEN count(*) = 0 THEN 'bronze.empty' WHEN count(*) FILTER (lang <> 'en') > 0 THEN 'bronze.unexpected_signature' WHEN count(DISTINCT source) > 1 THEN 'bronze.mixed_signatures' ELSE 'bronze.signatures_ok' END,
      CASE WHEN count(*) = 0 THEN 'WARN' WHEN count(*) FILTER (lang <> 'en') > 0 THEN 'FAIL' WHEN count(DISTINCT source) > 1 THEN 'WARN' ELSE 'PASS' END FROM documents
    UNION ALL SELECT CASE WHEN count(*) FILTER (quality = 1) = 0 THEN 'silver.version_missing' WHEN count(*) FILTER (quality <> 1) > 0 THEN 'silver.stale_version' ELSE 'silver.version_ok' END,
      CASE WHEN count(*) FILTER (quality <> 1) = 0 AND count(*) > 0 THEN 'PASS' ELSE 'FAIL' END FROM labels
    UNION ALL SELECT 'gold.snapshot_ok', 'PASS' UNION ALL SELECT 'gold.approved_missing', 'FAIL'""",
)
def audit_findings(spark, d):
    """The audit's findings over documents as bronze, labels as silver and the events' series as snapshots."""
    bronze = table(spark, d, "documents").select(F.concat(F.lit("lang="), "lang", F.lit("|src="), "source").alias("ocr_signature"))
    silver = table(spark, d, "labels").select(F.concat(F.lit("v"), "quality").alias("silver_transform_version"))
    gold = _series(spark, d).withColumn("rule_version", F.lit(RULES.version))
    manifest = {"runtime": {"silver_transform_version": "v1"}, "gold": {"topic_rule_version": "v1", "approved_snapshot_at": "1999-01-01"}, "bronze": {"allowed_ocr_signatures": ["lang=en"]}}
    found = snapshots.verified(gold, "1", F.to_timestamp(F.lit("1999-01-01")), "v1")
    findings = audit.run_audit(manifest, lexicon.Lexicon("1", STOP, STOP + EXTRA_STOP), "v2", RULES.version, audit.table_facts(bronze, silver, gold), found)
    return spark.createDataFrame([(f.check_id, f.level) for f in findings], "check_id string, level string")


ALLOWED = ("lang=en|src=src1", "lang=de|src=src2")


@query("signature_audit", "SELECT sig AS ocr_signature, count(*) AS n, (contains(sig, 'lang=en') AND contains(sig, 'src=src1')) OR (contains(sig, 'lang=de') AND contains(sig, 'src=src2')) AS allowed FROM (SELECT 'tesseract|lang=' || lang || '|src=' || source AS sig FROM documents) GROUP BY 1")
def signature_audit(spark, d):
    docs = table(spark, d, "documents").select(F.concat(F.lit("tesseract|lang="), "lang", F.lit("|src="), "source").alias("ocr_signature"))
    counts = docs.groupBy("ocr_signature").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("allowed", text.signature_allowed(F.col("ocr_signature"), ALLOWED))


@query("version_audit", "SELECT 'v' || quality AS version, count(*) AS n, quality = 1 AS expected FROM labels GROUP BY quality")
def version_audit(spark, d):
    rows_ = table(spark, d, "labels").select(F.concat(F.lit("v"), "quality").alias("version")).groupBy("version").agg(F.count(F.lit(1)).alias("n"))
    return rows_.withColumn("expected", F.col("version") == "v1")


SQL_LAG = """SELECT source AS dataset_id, count(DISTINCT d.doc_id) AS raw_images, count(DISTINCT l.doc_id) AS silver_images, count(DISTINCT CASE WHEN l.toxic = 0 THEN l.doc_id END) AS release_images
  FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1"""


def _lag(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("dataset_id"), F.col("doc_id").alias("image_path"))
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("image_path"), "toxic")
    silver = docs.join(labels, "image_path").select("dataset_id", "image_path", "toxic")
    return audit.lag_table(docs, silver, silver.filter("toxic = 0"))


@query("freshness_lag", f"SELECT *, greatest(raw_images - silver_images, 0) AS upstream_lag, greatest(silver_images - release_images, 0) AS release_lag FROM ({SQL_LAG})")
def freshness_lag(spark, d):
    return _lag(spark, d)


@query("coverage", f"SELECT dataset_id, round(silver_images / raw_images::DOUBLE, 6) AS coverage FROM ({SQL_LAG})")
def coverage(spark, d):
    return _lag(spark, d).select("dataset_id", F.round(F.try_divide("silver_images", "raw_images"), 6).alias("coverage"))


# sources and scalars -----------------------------------------------------------------------------------------------------


@query("sha256_hash", "SELECT page_id, sha256(html) AS file_hash FROM pages")
def sha256_hash(spark, d):
    return table(spark, d, "pages").select("page_id", F.sha2("html", 256).alias("file_hash"))


SQL_PATH = "SELECT page_id, 's3a://b/raw/images/' || split_part(url, '/', 3) || '/' || page_id || CASE page_id % 4 WHEN 0 THEN '.PNG' WHEN 1 THEN '.jpeg' WHEN 2 THEN '.txt' ELSE '' END AS path FROM pages"


def _paths(spark, d):
    ext = F.element_at(strings([".PNG", ".jpeg", ".txt", ""]), (F.col("page_id") % 4 + 1).cast("int"))
    return table(spark, d, "pages").select("page_id", F.concat(F.lit("s3a://b/raw/images/"), F.split_part("url", F.lit("/"), F.lit(3)), F.lit("/"), "page_id", ext).alias("path"))


@query("dataset_from_path", f"SELECT page_id, regexp_extract(path, '/raw/images/([^/]+)/', 1) AS dataset_id FROM ({SQL_PATH})")
def dataset_from_path(spark, d):
    return _paths(spark, d).select("page_id", text.dataset_of_path(F.col("path")).alias("dataset_id"))


@query("media_ext_filter", f"SELECT page_id, path FROM ({SQL_PATH}) WHERE regexp_matches(lower(path), '\\.(png|jpg|jpeg|bmp|gif|webp|tif|tiff)$')")
def media_ext_filter(spark, d):
    return _paths(spark, d).filter(F.lower("path").rlike(text.IMAGE_NAME))


@query("datasets_listed", f"SELECT regexp_extract(path, '/raw/images/([^/]+)/', 1) AS dataset_id, count(*) AS images FROM ({SQL_PATH}) GROUP BY 1")
def datasets_listed(spark, d):
    from ..sources.files import datasets

    return datasets(_paths(spark, d).withColumn("dataset_id", text.dataset_of_path(F.col("path"))))


@query("path_parts", f"SELECT page_id, 'b' AS bucket, substr(path, length('s3a://b/') + 1) AS key FROM ({SQL_PATH})")
def path_parts(spark, d):
    return _paths(spark, d).select("page_id", text.bucket_and_key(F.col("path")).alias("p")).select("page_id", "p.*")


@query(
    "object_paths",
    f"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN path WHEN 1 THEN 's3a://b/raw/images/x/' || page_id ELSE 's3a://b/raw/images/' || page_id || '.png' END AS path FROM ({SQL_PATH})""",
)
def object_paths(spark, d):
    n = F.col("page_id").cast("string")
    short = F.when(F.col("page_id") % 3 == 0, F.col("path")).when(F.col("page_id") % 3 == 1, F.concat(F.lit("raw/images/x/"), n)).otherwise(F.concat(F.lit(" "), n, F.lit(".png")))
    return _paths(spark, d).select("page_id", text.object_path(short, "b").alias("path"))


SHORT = ("a.png", "raw/x/b.png", " c/d.png ", None, "s3a://o/e.png", "a.png")


@query("paths_batched", "SELECT * FROM (VALUES (0, 's3a://b/base/a.png'), (0, 's3a://b/raw/x/b.png'), (1, 's3a://b/raw/images/c/d.png'), (1, 's3a://o/e.png')) t(batch, path)")
def paths_batched(spark, d):
    parts = files.batches(keys.full_paths(SHORT, "b", "base"), 5, 2)
    return spark.createDataFrame([(i, p) for i, part in enumerate(parts) for p in part], "batch int, path string")


@query(
    "image_files",
    "SELECT * FROM (VALUES ('a', 'all', 2), ('b', 'all', 1), ('a', 'first', 2), ('a', 'real', 1), ('b', 'real', 1)) t(dataset_id, kind, images)",
)
def image_files(spark, d):
    """Images in folders: listed by dataset, the first two by path, and those that really are images."""
    at = files.shared_folder(spark) + "/raw/images"
    png = "\x89PNG\r\n\x1a\n"
    for name in ("a/1.png", "a/2.PNG", "b/3.png", "a/notes.txt"):
        files.write_bytes(spark, f"{at}/{name}", (png if name != "a/2.PNG" else "text").encode("latin-1"))
    listing = files.image_listing(spark, at)
    real = files.real_images(files.images(spark, at)).withColumn("dataset_id", text.dataset_of_path(F.col("image_path")))
    first = files.first_images(spark, at, 2).withColumn("dataset_id", text.dataset_of_path(F.col("image_path")))
    parts = [files.datasets(x).withColumn("kind", F.lit(k)) for k, x in (("all", listing), ("first", first), ("real", real))]
    return reduce(DataFrame.unionByName, parts).select("dataset_id", "kind", "images")


@query(
    "upload_verdicts",
    "SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'not_an_image' WHEN 2 THEN 'extension' WHEN 3 THEN 'video' ELSE 'no_name' END AS verdict FROM pages",
)
def upload_verdicts(spark, d):
    pick = lambda values: F.element_at(strings(values), (F.col("page_id") % 5 + 1).cast("int"))
    name, mime = pick(["a.png", "a.jpg", "a.txt", "a.png", " "]), pick(["image/png", "image/jpeg", "text/plain", "video/mp4", "image/png"])
    content = F.unhex(pick(["89504E470D0A1A0A00", "3C68746D6C3E", "00", "89504E470D0A1A0A00", "00"]))
    return table(spark, d, "pages").select("page_id", text.upload_verdict(name, mime, content).alias("verdict"))


@query("cjk_collapsed", "SELECT doc_id, '好喝 ' || source || ' 很好' AS t, '茶葉' AS u FROM documents")
def cjk_collapsed(spark, d):
    t = F.concat(F.lit("好 \u3000喝 "), "source", F.lit(" 很 好"))
    return table(spark, d, "documents").select("doc_id", text.collapse_cjk(t).alias("t"), text.collapse_cjk(F.lit("茶 葉")).alias("u"))


def _hashing_engine(content: bytes, config: recognise.Config) -> tuple[str, str]:
    import hashlib

    return f"{hashlib.sha256(content).hexdigest()} {'x' * int(config.mode)}", recognise.signature(config)


def _scans(spark, d):
    pages = table(spark, d, "pages")
    return pages.select(F.concat(F.lit("/raw/images/p/"), "page_id").alias("image_path"), F.encode("html", "utf-8").alias("image_content"))


@query(
    "ocr_rows",
    """SELECT '/raw/images/p/' || page_id AS image_path, sha256(html) AS file_hash, 'p' AS dataset_id, sha256(html) || ' xxxxxx' AS extracted_text,
      'tesseract|lang=chi_tra+eng|psm=6|pre=v1.1|profile=dark_ui|scale=1500|ctr=2.0|shp=1.5|bin=adaptive' AS ocr_signature FROM pages""",
)
def ocr_rows(spark, d):
    return recognise.recognised(_scans(spark, d), recognise.Config(), _hashing_engine)


@query(
    "psm_ab",
    """SELECT psm, count(*) AS n_rows, 0::BIGINT AS error_rows, 0::BIGINT AS empty_rows, (65.0 + psm::INT)::DOUBLE AS avg_chars, 0.0::DOUBLE AS avg_cjk_gaps,
      sum(CASE WHEN contains(sha256(html), 'abc') THEN 1 ELSE 0 END + CASE WHEN psm = '11' THEN 1 ELSE 0 END)::BIGINT AS total_hits FROM pages, (VALUES ('6'), ('11')) m(psm) GROUP BY psm""",
)
def psm_ab(spark, d):
    return recognise.compare_modes(_scans(spark, d), recognise.Config(), ("6", "11"), ("abc", "xxxxxxxxxxx"), _hashing_engine)


KEYWORDS = ("the", "license", "Que", "und", "nowhere")


@query("keyword_hits", f"SELECT doc_id, array_to_string(list_filter([{sql_list(KEYWORDS)}], lambda k: contains(lower(text), lower(k))), ',') AS hits FROM documents")
def keyword_hits(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(text.keyword_hits(F.col("text"), KEYWORDS), ",").alias("hits"))


@query(
    "ab_summary",
    rf"""SELECT lang AS side, count(*) AS n_rows, count(*) FILTER (starts_with(text, 'OCR_ERROR_')) AS error_rows, count(*) FILTER (trim(text) = '') AS empty_rows,
      round(avg(length(text)), 1) AS avg_chars, 0.0::DOUBLE AS avg_cjk_gaps, sum(len(list_filter([{sql_list(KEYWORDS)}], lambda k: contains(lower(text), lower(k)))))::BIGINT AS total_hits FROM documents GROUP BY 1""",
)
def ab_summary(spark, d):
    docs = table(spark, d, "documents").select(F.col("lang").alias("side"), "text")
    return recognise.side_summary(recognise.text_metrics(docs, "text", KEYWORDS), "side")


@query("display_time", "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') || ' （台北）' AS shown FROM events")
def display_time(spark, d):
    return table(spark, d, "events").select("event_id", text.display_time(F.col("ts").cast("timestamp")).alias("shown"))


# extensions --------------------------------------------------------------------------------------------------------------


@query("events_tumbling", "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def events_tumbling(spark, d):
    return increment.tumbling(table(spark, d, "events"), "ts", ["event_type"]).withColumn("total", F.round("total", 4))


@query(
    "events_session",
    """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM (
      SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""",
)
def events_session(spark, d):
    return increment.sessions(table(spark, d, "events"), "ts", ["user_id"])
