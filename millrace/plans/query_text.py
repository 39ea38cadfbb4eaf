"""Queries of text functions, quality filters and language rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions import text as T
from ..functions.python import compiles, first_json_object
from ..operators import quality
from .registry import Tables, query

SP = r"[\s\x0B\x1c-\x1f\x85\p{Z}]+"
NORM = lambda x: f"trim(regexp_replace(replace(lower(coalesce({x}, '')), 'ß', 'ss'), '{SP}', ' ', 'g'))"
WORDS = lambda x: rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"
GRAMS = lambda w, n: f"list_transform(range(1, len({w}) - {n} + 2), lambda i: array_to_string({w}[i : i + {n} - 1], ' '))"
SENTENCES = lambda x: rf"list_filter(list_transform(regexp_split_to_array(regexp_replace({x}, '([.!?。])\s+', '\1' || chr(10), 'g'), '\n+'), lambda s: trim(regexp_replace(s, '{SP}', ' ', 'g'))), lambda s: s <> '')"
PLANTED = "CASE doc_id % 5 WHEN 0 THEN text || chr(10) || '```python' || chr(10) || 'x = 1' || chr(10) || '```' || ' tail' WHEN 1 THEN '\\frac{a}{b} ' || text || ' ```open' ELSE text END"
VI = T.VIETNAMESE_LETTERS


def quoted(names):
    return ", ".join(f"'{n}'" for n in names)


LANG = lambda x: rf"""CASE WHEN length(regexp_replace({x}, '[^\p{{L}}]', '', 'g')) < 20 THEN 'unknown'
  WHEN length(regexp_replace({x}, '[^\p{{Latin}}a-z]', '', 'g')) * 10 < length(regexp_replace({x}, '[^\p{{L}}]', '', 'g')) * 7 THEN 'other'
  WHEN length(regexp_replace({x}, '[^{VI}]', '', 'g')) * 20 >= length(regexp_replace({x}, '[^\p{{Latin}}a-z]', '', 'g')) THEN 'vi'
  WHEN len(list_filter({WORDS(x)}, lambda w: w IN ({quoted(T.VIETNAMESE_ASCII_WORDS)}))) * 100 >= len({WORDS(x)}) * 8 THEN 'vi-khong-dau'
  WHEN len(list_filter({WORDS(x)}, lambda w: w IN ({quoted(T.ENGLISH_WORDS)}))) * 20 >= len({WORDS(x)}) THEN 'en' ELSE 'unknown' END"""  # noqa: E731


@query(f"SELECT doc_id, {NORM('text')} AS normalized FROM documents")
def text_normalize(t: Tables):
    return t.documents.select("doc_id", T.normalize(F.col("text")).alias("normalized"))


APART = "replace(replace(text, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776))"


@query(f"SELECT doc_id, {NORM(f'nfc_normalize({APART})')} AS normalized, {LANG(f'lower(nfc_normalize({APART}))')} AS language FROM documents")
def text_nfc(t: Tables):
    """Texts whose accents are characters of their own."""
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("e\u0301")), F.lit("ü"), F.lit("u\u0308"))
    return t.documents.select("doc_id", T.normalize(apart).alias("normalized"), T.detect_language(apart).alias("language"))


def planted_text():
    fence = F.concat(F.col("text"), F.lit("\n```python\nx = 1\n```"), F.lit(" tail"))
    return F.when(F.col("doc_id") % 5 == 0, fence).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("\\frac{a}{b} "), "text", F.lit(" ```open"))).otherwise(F.col("text"))


@query(rf"SELECT doc_id, regexp_replace(regexp_replace(x, '(?s)```.*?(```|\z)', ' ', 'g'), '\\[A-Za-z]+', ' ', 'g') AS prose FROM (SELECT doc_id, {PLANTED} AS x FROM documents)")
def text_prose(t: Tables):
    return t.documents.select("doc_id", T.prose(planted_text()).alias("prose"))


@query(f"SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct FROM (SELECT doc_id, {WORDS(NORM('text'))} AS w FROM documents)")
def text_tokens(t: Tables):
    w = T.words(T.normalize(F.col("text")))
    return t.documents.select("doc_id", w.alias("w")).select("doc_id", F.size("w").cast("bigint").alias("n_words"), F.size(F.array_distinct("w")).cast("bigint").alias("n_distinct"))


@query(f"""WITH s AS (SELECT doc_id, list_filter(list_transform({SENTENCES('text')}, lambda s: replace(lower(s), 'ß', 'ss')), lambda s: length(s) >= 20) AS s FROM documents)
SELECT doc_id, CAST(len(s) AS BIGINT) AS sentences, CASE WHEN len(s) = 0 THEN 0.0::DOUBLE ELSE 1 - len(list_distinct(s))::DOUBLE / len(s) END AS share FROM s""")
def text_sentence_dup(t: Tables):
    s = t.documents.select("doc_id", F.filter(T.sentences(T.fold(F.col("text"))), lambda x: F.length(x) >= 20).alias("s"))
    return s.select("doc_id", F.size("s").cast("bigint").alias("sentences"), T.repeated_share(F.col("s")).alias("share"))


@query(f"""WITH g AS (SELECT doc_id, {GRAMS('w', 5)} AS g FROM (SELECT doc_id, {WORDS(NORM('text'))} AS w FROM documents))
SELECT doc_id, CAST(len(g) AS BIGINT) AS grams, CASE WHEN len(g) = 0 THEN 0.0::DOUBLE ELSE 1 - len(list_distinct(g))::DOUBLE / len(g) END AS share FROM g""")
def text_ngram_dup(t: Tables):
    g = t.documents.select("doc_id", T.ngrams(T.words(T.normalize(F.col("text"))), 5).alias("g"))
    return g.select("doc_id", F.size("g").cast("bigint").alias("grams"), T.repeated_share(F.col("g")).alias("share"))


@query(rf"""WITH w AS (SELECT doc_id, unnest({WORDS(NORM('text'))}) AS w, generate_subscripts({WORDS(NORM('text'))}, 1) AS i FROM documents),
k AS (SELECT doc_id, i, w, length(regexp_replace(w, '[^\p{{L}}]', '', 'g')) >= 2 AS ok, lag(w) OVER (PARTITION BY doc_id ORDER BY i) IS DISTINCT FROM w AS fresh FROM w),
g AS (SELECT doc_id, ok, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM k), r AS (SELECT doc_id, g, count(*) AS n FROM g WHERE ok GROUP BY ALL)
SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS longest_run FROM documents d LEFT JOIN r USING (doc_id) GROUP BY d.doc_id""")
def text_word_run(t: Tables):
    return t.documents.select("doc_id", T.longest_word_run(T.words(T.normalize(F.col("text")))).cast("bigint").alias("longest_run"))


@query(f"""SELECT doc_id, CASE WHEN len(w) = 0 THEN 0 WHEN len(w) < 3 THEN 1 ELSE len(list_distinct({GRAMS('w', 3)})) END::BIGINT AS n_shingles FROM (SELECT doc_id, {WORDS(NORM('text'))} AS w FROM documents)""")
def text_shingles(t: Tables):
    return t.documents.select("doc_id", F.size(T.shingles(T.words(T.normalize(F.col("text"))), 3)).cast("bigint").alias("n_shingles"))


@query(r"""SELECT event_id, len(regexp_extract_all(props, '\d+'))::BIGINT AS n, list_sum(list_transform(regexp_extract_all(props, '\d+'), lambda x: x::BIGINT))::BIGINT AS total FROM events""")
def text_numbers(t: Tables):
    n = T.integers(F.col("props"))
    return t.events.select("event_id", F.size(n).cast("bigint").alias("n"), F.when(F.size(n) > 0, F.aggregate(n, F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("total"))


@query(f"SELECT doc_id, {LANG('x')} AS language FROM (SELECT doc_id, replace(lower(coalesce(text, '')), 'ß', 'ss') AS x FROM documents)")
def lang_detect(t: Tables):
    return t.documents.select("doc_id", T.detect_language(F.col("text")).alias("language"))


CONV = "SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m FROM conversations GROUP BY conv_id"
FLAT = lambda role: f"array_to_string(list_transform(list_filter(m, lambda x: x.role = '{role}'), lambda x: x.content), chr(10))"


def conversations(t: Tables):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return t.conversations.groupBy("conv_id").agg(F.transform(turns, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


@query(f"SELECT conv_id, {LANG('x')} AS language FROM (SELECT conv_id, replace(lower({FLAT('user')} || chr(10) || {FLAT('assistant')}), 'ß', 'ss') AS x FROM ({CONV}))")
def lang_conversation(t: Tables):
    user, assistant = quality.flatten("messages")
    return conversations(t).select("conv_id", T.detect_language(T.prose(F.concat(user, F.lit("\n"), assistant))).alias("language"))


FILTER_LANG = f"""SELECT doc_id, CASE WHEN declared IS NOT NULL AND language NOT IN (declared, 'unknown', 'vi') THEN 'source language ' || declared || ', found ' || language
 WHEN language NOT IN ('vi', 'en', 'unknown') THEN 'language ' || language END AS reason FROM (SELECT doc_id, lang AS declared, {LANG('x')} AS language FROM (SELECT doc_id, lang, replace(lower(coalesce(text, '')), 'ß', 'ss') AS x FROM documents))"""


@query(FILTER_LANG)
def filter_language(t: Tables):
    return t.documents.select("doc_id", quality.language_reason(F.col("text"), F.col("lang")).alias("reason"))


LENGTH = """CASE WHEN length(p) < 3 THEN 'prompt shorter than 3' WHEN length(a) < 2 THEN 'answer shorter than 2' WHEN length(p) + length(a) > 16000 THEN 'longer than 16000' END"""
ENDS = lambda x: f"regexp_replace(regexp_replace({x}, '^{SP}', ''), '{SP}$', '')"


@query(f"SELECT conv_id, {LENGTH} AS reason FROM (SELECT conv_id, {ENDS(FLAT('user'))} AS p, {ENDS(FLAT('assistant'))} AS a FROM ({CONV}))")
def filter_length(t: Tables):
    return conversations(t).select("conv_id", quality.length_reason(*quality.flatten("messages")).alias("reason"))


RUNS = rf"""w AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM n), k AS (SELECT doc_id, i, length(regexp_replace(w, '[^\p{{L}}]', '', 'g')) >= 2 AS ok, lag(w) OVER (PARTITION BY doc_id ORDER BY i) IS DISTINCT FROM w AS fresh FROM w),
g AS (SELECT doc_id, ok, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM k), r AS (SELECT doc_id, max(c) AS run FROM (SELECT doc_id, g, count(*) AS c FROM g WHERE ok GROUP BY ALL) GROUP BY ALL)"""
REPEAT = f"""WITH n AS (SELECT doc_id, text, {WORDS(NORM('text'))} AS w FROM documents), {RUNS},
m AS (SELECT n.doc_id, w, coalesce(run, 0) AS run, list_filter(list_transform({SENTENCES('text')}, lambda s: replace(lower(s), 'ß', 'ss')), lambda s: length(s) >= 20) AS s, {GRAMS('w', 5)} AS g FROM n LEFT JOIN r USING (doc_id))
SELECT doc_id, CASE WHEN run > 8 THEN 'word run' WHEN len(w) < 50 THEN NULL WHEN len(s) > 0 AND 1 - len(list_distinct(s))::DOUBLE / len(s) > 0.5 THEN 'sentences' WHEN len(g) > 0 AND 1 - len(list_distinct(g))::DOUBLE / len(g) > 0.5 THEN 'n-grams' END AS reason FROM m"""


@query(REPEAT)
def filter_repetition(t: Tables):
    return t.documents.select("doc_id", quality.repetition_reason(F.col("text")).alias("reason"))


@query(f"""WITH l AS ({FILTER_LANG}), r AS ({REPEAT}), d AS (SELECT d.doc_id, l.reason IS NOT NULL AS l, length(text) > 16000 OR length(text) < 2 AS s, r.reason IS NOT NULL AS r FROM documents d JOIN l USING (doc_id) JOIN r USING (doc_id))
SELECT CASE WHEN l THEN 'language' WHEN s THEN 'length' WHEN r THEN 'repetition' ELSE 'kept' END AS filter, count(*)::BIGINT AS removed FROM d GROUP BY ALL""")
def quality_removed(t: Tables):
    d, text = t.documents, F.col("text")
    first = F.when(quality.language_reason(text, F.col("lang")).isNotNull(), "language").when((F.length(text) > 16000) | (F.length(text) < 2), "length").when(quality.repetition_reason(text).isNotNull(), "repetition").otherwise("kept")
    return d.select(first.alias("filter")).groupBy("filter").agg(F.count("*").alias("removed"))


SECRET_TEXT = "CASE doc_id % 7 WHEN 0 THEN text || ' password = hunter2hunter2' WHEN 1 THEN text || ' hf_abcdefghijklmnopqrstuv' WHEN 2 THEN text || chr(10) || 'DB_PASS=s3cretvalue' WHEN 3 THEN text || chr(10) || 'DB_PASS=$OTHER bypass=12345678' ELSE text END"


def secret_text():
    d, text = F.col("doc_id") % 7, F.col("text")
    return (
        F.when(d == 0, F.concat(text, F.lit(" password = hunter2hunter2")))
        .when(d == 1, F.concat(text, F.lit(" hf_abcdefghijklmnopqrstuv")))
        .when(d == 2, F.concat(text, F.lit("\nDB_PASS=s3cretvalue")))
        .when(d == 3, F.concat(text, F.lit("\nDB_PASS=$OTHER bypass=12345678")))
        .otherwise(text)
    )


@query(f"SELECT doc_id FROM (SELECT doc_id, {SECRET_TEXT} AS x FROM documents) WHERE regexp_matches(x, '{T.SECRET}')")
def secret_scan(t: Tables):
    return t.documents.where(T.has_secret(secret_text())).select("doc_id")


@query("SELECT doc_id FROM (SELECT doc_id, %s AS x FROM documents) WHERE regexp_matches(x, '%s')" % (SECRET_TEXT, T.SECRET_SHELL.replace("'", "''")))
def secret_scan_shell(t: Tables):
    return t.documents.where(T.has_shell_secret(secret_text())).select("doc_id")


@query(f"""SELECT doc_id, CASE WHEN regexp_matches(x, '{T.SECRET}') THEN 'pii_or_secret' WHEN length({ENDS('x')}) < 80 THEN 'too_short' WHEN len(list_distinct(string_split({ENDS('x')}, ''))) < 10 THEN 'low_quality' END AS reason
FROM (SELECT doc_id, {SECRET_TEXT} AS x FROM documents)""")
def corpus_clean_text(t: Tables):
    return t.documents.select("doc_id", quality.corpus_reason(secret_text()).alias("reason"))


@query("SELECT source, sum(strlen(text))::BIGINT AS tokens FROM documents GROUP BY source")
def corpus_token_count(t: Tables):
    return t.documents.groupBy("source").agg(F.sum(F.octet_length("text").cast("bigint")).alias("tokens"))


@query()
def json_extract(t: Tables):
    wrapped = F.concat(F.lit("<think>{\"k\": 0}</think> Answer: "), F.col("props"), F.lit(" end }"))
    return t.events.select("event_id", first_json_object(wrapped).alias("object"))


@query()
def verify_python(t: Tables):
    return t.documents.select("doc_id", compiles(F.concat(F.lit("x = "), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 0, " +").otherwise(""))).alias("passed"))


@query("SELECT doc_id, length(text)::BIGINT AS n FROM documents ORDER BY n DESC, doc_id LIMIT 10")
def doc_topk_longest(t: Tables):
    return t.documents.select("doc_id", F.length("text").cast("bigint").alias("n")).orderBy(F.desc("n"), "doc_id").limit(10)


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 50")
def mem_last_n(t: Tables):
    r = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id")))
    return t.events.withColumn("r", r).where("r <= 50").select("user_id", "event_id")
