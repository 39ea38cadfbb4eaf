"""Queries of exact and near dedup and of decontamination against an evaluation set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.sets import equal_share
from ..operators import guard
from ..operators import similarity as S
from ..operators.dedup import exact_dedup
from ..operators.lineage import shared
from .query_text import GRAMS, NORM, WORDS
from .registry import Tables, query

HASHED = f"SELECT doc_id, sha256({NORM('text')}) AS h FROM documents"


@query(f"SELECT doc_id, h AS content_hash FROM ({HASHED})")
def dedup_content_hash(t: Tables):
    return t.documents.select("doc_id", F.sha2(T.normalize(F.col("text")), 256).alias("content_hash"))


def deduped(t: Tables):
    """Hashes are worked out once, for the groups and the rows that are joined with them."""
    return exact_dedup(shared(t.documents.select("doc_id", F.sha2(T.normalize(F.col("text")), 256).alias("h"))), "doc_id", "h")


@query(f"SELECT min(doc_id) AS doc_id FROM ({HASHED}) GROUP BY h")
def dedup_exact(t: Tables):
    return deduped(t).where("duplicate_of is null").select("doc_id")


@query("SELECT doc_id, nullif(min(doc_id) OVER (PARTITION BY CASE WHEN lang = 'de' THEN NULL ELSE text END), doc_id) AS duplicate_of FROM documents")
def dedup_exact_nulls(t: Tables):
    """Rows without a content are one content."""
    rows = t.documents.select("doc_id", F.when(F.coalesce(F.col("lang") == "de", F.lit(False)), F.lit(None)).otherwise(F.col("text")).alias("h"))
    return exact_dedup(rows, "doc_id", "h").select("doc_id", "duplicate_of")


@query(f"SELECT doc_id, duplicate_of FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS duplicate_of FROM ({HASHED})) WHERE doc_id <> duplicate_of")
def dedup_rejected(t: Tables):
    return deduped(t).where("duplicate_of is not null").select("doc_id", "duplicate_of")


SHINGLED = f"""d AS (SELECT doc_id, {WORDS(NORM('text'))} AS w FROM documents), c AS (SELECT min(doc_id) AS id, w FROM d GROUP BY w),
s AS (SELECT id, unnest(CASE WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct({GRAMS('w', 3)}) END) AS g FROM c WHERE len(w) > 0),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
p AS (SELECT x.id AS a, y.id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.id < y.id GROUP BY ALL),
j AS (SELECT a, b, common, na.n + nb.n - common AS joined FROM p JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE common >= 0.8 * (na.n + nb.n - common))"""


def class_sets(t: Tables):
    """id, rep of every text, and the sets of those that stand for their class: texts are normalised once."""
    texts = S.worded(t.documents, "doc_id", F.col("text"))
    every = shared(S.same(texts))
    reps = every.where("id = rep").select("id")
    return every, S.sets_of(texts.join(reps, "id", "left_semi"))


def rep_sets(t: Tables):
    return class_sets(t)[1]


@query(f"WITH {SHINGLED} SELECT a, b, common::BIGINT AS common, joined::BIGINT AS joined FROM j")
def neardup_pairs(t: Tables):
    """Pairs of classes of equal texts; neardup_classes has who is in which class."""
    return S.similar_pairs(rep_sets(t), None, 0.8)


@query(f"SELECT doc_id, min(doc_id) OVER (PARTITION BY {WORDS(NORM('text'))}) AS class_id FROM documents")
def neardup_classes(t: Tables):
    return S.classes(t.documents, "doc_id", F.col("text")).select(F.col("id").alias("doc_id"), F.col("rep").alias("class_id"))


@query(
    f"""WITH RECURSIVE {SHINGLED}, e AS (SELECT id, row_number() OVER (ORDER BY id) AS r, coalesce(list(a) FILTER (a IS NOT NULL), []) AS low FROM (SELECT a AS id, NULL AS a FROM j UNION SELECT b, a FROM j) GROUP BY id),
k AS (SELECT 0::BIGINT AS r, []::BIGINT[] AS kept UNION ALL SELECT k.r + 1, CASE WHEN len(list_intersect(e.low, k.kept)) = 0 THEN list_append(k.kept, e.id) ELSE k.kept END FROM k JOIN e ON e.r = k.r + 1),
f AS (SELECT kept FROM k ORDER BY r DESC LIMIT 1), x AS (SELECT e.id, list_min(list_intersect(e.low, f.kept)) AS partner FROM e, f)
SELECT d.doc_id, coalesce(x.partner, c.id) AS near_duplicate_of FROM d JOIN c ON d.w = c.w LEFT JOIN x ON x.id = c.id WHERE x.partner IS NOT NULL OR d.doc_id <> c.id"""
)
def neardup_removed(t: Tables):
    """Greedy keep-first: copies go for the smallest id of their class, or with it for the document that it goes for."""
    every, sets = class_sets(t)
    fate = S.near_first(sets, 0.8)
    gone = every.join(fate.withColumnRenamed("id", "rep"), "rep", "left")
    return gone.where("partner is not null or id <> rep").select(F.col("id").alias("doc_id"), F.coalesce("partner", "rep").alias("near_duplicate_of"))


def alike(t: Tables):
    """Signatures of the texts that stand for their class, and the texts with words as id, rep: copies have one signature, which is worked out once."""
    every, sets = class_sets(t)
    signs = S.set_signatures(sets)
    return signs, every.join(signs.select(F.col("id").alias("rep")), "rep", "left_semi")


def of_one_class(every):
    """a, a for every class of several texts."""
    return every.groupBy("rep").agg(F.count("*").alias("n")).where("n > 1").select(F.col("rep").alias("a"), F.col("rep").alias("b"))


@query()
def minhash_estimate(t: Tables):
    """Of candidates, the share of equal signature slots; texts of the same words are candidates of each other, too."""
    signs, every = alike(t)
    told = S.beside(S.bucket_pairs(signs), signs, signs, "values", equal_share).select("a", "b", F.col("v").alias("estimate"))
    return S.with_copies(told.union(of_one_class(every).withColumn("estimate", F.lit(1.0))), every)


@query()
def lsh_candidates(t: Tables):
    """All pairs of texts that share a bucket, those of the same words among them."""
    signs, every = alike(t)
    return S.with_copies(S.set_candidates(signs).union(of_one_class(every)), every)


QUESTION = lambda x: f"regexp_replace(regexp_replace({NORM(x)}, '^[ .?!]+', ''), '[ .?!]+$', '')"


@query(f"SELECT conv_id, list_sort(list_distinct(list_filter(list({QUESTION('text')}), lambda q: q <> ''))) AS questions FROM conversations WHERE role = 'user' GROUP BY conv_id")
def decon_questions(t: Tables):
    asked = t.conversations.where("role = 'user'").select("conv_id", T.strip(T.normalize(F.col("text")), " .?!").alias("q"))
    return asked.groupBy("conv_id").agg(F.array_sort(F.filter(F.collect_set("q"), lambda x: x != "")).alias("questions"))


@query("SELECT item_id, text AS prompt, CASE WHEN item_id % 3 = 0 THEN 'A' WHEN item_id % 3 = 1 THEN 'B' ELSE '' END AS answer FROM benchmark")
def decon_eval_conversation(t: Tables):
    """The prompt, and the first of reference, expected output and expected value that is not empty."""
    k = F.col("item_id") % 3
    reference, expected = F.when(k == 0, "A").otherwise(""), F.when(k == 1, "B").otherwise(F.lit(None))
    return t.benchmark.select("item_id", F.col("text").alias("prompt"), F.coalesce(F.nullif(reference, F.lit("")), expected, F.lit("")).alias("answer"))


PLANTED = """tr AS (SELECT doc_id AS id, text FROM documents UNION ALL SELECT 1000000 + item_id, text FROM benchmark WHERE item_id % 4 = 0 UNION ALL SELECT 1000000 + item_id, '?' || upper(text) || '!' FROM benchmark WHERE item_id % 4 = 1
 UNION ALL SELECT 1000000 + item_id, text || ' and some more words' FROM benchmark WHERE item_id % 4 = 2)"""


def planted(t: Tables):
    """Documents, with benchmark rows planted as they are, in another case, and lengthened."""
    b, kind, moved = t.benchmark, F.col("item_id") % 4, (F.lit(1000000) + F.col("item_id")).alias("id")
    text = F.when(kind == 0, F.col("text")).when(kind == 1, F.concat(F.lit("?"), F.upper("text"), F.lit("!"))).otherwise(F.concat("text", F.lit(" and some more words")))
    return t.documents.select(F.col("doc_id").alias("id"), "text").union(b.where(kind < 3).select(moved, text.alias("text")))


OVERLAP = f"""WITH {PLANTED} SELECT id, CASE WHEN text IN (SELECT text FROM benchmark) THEN 'content' ELSE 'question' END AS reason FROM tr
WHERE text IN (SELECT text FROM benchmark) OR {QUESTION('text')} IN (SELECT {QUESTION('text')} FROM benchmark)"""


def overlap_sides(t: Tables):
    # texts are read and normalised once, and only hashes are kept, however often the sides are looked at
    question = F.array(F.sha2(T.strip(T.normalize(F.col("text")), " .?!"), 256))
    train = shared(planted(t).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("id"), F.sha2("text", 256).alias("content"), question.alias("questions")))
    return train, t.benchmark.select(F.concat(F.lit("e"), F.col("item_id").cast("string")).alias("id"), F.sha2("text", 256).alias("content"), question.alias("questions"))


@query(OVERLAP)
def decon_exact_overlap(t: Tables):
    return S.eval_overlap(*overlap_sides(t)).select(F.substring("id", 2, 20).cast("bigint").alias("id"), "reason")


@query(OVERLAP)
def decon_guard(t: Tables):
    """The same, with a Bloom filter of the cases in the scan of the training rows."""
    return guard.overlap(*overlap_sides(t)).select(F.substring("id", 2, 20).cast("bigint").alias("id"), "reason")


NEAR = f"""WITH {PLANTED}, a AS (SELECT id, unnest(list_distinct({GRAMS('w', 3)})) AS g FROM (SELECT id, {WORDS(NORM('text'))} AS w FROM tr) WHERE len(w) > 2),
b AS (SELECT item_id, unnest(list_distinct({GRAMS('w', 3)})) AS g FROM (SELECT item_id, {WORDS(NORM('text'))} AS w FROM benchmark)),
na AS (SELECT id, count(*) AS n FROM a GROUP BY id), nb AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
p AS (SELECT id, item_id, count(*) AS common FROM a JOIN b USING (g) GROUP BY ALL),
j AS (SELECT id, item_id, common, na.n + nb.n - common AS joined FROM p JOIN na USING (id) JOIN nb USING (item_id) WHERE common >= 0.8 * (na.n + nb.n - common))"""


def near_eval(t: Tables):
    left = S.shingle_sets(planted(t), "id", F.col("text"))
    right = S.shingle_sets(t.benchmark, "item_id", F.col("text"))
    found = S.similar_pairs(left, right, 0.8).withColumn("similarity", F.col("common") / F.col("joined"))
    best = found.groupBy("a").agg(F.max(F.struct("similarity", "b")).alias("m"))
    return best.select(F.col("a").alias("id"), F.col("m.b").alias("item_id"), F.col("m.similarity").alias("similarity"))


@query(f"{NEAR} SELECT id, item_id, similarity FROM (SELECT id, item_id, common::DOUBLE / joined AS similarity, row_number() OVER (PARTITION BY id ORDER BY common::DOUBLE / joined DESC, item_id DESC) AS r FROM j) WHERE r = 1")
def decon_near_duplicate(t: Tables):
    """For each row that an evaluation row is similar to, the most similar one; of equals the last."""
    return near_eval(t)


@query(f"{NEAR} SELECT (SELECT count(DISTINCT id) FROM j)::BIGINT AS removed, (SELECT count(*) FROM tr)::BIGINT AS train_rows, (SELECT count(*) FROM benchmark)::BIGINT AS eval_records")
def decon_removed(t: Tables):
    one = near_eval(t).agg(F.count("*").alias("removed"))
    return one.crossJoin(planted(t).agg(F.count("*").alias("train_rows"))).crossJoin(t.benchmark.agg(F.count("*").alias("eval_records")))  # three single rows
