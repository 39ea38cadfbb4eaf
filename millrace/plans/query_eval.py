"""Queries of scoring, comparing, agents' verdicts and the cost model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import agents, cases, cost, scoring
from .query_text import CONV, NORM, conversations
from .registry import Tables, query

EV = lambda x: f"regexp_replace(regexp_replace({NORM(x)}, '^[ .!?\"]+', ''), '[ .!?\"]+$', '')"
ANSWER = "CASE item_id % 3 WHEN 0 THEN ' ' || text || ' ! ' WHEN 1 THEN '<think>x' || chr(10) || 'y</think> so: ' || text ELSE 'no' END"


def answers(t: Tables):
    k = F.col("item_id") % 3
    answer = F.when(k == 0, F.concat(F.lit(" "), "text", F.lit(" ! "))).when(k == 1, F.concat(F.lit("<think>x\ny</think> so: "), "text")).otherwise("no")
    return t.benchmark.select("item_id", "text", answer.alias("answer"))


@query(f"SELECT item_id, {EV('a')} = {EV('text')} AS passed FROM (SELECT item_id, text, {ANSWER} AS a FROM benchmark)")
def eval_score_exact(t: Tables):
    return answers(t).select("item_id", scoring.exact(F.col("answer"), F.col("text")).alias("passed"))


@query(f"SELECT item_id, contains({EV('a')}, {EV('text')}) AS passed FROM (SELECT item_id, text, {ANSWER} AS a FROM benchmark)")
def eval_score_contains(t: Tables):
    return answers(t).select("item_id", scoring.contains(F.col("answer"), F.col("text")).alias("passed"))


@query(f"SELECT item_id, regexp_matches(a, CASE WHEN item_id % 2 = 0 THEN '(?is)so.{{1,3}}[a-z]' ELSE '(?is)^ *no$' END) AS passed FROM (SELECT item_id, {ANSWER} AS a FROM benchmark)")
def eval_score_regex(t: Tables):
    pattern = F.when(F.col("item_id") % 2 == 0, "so.{1,3}[a-z]").otherwise("^ *no$")
    return answers(t).select("item_id", scoring.regex(F.col("answer"), pattern).alias("passed"))


@query(rf"SELECT item_id, regexp_replace(regexp_replace(regexp_replace(a, '(?is)<think>.*?(</think>|\z)', '', 'g'), '^\s+', ''), '\s+$', '') AS answer FROM (SELECT item_id, {ANSWER} AS a FROM benchmark)")
def eval_strip_think(t: Tables):
    return answers(t).select("item_id", T.strip_think(F.col("answer")).alias("answer"))


@query("SELECT item_id, CASE item_id % 2 WHEN 0 THEN 'a = 1' || chr(10) || chr(10) || chr(10) || 'b = 2' || chr(10) ELSE text END AS code FROM benchmark")
def eval_extract_code(t: Tables):
    x = F.when(F.col("item_id") % 2 == 0, F.lit("see ```python\na = 1\n``` and ```py\nb = 2\n``` end")).otherwise(F.col("text"))
    return t.benchmark.select("item_id", T.extract_code(x).alias("code"))


SCORED = "SELECT d.doc_id, lang, source, length(text) AS n, quality = 1 AS before, toxic = 0 AS after FROM documents d JOIN labels l USING (doc_id)"


def scored(t: Tables):
    return t.documents.join(t.labels, "doc_id").select("doc_id", "lang", "source", F.length("text").cast("bigint").alias("n"), (F.col("quality") == 1).alias("before"), (F.col("toxic") == 0).alias("after"))


@query(f"SELECT lang, source, count(*)::BIGINT AS cases, count(*) FILTER (before)::BIGINT AS passed, count(*) FILTER (before)::DOUBLE / count(*) AS accuracy, sum(n)::BIGINT AS chars FROM ({SCORED}) GROUP BY GROUPING SETS ((lang), (source), ())")
def eval_buckets(t: Tables):
    return scoring.buckets(scored(t), ("lang", "source"), F.col("before"), F.col("n"))


@query("SELECT role AS id, count(*)::BIGINT AS n FROM conversations GROUP BY role HAVING count(*) > 1")
def eval_duplicate_ids(t: Tables):
    return t.conversations.groupBy(F.col("role").alias("id")).agg(F.count("*").alias("n")).where("n > 1")


@query(f"SELECT avg((trim(a) = trim(text))::INT)::DOUBLE AS accuracy FROM (SELECT text, {ANSWER} AS a FROM benchmark)")
def bench_exact(t: Tables):
    return answers(t).agg(F.coalesce(F.avg((F.trim("answer") == F.trim("text")).cast("double")), F.lit(0.0)).alias("accuracy"))


FLIPS = f"SELECT lang, count(*) FILTER (before AND NOT after)::BIGINT AS newly_failed, count(*) FILTER (after AND NOT before)::BIGINT AS newly_passed FROM ({SCORED}) GROUP BY lang"


@query(FLIPS)
def eval_compare_flips(t: Tables):
    return scoring.flips(scored(t), "lang")


@query(f"SELECT lang, round_even(100 * (count(*) FILTER (after)::DOUBLE / count(*) - count(*) FILTER (before)::DOUBLE / count(*)), 0)::BIGINT AS points FROM ({SCORED}) GROUP BY lang")
def eval_compare_rates(t: Tables):
    rate = lambda c: F.count_if(c).cast("double") / F.count("*")
    return scored(t).groupBy("lang").agg(F.bround(100 * (rate(F.col("after")) - rate(F.col("before")))).cast("bigint").alias("points"))


RUNS = "SELECT user_id AS id, count(*) FILTER (event_type = 'click') AS clicks, max(value) > 50 AS completed, count(*) % 3 = 0 AS answered FROM events GROUP BY user_id"
VERDICT = "CASE WHEN NOT completed THEN 'not completed' WHEN NOT answered THEN 'wrong answer' WHEN clicks = 0 THEN 'missing tool' END"


def agent_runs(t: Tables, shift: int = 0):
    return t.events.groupBy(F.col("user_id").alias("id")).agg(F.count_if(F.col("event_type") == "click").alias("clicks"), (F.max("value") > 50).alias("completed"), ((F.count("*") + shift) % 3 == 0).alias("answered"))


def verdicts(t: Tables, shift: int = 0):
    used = F.when(F.col("clicks") > 0, F.array(F.lit("terminal"))).otherwise(F.array().cast("array<string>"))
    return agent_runs(t, shift).select("id", scoring.agent_reason(F.col("completed"), F.col("answered"), F.array(F.lit("terminal")), used).alias("reason"))


@query(f"SELECT id, {VERDICT} AS reason FROM ({RUNS})")
def agent_verdict(t: Tables):
    return verdicts(t)


@query(f"SELECT count(*)::BIGINT AS total, count(*) FILTER (r IS NULL)::BIGINT AS passed, count(*) FILTER (r IS NULL)::DOUBLE / count(*) AS rate FROM (SELECT {VERDICT} AS r FROM ({RUNS}))")
def agent_report(t: Tables):
    ok = F.count_if(F.col("reason").isNull())
    return verdicts(t).agg(F.count("*").alias("total"), ok.alias("passed"), (ok.cast("double") / F.count("*")).alias("rate"))


@query(f"""WITH a AS (SELECT id, {VERDICT} AS r FROM ({RUNS})), b AS (SELECT id, {VERDICT.replace('NOT answered', 'NOT again')} AS r FROM ({RUNS.replace(' AS answered', ' AS answered, (count(*) + 1) % 3 = 0 AS again')}))
SELECT a.id, CASE WHEN b.id IS NULL THEN 'only in one' WHEN (a.r IS NULL) = (b.r IS NULL) THEN 'same' WHEN b.r IS NULL THEN 'newly passed' ELSE 'newly failed' END AS change FROM a LEFT JOIN b ON a.id = b.id AND b.r IS DISTINCT FROM 'not completed'""")
def agent_compare(t: Tables):
    """All runs, and a second report that lacks those that were not completed."""
    a = verdicts(t).select("id", F.col("reason").isNull().alias("before"))
    b = verdicts(t, 1).where(~F.col("reason").eqNullSafe("not completed")).select("id", F.col("reason").isNull().alias("after"))
    change = F.when(F.col("before").isNull() | F.col("after").isNull(), "only in one").when(F.col("before") == F.col("after"), "same").when(F.col("after"), "newly passed").otherwise("newly failed")
    return a.join(b, "id", "full_outer").select("id", change.alias("change"))


MORE = "SELECT user_id AS id, count(*) FILTER (event_type = 'click') AS clicks, max(value) > 50 AS completed, (count(*) + 1) % 3 = 0 AS answered, sum(event_id)::DOUBLE AS seconds FROM events GROUP BY user_id"


def agent_tasks(t: Tables, shift: int = 0):
    """A task for each user, and again for users with an even number, whose last one counts."""
    seconds = t.events.groupBy(F.col("user_id").alias("id")).agg(F.sum("event_id").cast("double").alias("duration_s"))
    once = verdicts(t, shift).join(seconds, "id").withColumn("position", F.col("id")).withColumn("success", F.col("reason").isNull())
    early = once.where("id % 2 = 0").withColumn("position", -F.col("id") - 1).withColumn("success", ~F.col("success")).withColumn("duration_s", F.lit(0.0))
    return once.unionByName(early)


@query(f"""WITH a AS (SELECT id, {VERDICT} AS r FROM ({RUNS})), b AS (SELECT id, {VERDICT} AS r, seconds FROM ({MORE}) WHERE completed)
SELECT a.id, a.r IS NULL AS first_success, a.r AS first_reason, CASE WHEN b.id IS NOT NULL THEN b.r IS NULL END AS second_success, b.r AS second_reason, b.seconds AS second_duration_s,
CASE WHEN b.id IS NULL THEN 'only in first' WHEN (a.r IS NULL) = (b.r IS NULL) THEN 'same' WHEN b.r IS NULL THEN 'newly passed' ELSE 'newly failed' END AS change FROM a LEFT JOIN b ON a.id = b.id""")
def agent_task_changes(t: Tables):
    """Two reports over all users task by task; the second lacks those that were not completed."""
    second = agent_tasks(t, 1).where(~F.col("reason").eqNullSafe("not completed"))
    return agents.compare(agent_tasks(t), second).drop("place", "first_duration_s")


@query(f"SELECT nation, count(*)::BIGINT AS total, count(*) FILTER (r IS NULL)::BIGINT AS passed, round_even(count(*) FILTER (r IS NULL)::DOUBLE / count(*), 4)::DOUBLE AS success_rate, round_even(sum(seconds) / 60, 1)::DOUBLE AS minutes FROM (SELECT id % 25 AS nation, {VERDICT} AS r, seconds FROM ({MORE})) GROUP BY nation")
def agent_summaries(t: Tables):
    """A report for each of 25 groups of users."""
    once = agent_tasks(t, 1).where("position >= 0")
    return agents.summarize(once.withColumn("nation", F.col("id") % 25), "nation")


ASKS = "CASE o_orderkey % 3 WHEN 0 THEN 'Brand#' || CAST(o_custkey % 40 AS VARCHAR(9)) WHEN 1 THEN 'STANDARD' END"


@query(f"WITH c AS (SELECT can, min(p_partkey) AS first FROM (SELECT p_partkey, unnest([p_brand, p_type]) AS can FROM part) GROUP BY can) SELECT o_orderkey, 'model ' || coalesce(first, 0) AS model FROM (SELECT o_orderkey, {ASKS} AS asks FROM orders) LEFT JOIN c ON asks = can")
def model_route(t: Tables):
    """For each order the first part whose brand or type it asks for; the first part of all does the rest."""
    models = t.part.select(F.concat(F.lit("model "), F.col("p_partkey").cast("string")).alias("name"), F.col("p_partkey").alias("place"), F.array("p_brand", "p_type").alias("capabilities"))
    asked = t.orders.select("o_orderkey", F.expr(ASKS.replace("VARCHAR(9)", "STRING")).alias("capability"))
    return agents.route(asked, models, default="model 0").select("o_orderkey", "model")


PVALUE = "CASE WHEN f + g = 0 THEN 1.0 ELSE least(1.0, 2 * list_sum(list_transform(range(0, least(f, g) + 1), lambda i: exp(lgamma(f + g + 1) - lgamma(i + 1) - lgamma(f + g - i + 1) - (f + g) * ln(2))))) END"


@query(f"""WITH s AS ({SCORED}), x AS (SELECT 'all' AS part, '' AS value, before, after FROM s UNION ALL SELECT 'lang', lang, before, after FROM s UNION ALL SELECT 'source', source, before, after FROM s),
n AS (SELECT part, value, count(*)::BIGINT AS cases, count(*) FILTER (before AND NOT after)::BIGINT AS f, count(*) FILTER (after AND NOT before)::BIGINT AS g FROM x GROUP BY ALL)
SELECT part, value, cases AS cases_before, cases AS cases_after, f AS newly_failed, g AS newly_passed, round({PVALUE}, 6)::DOUBLE AS p FROM n""")
def eval_compare(t: Tables):
    """Two runs over the same cases: flips and their exact p, over all and by two columns."""
    s = scored(t).withColumnRenamed("doc_id", "id")
    run = lambda c: s.select("id", "lang", "source", F.col(c).alias("passed"))
    out = cases.compare(run("before"), run("after"), ("lang", "source"))
    return out.select("part", "value", "cases_before", "cases_after", "newly_failed", "newly_passed", F.round("p", 6).alias("p"))


@query(f"""WITH n AS (SELECT lang, source, count(*) FILTER (before AND NOT after)::BIGINT AS f, count(*) FILTER (after AND NOT before)::BIGINT AS g FROM ({SCORED}) GROUP BY ALL), p AS (SELECT *, {PVALUE} AS p FROM n)
SELECT lang, source, f AS newly_failed, g AS newly_passed, round(p, 6)::DOUBLE AS p, CASE WHEN f + g = 0 THEN 'unchanged' WHEN p < 0.05 THEN 'real' ELSE 'uncertain' END AS verdict FROM p""")
def mcnemar_p(t: Tables):
    """The exact p of the flips of each language and source."""
    n = scored(t).groupBy("lang", "source").agg(F.count_if(F.col("before") & ~F.col("after")).alias("newly_failed"), F.count_if(F.col("after") & ~F.col("before")).alias("newly_passed"))
    p = n.withColumn("p", scoring.mcnemar(F.col("newly_failed"), F.col("newly_passed")))
    return p.withColumn("verdict", scoring.verdict(F.col("newly_failed") + F.col("newly_passed"), F.col("p"))).withColumn("p", F.round("p", 6))


AMOUNT = "'Total: 1.' || lpad((event_id % 1000)::VARCHAR, 3, '0') || ' dong, or ' || event_id || ',5'"


def amounts():
    k = F.col("event_id")
    return F.concat(F.lit("Total: 1."), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(" dong, or "), k.cast("string"), F.lit(",5"))


@query("SELECT event_id, 'total: 1' || lpad((event_id % 1000)::VARCHAR, 3, '0') || ' dong, or ' || event_id || ',5' AS normalized FROM events")
def answer_normalize(t: Tables):
    return t.events.select("event_id", T.normalize_answer(amounts()).alias("normalized"))


@query("SELECT event_id, (1000 + event_id % 1000)::DOUBLE AS first, event_id + 0.5::DOUBLE AS second FROM events")
def answer_numbers(t: Tables):
    n = T.answer_numbers(amounts())
    return t.events.select("event_id", n[0].cast("double").alias("first"), n[1].cast("double").alias("second"))


@query("SELECT event_id, '12345678901234567890123456789012345678901' || event_id AS number, event_id % 2 = 0 AS matches FROM events")
def answer_numbers_long(t: Tables):
    """Numbers of more digits than any number type has."""
    long = F.concat(F.lit("12345678901234567890123456789012345678901"), F.col("event_id").cast("string"))
    wanted = F.concat(long, F.when(F.col("event_id") % 2 == 0, ".0").otherwise(".5"))
    said = F.concat(F.lit("It is 000"), long, F.lit(" in all"))
    return t.events.select("event_id", T.answer_numbers(said)[0].alias("number"), T.answer_matches(said, F.array(wanted)).alias("matches"))


@query("SELECT event_id, (event_id % 1000 = 500 OR event_id = 1500) AS matches FROM events")
def answer_match(t: Tables):
    return t.events.select("event_id", T.answer_matches(amounts(), F.array(F.lit("1500"), F.lit("DONG"))).alias("matches"))


TOKENS = f"SELECT conv_id, least(1024, ceil(list_sum(list_transform(m, lambda x: length(x.content))) / 3.4) + 5 * len(m))::BIGINT AS tokens FROM ({CONV})"


def tokens(t: Tables):
    return conversations(t).select("conv_id", cost.row_tokens(F.col("messages"), 1024).alias("tokens"))


@query(TOKENS)
def est_row_tokens(t: Tables):
    return tokens(t)


@query(f"SELECT sum(m * n)::DOUBLE / sum(n) AS average FROM (SELECT max(tokens) AS m, count(*) AS n FROM (SELECT tokens, (row_number() OVER (ORDER BY conv_id) - 1) // 4 AS b FROM ({TOKENS})) GROUP BY b)")
def est_padded_tokens(t: Tables):
    """Rows in order of id, in batches of 4, padded to the longest of each."""
    return cost.padded_average(tokens(t), "conv_id", "tokens", 4)


@query("SELECT doc_id, least(1.0, 0.35 + CASE WHEN quality = 1 THEN 0.25 ELSE 0 END + CASE WHEN toxic = 0 THEN 0.25 ELSE 0 END + CASE WHEN doc_id % 4 = 0 THEN 0.1 ELSE 0 END + 0.05)::DECIMAL(4, 2)::DOUBLE AS score FROM documents LEFT JOIN labels USING (doc_id)")
def quality_score(t: Tables):
    d = t.documents.join(t.labels, "doc_id", "left")
    return d.select("doc_id", scoring.record_score(F.col("quality") == 1, F.col("toxic") == 0, F.col("doc_id") % 4 == 0, F.lit(True)).alias("score"))
