"""Plans of training runs, one for each order, and generated tool calls, one for each customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cost, synthetic
from .registry import Tables, query

# What an order stands for, as SQL that both engines read: sizes, batches and lengths by its numbers.
RUN = {
    "params_b": "(o_orderkey % 80 + 1) / CAST(10 AS DOUBLE)",
    "precision": "CASE o_orderkey % 3 WHEN 0 THEN 'bf16' WHEN 1 THEN '8bit' ELSE '4bit' END",
    "rows": "CAST(o_custkey % 500 AS BIGINT)",
    "tokens_per_row": "CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey % 700 AS DOUBLE) END",
    "length": "CAST(CASE o_orderkey % 5 WHEN 0 THEN 512 WHEN 1 THEN 4096 WHEN 2 THEN 2048 ELSE 1024 END AS BIGINT)",
    "batch": "CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 4 END AS BIGINT)",
    "accumulation": "CAST(o_orderkey % 7 + 1 AS BIGINT)",
    "epochs": "CAST(o_orderkey % 3 + 1 AS BIGINT)",
    "max_steps": "CAST(CASE WHEN o_orderkey % 11 = 0 THEN 50 ELSE 0 END AS BIGINT)",
    "checkpointing": "o_orderkey % 2 = 0",
    "done": "CAST(o_custkey % 90 AS BIGINT)",
    "cases": "CAST(o_custkey % 40 AS BIGINT)",
    "new_tokens": "CAST(512 AS BIGINT)",
    "device": "CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE 'NVIDIA Tesla T4' END",
}
MEASURED = " ".join(f"WHEN length = {a} AND batch = {b} THEN {n}" for (a, b), n in cost.MEASURED_TOKENS.items())
BITS = " ".join(f"WHEN '{name}' THEN {bits}" for name, bits in cost.BITS.items())
(GPU, MEMORY, TFLOPS, GBPS, OVERHEAD), = cost.GPUS


RUNS = f"SELECT o_orderkey, {', '.join(f'{sql} AS {name}' for name, sql in RUN.items())} FROM orders"


def runs(t: Tables, **more: str):
    return t.orders.select("o_orderkey", *[F.expr(sql).alias(name) for name, sql in (RUN | more).items()])


@query(f"SELECT o_orderkey, CASE WHEN device LIKE '%{GPU}%' THEN '{GPU}' END AS name, " + ", ".join(f"CASE WHEN device LIKE '%{GPU}%' THEN {v}::DOUBLE END AS {k}" for k, v in zip(cost.PROFILE, cost.GPUS[0][1:])) + f" FROM ({RUNS})")
def est_gpu_profile(t: Tables):
    """The profile of each run's device, nulls where it is unknown."""
    return runs(t).select("o_orderkey", cost.gpu_profile(F.col("device")).alias("p")).select("o_orderkey", "p.*")


STEPS = "(CASE WHEN max_steps > 0 THEN max_steps ELSE ceil(rows / (batch * accumulation)) * epochs END)::BIGINT"


@query(f"SELECT o_orderkey, steps, round(2 * params_b * 1e9 * (steps * batch * accumulation * tokens_per_row) * 3 / ({TFLOPS} * 1e12) / 60, 6) AS train_minutes, round({OVERHEAD} + 2 * params_b / {GBPS}, 6) AS token_seconds FROM (SELECT *, {STEPS} AS steps FROM ({RUNS}))")
def est_training(t: Tables):
    """Steps, minutes of training with three passes a token, and seconds of a generated token, all on the known device; null minutes where the tokens of a row are."""
    planned = runs(t).withColumn("steps", cost.training_steps(*map(F.col, ("rows", "batch", "accumulation", "epochs", "max_steps"))))
    tokens = F.col("steps") * F.col("batch") * F.col("accumulation") * F.col("tokens_per_row")
    minutes, seconds = cost.train_minutes(F.col("params_b"), tokens, 3, TFLOPS), cost.token_seconds(F.col("params_b"), GBPS, OVERHEAD)
    return planned.select("o_orderkey", "steps", F.round(minutes, 6).alias("train_minutes"), F.round(seconds, 6).alias("token_seconds"))


VRAM = f"(w + (w * {cost.EXTRA_SHARE} + CASE WHEN precision = 'bf16' THEN 0.0 ELSE {cost.KBIT_GB} * sqrt(params_b) END) * ({1 - cost.LENGTH_SHARE} + {cost.LENGTH_SHARE} * length / {cost.REFERENCE_LENGTH}.0) + {cost.CONTEXT_GB})"
PRECISIONS = ", ".join(f"('{name}', {bits}::DOUBLE)" for name, bits in cost.BITS.items())
SIZE, LENGTH = "(p_size / CAST(10 AS DOUBLE))", "(p_partkey % 8 + 1) * 512"
BUDGETS = (2.0, 16.0, 192.0)


@query(f"SELECT p_partkey, precision, round(w, 6) AS weights_gb, round({VRAM}, 6) AS training_gb FROM (SELECT p_partkey, precision, {SIZE} AS params_b, {LENGTH} AS length, {SIZE} * bits / 8 AS w FROM part, (VALUES {PRECISIONS}) v(precision, bits))")
def vram_table(t: Tables):
    """Memory of a model of each part's size, in each precision, at a length of the part."""
    rows = t.part.select("p_partkey", F.expr(SIZE).alias("params_b"), F.expr(LENGTH).alias("length"), F.explode(F.array(*map(F.lit, cost.BITS))).alias("precision"))
    size, precision = F.col("params_b"), F.col("precision")
    return rows.select("p_partkey", "precision", F.round(cost.weights_gb(size, precision), 6).alias("weights_gb"), F.round(cost.training_gb(size, precision, F.col("length")), 6).alias("training_gb"))


@query(f"""WITH s AS (SELECT DISTINCT p_size, {SIZE} AS params_b, '4bit' AS precision, {SIZE} * {cost.BITS['4bit']} / 8 AS w FROM part),
l AS (SELECT p_size, budget, coalesce(max(length) FILTER ({VRAM} <= budget), 0)::BIGINT AS longest FROM s, (VALUES {', '.join(f'({b}::DOUBLE)' for b in BUDGETS)}) g(budget), (SELECT 64 * unnest(range(1, 20000)) AS length) GROUP BY p_size, budget)
SELECT p_partkey, budget, longest FROM part JOIN l USING (p_size)""")
def vram_max_len(t: Tables):
    """The longest rows that each part's model can be trained on within three budgets of memory."""
    fits = [F.struct(F.lit(b).alias("budget"), cost.longest(F.expr(SIZE), F.lit("4bit"), b).alias("longest")) for b in BUDGETS]
    return t.part.select("p_partkey", F.explode(F.array(*fits)).alias("x")).select("p_partkey", "x.budget", "x.longest")


@query(
    f"""WITH r AS ({RUNS}),
f AS (SELECT * REPLACE (coalesce(nullif(rows, 0), {cost.DEFAULT_ROWS})::BIGINT AS rows, coalesce(nullif(tokens_per_row, 0), CASE {MEASURED} ELSE least(length, {cost.UNCUT_TOKENS}) END)::DOUBLE AS tokens_per_row), contains(device, '{GPU}') AS known, params_b * CASE precision {BITS} END / 8 AS w FROM r),
s AS (SELECT *, (CASE WHEN max_steps > 0 THEN max_steps ELSE ceil(rows / (batch * accumulation)) * epochs END)::BIGINT AS steps FROM f),
m AS (SELECT *, least(done, steps) AS done_steps, CASE WHEN known THEN 2 * params_b * 1e9 * (steps * batch * accumulation * tokens_per_row) * (CASE WHEN checkpointing THEN 3 ELSE 2 END) / ({TFLOPS} * 1e12) / 60 END AS minutes,
w + (w * {cost.EXTRA_SHARE} + CASE WHEN precision = 'bf16' THEN 0 ELSE {cost.KBIT_GB} * sqrt(params_b) END) * ({1 - cost.LENGTH_SHARE} + {cost.LENGTH_SHARE} * least(length * batch, {cost.REFERENCE_LENGTH}) / {cost.REFERENCE_LENGTH}) + {cost.CONTEXT_GB} AS vram FROM s)
SELECT o_orderkey, rows, steps, done_steps, round(minutes, 6) AS train_minutes, round(CASE WHEN steps > 0 THEN minutes * (steps - done_steps) / steps ELSE minutes * 0 END, 6) AS remaining_minutes,
CASE WHEN known THEN round(cases * new_tokens * ({OVERHEAD} + 2 * params_b / {GBPS}) / 60, 6) END AS eval_minutes, round(vram, 6) AS vram_gb, CASE WHEN known THEN {MEMORY}::DOUBLE END AS gpu_memory_gb, CASE WHEN known THEN vram <= {MEMORY} AND length <= {cost.REFERENCE_LENGTH} WHEN length > {cost.REFERENCE_LENGTH} THEN false END AS fits FROM m"""
)
def est_runs(t: Tables):
    """Steps, minutes and memory of a run for each order, and whether it fits its device."""
    figures = [F.round(c, 6).alias(c) for c in ("train_minutes", "remaining_minutes", "eval_minutes", "vram_gb")]
    return cost.estimate(runs(t)).select("o_orderkey", "rows", "steps", "done_steps", *figures, "gpu_memory_gb", "fits")


# What was measured of an order's run, of which a fifth tells nothing and a seventh ran no step.
MEASURED_RUN = {
    "start_step": "CAST(o_orderkey % 7 AS BIGINT)",
    "end_step": "CAST(CASE WHEN o_custkey % 7 = 0 THEN o_orderkey % 7 ELSE o_orderkey % 7 + o_custkey % 300 + 1 END AS BIGINT)",
    "train_seconds": "CASE WHEN o_orderkey % 5 > 0 THEN abs(o_totalprice) / 100 + 1 END",
    "peak_gb": "CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey % 29 + 2 AS DOUBLE) END",
}


@query(
    f"""WITH r AS (SELECT o_orderkey, {', '.join(f'{sql} AS {name}' for name, sql in (RUN | MEASURED_RUN).items())} FROM orders),
f AS (SELECT * REPLACE (coalesce(nullif(rows, 0), {cost.DEFAULT_ROWS})::BIGINT AS rows, coalesce(nullif(tokens_per_row, 0), CASE {MEASURED} ELSE least(length, {cost.UNCUT_TOKENS}) END)::DOUBLE AS tokens_per_row), contains(device, '{GPU}') AS known, params_b * CASE precision {BITS} END / 8 AS w, end_step - start_step AS ran FROM r),
s AS (SELECT *, {STEPS} AS steps, ran > 0 AND train_seconds > 0 AS trained, CASE WHEN checkpointing THEN 3 ELSE 2 END AS passes, CASE WHEN ran > 0 AND peak_gb > 0 THEN peak_gb END AS peak FROM f)
SELECT o_orderkey, ran AS ran_steps, round(CASE WHEN trained AND known AND steps > 0 THEN 2 * params_b * 1e9 * (steps * batch * accumulation * tokens_per_row) * passes / ({TFLOPS} * 1e12) / 60 * ran / steps END, 6) AS estimated_minutes,
CASE WHEN trained THEN train_seconds / 60 END AS measured_minutes, round(CASE WHEN trained THEN 2 * params_b * 1e9 * (batch * accumulation * tokens_per_row) * ran * passes / train_seconds / 1e12 END, 6) AS effective_tflops,
round(peak / w, 6) AS training_factor, round(CASE WHEN precision <> 'bf16' THEN (peak - w * {1 + cost.EXTRA_SHARE}) / sqrt(params_b) END, 6) AS kbit_overhead_gb, CASE WHEN peak IS NOT NULL AND known THEN w >= {cost.RELIABLE_GB} END AS reliable FROM s"""
)
def calib_train(t: Tables):
    """What was measured of a run for each order beside what was estimated, and the constants that it implies."""
    figures = ("estimated_minutes", "effective_tflops", "training_factor", "kbit_overhead_gb")
    return cost.calibrate(runs(t, **MEASURED_RUN)).select("o_orderkey", "ran_steps", "measured_minutes", *[F.round(c, 6).alias(c) for c in figures], "reliable")


# An evaluation for each order.
REPORT = {
    "params_b": RUN["params_b"],
    "device": RUN["device"],
    "status": "CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'running' END",
    "duration_s": "abs(o_totalprice) / 1000",
    "output_chars": "CAST(o_custkey % 997 * 10 AS BIGINT)",
    "load_s": "CASE WHEN o_orderkey % 997 > 5 THEN CAST(3 AS DOUBLE) END",
}


@query(f"""WITH r AS (SELECT o_orderpriority, {', '.join(f'{sql} AS {name}' for name, sql in REPORT.items())} FROM orders)
SELECT o_orderpriority, params_b, count(*)::BIGINT AS reports, round(greatest(0, avg(duration_s / (output_chars / {cost.CHARS_PER_TOKEN}) - 2 * params_b / {GBPS})), 6) AS overhead, bool_and(load_s IS NOT NULL) AS clean
FROM r WHERE status = 'completed' AND duration_s > 0 AND output_chars > 0 AND contains(device, '{GPU}') GROUP BY ALL""")
def calib_eval(t: Tables):
    """The overhead of a token that evaluations imply, for each priority and size of model, and whether it is clean of loading."""
    reports = t.orders.select("o_orderpriority", *[F.expr(sql).alias(name) for name, sql in REPORT.items()])
    return cost.eval_overheads(reports, "o_orderpriority", "params_b").withColumn("overhead", F.round("overhead", 6))


def _sql_of(text: str) -> str:
    """SQL for a form's text, whose places are x, y and their product."""
    values = ("x", "y", "x * y")
    out = "'" + text.replace("'", "''") + "'"
    for i, value in enumerate(values):
        out = f"replace({out}, '{{{i}}}', ({value})::VARCHAR)"
    return out


def _call_sql() -> str:
    """Every form as rows of a table of its own, then one lookup for each position."""
    forms = [(kind, k, len(all_), *slots, shape, asked) for kind, all_ in synthetic.FORMS.items() for k, (slots, shape, asked) in enumerate(all_)]
    table = ", ".join(f"('{kind}', {k}, {n}, '{one}', '{two}')" for kind, k, n, one, two, *_ in forms)
    case = lambda of: "CASE " + " ".join(f"WHEN kind = '{f[0]}' AND k = {f[1]} THEN {of(f)}" for f in forms) + " END"
    pools = " UNION ALL ".join(f"SELECT '{name}' AS pool, list(v ORDER BY v) AS l FROM range({a}, {b + 1}) r(v) WHERE v NOT IN (SELECT x FROM banned)" for name, (a, b) in synthetic.POOLS.items())
    orders = ", ".join(f"'{o}'" for o in synthetic.ORDERS)
    kinds = ", ".join(f"'{k}'" for k in synthetic.KINDS)
    named = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in synthetic.ARGUMENT.items())
    return f"""WITH banned AS (SELECT item_id * 7 AS x FROM benchmark), pools AS ({pools}), forms(kind, k, n, one, two) AS (VALUES {table}),
p AS (SELECT c_custkey AS position, CASE c_custkey % 2 WHEN 0 THEN 'vi' ELSE 'en' END AS language, ([{kinds}])[c_custkey // 2 % 4 + 1] AS kind, c_custkey // 8 AS turn FROM customer),
j AS (SELECT p.*, f.k, a.l AS la, b.l AS lb, (turn // f.n * {synthetic.STRIDE} + 17) % (len(a.l) * len(b.l) * {len(synthetic.ORDERS)}) AS spot FROM p JOIN forms f ON f.kind = p.kind AND f.k = turn % f.n JOIN pools a ON a.pool = f.one JOIN pools b ON b.pool = f.two),
d AS (SELECT *, la[spot % len(la) + 1] AS x, lb[spot // len(la) % len(lb) + 1] AS y, ([{orders}])[spot // (len(la) * len(lb)) + 1] AS tools FROM j),
t AS (SELECT *, CASE language WHEN 'vi' THEN 'Công cụ: ' || tools || '. ' || {case(lambda f: _sql_of(f[6]['vi']))} ELSE 'Tools: ' || tools || '. ' || {case(lambda f: _sql_of(f[6]['en']))} END AS input, {case(lambda f: _sql_of(f[5]) if f[5] else 'NULL')} AS argument FROM d)
SELECT position, language, kind, input, CASE kind WHEN 'none' THEN '{{"tool": null, "arguments": {{}}}}' ELSE '{{"tool": "' || kind || '", "arguments": {{"' || CASE kind {named} END || '": "' || argument || '"}}}}' END AS expected_output FROM t"""


@query(_call_sql())
def tool_call_records(t: Tables):
    """A generated call for each customer, without the numbers that the benchmark's prompts have (each prompt ends in seven times its item_id). Where customers outnumber a form's combinations it begins anew."""
    prompts = t.benchmark.select(F.concat_ws(" ", "text", (F.col("item_id") * 7).cast("string")).alias("prompt"))
    return synthetic.tool_call_records(t.customer, "c_custkey", synthetic.number_pools(prompts), beyond="again").select("position", "language", "kind", "input", "expected_output")
