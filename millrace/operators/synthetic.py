"""Generated tool-call rows: languages and kinds in turn, numbers from a hash, none of the banned ones, all prompts unlike."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from . import scoring
from .lineage import shared

KINDS = ("calculator", "read_file", "search", "none")
TEMPLATES = {
    ("en", "calculator"): "What is {a} times {b}?",
    ("vi", "calculator"): "Hãy nhân {a} với {b}.",
    ("en", "read_file"): "Open notes/{a}-{b}.txt and sum it up.",
    ("vi", "read_file"): "Xem tệp notes/{a}-{b}.txt.",
    ("en", "search"): "Look up flights {a} to {b} on the web.",
    ("vi", "search"): "Tra chuyến bay {a} đến {b}.",
    ("en", "none"): "Just say hello, guest {a} of {b}.",
    ("vi", "none"): "Chỉ cần chào khách {a} trên {b}.",
}


def tool_call_rows(spark: SparkSession, count: int, seed: int, banned: tuple[int, ...] = (), low: int = 13, high: int = 989) -> DataFrame:
    """position, language, kind, prompt, answer. The pair of numbers of a position is a step through all pairs, so no two prompts of a kind are equal."""
    allowed = [n for n in range(low, high + 1) if n not in set(banned)]
    if count > len(allowed) ** 2 * 2:
        raise ValueError(f"not enough numbers for {count} prompts")
    numbers = F.array(*map(F.lit, allowed))
    n, stride = len(allowed) ** 2, 7919
    pair = F.pmod(F.col("position") * stride + F.lit(seed), F.lit(n))
    a, b = F.element_at(numbers, (pair % len(allowed) + 1).cast("int")), F.element_at(numbers, (F.floor(pair / len(allowed)) + 1).cast("int"))
    rows = spark.range(count).withColumnRenamed("id", "position")
    rows = rows.withColumn("language", F.when(F.col("position") % 2 == 0, "vi").otherwise("en"))
    rows = rows.withColumn("kind", F.element_at(F.array(*map(F.lit, KINDS)), (F.floor(F.col("position") / 2) % 4 + 1).cast("int")))
    template = F.create_map(*[F.lit(x) for (language, kind), text in TEMPLATES.items() for x in (f"{language}/{kind}", text)])
    prompt = F.replace(F.replace(template[F.concat_ws("/", "language", "kind")], F.lit("{a}"), a.cast("string")), F.lit("{b}"), b.cast("string"))
    answer = F.to_json(F.struct(F.nullif("kind", F.lit("none")).alias("tool"), F.struct(F.when(F.col("kind") == "calculator", F.concat_ws(" * ", a, b)).alias("expression")).alias("arguments")))
    return rows.select("position", "language", "kind", prompt.alias("prompt"), answer.alias("answer"))


def generate(prompts: DataFrame, teacher, parser, verifier) -> tuple[DataFrame, DataFrame]:
    """prompts: id, prompt. Accepted and rejected rows of what a teacher answers.

    teacher: a function of a column of prompts to a column of outputs (a Pandas UDF around a model, say). parser: of the
    output to a structure, null where the output cannot be read. verifier: of the structure to a boolean. Rejected rows
    keep the raw output, and say whether it could not be read or was not right.
    """
    told = shared(prompts.withColumn("raw_output", teacher(F.col("prompt"))))
    told = told.withColumn("record", parser(F.col("raw_output")))
    told = told.withColumn("passed", F.when(F.col("record").isNotNull(), F.coalesce(verifier(F.col("record")), F.lit(False))))
    told = told.withColumn("quality_score", F.when(F.col("passed").isNotNull(), scoring.record_score(F.lit(False), F.col("passed"), F.lit(False), F.lit(False))))
    rejected = told.where("not coalesce(passed, false)").withColumn("reason", F.when(F.col("record").isNull(), "not readable").otherwise("not verified"))
    return told.where("passed").drop("raw_output"), rejected


#: What numbers of generated calls are drawn from: both ends belong to it.
POOLS = {"n": (13, 989), "small": (2, 12), "quotient": (11, 99)}
TOOLS = KINDS[:3]
#: Of each kind the forms that take turns: pools of its numbers, the argument, and what is asked in each language. {2} is the product of {0} and {1}, so that divisions leave no rest.
FORMS = {
    "calculator": [
        (("n", "n"), "{0} * {1}", {"en": "What is {0} times {1}?", "vi": "Hãy nhân {0} với {1}."}),
        (("n", "n"), "{0} + {1}", {"en": "Add {0} and {1}.", "vi": "Cộng {0} với {1}."}),
        (("n", "n"), "{0} - {1}", {"en": "Take {1} away from {0}.", "vi": "Lấy {0} trừ {1}."}),
        (("quotient", "small"), "{2} / {1}", {"en": "Split {2} into {1} equal parts.", "vi": "Chia đều {2} cho {1}."}),
    ],
    "read_file": [(("n", "n"), "notes/{0}-{1}.txt", {"en": "Open notes/{0}-{1}.txt and sum it up.", "vi": "Xem tệp notes/{0}-{1}.txt."})],
    "search": [(("n", "n"), "flight {0} gate {1}", {"en": "Look up flight {0} at gate {1} on the web.", "vi": "Tra chuyến bay {0} ở cửa {1}."})],
    "none": [(("n", "n"), None, {"en": "Just say hello, guest {0} of {1}.", "vi": "Chỉ cần chào khách {0} trên {1}."})],
}
ARGUMENT = {"calculator": "expression", "read_file": "path", "search": "query"}
ORDERS = [", ".join(order) for order in itertools.permutations(TOOLS)]
STRIDE = 1_000_003  #: a prime greater than any pool, so its multiples visit every combination of a form


def number_pools(prompts: DataFrame, column: str = "prompt") -> DataFrame:
    """One row: n, small and quotient, the numbers of each pool that no prompt of an evaluation has; at most as many as the pools hold, whatever the prompts."""
    low, high = min(a for a, _ in POOLS.values()), max(b for _, b in POOLS.values())
    found = prompts.select(F.explode(T.integers(F.col(column))).alias("x")).where(F.col("x").between(low, high)).distinct().agg(F.collect_set("x").alias("banned"))
    return found.select(*[F.array_except(F.sequence(F.lit(a), F.lit(b)).cast("array<bigint>"), F.col("banned")).alias(name) for name, (a, b) in POOLS.items()])


def tool_call_records(positions: DataFrame, position: str, pools: DataFrame, seed: int = 17, version: str = "1", beyond: str = "error") -> DataFrame:
    """A record for each row of positions, whose column `position` holds distinct whole numbers from 0, with numbers from pools (number_pools).

    Language, kind and form take turns by position. Numbers and the order in which tools are named come from a counter: its
    multiples of a prime, moved by the seed, are read as digits of the pools and of the orders. So each record follows from
    its position alone, whatever the partitions, and no two prompts are equal until every combination of a form is used.
    A position beyond that stops the query, unless `beyond` is "again", where the form begins anew, or "other", where the
    first form of the kind takes it with a combination of its upper half, which its own turns then leave alone, so that
    prompts stay unlike. A negative position or an empty pool stops the query. Null positions give no record.
    """
    if beyond not in ("error", "again", "other"):
        raise ValueError(f"beyond is error, again or other, not {beyond}")
    none_left = F.raise_error(F.lit("no combination is left for this position"))
    number = F.col(position).cast("bigint")
    rows = positions.where(F.col(position).isNotNull()).select(F.when(number < 0, none_left).otherwise(number).cast("bigint").alias("position")).crossJoin(F.broadcast(pools))  # pools: one row
    pick = lambda names, at: F.element_at(F.array(*map(F.lit, names)), (at + 1).cast("int"))
    turn = F.floor(F.col("position") / 8)
    rows = rows.withColumn("language", pick(("vi", "en"), F.col("position") % 2)).withColumn("kind", pick(KINDS, F.floor(F.col("position") / 2) % 4))
    combinations = lambda slots: F.size(slots[0]).cast("bigint") * F.size(slots[1]) * len(ORDERS)

    def with_spare(forms, form, step):
        """Form and step where the first form takes what the others have no combination for."""
        half = F.floor(combinations(forms[0][0]) / 2)
        to, at = F.when((form == 0) & (step >= half), none_left.cast("bigint")).otherwise(form), step
        for k, (slots, *_) in list(enumerate(forms))[1:]:
            over = step - combinations(slots)
            spent = (form == k) & (over >= 0)
            to, at = F.when(spent, F.lit(0)).otherwise(to), F.when(spent, half + over * (len(forms) - 1) + (k - 1)).otherwise(at)
        return to, at

    prompt = argument = None
    for kind, forms in FORMS.items():
        for k, (slots, shape, asked) in enumerate(forms):
            first, second = (F.col(slot) for slot in slots)
            count, form, step = combinations(slots), turn % len(forms), F.floor(turn / len(forms))
            if beyond == "other" and len(forms) > 1:
                form, step = with_spare(forms, form, step)
            gone = count == 0 if beyond == "again" else step >= count
            at = F.when(gone, none_left).otherwise((step * STRIDE + F.lit(seed)) % count).cast("bigint")
            x = F.element_at(first, (at % F.size(first) + 1).cast("int"))
            y = F.element_at(second, (F.floor(at / F.size(first)) % F.size(second) + 1).cast("int"))
            tools = pick(ORDERS, F.floor(at / (F.size(first) * F.size(second))))

            def filled(text, values=(x, y, x * y)):
                out = F.lit(text)
                for i, value in enumerate(values):
                    out = F.replace(out, F.lit(f"{{{i}}}"), value.cast("string")) if f"{{{i}}}" in text else out
                return out

            mine = (F.col("kind") == kind) & (form == k)
            words = F.when(F.col("language") == "vi", F.concat(F.lit("Công cụ: "), tools, F.lit(". "), filled(asked["vi"]))).otherwise(F.concat(F.lit("Tools: "), tools, F.lit(". "), filled(asked["en"])))
            prompt = F.when(mine, words) if prompt is None else prompt.when(mine, words)
            if shape:
                argument = F.when(mine, filled(shape)) if argument is None else argument.when(mine, filled(shape))
    rows = rows.select("position", "language", "kind", prompt.alias("input"), argument.alias("argument"))
    named = F.element_at(F.create_map(*[F.lit(x) for pair in ARGUMENT.items() for x in pair]), F.col("kind"))
    answer = F.when(F.col("kind") == "none", F.lit('{"tool": null, "arguments": {}}')).otherwise(F.concat(F.lit('{"tool": "'), "kind", F.lit('", "arguments": {"'), named, F.lit('": "'), "argument", F.lit('"}}')))
    rows = rows.withColumn("expected_output", answer)
    said = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return rows.select(
        F.concat(F.lit(f"call-{version}-"), F.format_string("%05d", "position")).alias("id"),
        "position", "language", "kind", F.lit("tool_use").alias("domain"), F.lit("sft").alias("task"), "input", "expected_output",
        F.array(said("user", "input"), said("assistant", "expected_output")).alias("messages"),
        F.when(F.col("kind") == "none", F.array().cast("array<string>")).otherwise(F.array("kind")).alias("tools_used"),
    )
