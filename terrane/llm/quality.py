"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Every rule is a boolean column that is true for a document to reject. The order
of the rules decides only how much work is done and which rule is named as the
first to reject; the verdict is the same for any order. The order comes from a
bounded sample of the rows that reach the cascade, which are those that the base
does not fail: each rule's rejections and its cost are estimated there in one
pass, and the rules with the most rejections for their cost go first. What the
report needs of every row (words, symbols, repeated lines and windows) is computed
for every row; a rule's cost is what it reads beyond that, in characters, and that
is what the cascade saves. A cost of characters, unlike one of seconds, is the same
in every run, so reruns name the same rules.

Defined results
    null text            counts as the empty text: no words, base fails
    empty table          no rows; the rules go by name
    repeated rows        each row is judged on its own
    ties                 rules of equal worth go by name
    very long texts      one pass, work grows with n log n of the words
    extra columns        ignored; only the id and the text are read
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import BLANKS, let, words


SYMBOL = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    name: str
    #: A Spark SQL condition over the columns of :func:`text_features`, true for a text to reject.
    rejects: str
    #: The same condition for another engine, where it reads differently.
    other_sql: str = ""
    #: The characters that the rule reads of a row, as a Spark SQL expression; where it is not given, the whole text each time that it is named.
    cost: str = ""

    @property
    def sql(self) -> str:
        return self.other_sql or self.rejects

    @property
    def work(self) -> str:
        return self.cost or f"1 + {len(re.findall(r'\b_text\b', self.rejects))} * length(_text)"


#: Rules for prose, loose on purpose: they name junk, and leave unusual prose alone.
DEFAULT_RULES = (
    Rule("symbols", "20 * n_symbols > word_chars"),
    Rule("duplicate_lines", "n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
    Rule(
        "upper_case",
        r"2 * regexp_count(_text, r'\p{Lu}') > word_chars",
        r"2 * (length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g'))) > word_chars",
    ),
    Rule("digits", "4 * regexp_count(_text, '[0-9]') > word_chars", "4 * (length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))) > word_chars"),
)


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of one text each: words, characters in words, symbols, repeated lines, repeated 3-word windows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    one = docs.select(F.col(id_col), text.alias("_text"), words(F.col(text_col)).alias("_w"), lines.alias("_lines"))
    # A window is known by the chained 64-bit hash of its three words.
    window = F.transform(
        F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", 2, F.size("_w")).alias("b"), F.slice("_w", 3, F.size("_w")).alias("c")),
        lambda z: F.xxhash64(z["a"], z["b"], z["c"]),
    )
    two = one.select(
        id_col,
        "_text",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.when(F.col("_text").rlike(SYMBOL), F.regexp_count("_text", F.lit(SYMBOL))).otherwise(F.lit(0)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.size("_w") >= 3, F.slice(window, 1, F.size("_w") - 2)).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )
    repeats = F.size(F.array_distinct("_h")) < F.size("_h")
    pairs = F.sort_array(F.arrays_zip(F.col("_h").alias("h"), F.sequence(F.lit(1), F.size("_h")).alias("i")))

    def covered(p: Column) -> Column:
        again = F.filter(p, lambda x, k: (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"]))
        at = F.sort_array(F.transform(again, lambda x: x["i"]))
        # Each window adds the words that the one before it has not covered: three at most.
        return F.aggregate(
            at,
            F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n")),
            lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")),
            lambda a: a["n"].cast("long"),
        )

    three = two.withColumn("n_repeat_words", F.when(repeats, let(pairs, covered)).otherwise(F.lit(0).cast("long")))
    return three.drop("_h")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measure_rules(sample: DataFrame, rules: Sequence[Rule]) -> list[dict]:
    """Each rule's rejection rate and mean cost over the features of a sample, by one aggregate; most rejections for their cost first."""
    if not rules:
        return []
    counts = [F.count_if(F.expr(r.rejects)) for r in rules] + [F.coalesce(F.sum(F.expr(r.work).cast("long")), F.lit(0)) for r in rules]
    n, *found = sample.agg(F.count(F.lit(1)), *counts).first()
    out = [{"name": r.name, "rejects": hits / max(n, 1), "cost": work / max(n, 1)} for r, hits, work in zip(rules, found, found[len(rules) :], strict=False)]
    return sorted(out, key=lambda x: (-x["rejects"] / max(x["cost"], 1e-9), x["name"]))


def cascade(features: DataFrame, rules: Sequence[Rule], order: list[str]) -> DataFrame:
    """Add ``rejected_by``: the first rule, in the given order, that rejects the row; null for none.

    A CASE expression stops at its first true branch, so later rules are not evaluated for that row.
    """
    by_name = {r.name: r for r in rules}
    verdict = F.lit(None).cast("string")
    for name in reversed(order):
        verdict = F.when(F.expr(by_name[name].rejects), F.lit(name)).otherwise(verdict)
    return features.withColumn("rejected_by", verdict)


def quality_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = DEFAULT_RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 1000,
) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``rejected_by`` and ``kept``.

    About ``sample_rows`` documents are drawn to order the rules; the sample never changes a verdict.
    """
    # Features are computed for the rows of the sample only, and the sample is read once.
    bare = docs.select(F.col(id_col), F.col(text_col))
    total = bare.count()
    picked = bare.sample(False, min(1.0, sample_rows / total), 17) if total else bare
    order = [x["name"] for x in measure_rules(text_features(picked, id_col, text_col).where(~base_failed()), rules)]
    out = cascade(text_features(bare, id_col, text_col).withColumn("base_failed", base_failed()), rules, order)
    out = out.withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(F.col("rejected_by")))
    return out.withColumn("kept", F.col("rejected_by").isNull()).drop("_text", "n_lines")
