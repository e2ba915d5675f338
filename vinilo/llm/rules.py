"""Quality rules: a table of thresholds compiled into one projection.

Each rule bounds a measure of the document. Measures and verdicts are plain
column expressions, computed row by row without a shuffle. Null and empty texts
have no words, fail the smallest length and are dropped. Rows are judged one by
one, so repeated rows and ids do not matter; other columns are kept as they are.
Texts have no upper length: a very long one is judged whole, within its task.

Rules about words as such (their length, function words) bind only texts in the
languages of the list of function words. Where a row names no language, texts of
less than 1.5 bytes a character count as such; other scripts have more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vinilo.llm.common import SEPARATORS, words

SYMBOLS = "#*$%&|<>"
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = tuple(
    "the be to of and that have with is in for "
    "der die das und ist nicht ein zu mit den von im "
    "le la les de et des un une que est dans pour "
    "el los y en se las del por con una".split()
)
LANGUAGES = ("en", "de", "fr", "es")
BYTES_PER_CHARACTER = 1.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high``; a bound of None does not bind.

    With ``covered_only`` the rule binds texts in the covered languages only.
    """

    measure: str
    low: float | None = None
    high: float | None = None
    covered_only: bool = False

    def holds(self) -> F.Column:
        value = F.col(self.measure)
        bounds = [value >= self.low] if self.low is not None else []
        bounds += [value <= self.high] if self.high is not None else []
        held = F.lit(True)
        for bound in bounds:
            held = held & bound
        held = F.coalesce(held, F.lit(False))
        return held | ~F.col("covered") if self.covered_only else held


RULES = (
    Rule("n_words", 50),
    Rule("mean_word_chars", 2, 20, covered_only=True),
    Rule("symbol_ratio", None, 0.1),
    Rule("stop_word_ratio", 0.01, covered_only=True),
    Rule("repeat_ratio", None, 0.5),
    Rule("dup_line_ratio", None, 0.5),
)

# A lambda over an array of one element names a value, so that it is worked out once.
# Texts without a repeated window are not sorted.
_REPEATED_WORDS = """
    transform(array(_w), w ->
    transform(array(CASE WHEN size(w) >= 3 THEN transform(sequence(0, size(w) - 3),
        i -> concat_ws(' ', get(w, i), get(w, i + 1), get(w, i + 2))) ELSE array() END), grams ->
    CASE WHEN size(array_distinct(grams)) = size(grams) THEN 0L ELSE
    transform(array(sort_array(transform(grams, (x, i) -> struct(x AS gram, i AS at)))), sorted ->
    aggregate(
        sort_array(filter(transform(sorted, (x, j) -> CASE
            WHEN x.gram <=> get(sorted, j - 1).gram OR x.gram <=> get(sorted, j + 1).gram
            THEN x.at END), p -> p IS NOT NULL)),
        struct(0 AS stop, 0L AS n),
        (a, p) -> struct(p + 3 AS stop, a.n + p + 3 - greatest(a.stop, p) AS n),
        a -> a.n))[0] END)[0])[0]"""


def _once(column) -> F.Column:
    """The column, marked so that no filter on results is pushed below it and works it out again."""
    return F.when(F.spark_partition_id() >= 0, column)


def _covered(docs: DataFrame, body: F.Column, lang: str) -> F.Column:
    """Whether the row's language is covered, by its tag or else by its script."""
    latin = F.octet_length(body) < F.length(body) * BYTES_PER_CHARACTER
    if lang not in docs.columns:
        return latin | (F.length(body) == 0)
    base = F.split(F.lower(F.trim(F.col(lang).cast("string"))), "[-_]")[0]
    return F.coalesce(F.nullif(base, F.lit("")).isin(*LANGUAGES), latin | (F.length(body) == 0))


def measured(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, and their measures.

    n_words, word_chars (code points), n_symbols, n_dup_lines (lines with a
    word that equal an earlier line), n_repeat_words (words in three-word
    windows found twice or more), n_stop_words (A-Z lower-cased), covered, and
    the ratios of the rules.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    listed = docs.select(
        F.struct("*").alias("row"),
        _once(words(F.col(text))).alias("_w"),
        F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, SEPARATORS, "")) > 0).alias(
            "_lines"
        ),
        F.length(F.translate(body, SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _covered(docs, body, lang).alias("covered"),
    )
    counted = listed.select(
        "row",
        "word_chars",
        "n_symbols",
        "covered",
        F.size("_w").cast("long").alias("n_words"),
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda x: F.translate(x, UPPER, LOWER).isin(*STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        _once(F.expr(_REPEATED_WORDS)).alias("n_repeat_words"),
    )

    def ratio(over: str, under: str) -> F.Column:
        return F.coalesce(
            F.try_divide(F.col(over).cast("double"), F.col(under).cast("double")), F.lit(0.0)
        )

    return counted.withColumns(
        {
            "mean_word_chars": ratio("word_chars", "n_words"),
            "symbol_ratio": ratio("n_symbols", "n_words"),
            "stop_word_ratio": ratio("n_stop_words", "n_words"),
            "repeat_ratio": ratio("n_repeat_words", "n_words"),
            "dup_line_ratio": ratio("n_dup_lines", "_n_lines"),
        }
    ).drop("_n_lines")


def quality_rules(
    docs: DataFrame, rules=RULES, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``docs`` with measures, ``base_failed``, the rules that failed, and ``kept``.

    The base rule asks for 50 words, at most half of them repeated. Columns of
    ``docs`` that are called as one of the new ones are replaced. ``lang`` names
    the column of language tags ("en", "pt-BR"); it may be absent or null.
    """
    table = measured(docs, text, lang)
    base_failed = (F.col("n_words") < 50) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * 50
    )
    failed = F.array_compact(
        F.array(*[F.when(~rule.holds(), F.lit(rule.measure)) for rule in rules])
    )
    judged = table.withColumns({"base_failed": base_failed, "failed_rules": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )
    new = judged.columns[1:]
    keep = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in new]
    return judged.select(*keep, *new)
