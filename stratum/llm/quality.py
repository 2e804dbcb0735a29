"""Quality rules: a threshold table compiled into one projection (operator 7).

No user functions: ratios are built-in expressions over the word array, and every
row is judged where it is read – no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.text import SPACES, ascii_lower, words

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "by", "this", "a",
    "de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans",
    "der", "die", "und", "das", "den", "von", "ist", "nicht", "mit", "dem", "zu", "ein", "eine", "sich", "im",
    "el", "los", "y", "las", "se", "del", "no", "una", "por", "con", "su", "para", "al", "lo", "es",
)
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Threshold:
    """Keep a text only when numerator / denominator is within [low, high] (None: open).

    With a zero denominator the ratio counts as 0."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None

    def ok(self) -> Column:
        ratio = F.col(self.numerator).cast("double")
        if self.denominator:
            ratio = F.when(F.col(self.denominator) > 0, ratio / F.col(self.denominator)).otherwise(F.lit(0.0))
        result = F.lit(True)
        if self.low is not None:
            result = result & (ratio >= F.lit(float(self.low)))
        if self.high is not None:
            result = result & (ratio <= F.lit(float(self.high)))
        return result

    def sql(self) -> str:
        ratio = f"CAST({self.numerator} AS DOUBLE)"
        if self.denominator:
            ratio = f"(CASE WHEN {self.denominator} > 0 THEN {ratio} / {self.denominator} ELSE 0.0 END)"
        parts = [f"{ratio} >= {float(self.low)!r}"] if self.low is not None else []
        parts += [f"{ratio} <= {float(self.high)!r}"] if self.high is not None else []
        return " AND ".join(parts) or "TRUE"


RULES: tuple[Threshold, ...] = (
    Threshold("length", "n_words", low=50, high=100_000),
    Threshold("mean_word", "word_chars", "n_words", low=2, high=12),
    Threshold("symbols", "n_symbols", "n_words", high=0.2),
    Threshold("stop_words", "n_stop_words", "n_words", low=0.02),
    Threshold("lines", "n_dup_lines", "n_lines", high=0.35),
)


def measures(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the counts the threshold table refers to (null text counts as empty).

    Positions covered by repeated 3-word windows: the windows' 64-bit hashes are
    sorted with their position, positions with an equal neighbour are put back in order, and each adds at most
    three covered words beyond the one before – n log n in the text's length, whatever repeats.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = df.withColumn("_text", text).withColumn("_w", words(F.col(text_col)))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    d = d.withColumn("_p", F.when(F.col("n_words") >= 3, F.expr(
        "sort_array(transform(sequence(0, size(_w) - 3), i -> struct(xxhash64(_w[i], _w[i + 1], _w[i + 2]) as h, i as i)))")))
    d = d.withColumn("_rep", F.expr(
        "filter(_p, (x, k) -> (k > 0 and _p[k - 1].h = x.h) or (k < size(_p) - 1 and _p[k + 1].h = x.h))"))
    d = d.withColumn("_at", F.expr("sort_array(transform(_rep, x -> x.i))"))
    d = d.withColumn("n_repeat_words", F.coalesce(F.expr(
        "aggregate(transform(_at, (x, k) -> if(k = 0, 3, least(3, x - _at[k - 1]))), 0L, (a, x) -> a + x)"), F.lit(0)).cast("long"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    d = d.withColumn("_lines", lines)
    d = (d.withColumn("n_lines", F.size("_lines").cast("long"))
         .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
         .withColumn("word_chars", F.length(F.translate("_text", SPACES, "")).cast("long"))
         .withColumn("n_symbols", (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"))
         .withColumn("n_stop_words", F.size(F.filter(
             F.split(ascii_lower(F.col("_text")), r"[\x20\x09-\x0D]+"),
             lambda x: x.isin(*STOP_WORDS))).cast("long")))
    return d.drop("_text", "_w", "_p", "_rep", "_at", "_lines")


def judge(df: DataFrame, rules: Sequence[Threshold] = RULES, text_col: str = "text") -> DataFrame:
    """Counts plus ``base_failed`` and ``kept`` for every row; extra columns pass through.

    Null, empty and blank texts have no words: all counts 0, base_failed, not kept.
    Repeated rows stay repeated. An empty rule table keeps what the base keeps.
    Input columns named like an output column are replaced.
    """
    outputs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
               "base_failed", "kept")
    d = measures(df.drop(*[c for c in outputs if c != text_col]), text_col)
    d = d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & rule.ok()
    return d.withColumn("kept", kept)
