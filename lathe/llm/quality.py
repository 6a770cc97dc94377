"""Quality rules as one Spark projection. Native: no user functions.

A table of thresholds on ratios of length, symbols, stop words and lines is
compiled into one boolean expression. The counts it needs are array
expressions over the words and lines of a text, so a text is judged inside its
row, without a shuffle and whatever its length.

Three-word windows are compared by their 64-bit XXH64 (two different windows
of one text agree with a probability below 2^-33 even at 65,000 words).

Defined cases: a null or empty text has no words and all counts are zero;
lines are compared whole, without trimming; repeated rows are judged alike;
other columns are not read.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = r"[ \x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Frequent function words of the languages at hand.
STOP_WORDS = ("the", "of", "and", "to", "in", "a", "is", "that", "for", "der", "die", "und", "den", "in", "zu", "von", "ist", "le", "la", "les", "de", "des", "et", "est", "que", "el", "los", "las", "en", "y", "por", "un")


@dataclass(frozen=True)
class Rule:
    """A text passes if ``low`` <= value <= ``high`` of ``above`` / ``below``."""

    above: str
    below: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        # Cross-multiplied: exact in long arithmetic for whole thresholds, and free of division by zero.
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (F.col(self.above) >= F.lit(self.low) * F.col(self.below))
        if self.high is not None:
            ok = ok & (F.col(self.above) <= F.lit(self.high) * F.col(self.below))
        return ok


RULES = (
    Rule("word_chars", "n_words", 2, 14),
    Rule("n_symbols", "n_words", None, 0.25),
    Rule("n_stop_words", "n_words", 0.01, None),
    Rule("n_dup_lines", "n_lines", None, 0.3),
)


def compiled(rules=RULES) -> Column:
    out = F.lit(True)
    for r in rules:
        out = out & r.passes()
    return out


def repeated_words(words: str) -> Column:
    """Words inside three-word windows that occur at least twice in the array."""
    return F.expr(
        f"""size(array_distinct(flatten(transform(
              filter(
                transform(
                  sequence(1, size({words}_runs)),
                  i -> if(element_at({words}_runs, i).h = try_element_at({words}_runs, i + 1).h
                          or (i > 1 and element_at({words}_runs, i).h = element_at({words}_runs, greatest(i - 1, 1)).h),
                          element_at({words}_runs, i).p, -1)),
                p -> p >= 0),
              p -> array(p, p + 1, p + 2)))))"""
    )


def quality(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t = docs.select(
        F.col(id_col).alias("id"),
        F.filter(F.split(text, BLANKS), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]")).alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    runs = """if(size(words) < 3, cast(array() as array<struct<h: bigint, p: int>>),
        sort_array(transform(sequence(0, size(words) - 3), i -> named_struct(
          'h', xxhash64(words[i], words[i + 1], words[i + 2]), 'p', i))))"""
    t = t.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(*sorted(set(STOP_WORDS))))).cast("long").alias("n_stop_words"),
        F.expr(runs).alias("words_runs"),
    )
    t = t.withColumn("n_repeat_words", F.when(F.size("words_runs") == 0, F.lit(0)).otherwise(repeated_words("words")).cast("long")).drop("words_runs")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return t.withColumn("base_failed", failed).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & compiled(rules)).alias("kept")
    )
