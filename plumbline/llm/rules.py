"""Quality rules: a table of thresholds compiled into one projection over measures of the whole text.

A rule bounds a ratio of two measures. `compile_rules` turns the table into columns, so a text is measured once in one scan and
nothing is shuffled or sent to Python. Repeated windows of a text are found inside its row: the hashes of all windows are sorted,
neighbours that agree are repeats, and the words that their windows cover are counted. Two different windows of a text would need
equal 64-bit hashes to be taken for one another.

Null and empty texts have zero measures and fail the base rule. A ratio with a zero denominator is zero. Repeated rows are judged
each for itself. Other columns do not matter to `measure`, which keeps them and replaces those with the name of a measure.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.frames import let

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

# Frequent function words of the languages served; a text of sentences has some of them.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "with", "be", "as", "by", "this", "are", "at", "from",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "auf", "im", "sich", "des",
    "de", "la", "le", "et", "les", "un", "une", "que", "qui", "dans", "pour", "du", "est", "pas", "en", "il",
    "el", "los", "y", "se", "las", "por", "con", "una", "para", "no", "su", "al", "lo", "como",
)


@dataclass(frozen=True)
class Limit:
    """A text passes if low <= part / whole <= high."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None


LIMITS = (
    Limit("word_length", "word_chars", "n_words", low=2.0, high=20.0),
    Limit("symbols", "n_symbols", "n_words", high=0.1),
    Limit("stop_words", "n_stop_words", "n_words", low=0.01),
    Limit("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
    Limit("repeated_neighbours", "n_adjacent", "n_words", high=0.3),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_adjacent")


def split_words(text: Column) -> Column:
    """Runs of characters that are not ASCII white space."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANK))


def span(first: int, last: Column) -> Column:
    """first, …, last; empty if last is smaller."""
    return F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """The number of words in windows that occur twice or more."""
    hashes = F.transform(span(0, F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))

    def covered(ordered: Column) -> Column:
        value = lambda k: F.get(ordered, k)["value"]
        repeats = F.filter(
            span(0, F.size(ordered) - 1),
            lambda k: F.coalesce(value(k) == value(k - 1), F.lit(False)) | F.coalesce(value(k) == value(k + 1), F.lit(False)),
        )
        places = F.sort_array(F.transform(repeats, lambda k: F.get(ordered, k)["place"]))
        return let(places, lambda p: F.aggregate(
            span(1, F.size(p) - 1), F.lit(width), lambda total, k: total + F.least(F.lit(width), F.get(p, k) - F.get(p, k - 1)),
        ))

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("value"), i.alias("place"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, covered))

    return let(hashes, count)


def measures(text: Column) -> Column:
    """All measures of a text as one struct; words and lines are cut once."""

    def of_words(words: Column) -> list[Column]:
        adjacent = F.filter(span(1, F.size(words) - 1), lambda i: F.get(words, i) == F.get(words, i - 1))
        return [
            F.size(words).alias("n_words"), F.char_length(F.array_join(words, "")).alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).alias("n_stop_words"), F.size(adjacent).alias("n_adjacent"),
        ]

    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    by_line = let(lines, lambda each: F.struct(F.size(each).alias("n_lines"), (F.size(each) - F.size(F.array_distinct(each))).alias("n_dup_lines")))
    by_word = let(split_words(text), lambda words: F.struct(*of_words(words)))
    return F.struct(by_word.alias("w"), by_line.alias("l"), F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"))


def measure(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add MEASURES to each row."""
    measured = documents.withColumn("_m", measures(F.coalesce(F.col(text), F.lit(""))))
    places = {"n_symbols": "_m.n_symbols", "n_lines": "_m.l.n_lines", "n_dup_lines": "_m.l.n_dup_lines"}
    return measured.withColumns({m: F.col(places.get(m, f"_m.w.{m}")).cast("bigint") for m in MEASURES}).drop("_m")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def compile_rules(limits: Sequence[Limit]) -> Column:
    """The names of the rules that a measured row breaks."""

    def broken(limit: Limit) -> Column:
        ratio = F.coalesce(F.try_divide(F.col(limit.part).cast("double"), F.col(limit.whole).cast("double")), F.lit(0.0))
        low = ratio < limit.low if limit.low is not None else F.lit(False)
        high = ratio > limit.high if limit.high is not None else F.lit(False)
        return F.when(low | high, F.lit(limit.name))

    return F.array_compact(F.array(*map(broken, limits)))


def judge(documents: DataFrame, text: str = "text", limits: Sequence[Limit] = LIMITS) -> DataFrame:
    """Add the measures, base_failed, broken_rules (names, in the order of the table) and kept."""
    judged = measure(documents, text).withColumns({"base_failed": base_failed(), "broken_rules": compile_rules(limits)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def quality_filter(documents: DataFrame, text: str = "text", limits: Sequence[Limit] = LIMITS) -> DataFrame:
    """The rows that pass, with their own columns."""
    return judge(documents.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text", limits).filter("kept").select("_row.*")
