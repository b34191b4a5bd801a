r"""Quality rules: a threshold table compiled into one projection over a document's measures.

A word is a run of characters other than the six ASCII white-space characters, a line what ``\n``
parts.  The measures of a text are counts:

    n_words, word_chars (code points in words), n_symbols (``#*$%&|<>``), n_stop_words, n_letter_words
    (words with a letter), n_lines (lines with a word), n_dup_lines (equal to an earlier one),
    n_bullet_lines, n_ellipsis_lines, n_repeat_words (words inside 3-word windows that the text holds
    twice or more, the first time included)

A rule bounds a ratio of two of them in thousandths, compared as integers, so a text exactly at a
threshold passes in every engine.  The table becomes conditions of a single ``select``: no user
function, no join and no shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"
_SPACES = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Frequent function words of the languages that the corpus is expected in.
STOP_WORDS = (
    "the be to of and that have with "
    "der die und das den von zu mit "
    "de la le et les des en un "
    "que el y los las del por con").split()


class Rule(NamedTuple):
    """``count`` by ``base`` must lie within [least, most] thousandths; None: no bound.

    With a base of 0 a rule holds."""
    name: str
    count: str
    base: str
    least: int | None = None
    most: int | None = None


#: The thresholds of the production table.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=2500, most=12000),
    Rule("symbols", "n_symbols", "n_words", most=100),
    Rule("stop_words", "n_stop_words", "n_words", least=40),
    Rule("letters", "n_letter_words", "n_words", least=800),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", most=500),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", most=900),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", most=300),
)
#: What a document needs before the table is asked.
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; words of a hundred


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and the measures of its whole text, all long.

    A null or empty text has zeros; a null id stays null; repeated rows are measured once each;
    other columns are ignored, an empty table gives no rows.  Memory in a task follows the
    longest text (about 200 bytes a word)."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    trimmed = F.btrim(F.col("text"), F.lit(_SPACES))
    none = F.array().cast("array<string>")
    base = (docs.select(F.col(id_column).alias("id"), text.alias("text"))
            .select("id", "text",
                    F.when(trimmed == "", none).otherwise(F.split(trimmed, f"[{SPACE}]+")).alias("words"),
                    F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]"))).alias("lines")))

    def long(count: Column) -> Column:
        return count.cast("long")

    def lines_like(pattern: str) -> Column:
        return long(F.size(F.filter("lines", lambda x: F.rlike(x, F.lit(pattern)))))

    def window(i: Column) -> Column:
        return F.struct(F.concat_ws(" ", *[F.get("words", i + k) for k in range(WINDOW)]).alias("words"),
                        i.alias("start"))

    size = F.size("words")
    counted = base.select(
        "id", long(size).alias("n_words"),
        long(F.length(F.translate("text", _SPACES, ""))).alias("word_chars"),
        long(F.length("text") - F.length(F.translate("text", _SYMBOLS, ""))).alias("n_symbols"),
        long(F.size(F.filter("words", lambda x: F.lower(x).isin(STOP_WORDS)))).alias("n_stop_words"),
        long(F.size(F.filter("words", lambda x: F.rlike(x, F.lit(r"\p{L}"))))).alias("n_letter_words"),
        long(F.size("lines")).alias("n_lines"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        lines_like(rf"^[{SPACE}]*[-*•]").alias("n_bullet_lines"),
        lines_like(rf"(?:\.\.\.|…)[{SPACE}]*\z").alias("n_ellipsis_lines"),
        F.when(size >= WINDOW, F.sort_array(F.transform(F.sequence(F.lit(0), size - WINDOW), window)))
        .alias("windows"))

    # Equal windows are neighbours now; those with an equal neighbour, by place, cover the words.
    def found_again(x: Column, i: Column) -> Column:
        return F.coalesce((F.get("windows", i - 1)["words"] == x["words"])
                          | (F.get("windows", i + 1)["words"] == x["words"]), F.lit(False))

    starts = F.sort_array(F.transform(F.filter("windows", found_again), lambda x: x["start"]))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(starts, zero, lambda acc, at: F.struct(
        (acc["n"] + F.least(F.lit(WINDOW), at - acc["last"])).alias("n"), at.alias("last")), lambda acc: acc["n"])
    return counted.select(*[c for c in counted.columns if c != "windows"],
                          long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"))


def failed_rules(rules=RULES) -> Column:
    """The table as one column: the names of the rules that a row of measures breaks, in order."""
    names = []
    for rule in rules:
        count, base = 1000 * F.col(rule.count), F.col(rule.base)
        broken = F.lit(False)
        if rule.least is not None:
            broken = broken | (count < rule.least * base)
        if rule.most is not None:
            broken = broken | (count > rule.most * base)
        names.append(F.when(broken, F.lit(rule.name)))
    return F.filter(F.array(*names), lambda x: x.isNotNull()) if names else F.array().cast("array<string>")


def judge(docs: DataFrame, rules=RULES, least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED,
          id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The measures of every row of ``docs`` with ``base_failed`` (too few words, or too large a
    share of them in repeated windows), ``failed`` (array of the broken rules' names) and ``kept``
    (neither).  Nulls, repeated rows and other columns as in :func:`measures`."""
    base_failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return (measures(docs, id_column, text_column)
            .select("*", base_failed.alias("base_failed"), failed_rules(rules).alias("failed"))
            .select("*", (~F.col("base_failed") & (F.size("failed") == 0)).alias("kept"))
            .withColumnRenamed("id", id_column))
