"""Quality rules, lines first.

Every line is judged by itself: it must hold the end of a sentence and must not be a row of separators, a
navigation list, a stock phrase or shouting. Failing lines are removed, and a document that loses too
much of its text with them is rejected; so is one that is too short or repeats itself. Only SQL
functions run, row by row: no shuffle, and nothing is cut off a long text.

Defined results: a null or empty text has no words and fails the base rule; lines without a word are
neither judged nor counted as lost; identical rows get identical results; an empty table stays empty.
Input columns of the names added here are replaced; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.common import WORD, computed, let, shielded, text_of

#: What counts in the base rule as a symbol.
SYMBOLS = "#*$%&|<>"
#: Prose holds the end of a sentence: a mark, closing quotes or brackets, then a space or the line's end.
SENTENCE_END = r"[.!?…。！？]['\"”’»)\]]*([\x20\x09-\x0D]|\z)"
#: Three or more separators between words make a navigation row.
SEPARATORS = "|»›•·<>"
NAVIGATION = (
    r"(?i)\A[\x20\x09-\x0D]*(home|menu|search|log ?in|sign (in|up|out)|register|next|previous|back|back to top|read more|"
    r"skip to (main )?content|share|print|contact( us)?|about( us)?|site ?map)[.!:]?[\x20\x09-\x0D]*\z"
)
BOILERPLATE = (
    r"(?i)(all rights reserved|privacy policy|terms (of (use|service)|and conditions)|(accept|use|uses|enable) cookies|"
    r"enable javascript|lorem ipsum|click here|subscribe (now|to our)|copyright ©)"
)


@dataclass(frozen=True)
class Rules:
    """Least words; most percent of words in repeated windows, of characters in failing lines; marks per line."""

    least_words: int = 50
    most_repeated: int = 50
    most_lost: int = 30
    separators: int = 3
    #: A line fails if its symbols, or its exclamation marks, are more than one for so many words.
    words_per_symbol: int = 3
    words_per_shout: int = 3


def _count(text: Column, pattern: str) -> Column:
    """Characters that match a one-character class."""
    # Not by what is left without all others: the inverse of a class with non-ASCII characters is slow to match.
    return F.regexp_count(text, F.lit(f"[{pattern}]"))


def line_fails(line: Column, rules: Rules = Rules()) -> Column:
    """Whether a line with at least one word breaks a punctuation, navigation or boilerplate rule."""
    words = F.regexp_count(line, F.lit(WORD))
    return (
        ~line.rlike(SENTENCE_END)
        | (_count(line, SEPARATORS) >= rules.separators)
        | line.rlike(NAVIGATION)
        | line.rlike(BOILERPLATE)
        | (_count(line, SYMBOLS) * rules.words_per_symbol > words)
        | (_count(line, "!") * rules.words_per_shout > words)
    )


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words inside a window of ``window`` words that is found at least twice in the array.

    Windows are sorted with their places, equal neighbours mark repeated ones, and the places they
    cover are added up from left to right. ``words`` must be a plain column.
    """
    last = F.size(words) - window
    places = F.when(last >= 1, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    found = F.transform(
        places, lambda i: F.struct(F.concat_ws(" ", *[F.get(words, i + k) for k in range(window)]).alias("w"), i.alias("i"))
    )

    def covered(ordered):
        same = F.filter(
            ordered,
            lambda x, k: x["w"].eqNullSafe(F.get(ordered, k - 1)["w"]) | x["w"].eqNullSafe(F.get(ordered, k + 1)["w"]),
        )
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), lambda starts: _cover(starts, window))

    return let(F.sort_array(found), covered)


def _cover(starts: Column, window: int) -> Column:
    """Length of the union of windows that begin at sorted places."""
    steps = F.transform(starts, lambda s, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - s, F.lit(window))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)


@shielded
def judge(df: DataFrame, text: str = "text", rules: Rules = Rules(), cleaned: str | None = None) -> DataFrame:
    """Add counts, ``base_failed``, ``lost_chars`` and ``kept``; with ``cleaned``, also the text without failing lines."""
    added = ["n_words", "lost_chars", "base_failed", "kept", *([cleaned] if cleaned else [])]
    body = text_of(text)
    split = computed(
        df.drop(*[c for c in added if c != text]),
        _words=F.regexp_extract_all(body, F.lit(WORD), F.lit(0)),
        _lines=F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD)),
    )
    failing = F.filter("_lines", lambda x: line_fails(x, rules))
    counted = computed(
        split,
        word_chars=F.length(F.regexp_replace(body, r"[\x20\x09-\x0D]+", "")).cast("long"),
        n_symbols=_count(body, SYMBOLS).cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        n_repeat_words=repeated_words(F.col("_words")),
        _lost=_chars(failing),
    )
    words = F.size("_words").cast("long")
    base = (words < rules.least_words) | (F.col("n_repeat_words") * 100 > words * rules.most_repeated)
    loss = F.col("_lost") * 100 <= _chars(F.col("_lines")) * rules.most_lost
    judged = {"n_words": words, "lost_chars": F.col("_lost"), "base_failed": base, "kept": ~base & loss}
    if cleaned:
        good = F.filter(F.split(body, "\n"), lambda x: ~(x.rlike(WORD) & line_fails(x, rules)))
        judged[cleaned] = F.array_join(F.when(F.col("_lost") > 0, good).otherwise(F.array(body)), "\n")
    return counted.withColumns(judged).drop("_words", "_lines", "_lost")


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda total, x: total + F.length(x))


@shielded
def clean(df: DataFrame, text: str = "text", length: str | None = None, rules: Rules = Rules()) -> DataFrame:
    """The kept rows of ``df`` with failing lines removed; ``length`` names a column that holds the text's length."""
    names = df.columns
    kept = judge.__wrapped__(df.select(text, F.struct(*[f"`{c}`" for c in names]).alias("_row")), text, rules, cleaned="_clean").where("kept")
    fields = {text: F.col("_clean"), **({length: F.length("_clean").cast(df.schema[length].dataType)} if length in names else {})}
    return kept.select(*[fields.get(c, F.col("_row")[c]).alias(c) for c in names])
