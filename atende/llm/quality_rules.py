"""Line-first quality rules, with DataFrame functions only.

Every line is judged on its own by punctuation, navigation and boilerplate rules; lines that fail are
removed, then documents that lose too much of their text are rejected. Base figures of the whole
text reject documents that are too short or repeat themselves.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atende.llm.common import let

# Fixed values of the rules.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEAT_PCT = 30
# Marks that end a sentence, and closing marks that may follow them.
SENTENCE_END = (".", "!", "?", "…", "。", "！", "？", ":", ";")
CLOSING = " \t\x0b\x0c\r\"'”’»)]"
# Marks between the items of a menu or a bread-crumb path, and how many make a line navigation.
MENU_MARK = ("|", "›", "→", "·", "•")
MENU_MARKS = 3
# Short lines that are only a menu entry.
MENU_LINE = (
    r"(?i)\A[\x20\x09-\x0D]*(home|menu|log ?in|log ?out|sign ?in|sign ?up|register|search|contact( us)?|about( us)?|next|previous|"
    r"back to top|read more|share( this)?|subscribe|sitemap|skip to content)[.!:]?[\x20\x09-\x0D]*\z"
)
# Phrases of site boilerplate.
BOILERPLATE = (
    "lorem ipsum", "enable javascript", "javascript is disabled", "javascript is required", "cookie policy", "we use cookies",
    "accept cookies", "terms of use", "terms of service", "privacy policy", "all rights reserved", "click here",
    "subscribe to our newsletter",
)
# Decoration: one symbol or more for two words; shouting: so many doubled exclamation marks.
WORDS_PER_SYMBOL = 2
SHOUT = "!!"
SHOUTS = 3
MAX_LOSS_PCT = 50


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def ends_like_prose(line: Column) -> Column:
    return F.right(F.rtrim(line, F.lit(CLOSING)), F.lit(1)).isin(*SENTENCE_END)


def is_menu(line: Column) -> Column:
    marks = F.length(line) - F.length(F.translate(line, "".join(MENU_MARK), ""))
    return (marks >= MENU_MARKS) | line.rlike(MENU_LINE)


def is_boilerplate(line: Column) -> Column:
    return let(F.lower(line), lambda x: _any(F.contains(x, F.lit(p)) for p in BOILERPLATE))


def is_decoration(line: Column) -> Column:
    symbols, shouts = _count(line, SYMBOLS), F.length(line) - F.length(F.replace(line, F.lit(SHOUT), F.lit("")))
    return (WORDS_PER_SYMBOL * symbols >= F.size(words_of(line))) & (symbols > 0) | (shouts >= len(SHOUT) * SHOUTS)


def passing_lines(text: Column, lines: Column, n_symbols: Column) -> Column:
    """The lines that end like a sentence and are no menu, no boilerplate and no decoration.

    Lines without a word pass; they carry no text and only keep paragraphs apart. A rule that the whole
    text shows to be idle (no such mark or phrase anywhere) is not tried on each line.
    """
    lively = (n_symbols > 0) | _any(F.contains(text, F.lit(m)) for m in (*MENU_MARK, SHOUT)) | is_boilerplate(text)
    busy = lambda x: ~is_menu(x) & ~is_boilerplate(x) & ~is_decoration(x)
    calm = lambda x: ~x.rlike(MENU_LINE)
    return F.when(lively, F.filter(lines, lambda x: ~x.rlike(WORD) | (ends_like_prose(x) & busy(x)))).otherwise(
        F.filter(lines, lambda x: ~x.rlike(WORD) | (ends_like_prose(x) & calm(x)))
    )


def repeat_words(words: Column) -> Column:
    """Words inside windows of 8 words that occur at least twice in the text, each word once.

    Windows are compared by a 64-bit hash of their word hashes, within one text only.
    """
    n = WINDOW_WORDS

    def covered(sorted_windows: Column) -> Column:
        # Starts of windows whose hash a neighbour in hash order shares.
        starts = F.sort_array(F.filter(
            F.transform(
                sorted_windows,
                lambda x, k: F.when(
                    (x.h == F.get(sorted_windows, k - 1).h) | (x.h == F.get(sorted_windows, k + 1).h), x.i
                ),
            ),
            lambda i: i.isNotNull(),
        ))
        return let(starts, lambda p: F.when(F.size(p) == 0, F.lit(0)).otherwise(
            n + F.aggregate(
                F.transform(p, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - x, F.lit(0)))),
                F.lit(0), lambda a, b: a + b,
            )
        ))

    def of_hashes(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered)
        )

    def widened(h: Column, by: int) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + by)))

    # Hashes of 2, then 4, then 8 words from each word on; those that reach past the end are cut off.
    by_two = lambda x: let(widened(x, 2), lambda y: F.slice(widened(y, 4), 1, F.size(words) - (n - 1)))
    return F.when(F.size(words) < n, F.lit(0)).otherwise(let(let(widened(words, 1), by_two), of_hashes)).cast("long")


def _judged(text: Column) -> Column:
    """All figures of one text and its clean form, as one struct."""

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeat_words(words).alias("n_repeat_words"),
        )

    def of_lines(lines: Column) -> Column:
        with_word = F.filter(lines, lambda x: x.rlike(WORD))
        return let(_count(text, SYMBOLS).cast("long"), lambda n_symbols: F.struct(
            n_symbols.alias("n_symbols"),
            let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.array_join(passing_lines(text, lines, n_symbols), "\n").alias("clean_text"),
        ))

    return F.struct(let(words_of(text), of_words).alias("w"), let(F.split(text, "\n"), of_lines).alias("l"))


def quality_rules(docs: DataFrame, text: str = "text", max_loss_pct: int = MAX_LOSS_PCT) -> DataFrame:
    """(row, q): each input row, and a struct of its figures, verdict and clean text.

    ``q.kept`` is false for texts with fewer than 20 words, with over 30 % of words in repeated
    windows, and for those that lose more than ``max_loss_pct`` % of their characters with the failing
    lines. A null text counts as none: no words, not kept, clean text empty. Repeated rows are judged
    alike. The input row is carried whole as a struct, so other columns may have any name.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    judged = docs.select(F.struct("*").alias("row"), F.length(body).cast("long").alias("chars_in"), let(body, _judged).alias("j"))
    figures = judged.select("row", "chars_in", "j.w.*", "j.l.*").withColumn("chars_out", F.length("clean_text").cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    lost = 100 * (F.col("chars_in") - F.col("chars_out")) > max_loss_pct * F.col("chars_in")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars_in", "chars_out", "clean_text"]
    return figures.select("row", F.struct(*names, failed.alias("base_failed"), (~failed & ~lost).alias("kept")).alias("q"))
