"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a built-in expression over the text, its words and its lines;
a rule is a measure and the range that a document must keep to.  The verdict is
the conjunction of all rules.  No user function runs and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that parts words: space and the controls 09-0D.
GAPS = "\x20\x09\x0a\x0b\x0c\x0d"
#: Marks at the end of a word that don't belong to it.
STOPS = ".,;:!?"
SYMBOLS = "#*$%&|<>"
WINDOW = 8  # a power of two

# Frequent function words of the languages the rules are meant for.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "a", "in", "is", "it", "for", "on", "was", "as", "by", "this", "at", "from", "or", "an", "are"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "es", "an"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "plus", "pas", "au", "sur", "ne", "se", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su", "para", "es", "al", "lo", "como", "más"],
}


@dataclass(frozen=True)
class Rule:
    """A document must have low <= measure <= high; None is no bound."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The method's verdict beside the base.
RULES = (
    Rule("n_words", low=20, high=10_000_000),
    Rule("mean_word_chars", low=1.5, high=25.0),
    Rule("symbols_per_word", high=0.3),
    Rule("stop_word_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
    Rule("repeat_word_ratio", high=0.3),
    Rule("bullet_line_ratio", high=0.9),
    Rule("ellipsis_line_ratio", high=0.5),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _repeat_words(windows: Column, n_words: Column) -> Column:
    """Words inside windows that are found twice or more, given the sorted (hash, place) of all windows.

    A window repeats if a neighbour in the order has its hash.  Each repeated
    window covers its words up to the next repeated one.
    """
    behind = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), F.slice(windows, 1, F.greatest(F.size(windows) - 1, F.lit(0))))
    ahead = F.concat(F.slice(windows, 2, F.greatest(F.size(windows) - 1, F.lit(0))), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
    marked = F.filter(
        F.arrays_zip(windows.alias("own"), behind.alias("behind"), ahead.alias("ahead")),
        lambda x: F.coalesce(x["own"]["h"] == x["behind"]["h"], F.lit(False)) | F.coalesce(x["own"]["h"] == x["ahead"]["h"], F.lit(False)),
    )
    places = F.array_sort(F.transform(marked, lambda x: x["own"]["i"]))
    start = F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(
        places,
        start,
        lambda s, i: F.struct((s["total"] + F.least(F.lit(WINDOW), i - s["last"])).alias("total"), i.alias("last")),
        lambda s: s["total"],
    )
    return F.when(n_words < WINDOW, F.lit(0)).otherwise(covered).cast("bigint")


def _is_bullet(line: Column) -> Column:
    """Whether a line begins, after spaces and tabs, with a bullet and a space."""
    return F.substr(F.ltrim(line, F.lit(" \t")), F.lit(1), F.lit(2)).isin("- ", "* ", "• ")


def _is_cut(line: Column) -> Column:
    """Whether a line ends in an ellipsis, white space aside."""
    end = F.rtrim(line, F.lit(GAPS))
    return end.endswith("...") | end.endswith("…")


def _both(x: Column, y: Column) -> Column:
    return F.xxhash64(x, y)


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id and all measures) of each row of docs(doc_id, text, ...), by built-in functions."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    split = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("t")).select(
        "doc_id",
        "t",
        F.filter(F.split(F.translate("t", GAPS, " " * len(GAPS)), " "), lambda w: w != "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(GAPS)) != "").alias("lines"),
    )
    # hashes of two, four and eight words, each of two neighbours of the size before
    pairs = split.select("*", F.size("words").alias("n"), F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    for k in (1, 2, 4):
        pairs = pairs.withColumn(f"h{2 * k}", F.zip_with(f"h{k}", F.slice(f"h{k}", k + 1, F.greatest(F.col("n"), F.lit(1))), _both))
    windows = F.slice(f"h{WINDOW}", 1, F.greatest(F.col("n") - (WINDOW - 1), F.lit(0)))
    hashed = pairs.select("doc_id", "t", "words", "lines", "n", windows.alias("hashes"))
    sorted_ = hashed.select(
        "*",
        # most texts repeat no window: only the others are sorted
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        )
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("windows"),
    )
    stop_words = sorted({w for x in STOP_WORDS.values() for w in x})
    is_stop = lambda w: F.lower(F.rtrim(w, F.lit(STOPS))).isin(stop_words)
    # The condition always holds.  Being no constant, it keeps filters on measures from being moved below this
    # projection, where they would compute every array again for each mention.
    n_words = F.when(F.rand(0) >= 0, F.col("n").cast("bigint"))
    return sorted_.select(
        "doc_id",
        n_words.alias("n_words"),
        F.length(F.translate("t", GAPS, "")).cast("bigint").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words(F.col("windows"), F.col("n")).alias("n_repeat_words"),
        F.size(F.filter("words", is_stop)).cast("bigint").alias("n_stop_words"),
        F.size(F.filter("lines", _is_bullet)).cast("bigint").alias("n_bullet_lines"),
        F.size(F.filter("lines", _is_cut)).cast("bigint").alias("n_ellipsis_lines"),
    )


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The conjunction of the rules over the columns of `measures`."""
    words, lines = F.col("n_words"), F.col("n_lines")
    derived = {
        "mean_word_chars": _ratio(F.col("word_chars"), words),
        "symbols_per_word": _ratio(F.col("n_symbols"), words),
        "stop_word_ratio": _ratio(F.col("n_stop_words"), words),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), lines),
        "repeat_word_ratio": _ratio(F.col("n_repeat_words"), words),
        "bullet_line_ratio": _ratio(F.col("n_bullet_lines"), lines),
        "ellipsis_line_ratio": _ratio(F.col("n_ellipsis_lines"), lines),
    }
    held = F.lit(True)
    for rule in rules:
        value = derived.get(rule.measure, F.col(rule.measure))
        if rule.low is not None:
            held = held & (value >= rule.low)
        if rule.high is not None:
            held = held & (value <= rule.high)
    return held


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ...) for each row of docs(doc_id, text, ...).

    Null and empty texts, and texts of white space, have no words, no lines with
    a word and fail the base, which asks for 20 words and at most 30 hundredths
    of the words in windows of eight that repeat.  kept is false for them and
    else the verdict of the rules.  Repeated rows and null ids are judged like
    any other row; other columns are ignored; an empty table gives an empty one.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["n_lines", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines"]
    return measures(docs).select(*base, failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"), *more)
