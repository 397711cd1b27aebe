"""Line-first cleaning: judge lines, remove those that fail, reject documents that lose too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteflow.llm.line_dedup import lines_of

# Space and the controls 9 to 13 part words; these characters count as symbols.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
# What parts the entries of a menu.
SEPARATORS = "|»›>•·"
# A line of prose ends with one of these, a closing quote or bracket may follow.
LINE_END = r"[.!?:;…。！？]['\"”’»)\]]*[" + SPACE + r"]*\z"
# Openings of lines that sites put on every page.
BOILERPLATE = (
    r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|accept (all )?cookies"
    r"|subscribe to (our|the) newsletter|sign (in|up) to|log in to|enable javascript|skip to content"
    r"|(licensed|released) under (the|a|cc) )"
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+", -1), lambda word: word != "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _symbols(text: Column) -> Column:
    """How many characters of `SYMBOLS` a text has."""
    return F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", ""))


def line_failures(line: Column, max_symbols: float = 0.2, max_separators: int = 3, words: Column | None = None) -> Column:
    """The first rule that a line breaks: ``navigation``, ``boilerplate``, ``symbols``, ``capitals`` or
    ``punctuation``; null if it breaks none. A line without words breaks none. ``words`` is their number, if it is known.

    Cheap conditions stand before those that search the line, as Spark works out no more than it needs.
    """
    words = _count(line, f"[^{SPACE}]+") if words is None else words
    separators = _count(line, f"(^|[{SPACE}])[{SEPARATORS}]([{SPACE}]|\\z)")
    # A line without separators needs no count.
    separators = F.when(line.rlike(f"[{SEPARATORS}]"), separators).otherwise(0)
    capitals, small = _count(line, r"\p{Lu}"), _count(line, r"\p{Ll}")
    return (
        F.when(words == 0, F.lit(None))
        .when((separators >= max_separators) & (separators * 6 >= words), "navigation")
        .when((words <= 30) & line.rlike(BOILERPLATE), "boilerplate")
        .when(_symbols(line) > max_symbols * words, "symbols")
        .when((F.length(line) >= 20) & (capitals >= 20) & (capitals > small * 2), "capitals")
        .when((words >= 4) & ~line.rlike(LINE_END), "punctuation")
    )


ADDED = "n_words word_chars n_symbols n_dup_lines n_repeat_words n_words_lost base_failed kept cleaned_text".split()


def quality_rules(
    documents: DataFrame,
    max_lost: float = 0.5,
    min_words: int = 50,
    max_repeated_percent: int = 50,
    text_column: str = "text",
) -> DataFrame:
    """``documents`` with counts, the cleaned text, and the verdict.

    Lines are judged by `line_failures` first and those that fail are removed (``cleaned_text``). A
    document is ``kept`` unless it fails the base test (fewer than ``min_words`` words, or more than
    ``max_repeated_percent`` per cent of them in three-word windows that occur twice) or its lines
    that fail hold more than ``max_lost`` of its words. Everything is worked out row by row from
    whole texts, in time that grows with ``n log n`` of a text, without any shuffle.

    Null counts as the empty text, which fails the base test; its ``cleaned_text`` is empty. Columns
    of the input stay, but those with a name that is added here are replaced. Rows are independent,
    so repeated rows get equal results.
    """
    # Columns of the input travel in one, so that their names can't clash with those used here.
    names = [name for name in documents.columns if name not in ADDED]
    rows = documents.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("_row"))
    text = F.coalesce(F.col("_row")[text_column], F.lit(""))
    # The words of a line are counted once.
    counted = F.transform(lines_of(text), lambda line: F.struct(line.alias("line"), _count(line, f"[^{SPACE}]+").alias("n")))
    judged = F.transform(
        counted, lambda x: F.struct(x["line"].alias("line"), x["n"].alias("n"), line_failures(x["line"], words=x["n"]).alias("rule"))
    )
    base = rows.withColumns({"_words": words_of(text), "_judged": judged})
    base = base.withColumns(
        {
            "_windows": _windows(F.col("_words")),
            "_worded": F.transform(F.filter("_judged", lambda x: x["n"] > 0), lambda x: x["line"]),
        }
    )
    base = base.withColumn("_twice", _found_twice(F.col("_windows"))).select(
        "_row",
        "_judged",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        _symbols(text).cast("long").alias("n_symbols"),
        (F.size("_worded") - F.size(F.array_distinct("_worded"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_twice")).alias("n_repeat_words"),
        F.aggregate(
            "_judged",
            F.lit(0).cast("long"),
            lambda total, x: total + F.when(x["rule"].isNull(), 0).otherwise(x["n"]),
        ).alias("n_words_lost"),
    )
    base = base.withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeated_percent),
    )
    kept = ~F.col("base_failed") & (F.col("n_words_lost") <= F.col("n_words") * max_lost)
    passed = F.transform(F.filter("_judged", lambda x: x["rule"].isNull()), lambda x: x["line"])
    return base.select(
        *[F.col("_row")[name].alias(name) for name in names], *ADDED[:-2], kept.alias("kept"), F.array_join(passed, "\n").alias("cleaned_text")
    )


def _windows(words: Column) -> Column:
    """A 64-bit hash of each three words in a row."""
    three = lambda at: F.xxhash64(F.get(words, at), F.get(words, at + 1), F.get(words, at + 2))
    found = F.when(F.size(words) >= 3, F.transform(F.sequence(F.lit(0), F.size(words) - 3), three))
    return F.coalesce(found, F.array().cast("array<bigint>"))


def _found_twice(windows: Column) -> Column:
    """Windows with their places, sorted, where any occurs twice; else none."""
    placed = F.sort_array(F.transform(windows, lambda window, at: F.struct(window.alias("window"), at.alias("at"))))
    none = F.array().cast("array<struct<window:bigint,at:int>>")
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).otherwise(none)


def _covered(placed: Column) -> Column:
    """Words inside windows that equal a neighbour in sorted order."""
    window = lambda at: F.get(placed, at)["window"]
    twice = F.filter(
        placed,
        lambda x, at: x["window"].eqNullSafe(window(at - 1)) | x["window"].eqNullSafe(window(at + 1)),
    )
    starts = F.sort_array(F.transform(twice, lambda x: x["at"]))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    step = lambda seen, at: F.struct(
        (at + 3).alias("end"), (seen["total"] + at + 3 - F.greatest(at, seen["end"])).alias("total")
    )
    return F.aggregate(starts, zero, step, lambda seen: seen["total"])
