"""Quality rules: a table of thresholds compiled into one projection of built-in expressions.

Counts of words, symbols, marks, stop words and lines are taken from each whole text, and every
rule bounds the ratio of two of them. No user function, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from has have he in is it of on or that the this to was were "
    "will with you not but "
    "der die das den dem des ein eine einer und oder ist sind war nicht mit von zu auf für im in "
    "sich auch es an dass "
    "le la les un une des du de et ou est sont pas que qui dans en pour par sur au aux il elle ce "
    "el los las lo una y o es son no por con para del al se su como más").split()

SPACE = r"[ \t-\r]+"


@dataclass(frozen=True)
class Rule:
    """``low`` <= ``count`` / ``per`` <= ``high``, for texts of ``words`` words or more."""

    name: str
    count: str
    per: str
    low: float | None = None
    high: float | None = None
    words: int = 0


RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2, 15),
    Rule("symbol_ratio", "n_symbols", "n_words", high=0.3),
    Rule("shout_ratio", "n_marks", "n_words", high=0.4),
    Rule("stop_word_ratio", "n_stop_words", "n_words", low=0.02, words=50),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", high=0.5),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", high=0.3),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", high=0.9),
)

#: A text fails the base if it has fewer words, or a larger percentage of repeated ones.
LEAST_WORDS, REPEATED_PERCENT, WINDOW = 10, 20, 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks",
          "n_stop_words", "n_lines", "n_ellipsis_lines", "n_bullet_lines")
RESULTS = (*COUNTS, "failed_rules", "base_failed", "kept")


def _left_out(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _repeated(words: Column, sorted_windows: Column) -> Column:
    """Words in windows whose hash stands next to an equal one in the sorted array of (hash, place):
    the sum of the steps between the places of such windows, each at most a window long."""
    at = F.sort_array(F.transform(F.filter(sorted_windows, lambda w, k: (
        (w.hash == F.get(sorted_windows, k - 1).hash)
        | (w.hash == F.get(sorted_windows, k + 1).hash))), lambda w: w.place))
    steps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))),
                       lambda a, b: F.least(F.lit(WINDOW), b - a))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def score(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``df`` with the counts, ``failed_rules`` (names), ``base_failed`` and ``kept``. Columns of
    these names are replaced.

    Words are runs of other than ASCII white space; a null text counts as an empty one, which has
    no words and fails the base. Lines without a word are not counted. ``n_repeat_words``: words
    that lie in a window of 5 words which the text has twice or more, the first included. Rows are
    neither joined nor dropped; the work on a text grows with n log n of its words.
    """
    prefix = "_quality_"
    while any(c.startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    rest = [F.col(f"`{c}`") for c in df.columns if c not in RESULTS]

    def own(name: str) -> Column:
        return F.col(prefix + name)

    rows = df.select(*rest, F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
                     .alias(prefix + "text"))
    rows = rows.select(
        "*",
        F.filter(F.split(own("text"), SPACE), lambda w: w != "").alias(prefix + "words"),
        F.filter(F.split(own("text"), "\n"), lambda l: l.rlike(r"[^ \t-\r]")).alias(prefix + "lines"))
    count = F.size(own("words"))
    windows = F.when(count >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(count - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(own("words"), i + k) for k in range(WINDOW)])))
    rows = rows.select("*", count.cast("long").alias(prefix + "n"), windows.alias(prefix + "hashes"))
    repeats = F.size(F.array_distinct(own("hashes"))) < F.size(own("hashes"))
    rows = rows.select("*", F.when(repeats, F.array_sort(F.transform(
        own("hashes"), lambda h, i: F.struct(h.alias("hash"), i.alias("place")))))
        .alias(prefix + "sorted"))

    n_lines = F.size(own("lines"))
    counts = {
        "n_words": own("n"),
        "word_chars": F.char_length(F.translate(own("text"), " \t\n\x0b\f\r", "")),
        "n_symbols": _left_out(own("text"), "#*$%&|<>"),
        "n_dup_lines": n_lines - F.size(F.array_distinct(own("lines"))),
        "n_repeat_words": F.coalesce(_repeated(own("words"), own("sorted")), F.lit(0)),
        "n_marks": _left_out(own("text"), "!?"),
        "n_stop_words": F.size(F.filter(own("words"), lambda w: F.lower(
            F.btrim(w, F.lit(".,;:!?\"'()"))).isin(STOP_WORDS))),
        "n_lines": n_lines,
        "n_ellipsis_lines": F.size(F.filter(own("lines"), lambda l: l.rlike(r"(\.\.\.|…)[ \t-\r]*$"))),
        "n_bullet_lines": F.size(F.filter(own("lines"), lambda l: l.rlike(r"^[ \t-\r]*[-*•]"))),
    }
    rows = rows.select(*rest, *[c.cast("long").alias(prefix + n) for n, c in counts.items()])

    def broken(rule: Rule) -> Column:
        ratio = own(rule.count) / F.when(own(rule.per) > 0, own(rule.per))
        bounds = [ratio < b if low else ratio > b
                  for b, low in ((rule.low, True), (rule.high, False)) if b is not None]
        out = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
        return F.coalesce(out & (own("n_words") >= rule.words), F.lit(False))

    failed = F.array_compact(F.array(*[F.when(broken(r), F.lit(r.name)) for r in rules]))
    base = (own("n_words") < LEAST_WORDS) | (
        100 * own("n_repeat_words") > REPEATED_PERCENT * own("n_words"))
    # a filter on the result must stay above it: pushed down, it would take the counts once more
    stays = F.monotonically_increasing_id() >= 0
    return (rows.select(*rest, *[own(n).alias(n) for n in COUNTS], failed.alias("failed_rules"),
                        base.alias("base_failed"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0) & stays))


def passing(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``df`` that no rule rejects, with the columns of ``df`` as they are."""
    return score(df.select(F.struct("*").alias("_row"), F.col(f"`{text}`").alias("_text")),
                 "_text", rules).filter("kept").select("_row.*")
