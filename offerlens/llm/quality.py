"""Quality rules: a table of thresholds, compiled into one projection.

Every document gets its counts (words, symbols, repeated lines, repeated passages, stop
words) from native functions on its own row: there is no shuffle and no user function,
so neither a hot source nor a group of copies matters.

Defined results: a missing text is an empty one and fails the base test; documents are
judged row by row, so repeated rows are judged alike; an empty table gives an empty one.
Columns of the input that share a name with a column made here are replaced.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.llm import words as W

#: Symbols that markup and code leave behind.
SYMBOLS = "#*$%&|<>"
#: Base test: so few words fail, and so large a share (in %) of words in repeated passages.
MIN_WORDS, MAX_REPEAT_PERCENT, PASSAGE = 10, 20, 5

#: Function words of the four languages of the corpus.
STOP_WORDS = sorted(set(
    "the of and to a in is it that for on was with as at by be this from or are an not have "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le et les du une un que est pour qui dans par plus pas au sur avec en "
    "el y los se del las por con no una su para es al lo".split()
))


@dataclass(frozen=True)
class Rule:
    """A bound on a ratio of two counts; documents outside are rejected.

    ``from_words`` exempts shorter documents, whose ratios say little.
    """

    name: str
    part: str
    whole: str
    at_least: float | None = None
    at_most: float | None = None
    from_words: int = 0


#: The production table. ``one`` is the constant 1, for bounds on a plain count.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", at_least=2.0, at_most=15.0),
    Rule("symbols_per_word", "n_symbols", "n_words", at_most=0.2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", at_most=0.5),
    Rule("stop_words", "n_stop_words", "n_words", at_least=0.02, from_words=100),
    Rule("words_per_line", "n_words", "n_lines", at_least=1.5, from_words=100),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the columns ``COUNTS`` (long)."""
    docs = docs.drop(*COUNTS)
    scratch = ["__text", "__pieces", "__words", "__lines", "__hash", "__grams", "__sorted"]
    whole = W.text_of(F.col("__text"))
    pieces = docs.withColumn("__text", W.text_of(F.col(text))).withColumn("__pieces", F.split(whole, W.SPACE_RUN))
    parts = pieces.withColumns({
        "__words": W.without_empty_ends(F.col("__pieces")),
        "__lines": F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    })
    hashed = parts.withColumns({
        "__hash": F.transform("__words", lambda w: F.xxhash64(w)),
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.char_length(W.without_chars(whole, W.SPACES)).cast("long"),
        "n_symbols": (F.char_length(whole) - F.char_length(W.without_chars(whole, SYMBOLS))).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_stop_words": F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
    }).drop("__text", "__pieces", "__words", "__lines")
    grams = hashed.withColumn("__grams", W.window_hashes(F.col("__hash"), PASSAGE))
    return W.computed_once(_with_repeats(grams).drop(*scratch), COUNTS)


def _with_repeats(grams: DataFrame) -> DataFrame:
    """Words covered by passages that occur twice or more, the first time included.

    Windows are sorted by hash, so that equal ones are neighbours; the starts of those
    are sorted again and their lengths added up, overlaps once.
    """
    repeats = F.size(F.array_distinct("__grams")) < F.size("__grams")
    placed = F.sort_array(F.transform("__grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    sorted_ = F.col("__sorted")
    twins = F.filter(
        sorted_,
        lambda x, i: F.coalesce(F.get(sorted_, i - 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.get(sorted_, i + 1)["g"] == x["g"], F.lit(False)),
    )
    covered = F.aggregate(
        F.sort_array(F.transform(twins, lambda x: x["i"])),
        F.struct(F.lit(0).alias("covered"), F.lit(-PASSAGE).alias("last")),
        lambda acc, i: F.struct(
            (acc["covered"] + F.least(F.lit(PASSAGE), i - acc["last"])).alias("covered"), i.alias("last")
        ),
        lambda acc: acc["covered"],
    )
    return grams.withColumn("__sorted", F.when(repeats, placed)).withColumn(
        "n_repeat_words", F.when(sorted_.isNull(), 0).otherwise(covered).cast("long")
    )


def passes(rule: Rule) -> Column:
    """True where a document keeps to ``rule``. A ratio with an empty whole is 0."""
    whole = F.col(rule.whole)
    ratio = F.when(whole > 0, F.col(rule.part) / F.greatest(whole, F.lit(1))).otherwise(0.0)
    bounds = [F.col("n_words") < rule.from_words] if rule.from_words else [F.lit(False)]
    inside = F.lit(True)
    if rule.at_least is not None:
        inside &= ratio >= rule.at_least
    if rule.at_most is not None:
        inside &= ratio <= rule.at_most
    return bounds[0] | inside


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` plus ``COUNTS``, ``base_failed``, ``broken_rules`` (names) and ``kept``."""
    counted = with_counts(docs, text).drop("base_failed", "broken_rules", "kept")
    broken = F.array_compact(F.array(*[F.when(~passes(rule), F.lit(rule.name)) for rule in rules]))
    verdict = reduce(lambda a, b: a & b, map(passes, rules), ~base_failed())
    return counted.withColumns({"base_failed": base_failed(), "broken_rules": broken, "kept": verdict})
