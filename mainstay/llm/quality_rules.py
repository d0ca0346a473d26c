"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mainstay.llm.columns import let, words

# What counts as a symbol, and frequent function words of the languages of the corpus.
SYMBOLS = "[#*$%&|<>]"
STOP_WORDS = (
    "the of and to in is that it for with as was on be at by this are or from an not have "
    "der die das und von den mit im ist zu ein eine für auf des dem nicht als auch es "
    "de la le et les des en un une du que dans est pour sur par au "
    "el los las se del una por con para es y"
).split()

# (name, measure, lowest allowed, highest allowed); a bound of None isn't tested.
RULES = [
    ("mean_word_length", "word_chars / n_words", 2.0, 12.0),
    ("symbol_ratio", "n_symbols / n_words", None, 0.10),
    ("exclaim_ratio", "n_exclaims / n_words", None, 0.30),
    ("stop_word_ratio", "n_stop_words / n_words", 0.02, None),
    ("dup_line_ratio", "n_dup_lines / n_lines", None, 0.50),
    ("repeat_word_ratio", "n_repeat_words / n_words", None, 0.50),
]


def _pairs(hashes: Column) -> Column:
    """A hash for each window of three words."""
    rest = lambda start: F.slice(hashes, F.lit(start), F.greatest(F.size(hashes), F.lit(1)))
    two = F.zip_with(hashes, rest(2), lambda a, b: F.xxhash64(a, b))
    three = F.zip_with(two, rest(3), lambda a, b: F.xxhash64(a, b))
    return F.slice(three, F.lit(1), F.greatest(F.size(hashes) - 2, F.lit(0)))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more: sort the windows, mark equal neighbours, add up what they cover."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = let(
        ordered,
        lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"])),
            lambda x: x["i"],
        )),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(
        starts, start,
        lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["end"])).alias("n"), (i + 3).alias("end")),
    )
    return total["n"]


def repeat_words(all_words: Column) -> Column:
    """Words in windows of three that occur at least twice in the text; texts without any skip the sorting."""
    return let(
        F.transform(all_words, lambda w: F.xxhash64(w)),
        lambda hashes: let(
            _pairs(hashes),
            lambda windows: F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_covered(windows)),
        ),
    )


def measures(text: Column) -> Column:
    """A struct of the counts that the rules use."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike("[^ \\t-\\r]"))
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
    whole = F.coalesce(text, F.lit(""))
    return let(
        words(text),
        lambda w: let(
            lines,
            lambda shown: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
                F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                F.size(shown).cast("long").alias("n_lines"),
                (F.size(shown) - F.size(F.array_distinct(shown))).cast("long").alias("n_dup_lines"),
                repeat_words(w).cast("long").alias("n_repeat_words"),
                F.regexp_count(whole, F.lit("!")).cast("long").alias("n_exclaims"),
                F.size(F.filter(w, lambda x: F.array_contains(stop, x))).cast("long").alias("n_stop_words"),
            ),
        ),
    )


def verdict(found: Column, rules: list = RULES) -> Column:
    """Whether all rules hold; a text without words or lines holds those whose ratio it doesn't have."""
    tests = []
    for _, measure, low, high in rules:
        top, bottom = measure.split(" / ")
        ratio = found[top] / F.nullif(found[bottom], F.lit(0))
        tests += [F.coalesce(ratio >= low, F.lit(True))] if low is not None else []
        tests += [F.coalesce(ratio <= high, F.lit(True))] if high is not None else []
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def quality_rules(docs: DataFrame, rules: list = RULES, text: str = "text") -> DataFrame:
    """doc_id, the counts of each whole text, base_failed and kept, from one projection without user functions.

    Words are runs of other than white space; a null text has none. n_dup_lines counts lines with a word that equal
    an earlier line; n_repeat_words counts words inside three-word windows that the text holds at least twice.
    base_failed: under 50 words, or more than half of them repeated; kept is then false, else the rules decide.
    Rows are judged one by one: repeated rows repeat, an empty table gives no rows, other columns aren't read.
    """
    found = docs.select("doc_id", measures(F.col(text)).alias("_m"))
    m = F.col("_m")
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(
        "doc_id", *[m[n].alias(n) for n in names], failed.alias("base_failed"),
        (~failed & verdict(m, rules)).alias("kept"), m["n_lines"].alias("n_text_lines"),
        m["n_exclaims"].alias("n_exclaims"), m["n_stop_words"].alias("n_stop_words"),
    )
