"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every measure of a text is a column expression over its words and lines; every rule is a row of ``RULES`` that bounds
the ratio of two measures; the verdict is the conjunction. There is no shuffle and no user function, so a hot source
or a group of copies costs no more than its share.

Defined results: a NULL or empty text has no words and fails; rows are judged one by one, so equal rows get equal
verdicts; other columns pass through, and working columns carry a prefix that gives way to the caller's names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs without ASCII white space; eight words make a window; symbol characters.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"

#: Frequent function words of the four languages of the corpus, lower case.
STOP_WORDS = (
    "the of and to in is that it for on was be with as by this a are at from "
    "der die das und zu den von mit ist ein eine nicht im sich des auf "
    "de la el en y que los las se un por con del no es "
    "le les et à une du dans pour sur pas qui par est au"
).split()


@dataclass(frozen=True)
class Rule:
    """The measure must be ``low`` to ``high`` percent of another one, in whole numbers; ``from_words`` spares short texts."""

    name: str
    measure: str
    of: str
    low: int | None = None
    high: int | None = None
    from_words: int = 0

    def compile(self) -> Column:
        value, base = F.col(self.measure) * 100, F.col(self.of)
        holds = F.lit(True)
        if self.low is not None:
            holds = holds & (value >= self.low * base)
        if self.high is not None:
            holds = holds & (value <= self.high * base)
        return holds | (F.col("n_words") < self.from_words) if self.from_words else holds


#: The threshold table. Base rules first: they make ``base_failed``.
BASE_RULES = (
    Rule("min_words", "n_words", "_one", low=2000),
    Rule("repeated_windows", "n_repeat_words", "n_words", high=30),
)
RULES = (
    Rule("word_length_low", "word_chars", "n_words", low=200),
    Rule("word_length_high", "word_chars", "n_words", high=1500),
    Rule("symbols_per_word", "n_symbols", "n_words", high=15),
    Rule("bangs_per_word", "n_bangs", "n_words", high=50),
    Rule("stop_words", "n_stop_words", "n_words", low=4, from_words=40),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the measures of its text column added.

    ``n_repeat_words``: windows of eight words are compared by a 64-bit hash inside one text. Positions of windows
    that occur twice or more are put in order; a position adds the words up to the next one, at most eight.
    """
    w = F.col("_words")
    hashes = F.col("_hashes")
    ranked = F.col("_ranked")
    at = F.col("_at")
    kept_lines = F.filter(F.split(F.col("_text"), "\n", -1), lambda x: x.rlike(NOT_SPACE))
    no_positions = F.array().cast("array<int>")
    twice = lambda x, j: (x["h"] == F.get(ranked, j - 1)["h"]) | (x["h"] == F.get(ranked, j + 1)["h"])
    return (
        docs.withColumn("_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
        .withColumns({"_words": F.array_remove(F.split(F.col("_text"), SPACE), ""), "_lines": kept_lines})
        .withColumn("_hashes", F.when(F.size(w) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))
            .otherwise(F.array().cast("array<bigint>")))
        .withColumn("_ranked", F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
        .withColumn("_at", F.when(ranked.isNotNull(), F.sort_array(
            F.transform(F.filter(ranked, lambda x, j: F.coalesce(twice(x, j), F.lit(False))), lambda x: x["i"])))
            .otherwise(no_positions))
        .withColumns({
            "_one": F.lit(1),
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
            "n_bangs": (F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("!"), F.lit("")))).cast("long"),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": _sum(F.transform(
                at, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW))).cast("long"))),
        })
        .drop("_text", "_words", "_lines", "_hashes", "_ranked", "_at")
    )


MEASURES = ("n_words", "word_chars", "n_symbols", "n_bangs", "n_stop_words", "n_lines", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input's columns as struct ``row``, and struct ``quality``: measures, ``base_failed``, ``kept``, ``failed`` (rules)."""
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    measured = measures(docs.select(own, F.col(text).alias("_judged")), "_judged")
    base_ok, all_ok = F.lit(True), F.lit(True)
    for rule in BASE_RULES:
        base_ok = base_ok & rule.compile()
    for rule in rules:
        all_ok = all_ok & rule.compile()
    names = F.array_compact(F.array(*[F.when(~r.compile(), F.lit(r.name)) for r in (*BASE_RULES, *rules)]))
    verdict = F.struct(
        *[F.col(m) for m in MEASURES], (~base_ok).alias("base_failed"), (base_ok & all_ok).alias("kept"), names.alias("failed"))
    # A generator of one row: a later filter on the verdict is evaluated above it. Otherwise the optimizer would move the
    # filter below and write the measures, which rest on each other, out in full for every use.
    return measured.select(F.inline(F.array(F.struct("row", verdict.alias("quality")))))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text passes every rule, with their own columns only."""
    return judge(docs, text).filter("quality.kept").select("row.*")
