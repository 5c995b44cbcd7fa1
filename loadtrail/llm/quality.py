"""Quality rules under weak supervision, in built-in functions only.

Eight rules look at a document and vote for it (1), against it (-1) or abstain (0). Nobody knows how far each rule
can be trusted, so expectation-maximisation estimates it from how the rules agree: given the accuracies, every
pattern of votes has a posterior probability of being good; given the posteriors, every rule has an accuracy on good
and on bad documents. A document stays if its posterior is high enough, instead of having to pass every rule.

The rows are read once. EM itself runs on the table of vote patterns with their counts, at most ``3 ** 8`` rows
whatever the size of the corpus.

Defined cases: a null or empty text has no words, all its counts are 0, and it fails the base rule; a row with no
vote at all gets the prior. Equal rows get equal verdicts. Long texts are treated whole. With an empty table the
accuracies keep their start values and the result is empty. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtrail.llm.staging import WORD, bound, landed, word_array

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Frequent function words of the four languages; fixed values.
STOP_WORDS = {
    "en": "the of and to in a is that it for was on with as be by are this from at an or not".split(),
    "de": "der die und das von zu den mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "fr": "le la les de des et un une que qui dans pour est par sur pas au du avec ce".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}
#: Accuracies before the first round: rules rarely accuse a good document, and each sees some of the bad ones.
START_GOOD, START_BAD = 0.95, 0.3
#: Words of a block in which different words are counted.
BLOCK_WORDS = 500
RULES = ("symbols", "capitals", "exclamations", "stop_words", "variety", "sentences", "repeats", "word_length")


@dataclass(frozen=True)
class Model:
    """Share of good documents, and per rule how often it is right on good and on bad ones."""

    prior: float = 0.8
    on_good: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RULES, START_GOOD))
    on_bad: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RULES, START_BAD))

    def posterior(self) -> Column:
        """Probability that a document with these votes is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule in RULES:
            good, bad = self.on_good[rule], self.on_bad[rule]
            odds += (
                F.when(F.col(rule) > 0, F.lit(math.log(good / (1 - bad))))
                .when(F.col(rule) < 0, F.lit(math.log((1 - good) / bad)))
                .otherwise(F.lit(0.0))
            )
        return 1 / (1 + F.exp(-odds))


def count_of(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{characters}]")).cast("long")


def repeated_window_words(codes: Column) -> Column:
    """Words, given by their hashes, that lie in a window of eight words found more than once in the text.

    Hashes of two, four and eight words in a row are built from one another. A window of eight can only repeat where
    one of four does, and only texts in which a hash of eight repeats sort them. The windows that repeat are then
    taken by position, and each adds the words that the one before it did not cover.
    """

    def rows_of(shorter: Column, step: int) -> Column:
        ahead = F.slice(shorter, F.lit(step + 1), F.greatest(F.size(shorter) - step, F.lit(0)))
        behind = F.slice(shorter, F.lit(1), F.greatest(F.size(shorter) - step, F.lit(0)))
        return F.zip_with(behind, ahead, lambda a, b: F.xxhash64(a, b))

    def repeats(hashes: Column) -> Column:
        return F.size(F.array_distinct(hashes)) < F.size(hashes)

    def starts(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = lambda s, x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        twice = lambda s: F.filter(s, lambda x, k: again(s, x, k - 1) | again(s, x, k + 1))
        return F.array_sort(F.transform(bound(placed, twice), lambda x: x["i"]))

    def covered(hashes: Column) -> Column:
        first = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("words"))
        step = lambda seen, at: F.struct(
            at.alias("last"), (seen["words"] + F.least(F.lit(WINDOW), at - seen["last"])).alias("words")
        )
        return F.aggregate(starts(hashes), first, step, lambda seen: seen["words"])

    none = F.lit(0).cast("long")
    of_eights = lambda eights: F.when(repeats(eights), covered(eights)).otherwise(none)
    of_fours = lambda fours: F.when(repeats(fours), bound(rows_of(fours, 4), of_eights)).otherwise(none)
    of_twos = lambda twos: bound(rows_of(twos, 2), of_fours)
    return F.when(F.size(codes) <= WINDOW, none).otherwise(bound(rows_of(codes, 1), of_twos))


def distinct_by_blocks(codes: Column) -> Column:
    """Different words of every block of ``BLOCK_WORDS``, added up: their share in all words does not fall with the length."""
    starts = F.sequence(F.lit(0), F.floor(F.greatest(F.size(codes) - 1, F.lit(0)) / BLOCK_WORDS).cast("int"))
    sizes = F.transform(starts, lambda k: F.size(F.array_distinct(F.slice(codes, k * BLOCK_WORDS + 1, F.lit(BLOCK_WORDS)))))
    return F.aggregate(sizes, F.lit(0).cast("long"), lambda total, size: total + size)


def measured(docs: DataFrame, keep: list[Column], text_column: str) -> DataFrame:
    """The kept columns and, per document, the base counts and the votes."""
    text = F.coalesce(docs[text_column], F.lit(""))
    kept = [*keep, text.alias("quality_text"), word_array(docs[text_column]).alias("quality_words")]
    rows = docs.select(*kept)
    rows = rows.withColumn("quality_codes", F.transform("quality_words", lambda w: F.xxhash64(w)))
    text, words, codes = F.col("quality_text"), F.col("quality_words"), F.col("quality_codes")
    worded = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_count(line, F.lit(WORD)) > 0)
    stop = F.array(*[F.lit(w) for w in sorted({w for own in STOP_WORDS.values() for w in own})])
    rows = rows.select(
        *rows.columns[: len(keep)],
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).alias("n_symbols"),
        bound(worded, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        repeated_window_words(codes).alias("n_repeat_words"),
        count_of(text, "A-Z").alias("n_capitals"),
        count_of(text, "!").alias("n_exclamations"),
        count_of(text, ".!?").alias("n_ends"),
        distinct_by_blocks(codes).alias("n_distinct"),
        F.size(F.array_intersect(words, stop)).cast("long").alias("n_stop"),
    )
    n = F.col("n_words")
    votes = {
        "symbols": (F.col("n_symbols") * 50 <= n, F.col("n_symbols") * 5 > n),
        "capitals": (F.col("n_capitals") * 4 <= F.col("word_chars"), F.col("n_capitals") * 2 > F.col("word_chars")),
        "exclamations": (F.col("n_exclamations") * 20 <= n, F.col("n_exclamations") * 5 > n),
        "stop_words": ((F.col("n_stop") >= 4) & (n >= 10), (F.col("n_stop") <= 1) & (n >= 20)),
        "variety": (F.col("n_distinct") * 5 >= n * 2, (F.col("n_distinct") * 5 < n) & (n >= 40)),
        "sentences": (F.col("n_ends") * 50 >= n, (F.col("n_ends") == 0) & (n >= 40)),
        "repeats": (F.col("n_repeat_words") * 10 <= n, F.col("n_repeat_words") * 5 > n),
        "word_length": (F.col("word_chars").between(n * 3, n * 9), ~F.col("word_chars").between(n * 2, n * 15)),
    }
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    counted = F.col("n_words") > 0
    return rows.withColumns(
        {
            "base_failed": failed,
            **{
                rule: F.when(counted & votes[rule][0], 1).when(counted & votes[rule][1], -1).otherwise(0)
                for rule in RULES
            },
        }
    )


def fitted(patterns: DataFrame, rounds: int = 30) -> Model:
    """EM over a table of vote patterns and their counts ``n``, as one expression over its at most ``3 ** 8`` rows.

    The counts are smoothed by ten imagined votes at the start accuracy. On good documents accuracies stay above
    0.55, which keeps the two classes from changing places; on bad ones a rule may be blind, down to 0.05.
    """

    def odds(state: Column, votes: Column) -> Column:
        total = F.log(state["prior"] / (1 - state["prior"]))
        for k in range(len(RULES)):
            good, bad = state["on_good"][k], state["on_bad"][k]
            total += F.when(votes[k] > 0, F.log(good / (1 - bad))).when(votes[k] < 0, F.log((1 - good) / bad)).otherwise(0.0)
        return total

    def share(rows: Column, start: float, right, of) -> Column:
        """Smoothed share of ``right`` in ``of``, both functions from a row to a number."""
        zero = F.struct(F.lit(10 * start).alias("right"), F.lit(10.0).alias("of"))
        add = lambda s, x: F.struct((s["right"] + right(x)).alias("right"), (s["of"] + of(x)).alias("of"))
        return F.aggregate(rows, zero, add, lambda s: F.least(F.lit(0.99), s["right"] / s["of"]))

    def updated(rows: Column) -> Column:
        on_good, on_bad = [], []
        for k in range(len(RULES)):
            up = share(rows, START_GOOD, lambda x: F.when(x["v"][k] > 0, x["p"]).otherwise(0.0), lambda x: F.when(x["v"][k] != 0, x["p"]).otherwise(0.0))
            down = share(rows, START_BAD, lambda x: F.when(x["v"][k] < 0, x["q"]).otherwise(0.0), lambda x: F.when(x["v"][k] != 0, x["q"]).otherwise(0.0))
            on_good.append(F.greatest(F.lit(0.55), up))
            on_bad.append(F.greatest(F.lit(0.05), down))
        prior = F.greatest(F.lit(0.01), share(rows, 0.8, lambda x: x["p"], lambda x: x["p"] + x["q"]))
        return F.struct(prior.alias("prior"), F.array(*on_good).alias("on_good"), F.array(*on_bad).alias("on_bad"))

    def step(state: Column, _: Column) -> Column:
        def weighed(x: Column) -> Column:
            return bound(
                1 / (1 + F.exp(-odds(state, x["v"]))),
                lambda p: F.struct(x["v"].alias("v"), (x["n"] * p).alias("p"), (x["n"] * (1 - p)).alias("q")),
            )

        return bound(F.transform("patterns", weighed), updated)

    start = F.struct(
        F.lit(0.8).alias("prior"),
        F.array_repeat(F.lit(START_GOOD), len(RULES)).alias("on_good"),
        F.array_repeat(F.lit(START_BAD), len(RULES)).alias("on_bad"),
    )
    gathered = patterns.agg(F.collect_list(F.struct(F.array(*RULES).alias("v"), F.col("n").cast("double").alias("n"))).alias("patterns"))
    found = gathered.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("model")).first()["model"]
    return Model(found["prior"], dict(zip(RULES, found["on_good"])), dict(zip(RULES, found["on_bad"])))


def vote_patterns(rows: DataFrame) -> DataFrame:
    """How often each pattern of votes occurs among the rows that the base rule lets through."""
    return rows.where(~F.col("base_failed")).groupBy(*RULES).agg(F.count(F.lit(1)).alias("n"))


def quality_verdicts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Per row: identifier, base counts, ``base_failed``, ``kept``, the posterior and the votes."""
    rows = landed(measured(docs, [docs[id_column].alias(id_column)], text_column), "quality-counts")
    posterior = fitted(vote_patterns(rows)).posterior()
    return rows.select(
        id_column,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (posterior >= threshold)).alias("kept"),
        posterior.alias("posterior"),
        *RULES,
    )


def drop_low_quality(docs: DataFrame, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that pass, with all their columns.

    The rows are landed beside their votes: they are measured once, and the decision is a filter over plain columns. Over
    the measures themselves it would repeat their expressions for every mention of a vote.
    """
    rows = measured(docs, [F.struct("*").alias("quality_row")], text_column)
    rows = landed(rows.select("quality_row", "base_failed", *RULES), "quality-rows")
    posterior = fitted(vote_patterns(rows)).posterior()
    passed = rows.where(~F.col("base_failed") & (posterior >= threshold))
    return passed.select([F.col("quality_row").getField(c).alias(c) for c in docs.columns])
