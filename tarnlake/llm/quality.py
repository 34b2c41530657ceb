"""Quality rules as weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Everything runs as DataFrame expressions. The only rows that reach the driver are the counts of vote
patterns, of which there are at most 3 to the power of the number of rules, whatever the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import SPACE, WORD, bind, named, packed, settle, unpacked

BAD, ABSTAIN, GOOD = -1, 0, 1
VOTES = (BAD, ABSTAIN, GOOD)
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Each rule: its name, when it votes bad, and when it votes good. Otherwise it abstains. A document is junk
# in one way at a time, so a rule that finds nothing to blame abstains; only whole-text rules vote good.
RULES = (
    ("length", "n_words < 20", "false"),
    ("symbols", "n_symbols > 0.10 * n_words", "false"),
    ("shouting", "n_capitals > 0.50 * word_chars", "false"),
    ("stutter", "n_stutters > 0.15 * n_words", "false"),
    ("repeats", "n_repeat_words > 0.30 * n_words", "false"),
    ("lines", "n_dup_lines > 0.50 * n_lines", "false"),
    ("word_length", "word_chars < 2.5 * n_words OR word_chars > 15 * n_words", "false"),
    ("prose", "false",
     "n_words >= 20 AND n_symbols <= 0.02 * n_words AND n_capitals <= 0.20 * word_chars"
     " AND n_stutters <= 0.10 * n_words"),
)

# What EM starts from and is drawn to: how often a rule gives each vote to bad and to good documents.
PRIOR_BAD_SHARE = 0.1
PRIOR_VOTES = {"bad": {BAD: 0.30, ABSTAIN: 0.60, GOOD: 0.10}, "good": {BAD: 0.002, ABSTAIN: 0.498, GOOD: 0.50}}
PRIOR_WEIGHT = 0.05


@dataclass(frozen=True)
class VoteModel:
    """The share of bad documents, and for each rule the probability of each vote in either class."""

    bad_share: float
    bad: tuple[dict[int, float], ...]
    good: tuple[dict[int, float], ...]

    def log_odds(self, votes) -> float:
        """Log odds that a document with these votes is good."""
        return math.log((1 - self.bad_share) / self.bad_share) + sum(
            math.log(g[v] / b[v]) for g, b, v in zip(self.good, self.bad, votes))

    def accuracies(self) -> list[float]:
        """How often a rule is right when it doesn't abstain."""
        s = self.bad_share
        return [(s * b[BAD] + (1 - s) * g[GOOD]) / (s * (b[BAD] + b[GOOD]) + (1 - s) * (g[BAD] + g[GOOD]))
                for b, g in zip(self.bad, self.good)]


def repeated_window_words(hashes: Column, width: int = WINDOW) -> Column:
    """How many words lie in windows of ``width`` words that the text holds twice or more.

    Windows are compared by 64-bit hashes of the word hashes. The positions of repeated windows are
    sorted, so that the cost stays n log n however often a window comes back.
    """

    def covered(windows: Column) -> Column:
        def words_of(pairs: Column) -> Column:
            again = F.filter(pairs, lambda p, k: (
                (k > 0) & (F.get(pairs, k - 1)["h"] == p["h"])) | F.coalesce(
                    F.get(pairs, k + 1)["h"] == p["h"], F.lit(False)))
            return bind(F.sort_array(F.transform(again, lambda p: p["at"])), lambda starts: F.aggregate(
                F.transform(starts, lambda s, k: F.least(
                    F.lit(width), F.coalesce(F.get(starts, k + 1) - s, F.lit(width))).cast("long")),
                F.lit(0).cast("long"), lambda a, b: a + b))

        pairs = F.sort_array(F.transform(windows, lambda h, k: F.struct(h.alias("h"), k.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            bind(pairs, words_of))

    def windows_of(hs: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hs) - (width - 1))
        return bind(F.transform(starts, lambda i: F.xxhash64(F.slice(hs, i, width))), covered)

    return bind(hashes, lambda hs: F.when(
        F.size(hs) <= width, F.lit(0).cast("long")).otherwise(windows_of(hs)))


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_stutters",
            "n_lines")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row) and the counts in ``FEATURES``, all over the whole text.

    A null text counts as an empty one: all counts are 0.
    """
    frame = packed(docs, text=F.coalesce(named(text), F.lit("")))
    frame = frame.select(
        "row", "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD)).alias("lines"))

    def count(kept: Column) -> Column:
        return F.char_length(kept).cast("long")

    hashes = F.transform("words", lambda w: F.xxhash64(w))
    stutters = bind(hashes, lambda hs: F.size(F.filter(hs, lambda h, i: (i > 0) & (F.get(hs, i - 1) == h))))
    return frame.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        count(F.array_join("words", "")).alias("word_chars"),
        count(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(hashes).alias("n_repeat_words"),
        count(F.regexp_replace("text", "[^A-Z]+", "")).alias("n_capitals"),
        stutters.cast("long").alias("n_stutters"),
        F.size("lines").cast("long").alias("n_lines"),
    )


def vote_columns() -> list[Column]:
    return [F.when(F.expr(bad), BAD).when(F.expr(good), GOOD).otherwise(ABSTAIN).alias(f"vote_{name}")
            for name, bad, good in RULES]


def fit_votes(measures: DataFrame, rounds: int = 200, tolerance: float = 1e-9) -> VoteModel:
    """Estimate the rules' vote probabilities from all rows of ``measured``, without labels.

    Counts of vote patterns are a sufficient statistic, so EM runs over those. The prior weighs
    ``PRIOR_WEIGHT`` of the rows: it decides which class is the bad one, and keeps the classes apart where a
    corpus holds no bad documents. An empty table gives the prior.
    """
    names = [f"vote_{name}" for name, _, _ in RULES]
    patterns = [(tuple(r[n] for n in names), r["count"])
                for r in measures.select(*vote_columns()).groupBy(*names).count().orderBy(*names).collect()]
    total = sum(n for _, n in patterns)
    start = VoteModel(PRIOR_BAD_SHARE, tuple(dict(PRIOR_VOTES["bad"]) for _ in RULES),
                      tuple(dict(PRIOR_VOTES["good"]) for _ in RULES))
    if not total:
        return start
    weight, model = PRIOR_WEIGHT * total, start
    for _ in range(rounds):
        mass = {"bad": weight * PRIOR_BAD_SHARE, "good": weight * (1 - PRIOR_BAD_SHARE)}
        seen = {kind: [{v: mass[kind] * PRIOR_VOTES[kind][v] for v in VOTES} for _ in RULES] for kind in mass}
        for votes, n in patterns:
            good = n / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(votes)))))
            for kind, part in (("good", good), ("bad", n - good)):
                mass[kind] += part
                for rule, v in enumerate(votes):
                    seen[kind][rule][v] += part
        share = mass["bad"] / (total + weight)
        bad, good = (tuple({v: counts[v] / mass[kind] for v in VOTES} for counts in seen[kind])
                     for kind in ("bad", "good"))
        change, model = abs(share - model.bad_share), VoteModel(share, bad, good)
        if change < tolerance:
            break
    return model


def judged(measures: DataFrame, model: VoteModel) -> DataFrame:
    """Add the votes, ``posterior`` (that the document is good), and ``base_failed``."""
    odds = F.lit(math.log((1 - model.bad_share) / model.bad_share))
    for (name, _, _), bad, good in zip(RULES, model.bad, model.good):
        vote, part = F.col(f"vote_{name}"), F.lit(math.log(good[ABSTAIN] / bad[ABSTAIN]))
        for v in (BAD, GOOD):
            part = F.when(vote == v, F.lit(math.log(good[v] / bad[v]))).otherwise(part)
        odds = odds + part
    base_failed = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
    return measures.select("*", *vote_columns()).select(
        "*", (1 / (1 + F.exp(-odds))).alias("posterior"), F.expr(base_failed).alias("base_failed"))


def weak_quality(docs: DataFrame, *, text: str = "text", threshold: float = 0.5,
                 model: VoteModel | None = None) -> DataFrame:
    """The input columns with the counts of ``FEATURES``, ``base_failed``, ``posterior`` and ``kept``.

    ``kept`` is false for a document that fails the base rules, and else true if the posterior probability
    of a good document reaches ``threshold``. The model is fitted to ``docs`` unless given. A null or empty
    text has no words and fails the base rules; equal texts get equal verdicts; an empty table gives no
    rows. Input columns named like a result are replaced.
    """
    measures = measured(docs, text)
    scored = judged(measures, model or fit_votes(measures))
    results = {n: F.col(n) for n in (*FEATURES, "base_failed", "posterior")}
    return unpacked(scored, docs.columns, results | {
        "kept": ~F.col("base_failed") & (F.col("posterior") >= F.lit(threshold))})


def keep_good(docs: DataFrame, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that ``weak_quality`` keeps, with their own columns only.

    The rows are written once beside their counts, as the fit and the verdicts both need the counts, which cost far
    more than the writing. Null and empty texts fail the base rules and go; equal texts get equal verdicts, so that repeated
    rows stay or go together; a null key and columns of any name are of no matter. An empty table gives no rows.
    """
    measures = settle(measured(docs, text), "quality-measures")
    scored = judged(measures, fit_votes(measures))
    kept = scored.where(~F.col("base_failed") & (F.col("posterior") >= F.lit(threshold)))
    return unpacked(kept, docs.columns, {})
