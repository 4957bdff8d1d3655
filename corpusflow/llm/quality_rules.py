"""Quality rules by weak supervision (native).

Each rule reads counts of the whole text and votes good (1), bad (-1) or
abstains (0). Expectation-maximisation over the vote patterns estimates, without
labels, how often each rule votes either way on good and on bad documents; the
posterior probability of *good* replaces a filter in which every rule must pass.
Patterns are counted once, by one aggregate over the corpus. There are 3**rules of
them at most (``MAX_RULES`` bounds that), so their counts are fetched and the rounds
run on this small table; their cost does not depend on the corpus.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import stage, text_or_empty, words

MAX_ROUNDS, CLOSE = 40, 1e-4
#: most rules; their vote patterns, 3**rules at most, are fetched by the driver
MAX_RULES = 9
THRESHOLD = 0.5

#: Frequent function words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "the of and to in is that it for was on are with as by at be this from or "
    "der die und das den von zu mit ist des im ein eine nicht sich auf "
    "le la les de et des en un une du que est pour dans qui sur par au "
    "el los las del y que por con para una se su").split()


def measure(docs: DataFrame, text: str = "text", *keep: Column) -> DataFrame:
    """The columns ``keep`` with counts of the whole text (null: none), each a long.

    n_words; word_chars, code points in words; n_symbols, characters of
    ``#*$%&|<>``; n_lines, lines with a word; n_dup_lines, those equal to an
    earlier line; n_repeat_words, words in 5-word windows found twice or more in
    the text, first included; n_upper and n_letters, cased letters; n_stop, words
    among ``STOP_WORDS``; n_distinct, distinct words.
    """
    raw = docs.select(F.struct(*keep).alias("keep"), text_or_empty(F.col(text)).alias("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = raw.select(
        "keep", words(F.col("t")).alias("w"), lines.alias("lines"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.length(F.regexp_replace("t", r"[^\p{Lu}]+", "")).alias("n_upper"),
        F.length(F.regexp_replace("t", r"[^\p{L}]+", "")).alias("n_letters"))
    stop = F.array(*[F.lit(x) for x in STOP_WORDS])
    last = F.size("w") - 4
    hashed = step.select(
        "*", F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(*[
            F.element_at("w", i + k) for k in range(5)]))).otherwise(F.array().cast("array<long>")).alias("g"))
    # only texts with a repeated window are looked at position by position
    some = F.size(F.array_distinct("g")) < F.size("g")
    return hashed.select(
        "keep.*", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(some, _covered("g")).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.col("n_upper").cast("long"), F.col("n_letters").cast("long"),
        F.size(F.filter("w", lambda x: F.array_contains(stop, x))).cast("long").alias("n_stop"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))


def _covered(g: str) -> Column:
    """Words covered by 5-word windows whose hash occurs twice or more in the array ``g``."""
    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: (x["v"] == F.get(s, j - 1)["v"]) | (x["v"] == F.get(s, j + 1)["v"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def gaps(p: Column) -> Column:
        return F.transform(p, lambda x, j: F.coalesce(F.least(F.get(p, j + 1) - x, F.lit(5)), F.lit(5)))

    pairs = F.array_sort(F.transform(g, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    # a one-element array binds each intermediate to a name, so that it is computed once
    bound = F.transform(F.array(pairs), places)
    return F.aggregate(F.flatten(F.transform(bound, gaps)), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def default_rules() -> dict[str, Column]:
    """Name -> vote over the columns of ``measure``: 1 good, -1 bad, 0 abstains."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    mean = F.col("word_chars") / n
    symbols = F.col("n_symbols") / n
    upper = F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1))
    repeat = F.col("n_repeat_words") / n
    dup = F.col("n_dup_lines") / lines
    stop = F.col("n_stop") / n
    long_enough = F.col("n_words") >= 30
    return {
        "length": vote(F.col("n_words") >= 30, F.col("n_words") < 10),
        "word_length": vote(mean.between(3, 9), (mean < 2) | (mean > 15)),
        "symbols": vote(symbols <= 0.02, symbols > 0.1),
        "capitals": vote(upper <= 0.15, upper > 0.4),
        "repeats": vote(repeat <= 0.05, repeat > 0.2),
        "line_copies": vote((dup <= 0.1) & (F.col("n_lines") >= 2), dup > 0.3),
        "function_words": vote((stop >= 0.08) & long_enough, (stop < 0.02) & long_enough),
    }


def fit(votes: DataFrame, names: list[str]) -> dict:
    """Estimate from the vote columns ``names``: the share of good documents and each rule's accuracies.

    ``right[r]``: how often the rule, where it votes, says good on good documents
    and bad on bad ones. An abstention is no evidence. A rule here looks for one
    defect, so the start takes a bad vote for reliable (1 in 500 good documents)
    and a good vote for weak (a bad document passes seven rules in ten). The
    smoothing, a thousandth of a class's votes, keeps an unseen vote possible.
    """
    if len(names) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    patterns = votes.groupBy(*names).agg(F.count("*").alias("n")).collect()
    total = sum(p["n"] for p in patterns)
    model = {"good": 0.85, "right": {r: (0.998, 0.3) for r in names}}
    for _ in range(MAX_ROUNDS if total else 0):
        start, weights = _weights(model, names)
        good, seen = 0.0, {(r, v): [0.0, 0.0] for r in names for v in (1, -1)}
        for pattern in patterns:
            p = 1 / (1 + exp(-(start + sum(weights[r].get(pattern[r], 0.0) for r in names))))
            good += pattern["n"] * p
            for r in names:
                if pattern[r]:
                    seen[r, pattern[r]][0] += pattern["n"] * p
                    seen[r, pattern[r]][1] += pattern["n"] * (1 - p)

        def share(hit: float, miss: float) -> float:
            slack = 0.001 * (hit + miss) + 1e-9
            return (hit + slack) / (hit + miss + 2 * slack)

        new = {"good": share(good, total - good), "right": {
            r: (share(seen[r, 1][0], seen[r, -1][0]), share(seen[r, -1][1], seen[r, 1][1])) for r in names}}
        moved = max([abs(new["good"] - model["good"]), *(abs(x - y) for r in names for x, y in zip(new["right"][r], model["right"][r]))])
        model = new
        if moved < CLOSE:
            break
    return model


def _weights(model: dict, names: list[str]) -> tuple[float, dict[str, dict[int, float]]]:
    """Log odds of *good* before any vote, and what each rule's votes add."""
    votes = {}
    for r in names:
        on_good, on_bad = model["right"][r]
        votes[r] = {1: log(on_good / (1 - on_bad)), -1: log((1 - on_good) / on_bad)}
    return log(model["good"] / (1 - model["good"])), votes


def posterior(model: dict, names: list[str]) -> Column:
    """Probability of *good* given the vote columns, under independent votes."""
    start, weights = _weights(model, names)
    odds = F.lit(start)
    for r in names:
        odds = odds + F.when(F.col(r) == 1, weights[r][1]).when(F.col(r) == -1, weights[r][-1]).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rules: dict[str, Column] | None = None,
          threshold: float = THRESHOLD) -> DataFrame:
    """Per document its counts, votes ``vote_<rule>``, ``p_good``, ``base_failed`` and ``kept``.

    ``base_failed``: n_words < 10 or 100 * n_repeat_words > 20 * n_words; such a
    document is not kept. Otherwise ``kept`` says ``p_good >= threshold``.

    A null text has no words and fails the base. A document on which every rule
    abstains has the prior's probability. Null doc_ids and repeated rows are
    judged like others; other columns are ignored; an empty table gives an empty
    result.
    """
    model, votes, names = _fitted(docs, text, rules, F.col(doc_id).alias("doc_id"))
    return (votes.withColumn("p_good", posterior(model, names)).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _votes(counted: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return counted.select("*", *[F.coalesce(c, F.lit(0)).cast("int").alias(f"vote_{r}") for r, c in rules.items()])


def _fitted(docs: DataFrame, text: str, rules: dict[str, Column] | None, *keep: Column) -> tuple[dict, DataFrame, list[str]]:
    rules = rules or default_rules()
    names = [f"vote_{r}" for r in rules]
    votes = _votes(stage(measure(docs, text, *keep), "counts")[0], rules)
    return fit(votes, names), votes, names


def kept_documents(docs: DataFrame, text: str = "text", rules: dict[str, Column] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns.

    The rows are staged beside their counts, so no join is needed and repeated or
    null ids don't matter.
    """
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    model, votes, names = _fitted(docs, text, rules, row)
    return votes.where(~base_failed() & (posterior(model, names) >= threshold)).select("__row.*")
