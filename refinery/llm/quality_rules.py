"""Quality rules whose cutoffs are certified on labelled documents, in DataFrame functions only.

Fixed base rules come first. Then each rule rejects a document whose measure lies above a cutoff.
Cutoffs are chosen per stratum: with n labelled good documents of which k would be rejected, a
cutoff is certified if an exact binomial test excludes a false rejection rate above the rule's
part of the limit, that is if P(Binomial(n, limit) <= k) is at most the level. The level is divided
by the number of (stratum, rule) chains (Bonferroni); inside a chain k only grows from the lenient
to the strict end, so testing in that order needs no further correction. Among certified cutoffs
the one that best separates bad from good labels wins, so no good document is risked for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from refinery.llm.stored import stored

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30

#: The most good documents of a stratum that all rules together may reject, and the probability
#: that this fails anywhere.
FALSE_REJECTION, LEVEL = 0.05, 0.05
#: Cutoffs of every rule, as percentages from lenient to strict.
CUTOFFS = (50, 40, 30, 25, 20, 15, 12, 10, 8, 6, 5, 4, 3, 2, 1)
#: Each rule's measure as a percentage: parts and whole.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "stutter": ("n_stutters", "n_words"),
    "lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_capitals", "n_lines", "n_dup_lines", "n_stutters", "n_repeat_words")
_STEPS = ("_words", "_lines", "_windows", "_ranked", "_places")


def _without(text: str, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def measure(documents: DataFrame) -> DataFrame:
    """All columns of ``documents`` and the counts of its text; null counts as empty.

    n_repeat_words: windows of eight words are hashed and compared inside the row. Only a text
    that has a repeated window ranks its windows by hash; neighbours in that order that are equal
    are the repeats, and their places give the words they cover.
    """
    documents = documents.drop(*COUNTS, *_STEPS, "_text", "base_failed")
    df = documents.withColumn("_text", F.coalesce("text", F.lit("")))
    df = df.withColumns(
        {
            "_words": F.filter(F.split("_text", SPACE_RUN), lambda w: w != ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda line: F.translate(line, SPACES, "") != ""),
        }
    )
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": _without("_text", SPACES).cast("long"),
            "n_symbols": (F.char_length("_text") - _without("_text", SYMBOLS)).cast("long"),
            "n_capitals": (F.char_length("_text") - _without("_text", CAPITALS)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_stutters": F.size(F.expr("filter(_words, (w, i) -> i > 0 AND _words[i - 1] = w)")).cast("long"),
            "_windows": F.expr(
                f"CASE WHEN size(_words) < {WINDOW} THEN array() ELSE "
                f"transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW}))) END"
            ),
        }
    ).drop("_words", "_lines", "_text")
    ranked = F.expr(
        "CASE WHEN size(array_distinct(_windows)) < size(_windows) "
        "THEN sort_array(transform(_windows, (h, i) -> struct(h, i))) END"
    )
    df = df.withColumn("_ranked", ranked).drop("_windows")
    repeated = F.expr(
        "sort_array(transform(filter(_ranked, (x, k) -> "
        "(k > 0 AND _ranked[k - 1].h = x.h) OR (k < size(_ranked) - 1 AND _ranked[k + 1].h = x.h)), x -> x.i))"
    )
    df = df.withColumn("_places", repeated).drop("_ranked")
    covered = F.expr(
        f"aggregate(_places, struct(0L AS n, {-WINDOW} AS last), "
        f"(a, p) -> struct(a.n + least({WINDOW}, p - a.last) AS n, p AS last), a -> a.n)"
    )
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_places")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return df.withColumn("base_failed", failed)


def rule_levels() -> dict[str, Column]:
    """For each rule, how many of the cutoffs a document's measure lies above."""
    levels = {}
    for name, (part, whole) in RULES.items():
        above = [(100 * F.col(part) > cut * F.col(whole)).cast("int") for cut in CUTOFFS]
        levels[name] = sum(above[1:], above[0])
    return levels


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 11, exact to about 1e-13."""
    x = n.cast("double") + 11
    series = (x - 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))
    product = F.lit(1.0)
    for i in range(1, 11):
        product = product * (n + i)
    return series - F.log(product)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), or 1 where k >= n p.

    The probability of k itself, times the sum of the falling ratios to those below. Beyond 40
    standard deviations the terms are under 1e-300 and are left out.
    """
    top = _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    steps = F.least(k, (40 * F.sqrt(n * p)).cast("long") + 100)
    below = F.when(steps > 0, F.sequence(F.lit(0).cast("long"), steps - 1)).otherwise(F.array().cast("array<bigint>"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(state: Column, t: Column) -> Column:
        term = state["term"] * (k - t) * (1 - p) / ((n - k + t + 1) * p)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    tail = F.exp(top) * F.aggregate(below, start, add, lambda s: s["total"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(tail)


def certify(
    measured: DataFrame, labels: DataFrame, stratum: str = "lang", *, limit: float = FALSE_REJECTION, level: float = LEVEL
) -> DataFrame:
    """(stratum, rule, above): a document whose measure lies above at least ``above`` of the
    rule's cutoffs is rejected. One row for each stratum and rule that has a certified cutoff.

    Labels of documents that fail the base rules are not used. A stratum without enough good
    labels gets no cutoff, so nothing of it is rejected.
    """
    labels = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), above.alias("above")) for name, above in rule_levels().items()])
    rows = (
        measured.filter(~F.col("base_failed"))
        .select("doc_id", F.coalesce(stratum, F.lit("")).alias("stratum"), rules.alias("rules"))
        .join(labels, "doc_id")
        .select("stratum", "_good", F.explode("rules").alias("r"))
    )
    counts = rows.groupBy("stratum", "r.rule", "r.above").agg(
        F.sum((F.col("_good") == 1).cast("long")).alias("good"), F.sum((F.col("_good") == 0).cast("long")).alias("bad")
    )
    # One list entry per number of cutoffs: its length does not depend on the input.
    chains = counts.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"), F.collect_list(F.struct("above", "good", "bad")).alias("found")
    )
    chains = stored(chains, "chains")
    tests = max(chains.count(), 1)
    tried = chains.withColumn("above", F.explode(F.sequence(F.lit(1), F.lit(len(CUTOFFS)))))
    rejected = {
        name: F.expr(f"aggregate(filter(found, x -> x.above >= above), 0L, (n, x) -> n + x.{name})") for name in ("good", "bad")
    }
    tried = tried.withColumns({"k_good": rejected["good"], "k_bad": rejected["bad"]})
    tail = binomial_tail(F.col("n_good"), F.col("k_good"), limit / len(RULES))
    gain = F.col("k_bad") * F.col("n_good") - F.col("k_good") * F.col("n_bad")
    certified = tried.filter((tail <= level / tests) & (gain > 0))
    return certified.groupBy("stratum", "rule").agg(F.max_by("above", F.struct(gain, F.col("above"))).alias("above"))


def judge(documents: DataFrame, labels: DataFrame, *, stratum: str = "lang", keep_text: bool = True) -> DataFrame:
    """All columns of ``documents``, the counts, base_failed, and kept.

    kept is false for a document that fails the base rules or lies above a certified cutoff of its
    stratum. Null and empty texts have no words and fail the base rules. A null stratum is a stratum
    of its own. Rows that repeat a doc_id are judged one by one; a label counts for each of them,
    and of several labels the lowest. Columns with the names of the results are replaced. With
    ``keep_text`` false the text is left out once it is measured.
    """
    measured = measure(documents.drop("kept"))
    measured = stored(measured if keep_text else measured.drop("text"), "measured")
    cutoffs = stored(certify(measured, labels, stratum), "cutoffs")
    by_stratum = cutoffs.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("above"))
    by_stratum = by_stratum.select(
        F.col("stratum").alias("_stratum"), *[F.col(name).alias(f"_from_{name}") for name in RULES]
    )
    out = measured.withColumn("_stratum", F.coalesce(stratum, F.lit(""))).join(by_stratum, "_stratum", "left")
    over = F.lit(False)
    for name, above in rule_levels().items():
        over = over | F.coalesce(above >= F.col(f"_from_{name}"), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~over).drop("_stratum", *[f"_from_{name}" for name in RULES])
