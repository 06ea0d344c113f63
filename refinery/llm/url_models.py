"""URL filter: allow and block rules, and a character language-model ratio for what they leave open.

URLs that a rule accepts or rejects train two variable-order Markov models of their characters:
contexts of six characters down to none, interpolated by Witten-Bell weights, so a context counts as
far as it was seen and an unseen one gives way to the next shorter. A URL's score is the difference
of its log-likelihoods under the two models, divided by its length. A fifth of the labelled URLs is
held out to calibrate the threshold. All of it is DataFrame functions.

The model is a table with a row for each sequence of seven characters that occurs in the URLs, and
grows with them. It is made level by level: a level's sequences are joined with their own ends, one
character shorter, of the level before, so no key of a join has more rows than there are characters.
URLs are scored by a join of their sequences with that table. No side of a join is gathered in the
driver, since all but the shortest levels grow with the URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from refinery.llm.stored import stored

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters of the longest context.
ORDER = 6
#: What stands before the first and after the last character of a text.
START, END = "\u0002", "\u0003"
MILLION = 1_000_000
#: Scores are calibrated in steps of a hundredth within these limits.
LEAST_STEP, MOST_STEP = -1000, 1000
HELD_OUT = 5
KINDS = ("allow", "block")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://``, and the path up to ``?`` or ``#``."""
    pattern = F.lit("://([^/?#]*)([^?#]*)")
    host, path = (F.coalesce(F.get(F.regexp_extract_all(url, pattern, F.lit(i)), F.lit(0)), F.lit("")) for i in (1, 2))
    return F.translate(host, CAPITALS, SMALL), path


def rule_column(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule, and its verdict, or nulls. ``rules``: (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last one to be wrapped around is asked first: shortest first, block before allow in a tie.
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        wanted, slash, rest = text.partition("/")
        fits = ((host == wanted) | host.endswith(f".{wanted}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def said(url: Column) -> Column:
    """What follows the first ``://``, A-Z lower-cased; empty for a null URL or one without it."""
    rest = F.get(F.regexp_extract_all(url, F.lit("(?s)://(.*)"), F.lit(1)), F.lit(0))
    return F.translate(F.coalesce(rest, F.lit("")), CAPITALS, SMALL)


def grams(text: Column) -> Column:
    """Each character of a text, and its end, with the ``ORDER`` characters before it."""
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    padded = F.concat(F.array(*[F.lit(START)] * ORDER), characters, F.array(F.lit(END)))
    return F.transform(F.sequence(F.lit(1), F.size(padded) - ORDER), lambda i: F.array_join(F.slice(padded, i, ORDER + 1), ""))


def _joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Their inner join by sorted rows, of which the driver holds none.

    Spark would estimate a side by the size of its files, which are compressed and hold a text once
    where the rows hold each of its sequences, and broadcast what is many times its limit.
    """
    return left.join(right.hint("merge"), key)


def _level(seen: DataFrame, k: int) -> DataFrame:
    """Sequences with a context of k characters: gram, and per kind how often it was seen."""
    gram = F.expr(f"right(gram, {k + 1})")
    return seen.groupBy(gram.alias("gram")).agg(*[F.sum(kind).alias(kind) for kind in KINDS])


def learn(texts: DataFrame) -> DataFrame:
    """The model: gram and ratio, ln(p allowed / p blocked) of its last character in whole millionths.

    ``texts`` has said and, per kind, how many labelled URLs say so. Every sequence that occurs in
    them has a row, whether it was labelled or not.
    """
    spread = texts.select(*KINDS, F.explode(grams(F.col("said"))).alias("gram"))
    seen = stored(spread.groupBy("gram").agg(*[F.sum(kind).alias(kind) for kind in KINDS]), "url-grams")
    model = None
    for k in range(ORDER + 1):
        # One context has at most as many rows as there are characters.
        context = Window.partitionBy(F.expr(f"left(gram, {k})") if k else F.lit(""))
        level = _level(seen, k)
        for kind in KINDS:
            level = level.withColumns(
                {f"{kind}_n": F.sum(kind).over(context), f"{kind}_t": F.sum((F.col(kind) > 0).cast("int")).over(context)}
            )
        if model is None:
            shorter = {f"{kind}_p": 1 / F.count(F.lit(1)).over(context) for kind in KINDS}
            level = level.withColumns(shorter)
        else:
            level = _joined(level.withColumn("end", F.expr(f"right(gram, {k})")), model.withColumnRenamed("gram", "end"), "end")
        model = level.select("gram", *[_mixed(kind).alias(f"{kind}_p") for kind in KINDS])
    ratio = F.round(MILLION * (F.log(f"{KINDS[0]}_p") - F.log(f"{KINDS[1]}_p"))).cast("long")
    return stored(model.select("gram", ratio.alias("ratio")), "url-model")


def _mixed(kind: str) -> Column:
    """The probability after a context, given that after the context one character shorter."""
    n, seen, kinds, shorter = (F.col(name) for name in (kind, f"{kind}_n", f"{kind}_t", f"{kind}_p"))
    return F.when(seen > 0, (n + kinds * shorter) / (seen + kinds)).otherwise(shorter)


def _step() -> Column:
    """The score in hundredths, rounded down."""
    step = F.floor(F.col("total") / (F.col("length") * (MILLION // 100))).cast("int")
    return F.greatest(F.least(step, F.lit(MOST_STEP)), F.lit(LEAST_STEP))


def totals(texts: DataFrame, model: DataFrame) -> DataFrame:
    """said, total and length: the sum of the ratios of each text's sequences, and their number."""
    spread = texts.select("id", F.explode(grams(F.col("said"))).alias("gram"))
    # Of sequences that most texts have, Spark splits the texts' side of the join.
    scored = _joined(spread, model, "gram")
    summed = scored.groupBy("id").agg(F.sum("ratio").alias("total"), F.count(F.lit(1)).alias("length"))
    return _joined(texts.select("id", "said"), summed, "id").select("said", "total", "length")


def threshold(held: DataFrame) -> DataFrame:
    """One row, column step: the least score that is allowed, from texts with their held-out labels.

    It minimizes the sum of the two error rates on the held-out URLs; of all steps that do, it lies
    halfway between the lowest one that occurs and the next lower score. Without held-out URLs of
    both kinds it is 0.
    """
    steps = held.where("held_allow + held_block > 0").groupBy(_step().alias("step")).agg(
        F.sum("held_allow").alias("allowed"), F.sum("held_block").alias("blocked")
    )
    # At most one row per step, so one task is enough.
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    tried = steps.withColumns(
        {
            "lost": F.coalesce(F.sum("allowed").over(below), F.lit(0)),
            "stopped": F.coalesce(F.sum("blocked").over(below), F.lit(0)),
            "all_allowed": F.sum("allowed").over(whole),
            "all_blocked": F.sum("blocked").over(whole),
            "lower": F.lag("step").over(Window.orderBy("step")),
        }
    )
    halfway = F.floor((F.coalesce("lower", "step") + F.col("step") + 1) / 2).cast("int")
    errors = F.col("lost") * F.col("all_blocked") + (F.col("all_blocked") - F.col("stopped")) * F.col("all_allowed")
    best = tried.filter("all_allowed > 0 AND all_blocked > 0").agg(F.min_by(halfway, F.struct(errors, F.col("step"))).alias("step"))
    return best.select(F.coalesce("step", F.lit(0)).alias("step"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """All columns of ``pages`` with host, path, rule, verdict and score.

    ``verdict`` is the longest fitting rule's, else allow or block by the score: the difference of
    the two log-likelihoods per symbol. A null URL, or one without ``://``, has an empty host and
    path, fits no rule and is scored as an empty text. Repeated rows repeat; each counts in training.
    Without labelled URLs of both kinds all scores are equal or untested, and the threshold is 0.
    Columns with the names of the results are replaced; an empty table gives an empty result.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "score")
    host, path = host_and_path(F.col(url))
    judged = pages.withColumns({"host": host, "path": path})
    rule, verdict = rule_column(rules, F.col("host"), F.col("path"))
    judged = judged.withColumns({"rule": rule, "__label": verdict, "__said": said(F.col(url))})
    held = F.coalesce(F.conv(F.substring(F.md5(F.col(url)), 1, 6), 16, 10).cast("long") % HELD_OUT == 0, F.lit(False))
    told = judged.select(F.col("__said").alias("said"), F.col("__label").alias("label"), held.alias("held"))
    # Equal texts are one row from here on, however many URLs have them.
    counts = [F.count_if((F.col("label") == kind) & ~F.col("held")).alias(kind) for kind in KINDS]
    kept = [F.count_if((F.col("label") == kind) & F.col("held")).alias(f"held_{kind}") for kind in KINDS]
    texts = told.groupBy("said").agg(*counts, *kept).withColumn("id", F.monotonically_increasing_id())
    texts = stored(texts, "url-texts")
    found = stored(totals(texts, learn(texts)), "url-scores")
    cut = stored(threshold(_joined(texts, found, "said")), "url-threshold")
    scores = found.select(F.col("said").alias("__said"), _step().alias("__step"), (F.col("total") / (F.col("length") * F.lit(float(MILLION)))).alias("score"))
    by_score = F.when(F.col("__step") >= cut.scalar(), "allow").otherwise("block")
    return _joined(judged, scores, "__said").select(
        *[F.col(f"`{name}`") for name in pages.columns], "host", "path", "rule", F.coalesce("__label", by_score).alias("verdict"), "score"
    )
