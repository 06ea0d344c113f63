import math

from pyspark.sql import functions as F

from refinery.llm import url_models
from refinery.llm.queries import URL_RULES
from refinery.llm.stored import stored
from refinery.llm.url_models import ORDER, host_and_path, judge_urls, learn, said, totals

PAGES = "page_id bigint, url string, verdict string, grams string"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], PAGES)


def test_host_and_path(spark):
    cases = {
        "https://WWW.Example.ORG/En/1?a=/b#c": ("www.example.org", "/En/1"),
        "http://a.b": ("a.b", ""),
        "http://a.b?x": ("a.b", ""),
        "http://a.b#/x": ("a.b", ""),
        "x://y://z/w": ("y:", "//z/w"),
        "://": ("", ""),
        "no scheme/a": ("", ""),
        "": ("", ""),
        None: ("", ""),
    }
    host, path = host_and_path(F.col("url"))
    rows = pages(spark, list(cases)).select("url", host.alias("h"), path.alias("p")).collect()
    assert {r.url: (r.h, r.p) for r in rows} == cases


def test_the_longest_rule_wins(spark):
    cases = {
        "http://example.org/fr/1": ("org/", "allow"),
        "http://a.example.org/es/": ("example.org/es/", "block"),
        "http://a.example.org/en/12": ("example.org/en/1", "block"),
        "http://notexample.org/es/": ("org/", "allow"),
        "http://org/es": ("org/", "allow"),
        "http://x.com/fr/": ("com/fr/", "allow"),
        "http://x.com/de/1": ("com/de/", "block"),
        "http://x.org": (None, None),
        "http://borg/": (None, None),
        None: (None, None),
    }
    rows = judge_urls(pages(spark, list(cases) * 2), URL_RULES).collect()
    assert len(rows) == 2 * len(cases)
    for row in rows:
        rule, verdict = cases[row.url]
        assert row.rule == rule
        assert row.verdict in ("allow", "block") if verdict is None else row.verdict == verdict


def brute_scores(labelled, urls):
    """Witten-Bell interpolation by dictionaries."""

    def symbols(url):
        rest = (url or "").partition("://")[2]
        return ["\2"] * ORDER + [c.lower() if c.isascii() else c for c in rest] + ["\3"]

    alphabet = {c for url in [u for u, _ in labelled] + urls for c in symbols(url)[ORDER:]}

    def model(texts):
        counts = {}
        for text in texts:
            s = symbols(text)
            for i in range(ORDER, len(s)):
                for n in range(ORDER + 1):
                    counts.setdefault(tuple(s[i - n : i]), {}).setdefault(s[i], 0)
                    counts[tuple(s[i - n : i])][s[i]] += 1

        def p(context, c):
            value = 1 / len(alphabet)
            for n in range(ORDER + 1):
                seen = counts.get(tuple(context[ORDER - n :]))
                if seen:
                    total, kinds = sum(seen.values()), len(seen)
                    value = (seen.get(c, 0) + kinds * value) / (total + kinds)
            return value

        return p

    good, bad = (model([u for u, label in labelled if label == x]) for x in ("allow", "block"))
    out = []
    for url in urls:
        s = symbols(url)
        places = range(ORDER, len(s))
        ratios = [round(1e6 * (math.log(good(s[i - ORDER : i], s[i])) - math.log(bad(s[i - ORDER : i], s[i])))) for i in places]
        out.append(sum(ratios) / len(ratios) / 1e6)
    return out


def test_scores_equal_a_brute_force_model(spark):
    good = [f"http://good{i}.site/page" for i in range(8)]
    bad = [f"http://spam.bad/{'x' * i}_Ü?q={i}%" for i in range(5)]
    urls = ["http://good.site/x", "http://spam.bad/xx", "no url", None, "http://" + "long/" * 3000, "http://spam.bad/🙂_Ü?q=4%"]
    labelled = [(u, "allow") for u in good] + [(u, "block") for u in bad]
    rows = [(u, int(x == "allow"), int(x == "block")) for u, x in labelled] + [(u, 0, 0) for u in urls]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id bigint, url string, allow bigint, block bigint")
    texts = frame.withColumn("said", said(F.col("url")))
    found = {r.said: r.total / r.length / 1e6 for r in totals(texts, learn(texts)).collect()}
    keys = [r.said for r in texts.where(F.col("id") >= len(labelled)).orderBy("id").collect()]
    for key, expected in zip(keys, brute_scores(labelled, urls)):
        assert abs(found[key] - expected) < 2e-6


def test_every_character_counts(spark):
    """URLs that differ in one digit, letter or sign are told apart if the labels say so."""
    for left, right in (("1", "9"), ("ü", "%"), ("_", "-")):
        urls = [f"http://a.net/{x}/p{s}" for x, s in (("fr", left), ("de", right))]
        taught = [f"http://h{i}.com/{u[13:15]}/p{s}{i % 3}" for i in range(60) for u, s in zip(urls, (left, right))]
        asked = [f"http://a.net/p{s}" for s in (left, right)]
        found = {r.url: (r.verdict, r.score) for r in judge_urls(pages(spark, taught + asked), URL_RULES).collect()}
        assert found[asked[0]][1] > found[asked[1]][1]
        assert (found[asked[0]][0], found[asked[1]][0]) == ("allow", "block")


def test_the_model_grows_with_the_urls(spark):
    sizes = []
    for n in (5, 50):
        rows = [(i, f"host{i * 7919}.org/{i * 104729}", 1, 0) for i in range(n)]
        sizes.append(learn(spark.createDataFrame(rows, "id bigint, said string, allow bigint, block bigint")).count())
    assert sizes[1] > 5 * sizes[0]


def test_the_method_tells_unruled_urls_apart(spark):
    urls = [f"http://h{i}.com/fr/{i}" for i in range(60)] + [f"http://h{i}.com/de/{i}" for i in range(60)]
    rows = judge_urls(pages(spark, [*urls, "http://h9.net/fr/9", "http://h9.net/de/9"]), URL_RULES)
    found = {r.url: r.verdict for r in rows.collect()}
    assert found["http://h9.net/fr/9"] == "allow" and found["http://h9.net/de/9"] == "block"


def test_no_join_gathers_a_side_in_the_driver(spark, monkeypatch):
    """The files of these texts are far below the limit of broadcasts, however many sequences they have."""
    frames = []

    def noted(df, name):
        df.collect()
        frames.append(df)
        return stored(df, name)

    monkeypatch.setattr(url_models, "stored", noted)
    urls = [f"http://h{i}.com/{x}/{i}" for i in range(40) for x in ("fr", "de")] + ["http://h9.net/fr/9" + "/page" * 400]
    judged = judge_urls(pages(spark, urls), URL_RULES)
    assert len(judged.collect()) == len(urls)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (*frames, judged)]
    assert all("isFinalPlan=true" in plan for plan in plans)
    # The model, the scores, the held-out texts and the judged pages are made by joins.
    assert sum("SortMergeJoin" in plan for plan in plans) == 4
    assert not any("Broadcast" in plan for plan in plans)


def test_without_labels_and_without_rows(spark):
    assert judge_urls(pages(spark, []), URL_RULES).count() == 0
    rows = judge_urls(pages(spark, ["http://a.net/", None]), URL_RULES).collect()
    assert [r.verdict for r in rows] == ["allow", "allow"] and all(r.score == 0 for r in rows)
