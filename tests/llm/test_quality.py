import numpy as np
from pyspark.sql import functions as F

from refinery.llm import pairwise_quality
from refinery.llm.pairwise_quality import CUT, FEATURES, features, fit, learn, score
from refinery.llm.queries import fold, op2
from refinery.llm.textbatch import string_buffers
import pyarrow as pa

GOOD = "A plain sentence of some words follows here. Then another one, a little longer than it."
BAD = "buy### now&&& cheap$$$ pills%%% BUY### NOW&&& cheap$$$"



def of(texts):
    return features(*string_buffers(pa.array(texts, pa.string())))


def test_features_of_known_texts():
    names = list(FEATURES)
    x = of(["a a b", "", None, "x|y!\n", "w " * 20])
    assert x[0][names.index("stutters")] == 1 / 3 and x[0][names.index("repeated_words")] == 1 / 3
    assert not x[1].any() and not x[2].any()
    assert x[3][names.index("bars")] == 1 / 4 and x[3][names.index("lines")] == 1
    assert abs(x[4][names.index("repeated_windows")] - 12 / 20) < 1e-12
    # A text's features do not depend on its neighbours.
    assert np.array_equal(of(["w " * 20])[0], x[4])


def test_pairwise_weights_rank_like_the_labels():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, len(FEATURES)))
    good = x[:, 3] + 0.5 * x[:, 5] > -0.8
    ranking = learn(x, good)
    scores = ranking.scores(x)
    assert ((scores >= CUT) == good).mean() > 0.93
    order = np.argsort(ranking.raw(x))
    assert (np.diff(scores[order]) >= 0).all() and scores.min() >= 0 and scores.max() <= 1


def test_edge_rows(spark, documents):
    rows = [(i, GOOD + f" number {i}") for i in range(30)] + [(100 + i, BAD + f" {i}") for i in range(30)]
    odd = [(500, None), (501, ""), (502, " \n "), (503, GOOD), (503, GOOD), (None, BAD), (504, "word " * 60_000)]
    frame = documents(rows + odd, score="x", predicted="y", features="z")
    labels = spark.createDataFrame(
        [(i, 1) for i in range(30)] + [(100 + i, 0) for i in range(30)] + [(None, 0), (7, None), (9999, 1), (3, 1)],
        "doc_id bigint, quality int",
    )
    ranking = fit(frame, labels, F.lit(True))
    found = score(frame, ranking).collect()
    assert len(found) == len(rows) + len(odd)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= CUT) and r.features == "z" for r in found)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r.score)
    assert len(set(by_id[503])) == 1 and by_id[500] == by_id[501]
    assert min(by_id[i][0] for i in range(30)) > max(by_id[100 + i][0] for i in range(30))
    assert score(documents([]), ranking).count() == 0


def test_one_class_rejects_nothing(spark, documents):
    frame = documents([(1, GOOD), (2, BAD)])
    for labels in ([(1, 1)], []):
        known = spark.createDataFrame(labels, "doc_id bigint, quality int")
        assert all(r.predicted == 1 for r in score(frame, fit(frame, known, F.lit(True))).collect())


def test_held_out_accuracy(spark):
    found = op2(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.join(labels, "doc_id").where(F.col("held_out") & (fold(5) == 0)).collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95


def test_weights_minimize_the_loss_of_the_pairs():
    """Two documents a class: all pairs are drawn equally often, so the plain loss is known."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4, len(FEATURES)))
    good = np.array([True, True, False, False])
    ranking = learn(x, good)

    def loss(weights):
        z = pairwise_quality._expanded(x, ranking.middle, ranking.width) @ weights
        pairs = [z[i] - z[j] for i in range(2) for j in range(2, 4)]
        return np.mean(np.log1p(np.exp(-np.array(pairs)))) + pairwise_quality.RIDGE / 2 * weights @ weights

    least = loss(ranking.weights)
    for i in range(len(ranking.weights)):
        for step in (-1e-3, 1e-3):
            moved = ranking.weights.copy()
            moved[i] += step
            assert loss(moved) >= least - 1e-12


def test_repeated_ids_teach_one_text_whatever_the_order(spark, documents):
    rows = [(i, f"{GOOD} {i} {k}") for i in range(12) for k in range(4)] + [(100 + i, f"{BAD} {i} {k}") for i in range(12) for k in range(4)]
    labels = spark.createDataFrame([(i, int(i < 100)) for i in [*range(12), *range(100, 112)]], "doc_id bigint, quality int")
    found = [fit(documents(part).repartition(n), labels, F.lit(True)) for part, n in ((rows, 1), (rows[::-1], 5), (rows * 3, 3))]
    for other in found[1:]:
        assert np.array_equal(found[0].weights, other.weights) and found[0].cut == other.cut


def test_every_labelled_document_teaches(spark, documents):
    """A kind of good documents that only the greatest hashes have: all others come first."""
    ids = [r.id for r in spark.range(5000).orderBy(F.xxhash64("id"), "id").collect()]
    plain, dated = ids[:4000], ids[4000:]
    rows = [(i, f"{GOOD} word{'s' * (i % 7)}") for i in plain] + [(i, f"{GOOD} {i} 1999 2001 2024") for i in dated]
    rows += [(i, f"{GOOD} {i} 1999 2001 2024 ###") for i in range(10_000, 10_300)]
    frame = documents(rows).repartition(4)
    labels = spark.createDataFrame([(i, int(i < 10_000)) for i, _ in rows], "doc_id bigint, quality int")
    ranking = fit(frame, labels, F.lit(True))
    x = of([text for _, text in rows])
    assert np.array_equal(ranking.middle, np.median(x, axis=0))
    width = x.std(axis=0)
    assert np.allclose(ranking.width, np.where(width > 0, width, 1.0), rtol=1e-9, atol=1e-9)
    predicted = ranking.scores(x) >= CUT
    assert predicted[:5000].all() and not predicted[5000:].any()


def test_blocks_hold_every_document_and_enough_of_both_classes(spark, monkeypatch):
    monkeypatch.setattr(pairwise_quality, "BLOCK", 16)
    monkeypatch.setattr(pairwise_quality, "FEWEST", 6)
    for won, lost in ((100, 40), (3, 150), (17, 17), (1, 1), (200, 25)):
        rows = [(i, i < won, [float(i)] * len(FEATURES)) for i in range(won + lost)]
        taught = spark.createDataFrame(rows, "doc_id bigint, good boolean, measures array<double>").repartition(5)
        found = pairwise_quality._dealt(taught, won, lost).collect()
        assert len(found) == -(-max(won, lost) // 16)
        for name, ids in (("won", range(won)), ("lost", range(won, won + lost))):
            members = [[int(v) for v in row[name][:: len(FEATURES)]] for row in found]
            assert {i for block in members for i in block} == set(ids)
            assert all(len(set(block)) == len(block) >= min(len(ids), 6) for block in members)
            if len(ids) == max(won, lost):
                assert sum(map(len, members)) == len(ids) and max(map(len, members)) <= 16


def test_pairs_take_in_every_document():
    for won, lost in ((256, 64), (255, 64), (9, 8), (8, 40), (2, 2), (3, 1), (1, 40), (9, 40)):
        # The number of a document is in one of two columns, by its class.
        one = np.stack([np.arange(1, won + 1), np.zeros(won)], axis=1)
        other = np.stack([np.zeros(lost), -np.arange(1, lost + 1)], axis=1)
        pairs = pairwise_quality._differences(one, other).astype(int)
        assert len(pairs) == pairwise_quality.PAIRS * max(won, lost)
        for column, size in ((0, won), (1, lost)):
            assert {*pairs[:, column].tolist()} == set(range(1, size + 1))


def test_sums_before_each_row_over_several_ranges(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(pairwise_quality, "stored", lambda df, name: kept.append(df.localCheckpoint()) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        draw = np.random.default_rng(3)
        rows = [(int(i), float(draw.normal()), int(draw.integers(3)), int(draw.integers(3))) for i in range(500)]
        frame = spark.createDataFrame(rows, "id int, value double, won bigint, lost bigint").repartition(4)
        found = sorted(pairwise_quality._placed(frame, "value").collect(), key=lambda r: r.value)
        assert kept[0].select("part").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for name in ("won", "lost"):
        sums = np.cumsum([0, *[r[name] for r in found]])[:-1].tolist()
        assert [r[f"{name}_before"] for r in found] == sums


def test_many_blocks_learn_the_least_loss_and_the_best_quantile(spark, documents, monkeypatch):
    monkeypatch.setattr(pairwise_quality, "BLOCK", 32)
    draw = np.random.default_rng(11)
    rows = [(i, " ".join(draw.choice(["word", "two, ", "x#", "Name", "7"], size=draw.integers(5, 40)))) for i in range(600)]
    good = {i: text.count("#") < draw.integers(3, 9) for i, text in rows}
    frame = documents(rows).repartition(3)
    labels = spark.createDataFrame([(i, int(g)) for i, g in good.items()], "doc_id bigint, quality int")
    dealt, real = [], pairwise_quality._dealt
    monkeypatch.setattr(pairwise_quality, "_dealt", lambda *args: dealt.append(real(*args)) or dealt[-1])
    ranking = fit(frame, labels, F.lit(True))
    blocks = [
        [pairwise_quality._ordered(np.reshape(v, (-1, len(FEATURES)))) for v in row] for row in dealt[0].collect()
    ]
    blocks = [[pairwise_quality._expanded(x, ranking.middle, ranking.width) for x in block] for block in blocks]
    assert len(blocks) > 5
    pairs = np.concatenate([pairwise_quality._differences(*block) for block in blocks])
    gradient = pairwise_quality.RIDGE * ranking.weights - pairs.T @ (1 / (1 + np.exp(pairs @ ranking.weights))) / len(pairs)
    assert np.abs(gradient).max() < 1e-7
    x, y = of([text for _, text in rows]), np.array([*good.values()])
    raw = ranking.raw(x)
    tried = np.unique(np.quantile(raw, np.arange(1, pairwise_quality.QUANTILES) / pairwise_quality.QUANTILES))
    kept = raw[None, :] >= tried[:, None]
    best = (kept[:, y].mean(axis=1) + (~kept[:, ~y]).mean(axis=1)).max()
    assert abs((raw >= ranking.cut)[y].mean() + (raw < ranking.cut)[~y].mean() - best) < 1e-12
    assert abs(ranking.spread - raw.std()) < 1e-9


def test_stored_features_stand_for_the_texts(spark, documents):
    rows = [(i, f"{GOOD} {i}") for i in range(20)] + [(50 + i, f"{BAD} {i}") for i in range(20)] + [(None, None), (3, "")]
    frame = documents(rows, source="s")
    labels = spark.createDataFrame([(i, int(i < 50)) for i in [*range(20), *range(50, 70)]], "doc_id bigint, quality int")
    without = pairwise_quality.measured(frame).drop("text")
    ranking, other = fit(frame, labels, F.lit(True)), fit(without, labels, F.lit(True))
    assert np.array_equal(ranking.weights, other.weights) and ranking.cut == other.cut
    found = score(without, ranking)
    assert found.columns == ["doc_id", "source", "score", "predicted"]
    wanted = score(frame, ranking).select(found.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
