import random
import re
from collections import defaultdict

import numpy as np
import pytest

from refinery.llm.components import components
from refinery.llm.superminhash import band_keys, difference_prefix, near_duplicates, signatures


def sets_of(rows, size):
    out = {}
    for key, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        out[key] = grams or ({tuple(words)} if words else set())
    return out


def brute(rows, size=5, percent=80):
    sets, root = sets_of(rows, size), {k: k for k, _ in rows}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in keys}


def edited(draw, words, share):
    return [f"e{draw.random()}" if draw.random() < share else w for w in words]


def test_signatures_estimate_the_similarity():
    draw = np.random.default_rng(1)
    off = []
    for similarity in (0.5, 0.8):
        for _ in range(150):
            n = int(draw.integers(5, 300))
            common = max(1, round(2 * n * similarity / (1 + similarity)))
            pool = draw.integers(0, 1 << 62, 2 * n - common, dtype=np.uint64)
            a, b = signatures([pool[:n], pool[n - common :]])
            off.append((a == b).mean() - common / (2 * n - common))
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.045


def test_signature_of_one_set_does_not_depend_on_others():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 1 << 62, n, dtype=np.uint64)) for n in (1, 3, 0, 500, 60)]
    together = signatures(sets)
    for i, s in enumerate(sets):
        assert (signatures([s])[0] == together[i]).all()
    assert (together[2] == np.iinfo(np.uint64).max).all() and len(np.unique(band_keys(together))) == 5 * 32


def test_linked_members_share_a_prefix_element():
    """Any two members of a leader's bucket that are similar meet, unless both are linked to it."""
    draw = random.Random(3)
    met = 0
    for _ in range(1500):
        base = list(range(draw.randint(5, 60)))
        pool = [draw.randint(100, 140) for _ in range(40)]
        make = lambda: {x if draw.random() > share else draw.choice(pool) for x in base}  # noqa: E731, B023
        share = draw.choice([0.05, 0.1, 0.2, 0.3])
        leader, x, y = ({int(v) for v in make()} for _ in range(3))
        if draw.random() < 0.5:  # often x and y share their edits
            y = set(list(x)[: int(len(x) * 0.95)]) | {draw.choice(pool)}
        array = lambda s: np.array(sorted(s), np.uint64)
        both = len(x & y)
        similar = 100 * both >= 80 * (len(x) + len(y) - both)
        linked_x, part_x, short_x, size_x = difference_prefix(array(leader), array(x), 80)
        linked_y, part_y, short_y, size_y = difference_prefix(array(leader), array(y), 80)
        if not similar or x == y or x == leader or y == leader or (linked_x and linked_y):
            continue
        met += 1
        if not linked_x and not linked_y:
            parts = part_x[:short_x].tolist(), part_y[:short_y].tolist()
        elif not linked_x:
            parts = part_x.tolist(), part_y[:short_y].tolist()
        else:
            parts = part_x[:short_x].tolist(), part_y.tolist()
        common = set(parts[0]) & set(parts[1])
        assert common
        # The first place at which they meet leaves room for all they need to share.
        places = [(parts[0].index(e), parts[1].index(e)) for e in common]
        needed = 180 * (size_x + size_y) - 20 * (len(x) + len(y))
        assert any(360 * min(size_x - i, size_y - j) >= needed for i, j in places)
    assert met > 100


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_brute_force(spark, documents, seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, key = [], 0
    for _ in range(12):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([3, 8, 40, 150]))]
        for share in (0, 0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06):
            copy = edited(draw, base, share)
            for words in (copy, edited(draw, copy, 0.02)):
                key += 1
                rows.append((key, " ".join(w.upper() if draw.random() < 0.1 else w for w in words)))
    draw.shuffle(rows)
    for size in (4, 5):
        found = near_duplicates(documents(rows, component_id="x", bands="y", kept="z"), shingle=size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, size)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(rows)


def test_edge_rows(spark, documents):
    long = " ".join(f"x{i}" for i in range(30_000))
    rows = [
        (9, "one two"), (3, "ONE  two\n"), (4, None), (5, ""), (6, " \t"), (7, long), (2, long + " end"), (8, "alone"),
        (8, "alone"), (None, "one two"), (None, None), (1, "two one"), (11, "Ünï x"), (12, "ünï x"),
    ]
    found = [tuple(r) for r in near_duplicates(documents(rows)).collect()]
    assert sorted(found, key=str) == sorted([
        (9, 1, 3, False), (3, 1, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 29_996, 2, False),
        (2, 29_997, 2, True), (8, 1, 8, True), (8, 1, 8, True), (None, 1, None, False), (None, 0, None, False), (1, 1, 1, True),
        (11, 1, 11, True), (12, 1, 12, True)], key=str)
    assert near_duplicates(documents([])).count() == 0
    assert near_duplicates(documents([(1, None)])).collect()[0].component_id == 1


@pytest.mark.parametrize("seed, chunk", [(0, 100_000), (1, 40), (2, 1)])
def test_connected_components(spark, monkeypatch, seed, chunk):
    """Small chunks leave the work to the rounds."""
    monkeypatch.setattr("refinery.llm.components.CHUNK", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(chunk, 10_000)))
    draw = random.Random(seed)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(5, 5), (None, 3), (2000, None)]
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    expected = {}
    for start in sorted(near):
        stack = [start] if start not in expected else []
        while stack:
            node = stack.pop()
            if node not in expected:
                expected[node] = start
                stack.extend(near[node])
    frame = spark.createDataFrame(edges, "a bigint, b bigint").repartition(7)
    try:
        rows = components(frame).collect()
        assert components(frame.limit(0)).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.node: r.component for r in rows} == expected and len(rows) == len(expected)
