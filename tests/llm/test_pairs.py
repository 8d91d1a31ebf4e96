"""Near duplicates and leaks against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from siftwork.llm import cleanup, leaks
from siftwork.llm import neardups as nd

SCHEMA = "field string, id bigint, text string, sig string"


def corpus(seed=5, groups=25):
    rng = random.Random(seed)
    vocabulary = [f"s{i}" for i in range(400)]
    rows = []
    for g in range(groups):
        base = rng.sample(vocabulary, 45)
        for k in range(4):
            words = list(base)
            for _ in range(rng.randint(0, 9)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rng.shuffle(words)
            rows.append(("question" if g % 2 else "post", g * 10 + k, " ".join(words), "clash"))
    return rows + rows[:2] + [("question", 900, None, ""), ("question", 901, "", ""), ("question", 902, "a b", ""), (None, 903, rows[0][2], ""), ("post", None, rows[0][2], "")]


def brute(rows, threshold=0.7, least=30):
    sets = {(f, i): set(cleanup.words(t)) for f, i, t, _ in rows if f and i is not None and t}
    sets = {k: v for k, v in sets.items() if len(v) >= least}
    return {(f, i, j) for (f, i), a in sets.items() for (g, j), b in sets.items() if f == g and i < j and len(a & b) >= threshold * len(a | b)}


def test_pairs_are_those_of_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    got = [tuple(r) for r in nd.near_duplicate_pairs(df, recall=0.9999).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20


def test_whole_comparison_in_blocks_loses_nothing(spark):
    rows = corpus(groups=6)
    df = spark.createDataFrame(rows, SCHEMA)
    # every node is too large at once, so all are compared in blocks
    got = [tuple(r) for r in nd.near_duplicate_pairs(df, recall=0.99999, limit=1, max_depth=1, block=3).collect()]
    assert set(got) == brute(rows) and len(got) == len(set(got))


def test_splitting_large_nodes_keeps_the_recall(spark):
    rows = corpus(groups=30)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    # every node is split, where its rows stand or, with one cell, in shuffles of its own
    for cells in (nd.CELLS, 1):
        got = {tuple(r) for r in nd.near_duplicate_pairs(df, recall=0.9999, limit=1, cells=cells).collect()}
        assert got == want


def templated(groups, shared, own, single, seed=4):
    """Pairs (2 k, 2 k + 1) of one template of ``shared`` words, which all texts have."""
    rng = random.Random(seed)
    common, rows = [f"c{i}" for i in range(shared)], []
    for k in range(groups):
        words = common + [f"o{k}n{i}" for i in range(own)]
        rows += [("post", 2 * k + e, " ".join(rng.sample(words + [f"d{k}e{e}n{i}" for i in range(single)], len(words) + single)), "") for e in (0, 1)]
    return rows, {("post", 2 * k, 2 * k + 1) for k in range(groups)}


def test_a_hot_template_reaches_the_asked_recall(spark):
    # pairs at 50 / 70 in a group whose members are otherwise 40 / 80 alike
    for groups, cells in ((2000, nd.CELLS), (300, 1)):
        rows, want = templated(groups, 40, 10, 10)
        if groups < 500:
            assert brute(rows) == want
        got = {tuple(r) for r in nd.near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA), limit=20, cells=cells).collect()}
        # at the asked 0.995, more lost pairs than this have a chance below one in a thousand
        assert got <= want and len(want) - len(got) <= 0.005 * groups + 3.1 * (0.005 * groups) ** 0.5 + 1


def test_runs_count_the_levels():
    assert [round(nd.met(0.7, d), 3) for d in (1, 2, 3, 6)] == [0.7, 0.553, 0.461, 0.313]
    assert nd.runs_for(0.995, 0.7, 1) == 5 and nd.runs_for(0.995, 0.7, 3) == 9
    assert round(nd.met(0.4, 2), 2) == 0.28  # two or three orders a node


def test_no_task_gets_a_hot_node(spark):
    rows, _ = templated(400, 40, 10, 10)
    sets = nd.with_sketches(nd.word_sets(spark.createDataFrame(rows, SCHEMA), 30).select("sig", "words"), 7).cache()
    tree = nd.grown(sets, sets.count(), nd.Tree(range(6), 0.7, 7), 20, nd.CELLS, 30)
    largest = nd._leaves(sets, tree, whole=False).groupBy("key").count().agg(F.max("count")).first()[0]
    assert len(tree.hot) > 2 and largest <= nd.limit_at(20, len(tree.hot) + 1)
    # every set ends in each run, whether its nodes are split or not
    assert nd._leaves(sets, tree, whole=False).groupBy("sig").count().agg(F.min("count")).first()[0] >= 6


def test_the_sketches_are_counted_in_the_recall(spark):
    rng = random.Random(6)
    rows = []
    for k in range(2000):  # pairs of similarity 42 / 60
        both = [f"b{k}n{i}" for i in range(42)]
        rows += [("post", 2 * k + e, " ".join(rng.sample(both + [f"d{k}e{e}n{i}" for i in range(9)], 51)), "") for e in (0, 1)]
    got = {tuple(r) for r in nd.near_duplicate_pairs(spark.createDataFrame(rows, SCHEMA), recall=0.9999).collect()}
    assert got <= {("post", 2 * k, 2 * k + 1) for k in range(2000)} and len(got) >= 1999
    for recall in (0.9, 0.995, 0.9999):
        least, lost = nd.sketch_bound(recall, 0.7)
        assert lost <= (1 - recall) / 2 and 30 < least <= 45


def test_odd_sketches_never_differ_in_more_bits_than_words():
    rng = np.random.default_rng(1)
    words = [np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint32)) for n in (1, 40, 70, 400)]
    x, y = np.concatenate(words), np.concatenate([w[::2] for w in words])
    starts = [np.concatenate([[0], np.cumsum([len(v) for v in vs])[:-1]]) for vs in (words, [w[::2] for w in words])]
    for wide in (2, 8):
        differ = sum(np.bitwise_count(a ^ b) for a, b in zip(nd._odd(x, starts[0], wide), nd._odd(y, starts[1], wide), strict=True))
        assert all(d <= len(w) // 2 for d, w in zip(differ.tolist(), words, strict=True))


def test_a_large_group_of_like_texts_is_compared_whole(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append(("post", i, " ".join(words), ""))
    rows += [("post", 1000 + i, " ".join(f"y{rng.randrange(3000)}" for _ in range(60)), "") for i in range(150)]
    df = spark.createDataFrame(rows, SCHEMA)
    sets = nd.with_sketches(nd.word_sets(df, 30).select("sig", "words").dropDuplicates(["sig"]), 7).cache()
    tree = nd.grown(sets, sets.count(), nd.Tree(range(3), 0.7, 7), 40, nd.CELLS, 30)
    assert sum(map(len, tree.whole)) >= 3 and sum(map(len, tree.hot)) <= 3
    want = brute(rows)
    for cells in (nd.CELLS, 1):
        got = {tuple(r) for r in nd.near_duplicate_pairs(df, recall=0.9999, limit=40, cells=cells, block=50).collect()}
        assert got == want and len(got) > 10_000


def test_copies_pair_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([("post", i, text, "") for i in range(5)], SCHEMA)
    assert nd.near_duplicate_pairs(df).count() == 10
    assert {r.group_id for r in nd.near_duplicate_groups(df).collect()} == {0}
    assert nd.near_duplicate_pairs(df.where(F.lit(False))).count() == 0
    assert nd.near_duplicate_groups(df.where(F.lit(False))).count() == 0


def test_groups_follow_chains(spark):
    base = [f"w{i}" for i in range(50)]
    rows = [("post", k, " ".join(base[: 50 - 6 * k] + [f"x{i}" for i in range(6 * k)]), "") for k in range(4)]
    got = {r.id: (r.group_id, r.links) for r in nd.near_duplicate_groups(spark.createDataFrame(rows, SCHEMA), recall=0.9999).collect()}
    assert got == {0: (0, 1), 1: (0, 2), 2: (0, 2), 3: (0, 1)}


def leak_rows(rng):
    words = [f"v{i}" for i in range(60)]
    items = [(1, " ".join(rng.choices(words, k=40)), " ".join(rng.choices(words, k=30))), (2, " ".join(rng.choices(words, k=14)), None), (3, "krótkie", ""), (1, None, None)]
    text = []
    for i in range(60):
        body = rng.choices(words, k=30)
        if i % 3 == 0:
            source = rng.choice([t for it in items for t in it[1:] if t and len(t) > 60]).split()
            n = rng.choice([11, 12, 13, 14, len(source)])
            at = rng.randint(0, max(0, len(source) - n))
            body[5:5] = source[at : at + n]
        text.append((i, " ".join(body[:20]), " ".join(body[20:])))
    return items, [*text, text[0], (77, None, ""), (None, items[0][1], ""), (78, items[0][1], "x " * 20_000)]


def brute_leaks(items, rows, run=13):
    grams = {}
    for k, *ts in items:
        for t in ts:
            w = cleanup.words(t or "")
            for i in range(len(w) - run + 1):
                grams.setdefault(tuple(w[i : i + run]), set()).add(k)
    return {(r, k) for r, *ts in rows if r is not None for t in ts for w in [cleanup.words(t or "")] for i in range(len(w) - run + 1) for k in grams.get(tuple(w[i : i + run]), ())}


def test_leaks_are_those_of_brute_force(spark, monkeypatch):
    items, rows = leak_rows(random.Random(3))
    bench = spark.createDataFrame(items, "task_id bigint, task string, solution string")
    df = spark.createDataFrame(rows, "record_id bigint, question string, solution string")
    want = brute_leaks(items, rows)
    for bits in (leaks.BITS, 8):  # with a filter that lets nearly everything through, the join alone decides
        monkeypatch.setattr(leaks, "BITS", bits)
        got = [tuple(r) for r in leaks.leaked(df, "record_id", ["question", "solution"], bench, "task_id", ["task", "solution"]).collect()]
        assert set(got) == want and len(got) == len(want) and len(want) > 5
    assert leaks.leaked(df.where("false"), "record_id", ["question"], bench, "task_id", ["task"]).count() == 0
    assert leaks.leaked(df, "record_id", ["question"], bench.where("false"), "task_id", ["task"]).count() == 0
