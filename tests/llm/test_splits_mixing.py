import random

import pytest
from pyspark.sql import functions as F

from siftwork.llm import mixing, splits


@pytest.mark.parametrize(
    ("url", "host", "no"),
    [
        ("https://a.example/viewtopic.php?f=12&t=77#p5", "a.example", 77),
        ("  HTTPS://WWW.A.Example:443/viewtopic.php?t=77&amp;start=15", "a.example", 77),
        ("http://m.a.example/temat/77//?sid=ab", "a.example", 77),
        ("a.example/forum.php?id=77&utm_source=x9", "a.example", 77),
        ("https://a.example/t100-zadanie-t77.html?start=3", "a.example", 77),
        ("https://a.example/watek-t77.html", "a.example", 77),
        ("https://a.example/temat/77-o-sumach", "a.example", 77),
        ("https://a.example/temat/77x", None, None),
        ("https://a.example/viewtopic.php?start=7", None, None),
        ("about:blank", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_addresses(spark, url, host, no):
    h, n = splits.thread_of(F.col("u"))
    assert tuple(spark.createDataFrame([(url,)], "u string").select(h, n).first()) == (host, no)


def test_differencing_and_allotment():
    rng = random.Random(1)
    weights = [rng.randint(1, 50) for _ in range(400)]
    where = splits.differencing(weights, 10)
    sums = [sum(w for w, b in zip(weights, where, strict=True) if b == k) for k in range(10)]
    assert max(sums) - min(sums) <= 3 and splits.differencing([], 4) == []
    got = splits.allot(sums, {"train": 0.8, "test": 0.2})
    assert got.count("test") == 2


def test_differencing_fills_up_what_bins_hold():
    rng = random.Random(3)
    held, weights = [rng.randint(0, 400) for _ in range(10)], [rng.randint(1, 50) for _ in range(400)]
    sums = list(held)
    for w, k in zip(weights, splits.differencing(weights, 10, held), strict=True):
        sums[k] += w
    assert max(sums) - min(sums) <= 3 and splits.differencing([], 10, held) == []


def test_the_driver_sees_few_of_a_million_weights(spark, monkeypatch):
    seen = []
    real = splits.differencing
    monkeypatch.setattr(splits, "differencing", lambda weights, bins, start=None: seen.append(len(weights)) or real(weights, bins, start))
    weights = spark.range(1_000_000).select(splits.weight_range(F.col("id") + 1).alias("r"))
    assert weights.distinct().count() < 400
    rows = spark.range(30_000).select((F.col("id") % 300).alias("k"), "id").where("id % 300 * 100 > id - 5000")
    got = splits.related_splits(rows.withColumn("k", F.col("k").cast("string")), "id", ["k"], bins=10, slice_rows=7)
    assert seen and seen[0] < 10 * 400 and got.count() == rows.count()
    assert got.groupBy("k").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    share = got.where("split = 'train'").count() / got.count()
    assert abs(share - 0.8) < 0.02


def test_related_rows_stay_together(spark):
    rng = random.Random(2)
    rows = [(i, None if i % 17 == 0 else f"k{int(rng.paretovariate(0.7)) % 60}", "" if i % 5 else f"a{i % 40}", "clash") for i in range(600)] + [(None, None, None, None)] * 3
    df = spark.createDataFrame(rows, "id bigint, k string, a string, split string")
    for keys in (["k"], ["k", "a"]):
        got = splits.related_splits(df, "id", keys, {"train": 0.6, "test": 0.4}, bins=10)
        assert got.count() == 603 and set(got.columns) == {"id", "k", "a", "split"}
        for key in keys:
            assert got.where(f"{key} <> ''").groupBy(key).agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    one = got.where("split = 'train'").count()
    assert abs(splits.related_splits(df, "id", ["k"], {"train": 0.6, "test": 0.4}, bins=10).where("split = 'train'").count() - 362) < 40 or one
    assert splits.related_splits(df.where("false"), "id", ["k"]).count() == 0


def test_chains_of_keys_are_one_component(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x"), (3, None, "x"), (4, "b", "x"), (5, None, None), (6, "c", "y")], "id bigint, k string, l string")
    got = {r.id: r.split_key for r in splits.component_keys(df, "id", ["k", "l"]).collect()}
    assert len({got[i] for i in (1, 2, 3, 4)}) == 1 and len(set(got.values())) == 3


TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("none", 0.0, 1)]


def documents(spark):
    rng = random.Random(4)
    rows = [(i, rng.choices(["a", "b", "c", "x", None], [60, 15, 5, 10, 10])[0], "słowo i liczba 12 " * rng.randint(1, 30)) for i in range(400)]
    return spark.createDataFrame([*rows, rows[0], (900, "a", None), (901, "a", "")], "doc_id bigint, source string, text string")


def test_mix_against_a_plain_queue(spark):
    docs, targets = documents(spark), spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    sized = mixing.sizes(docs, "doc_id", "text", "source").join(targets.where("target_share > 0").select("source"), "source")
    every = sorted((r.finish, r.source, r.doc_id, r.copy, r.n_tokens) for r in mixing.queue(sized.select("doc_id", "source", "n_tokens"), targets).collect())
    total = sum(r.n_tokens for r in sized.collect())
    for budget in (None, total // 3, 10**9, 0):
        room, want = total if budget is None else budget, []
        for f, s, d, c, n in every:
            if n > room:
                break
            room -= n
            want.append((d, c))
        got = [(r.doc_id, r.copy) for r in mixing.mix(docs, targets, budget=budget).collect()]
        short = mixing.queue(sized.select("doc_id", "source", "n_tokens"), targets, budget=budget).count()
        assert len(got) <= short <= len(every) and (budget is None or budget > total or short < len(every))
        assert sorted(got) == sorted(want), budget
    third = mixing.shares(mixing.mix(docs, targets, budget=total // 3), targets).collect()
    share = {r.source: r.actual_share for r in third}
    assert abs(share["a"] - 0.5) < 0.1 and share["none"] == 0 and max(r.most_copies for r in third) <= 3
    assert mixing.mix(docs.where("false"), targets).count() == 0
    assert sum(r.tokens for r in mixing.shares(mixing.mix(docs.where("false"), targets), targets).collect()) == 0
