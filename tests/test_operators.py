import random
from collections import Counter

import json

import pytest
from pyspark.sql import functions as F

from siftwork.operators import components, dedup, metrics, ngrams, sampling, similarity, threads


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts, 1)], "id bigint, text string")


LONG = "jeden dwa trzy cztery pięć sześć siedem osiem dziewięć dziesięć"


def test_decontaminate(spark):
    bench = spark.createDataFrame([(1, LONG, "odp a b c"), (None, "x", "y")], "task_id bigint, task string, solution string")
    index = ngrams.build_index(bench, 9)
    assert {r.task_name for r in index.select("task_name").distinct().collect()} == {"benchmark_task1"}
    d = docs(spark, "wstęp " + LONG, LONG.replace("dwa", "2"), None, "", LONG[:20])
    clean, removed = ngrams.decontaminate(d, index, "id", F.col("text"), 9)
    hit = removed.collect()
    assert [(r.id, r.contaminated_task, r.contaminated_ngram) for r in hit] == [(1, "benchmark_task1", " ".join(LONG.split()[:9]))]
    assert {r.id for r in clean.collect()} == {2, 3, 4, 5}
    shorter = ngrams.decontaminate(d, ngrams.build_index(bench, 5), "id", F.col("text"), 5)[1]
    assert {r.id for r in shorter.collect()} >= {1}


def test_index_spans_the_seam(spark):
    bench = spark.createDataFrame([(1, "a b c", "d e f")], "task_id bigint, task string, solution string")
    assert {r.gram for r in ngrams.build_index(bench, 4).collect()} == {"a b c d", "b c d e", "c d e f"}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 51), (52, 51), (60, 60), (None, 3)], "a bigint, b bigint")
    got = dict(components.connected_components(edges).collect())
    assert {got[i] for i in range(1, 41)} == {1} and got[52] == 50 and got[60] == 60
    assert components.connected_components(edges.where("a > 100")).count() == 0


def test_dedup_fewer_with_more_rows_and_exact_copies(spark):
    base = [" ".join(f"w{(i * 7 + k) % 90}" for k in range(60)) for i in range(12)]
    d = docs(spark, *base, base[0], base[0] + " koniec", "a b", "a b")
    gone = []
    for rows in (1, 3, 8):
        kept, removed = dedup.deduplicate(d, "id", F.col("text"), rows=rows)
        ids = {r.id for r in removed.collect()}
        assert 13 in ids and not ids & {15, 16}
        assert kept.count() + len(ids) == d.count()
        gone.append(len(ids))
    assert gone[0] >= gone[1] >= gone[2]
    with pytest.raises(ValueError):
        dedup.signatures(d, "id", F.col("text"), bands=0)


def test_signature_is_the_least_of_each_map(spark):
    d = docs(spark, "a b c d")
    hashes = dedup.shingles(d, "id", F.col("text")).first().hashes
    got = dedup.signatures(d, "id", F.col("text"), 2, 2).first().signature
    assert list(got) == [min((a * h + b) % 2147483647 for h in hashes) for a, b in dedup.family(4)]


def test_best_matches(spark):
    kept = docs(spark, "a b c d e", "a b c x y", "q r s")
    q = spark.createDataFrame([(9, "a b c d"), (10, "z z"), (11, None)], "id bigint, text string")
    got = {r.id: (r.best_id, r.score) for r in similarity.best_matches(q, kept, "id", F.col("text")).collect()}
    assert got[9] == (1, 2 / 3) and got[10] == (None, 0.0) and got[11] == (None, 0.0)


def test_best_matches_are_those_of_brute_force(spark):
    rng = random.Random(5)
    rows = [(f"d{i:03}", " ".join(rng.choices("abcde", k=rng.choice([0, 2, 3, 9, 30])))) for i in range(120)] + [("d200", None)]
    df = spark.createDataFrame(rows, "key string, text string").repartition(3)

    def grams(t):
        w = (t or "").split()
        return Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))

    have = {k: grams(t) for k, t in rows}
    want = {}
    for k in have:
        if int(k[1:]) % 4 == 0:
            scores = [(-(have[k] & g).total() / (have[k] | g).total(), o) for o, g in have.items() if o != k and (have[k] & g)]
            want[k] = (min(scores)[1], -min(scores)[0]) if scores else (None, 0.0)
    queries = df.where("int(substr(key, 2)) % 4 = 0")
    for size in (10, 100, 10**6):
        got = {r.id: (r.best_id, r.score) for r in similarity.best_matches(queries, df, "key", F.col("text"), block_grams=size).collect()}
        assert got == want
    assert similarity.best_matches(queries.where("false"), df, "key", F.col("text")).count() == 0
    assert {r.best_id for r in similarity.best_matches(queries, df.where("false"), "key", F.col("text")).collect()} == {None}


def test_split_is_exact_and_independent_of_partitions(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    one = {r.k for r in sampling.exact_split(df.repartition(1), "k", fraction=0.1).where("split='validation'").collect()}
    two = {r.k for r in sampling.exact_split(df.repartition(7), "k", fraction=0.1).where("split='validation'").collect()}
    assert one == two and len(one) == 11
    assert sampling.exact_split(df, "k", size=500).where("split='train'").count() == 0
    assert sampling.exact_split(df, "k", size=0).where("split='validation'").count() == 0
    many = spark.range(20_000).withColumnRenamed("id", "k")
    for size in (1, 777, 19_999):
        assert sampling.exact_split(many, "k", size=size).where("split='validation'").count() == size
    assert sampling.exact_split(many.where("k < 0"), "k", fraction=0.1).count() == 0


def test_heads_and_chat(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "s string, k int")
    assert sorted(map(tuple, sampling.head_per_source(df, "s", ["k"], 2).collect())) == [("a", 1), ("a", 2), ("b", 9)]
    msg = spark.range(1).select(sampling.rendered_chat(sampling.chat(F.lit("q"), F.lit("r")))).first()[0]
    assert msg == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\nr<|im_end|>\n"


@pytest.mark.parametrize(("gold", "said", "same"), [("$\\frac{1}{2}$", "0,5", True), ("\\boxed{7}", "7.", True), ("x = 3", "x=3", True), ("", "", False), ("2", "3", False), ("1/0", "5", False)])
def test_same_answer(spark, gold, said, same):
    assert spark.createDataFrame([(gold, said)], "a string, b string").select(metrics.same_answer(F.col("a"), F.col("b"))).first()[0] is same


def test_accuracy(spark):
    df = spark.createDataFrame([("1", "1"), ("", "1"), ("2", "3")], "g string, p string")
    assert metrics.accuracy(df, "g", "p").first().accuracy == pytest.approx(1 / 3)
    assert metrics.accuracy(df, "g", "p", skip_empty_gold=True).first().accuracy == 0.5
    assert metrics.accuracy(df.where("false"), "g", "p").first().accuracy == 0.0


def test_threads(spark):
    posts = spark.createDataFrame([("t", 2, "b"), ("t", 1, "a"), ("u", 1, "c")], "url string, pos int, content string")
    got = {r.url: [tuple(p) for p in r.posts] for r in threads.assemble(posts, ["url"], ["pos"], ["content"]).collect()}
    assert got == {"t": [(0, "a"), (1, "b")], "u": [(0, "c")]}
    p = F.from_json(F.lit(json.dumps([{"index": 1, "content": "x"}, {"index": 1, "content": "y", "contains_images": True}, {"index": 2}])), "array<struct<index:int,author:string,content:string,contains_images:boolean>>")
    row = spark.range(1).select(threads.post_content(p, F.lit(1)), threads.post_content(p, F.lit(7)), threads.any_images(threads.relevant(p, F.array(F.lit(2)))), threads.any_images(p)).first()
    assert tuple(row) == ("y", None, False, True)
    pages = spark.createDataFrame([("t", 1, ["c"]), ("t", 0, ["a", "b"])], "t string, page int, posts array<string>")
    assert sorted(map(tuple, threads.across_pages(pages, "t", "page", "posts").collect())) == [("t", 0, "a"), ("t", 1, "b"), ("t", 2, "c")]


def test_until_misses(spark):
    hits = [False] * 4 + [True] + [False] * 5 + [True]
    df = spark.createDataFrame([("s", i, h) for i, h in enumerate(hits)], "s string, id int, hit boolean")
    assert [r.id for r in threads.until_misses(df, "s", "id", "hit").orderBy("id").collect()] == list(range(10))
    start = df.where("id > 4").withColumn("hit", F.lit(False))
    assert threads.until_misses(start, "s", "id", "hit").count() == 5


def test_runs_of_misses_go_over_blocks(spark):
    rng = random.Random(3)
    rows, want = [], set()
    for g in range(12):
        run, stopped = 0, False
        for i in sorted(rng.sample(range(200), 120)):
            hit = rng.random() < 0.25
            rows.append((f"g{g}", i, hit))
            run = 0 if hit else run + 1
            if not stopped:
                want.add((f"g{g}", i))
            stopped |= run >= 9
    df = spark.createDataFrame(rows, "s string, id int, hit boolean")
    for block in (1, 7, 1000):
        assert {(r.s, r.id) for r in threads.until_misses(df, "s", "id", "hit", 9, block).collect()} == want
    spans = spark.createDataFrame([("a", 1, 23), ("b", 5, 5), ("c", 9, 8), ("d", None, 3)], "s string, a bigint, b bigint")
    got = [(r.s, r.id) for r in threads.id_grid(spans, "a", "b", "id", 10).orderBy("s", "id").collect()]
    assert got == [("a", i) for i in range(1, 24)] + [("b", 5)]


def test_resume_and_ranges(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "cat string")
    assert [r.cat for r in threads.from_checkpoint(df, "cat", "b", ["a", "b", "c"]).collect()] == ["b", "c"]
    assert threads.from_checkpoint(df, "cat", None, ["a", "b", "c"]).count() == 3
    assert [tuple(r) for r in threads.id_range(spark, 3, 4, "x/%d").collect()] == [(3, "x/3"), (4, "x/4")]


def test_batches_and_metadata(spark):
    df = spark.range(25).selectExpr("id as k", "map('a', string(id), if(id = 3, 'b', '_source_path'), 'x') as meta")
    assert sorted((r.batch, r.k) for r in threads.batches(df.select("k").repartition(5), ["k"], 10).collect()) == [(i // 10, i) for i in range(25)]
    flat = threads.flat_metadata(df, "meta")
    assert flat.columns == ["k", "a", "b"] and [r.b for r in flat.where("b is not null").collect()] == ["x"]


def test_problem_thread(spark):
    c = threads.problem_thread(F.lit("s"), F.lit("u"), F.lit("zbiory"), F.lit("Zadanie 1"), F.lit("p"), F.lit("r"), F.lit(True), F.lit("z"))
    t = spark.range(1).select(c.alias("t")).first().t
    assert t.title == "zbiory – Zadanie 1" and [p.content for p in t.posts] == ["p", "r"] and t.posts[0].contains_images
