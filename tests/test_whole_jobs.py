"""Queries over the whole of what their names promise."""

from siftwork.plans import core_queries


def test_best_match_may_be_another_query(spark, tmp_path):
    rows = [(50, "a b c d e f"), (100, "a b c d e f"), (101, "a b c d x y"), (150, "q r s t"), (151, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.id: (r.best_id, r.score) for r in core_queries.jaccard_best_match(spark, str(tmp_path)).collect()}
    assert got == {50: (100, 1.0), 100: (50, 1.0), 150: (None, 0.0)}


def test_missing_ids_are_those_of_every_source(spark, tmp_path):
    rows = [("a", 1), ("a", 3), ("b", 2), ("b", 2), ("c", 4), (None, 1)]
    spark.createDataFrame(rows, "source string, thread_id bigint").write.parquet(str(tmp_path / "forum_example_fixed.parquet"))
    got = [tuple(r) for r in core_queries.id_range_missing(spark, str(tmp_path)).collect()]
    assert sorted(got) == [(s, i, f"https://pages.example/temat,{i}") for s, i in (("a", 2), ("a", 4), ("b", 1), ("b", 3), ("b", 4), ("c", 1), ("c", 2), ("c", 3))]
