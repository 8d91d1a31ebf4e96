from pyspark.sql import functions as F

from siftwork.llm import cleanup as c
from siftwork.llm.unify import unify_text


def test_fold():
    assert c.fold("Ｗｙkaż ﬁn​ite ą x") == "Wykaż finite ą x"
    assert c.fold("обот x̄ ½ x² „a” — α \U0001f600") == "обот x̄ ½ x² „a” — α \U0001f600"
    assert c.fold("tоpоlоgіі") == "topologii"
    assert c.fold("решениe") == "решение"
    assert c.fold("") == ""


def test_kinds():
    assert c.kinds_of("x̄ α ² „a”") == []
    assert c.kinds_of("１") == ["wide"] and c.kinds_of("ą") == ["composable"] and c.kinds_of("a­") == ["invisible"]
    assert c.kinds_of("a b") == ["blank"] and c.kinds_of("Ζapisz") == ["mixed_script"]
    assert c.kinds_of("\U0001f469‍\U0001f4bb") == [] and c.kinds_of("a\tb\nc d") == []


def test_operator(spark):
    rows = [(1, "topologii i reszta", "k"), (2, "tоpologii", None), (2, "tоpologii", None), (3, None, "x"), (4, "", "x"), (5, "nieznanаgwara", "y"), (6, "a " * 50_000, "z")]
    df = spark.createDataFrame(rows, "id bigint, text string, kinds_ string")
    got = unify_text(df)
    assert got.columns == ["id", "text", "kinds_", "unified", "kinds"]
    by = {r.id: (r.unified, r.kinds) for r in got.collect()}
    assert got.count() == 7
    assert by[2] == ("topologii", ["mixed_script"]) and by[3] == (None, []) and by[4] == ("", [])
    assert by[5] == ("nieznanаgwara", ["mixed_script"])  # no such word in the corpus
    assert by[6] == ("a " * 50_000, ["blank"])
    assert unify_text(df.where(F.lit(False))).count() == 0


def test_letters_of_further_scripts_inside_latin_words():
    # Armenian o, Cherokee A, Coptic o, a Hebrew letter without a twin
    assert c.kinds_of("t\u0585pologia") == ["mixed_script"] and c.fold("t\u0585pologia") == "topologia"
    assert c.fold("\u13aalgebra") == "Algebra" and c.fold("t\u2c9fpologia") == "topologia"
    assert c.kinds_of("alge\u05d1ra") == ["mixed_script"] and c.fold("alge\u05d1ra") == "alge\u05d1ra"
    assert c.kinds_of("\u0563\u056b\u0580\u0584 \u05d0\u05d1") == []  # whole words
