import pytest
from pyspark.sql import functions as F

from siftwork.functions import html, latex, protocol, text


def value(spark, column, **row):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in row.items()) or "x string"
    return spark.createDataFrame([tuple(row.values()) or (None,)], schema).select(column).first()[0]


def test_build_text_keeps_separators_and_strips(spark):
    c = text.build_text(F.col("a"), F.col("b"))
    assert value(spark, c, a=None, b="x") == "x"
    assert value(spark, c, a="\u00a0q ", b="") == "q"
    assert value(spark, text.build_text(F.col("a"), F.col("b"), F.col("c")), a="p", b=None, c="r") == "p  r"


def test_tokens_and_grams(spark):
    assert value(spark, text.norm_tokens(F.col("a")), a="Ala, ma 3.14 kotów!") == ["ala", "ma", "0", "kotów"]
    assert value(spark, text.norm_tokens(F.col("a"), numbers=False), a="x 31") == ["x", "31"]
    assert value(spark, text.norm_tokens(F.col("a")), a=None) == []
    assert value(spark, text.ngrams(F.col("w"), 3), w=list("abcd")) == ["a b c", "b c d"]
    assert value(spark, text.ngrams(F.col("w"), 3), w=list("ab")) == []
    assert value(spark, text.overlap_ngrams(F.col("q"), F.col("s"), 3), q=list("ab"), s=list("xy")) == ["a b x", "b x y"]
    assert value(spark, text.overlap_ngrams(F.col("q"), F.col("s"), 3), q=["a"], s=["x"]) == []


def test_navigation_and_lines(spark):
    assert value(spark, text.without_navigation(F.col("a")), a="Treść\n\n Logowanie \nKontakt: x\n dalej ") == "Treść\ndalej"
    assert value(spark, text.squeeze_blank_lines(F.col("a")), a="a\n\n\n\nb") == "a\n\nb"
    assert value(spark, text.has_image_link(F.col("a")), a="http://x.example/a.JPG") is True
    assert value(spark, text.has_image_link(F.col("a")), a=None) is False


@pytest.mark.parametrize(
    ("base", "href", "out"),
    [
        ("https://a.example/b/c?d", "e", "https://a.example/b/e"),
        ("https://a.example/b/c", "/e", "https://a.example/e"),
        ("https://a.example/b/c", "//z.example/e", "https://z.example/e"),
        ("https://a.example/b/c", "http://z.example/", "http://z.example/"),
        ("https://a.example/b/c?d", "?e=1", "https://a.example/b/c?e=1"),
        ("https://a.example/b/c#x", "#e", "https://a.example/b/c#e"),
        ("https://a.example", "e", "https://a.example/e"),
        ("https://a.example/b", "", "https://a.example/b"),
    ],
)
def test_absolute_url(spark, base, href, out):
    assert value(spark, text.absolute_url(F.col("b"), F.col("h")), b=base, h=href) == out


def test_urls_and_pages(spark):
    assert value(spark, text.canonical_url(F.col("a")), a="https://a.example/x?y#z") == "https://a.example/x"
    assert value(spark, text.max_page(F.col("h"), F.lit(2)), h=["/t,1,3", "/t,1,x"]) is True
    assert value(spark, text.max_page(F.col("h"), F.lit(3)), h=["/t,1,3"]) is False


def test_dates(spark):
    c = text.forum_date(F.col("a"))
    assert value(spark, c, a=" 2020-01-31 08:05:09 ") == "2020-01-31T08:05:09+00:00"
    assert value(spark, c, a="2020-01-31 08:05") == "2020-01-31T08:05:00+00:00"
    assert value(spark, c, a="2020-02-31 08:05") == "2020-02-31 08:05"
    assert value(spark, c, a="wczoraj") == "wczoraj"
    date, rest = text.date_headed(F.col("a"))
    assert value(spark, date, a="2020-01-31 08:05:09\nTreść") == "2020-01-31T08:05:09+00:00"
    assert value(spark, rest, a="2020-01-31 08:05:09\nTreść") == "Treść"
    assert value(spark, rest, a="Treść\ndalej") == "Treść\ndalej"


def test_split_solution(spark):
    problem, solution = text.split_solution(F.col("a"))
    a = "Policz x. Odp.: 3\nROZWIĄZANIE\nLiczymy."
    assert (value(spark, problem, a=a), value(spark, solution, a=a)) == ("Policz x.", "Odp.: 3\nLiczymy.")
    assert (value(spark, problem, a="Policz"), value(spark, solution, a="Policz")) == ("Policz", "")
    assert value(spark, solution, a="Policz. Odp. 3") == "Odp. 3"


def test_percent_and_json(spark):
    assert value(spark, text.percent(F.lit(0.875))) in ("88%",)
    assert value(spark, text.json_line(F.col("a"), F.lit(None).cast("string").alias("b")), a="ż") == '{"a":"ż","b":null}'


@pytest.mark.parametrize(
    ("raw", "out"),
    [
        ("a\u00a0b\u2009c\u200bd", "a b cd"),
        (r"\(\displaystyle{\frac{1}{2}}\) x", "\\[\n\\frac{1}{2}\n\\] x"),
        (r"\(\displaystyle{a} + b", r"{\displaystyle a} + b"),
        (r"\(\displaystyle{a+b", r"{\displaystyle a+b}"),
        ("x \\(a\nb\\) y \\(c\\)", "x $a\nb$ y $c$"),
        ("x^{} a_{  2} b^{\t3}", "x a_{2} b^{3}"),
        ("1...2", r"1\cdots2"),
        ("....", r"\cdots."),
        (r"\...", r"\..."),
        ("a......b", r"a\cdots...b"),
    ],
)
def test_normalize_latex(spark, raw, out):
    assert value(spark, latex.normalize_latex(F.col("a")), a=raw) == out
    assert value(spark, latex.normalize_latex_each(F.col("a")), a=[raw, None]) == [out, None]


def test_latex_null_and_fences(spark):
    assert value(spark, latex.normalize_latex(F.col("a")), a=None) is None
    assert value(spark, latex.strip_fences(F.col("a")), a="```json\n[1]\n```") == "[1]"
    assert value(spark, latex.strip_fences(F.col("a"), "latex"), a="```\nx\n```") == "x"


@pytest.mark.parametrize(
    ("raw", "out"),
    [
        (r'{"a":"\{x\}"}', "\\{x\\}"),
        (r'{"a":"\\dots \{"}', "\\dots \\{"),
        (r'{"a":"\\\\ \{"}', "\\\\ \\{"),
        (r'{"a":"\underline"}', "\\underline"),
        (r'{"a":"\u0041"}', "A"),
    ],
)
def test_json_repair(spark, raw, out):
    c = F.get_json_object(latex.repair_json_escapes(F.col("a")), "$.a")
    assert value(spark, c, a=raw) == out


def test_protocols(spark):
    assert value(spark, protocol.decision(F.col("a")), a="x") is True
    assert value(spark, protocol.decision(F.col("a")), a="DECISION: no\n DECISION: yes") is True
    assert value(spark, protocol.decision(F.col("a")), a="decision: no") is True
    assert value(spark, protocol.decision(F.col("a")), a="DECISION: NO\nREASON: a: b") is False
    assert value(spark, protocol.reason(F.col("a")), a="DECISION: NO\nREASON: a: b") == "a: b"
    assert value(spark, protocol.category(F.col("a")), a="CATEGORY: proof") == "PROOF"
    assert value(spark, protocol.category(F.col("a")), a="CATEGORY: nothing") is None
    for raw, out in (("POST_INDEX: 3\nPOST_INDEX: 3x", 3), (" POST_INDEX: 3\nPOST_INDEX: 4", 4), ("x\n POST_INDEX: 3", None), ("POST_INDEX: 3\nNO_ANSWER", None), ("", None)):
        assert value(spark, protocol.post_index(F.col("a")), a=raw) == out, raw


def test_tasks(spark):
    posts = F.from_json(F.lit('[{"index":0,"content":"p0"},{"index":1,"content":"p1"}]'), "array<struct<index:int,content:string>>")

    def of(raw, posts=posts):
        return [tuple(t) for t in value(spark, protocol.tasks(F.col("a"), posts, F.lit("title")), a=raw)]

    whole = [("p0", [0, 1], False)]
    assert of('```json\n[{"question":"q","post_indices":[1],"has_inline_solution":true}]\n```') == [("q", [1], True)]
    for bad in ("", "[]", '{"question":"q"}', "[1,2]", "nonsense", "null"):
        assert of(bad) == whole, bad
    none = F.array().cast("array<struct<index:int,content:string>>")
    assert of("", none) == [("title", [], False)]


BOARD = """<html><body><h2 class="topic-title">T</h2><a rel="next" href="/n">n</a>
<div class="post"><p class="author"><span class="responsive-hide"><strong><a>ala</a></strong></span></p><time datetime="2020-01-01T00:00:00+00:00">x</time>
<div class="content">a &lt; b <img class="smilies" src="s"><script type="math/tex">x^2</script><script type="math/tex; mode=display">y</script><img class="postimage" src="z"></div></div>
<div class="post"><a class="username">ola</a></div></body></html>"""


def test_board_page(spark):
    page = value(spark, html.board_page(F.col("a")), a=BOARD)
    assert page["title"] == "T"
    assert [tuple(p) for p in page["posts"]] == [(0, "ala", "2020-01-01T00:00:00+00:00", "a < b\n$x^2$\n$$\ny\n$$", True), (1, "ola", None, "", False)]
    assert value(spark, html.next_page(F.col("a")), a=BOARD) == "/n"
    assert value(spark, html.board_page(F.col("a")), a=None)["posts"] == []
    assert value(spark, html.has_post_image(F.col("a")), a=BOARD) is True


def test_table_page(spark):
    page = """<h2>Z</h2><table><tr><th>Autor</th></tr><tr><td><a href="/forum/uzytkownik,1">ala m</a></td><td>2020-01-31 08:05:09<br>x<br>y</td></tr>
    <tr><td>jan k<br>gość</td><td>bez daty</td></tr><tr><td></td><td> </td></tr><tr><td>a</td></tr></table>"""
    got = value(spark, html.table_page(F.col("a")), a=page)
    assert got["title"] == "Z"
    assert [(p["author"], p["date"], p["content"]) for p in got["posts"]] == [("ala m", "2020-01-31 08:05:09", "x\ny"), ("jan", "", "bez daty")]
    assert value(spark, html.table_page(F.col("a")), a="<table><tr><td>x</td></tr></table>")["posts"] == []


def test_problem_page(spark):
    page = """<body><b>Zadanie 7</b> Policz <math><mfrac><mn>1</mn><msup><mi>x</mi><mn>2</mn></msup></mfrac><mo>·</mo><mo>×</mo></math><hr>Rozwiązanie<br>tak<hr><a href="/8">Następne zadanie</a><img></body>"""
    got = value(spark, html.problem_fields(F.col("a")), a=page)
    assert got["title"] == "Zadanie 7" and got["contains_images"] and got["next_href"] == "/8"
    assert got["segments"][0] == "Zadanie 7\nPolicz\n$\\frac{1}{x^{2}} \\cdot  \\times $"
    assert got["segments"][1] == "Rozwiązanie\ntak"
    assert value(spark, html.problem_fields(F.col("a")), a="<p>x</p>")["segments"] == []


def test_links_sitemap_encoding(spark):
    assert value(spark, html.links(F.col("a")), a='<a class="x" href="/1">a</a><A HREF="/2">b</A>') == ["/1", "/2"]
    xml = '<urlset xmlns="http://www.sitemaps.example/s"><url><loc>https://x.example/viewforum.php?f=1</loc></url><url><loc>https://x.example/faq</loc></url></urlset>'
    assert value(spark, html.sitemap_locations(F.col("a")), a=xml) == ["https://x.example/viewforum.php?f=1"]
    assert spark.createDataFrame([(bytearray("ąść".encode("iso-8859-2")),)], "a binary").select(html.latin2(F.col("a"))).first()[0] == "ąść"
    assert value(spark, html.html_text(F.col("a")), a="<p>a<style>b</style></p><p>c</p>") == "a\nc"


def test_stamps(spark):
    t = F.to_timestamp(F.lit("2020-01-31T08:05:09+01:00"))
    assert value(spark, text.utc_stamp(t)) == "2020-01-31T07:05:09Z"
    assert len(value(spark, text.utc_stamp())) == 20
    assert value(spark, text.first_word(F.col("a")), a=" ala ma ") == "ala" and value(spark, text.first_word(F.col("a")), a=" ") == "unknown"


def test_links_in_any_quotes_and_folded_paths(spark):
    page = """<a class='x' href='/a?b=1&amp;c=2'>1</a><A HREF="../d">2</A><a href=e.html>3</a><abbr href="no">x</abbr><a rel='next' href='p,2'>next</a>"""
    df = spark.createDataFrame([(page,), ("<p>no link</p>",), (None,)], "page string")
    got = df.select(html.links(F.col("page")).alias("links"), html.next_page(F.col("page")).alias("next")).collect()
    assert got[0].links == ["/a?b=1&c=2", "../d", "e.html", "p,2"] and got[0].next == "p,2"
    assert got[1].links == [] and got[1].next is None and got[2].links is None
    cases = {"http://h.example/a/b/../c": "http://h.example/a/c", "http://h.example/a/./b/..": "http://h.example/a/", "http://h.example/../x?y=/../z": "http://h.example/x?y=/../z", "http://h.example": "http://h.example", "http://h.example/a/": "http://h.example/a/"}
    urls = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.f for r in urls.select("u", text.folded_path(F.col("u")).alias("f")).collect()} == cases
    asked = spark.createDataFrame([("https://h.example/zadanie-t77.html",), ("https://other.test/zadanie-t77.html",), ("https://h.example/t77",), (None,)], "u string")
    assert [r[0] for r in asked.select(text.is_thread_url(F.col("u"), "h.example")).collect()] == [True, False, False, False]
