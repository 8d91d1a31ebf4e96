"""Queries over the reference operators, each over whole tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions import html, latex, protocol, text
from siftwork.operators import dedup, metrics, ngrams, sampling, similarity, threads
from siftwork.operators.layout import dealt
from siftwork.plans import curation
from siftwork.schema import CATEGORIES
from siftwork.sources.readers import union_sources


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return dealt(_t(spark, d, "documents").select(*columns))


# SQL pieces ---------------------------------------------------------------

_SPACE = r"[\t-\r \x{85}\p{Z}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _tokens(x: str) -> str:
    return rf"list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[0-9]+([.][0-9]+)?', '0', 'g'), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' '), lambda w: w <> '')"


def _grams(w: str, n: int) -> str:
    return f"list_transform(range(1, len({w}) - {n - 2}), lambda i: array_to_string({w}[i:i + {n - 1}], ' '))"


def _overlap(q: str, s: str, n: int) -> str:
    return f"list_filter(list_transform(range(0, {n - 1}), lambda i: case when len({q}) >= {n - 1} - i and len({s}) >= i + 1 then array_to_string(list_concat({q}[len({q}) - {n - 2} + i:], {s}[1:i + 1]), ' ') end), lambda g: g is not null)"


def _index(n: int) -> str:
    return f"""named as (select 'benchmark' || coalesce('_task' || task_id, '_0') as task_name, {_tokens("task")} as q, {_tokens("solution")} as s from benchmark),
idx as (select distinct unnest(list_concat(list_concat({_grams("s", n)}, {_grams("q", n)}), {_overlap("q", "s", n)})) as gram, task_name from named)"""


def _hits(n: int) -> str:
    return f"""with {_index(n)}, tagged as (select gram, max(task_name) as task_name from idx group by gram),
w as (select doc_id, {_tokens("text")} as w from documents),
g as (select doc_id, unnest({_grams("w", n)}) as gram, unnest(range(0, len(w) - {n - 1})) as pos from w where len(w) >= {n}),
hits as (select doc_id, arg_min(task_name, pos) as contaminated_task, arg_min(g.gram, pos) as contaminated_ngram from g join tagged on g.gram = tagged.gram group by doc_id)"""


# decontamination ----------------------------------------------------------


def _contamination(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return ngrams.decontaminate(_docs(spark, d, "doc_id", "n_chars", "text"), ngrams.build_index(_t(spark, d, "benchmark")), "doc_id", F.col("text"))


def decontam_clean_docs(spark, d):
    return _contamination(spark, d)[0].select("doc_id", "n_chars")


def decontam_report(spark, d):
    return _contamination(spark, d)[1].select("doc_id", "contaminated_task", "contaminated_ngram")


def decontam_task_counts(spark, d):
    return decontam_report(spark, d).groupBy("contaminated_task").agg(F.count("*").alias("docs"), F.min("contaminated_ngram").alias("example"))


def benchmark_index(spark, d):
    return ngrams.build_index(_t(spark, d, "benchmark"))


def decontam_training_rows(spark, d):
    """Training rows by question and raw answer, as the pipeline's records have them."""
    rows = _t(spark, d, "pipeline_output").select("record_id", "question", "raw_answer").distinct()
    clean, _ = ngrams.decontaminate(rows, ngrams.build_index(_t(spark, d, "benchmark")), "record_id", text.build_text(F.col("question"), F.col("raw_answer")))
    return clean.select("record_id")


# deduplication ------------------------------------------------------------

_BANDS, _ROWS, _N = 14, 3, 3


def _signed(spark, d):
    return dedup.signatures(_docs(spark, d, "doc_id", "text"), "doc_id", F.col("text"), _BANDS, _ROWS, _N)


def minhash_signature(spark, d):
    return _signed(spark, d).select(F.col("id").alias("doc_id"), F.array_join(F.col("signature").cast("array<string>"), "-").alias("signature"))


def lsh_candidate_edges(spark, d):
    return dedup.candidate_edges(_signed(spark, d), _BANDS, _ROWS)


def dedup_clusters(spark, d):
    return dedup.clusters(_docs(spark, d, "doc_id", "text"), "doc_id", F.col("text"), _BANDS, _ROWS, _N)


def _deduped(spark, d):
    return dedup.deduplicate(_docs(spark, d, "doc_id", "n_chars", "text"), "doc_id", F.col("text"), _BANDS, _ROWS, _N)


def dedup_clean(spark, d):
    return _deduped(spark, d)[0].select("doc_id", "n_chars")


def dedup_removed(spark, d):
    return _deduped(spark, d)[1].select("doc_id", "duplicate_of")


def exact_dup_groups(spark, d):
    return _t(spark, d, "documents").where("text is not null").groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


def jaccard_best_match(spark, d):
    """Queries are the documents whose id 50 divides, against all others."""
    docs = _docs(spark, d, "doc_id", "text").where("text is not null")
    found = similarity.best_matches(docs.where("doc_id % 50 = 0"), docs, "doc_id", F.col("text"))
    return found.select("id", "best_id", F.round("score", 6).alias("score"))


_FAMILY = ", ".join(f"({s}, {a}, {b})" for s, (a, b) in enumerate(dedup.family(_BANDS * _ROWS)))
_SIGNED_SQL = rf"""w as (select doc_id, {_tokens("text")} as w from documents),
h as (select distinct doc_id, cast('0x' || substr(md5(g), 1, 8) as bigint) & 2147483647 as h from (select doc_id, unnest({_grams("w", _N)}) as g from w where len(w) >= {_N})),
f(seed, a, b) as (values {_FAMILY}),
m as (select doc_id, seed, min((a::bigint * h + b) % 2147483647) as v from h, f group by doc_id, seed)"""
_EDGES_SQL = f"""{_SIGNED_SQL}, bk as (select doc_id, seed // {_ROWS} as band, string_agg(v::varchar, '-' order by seed) as key from m group by doc_id, seed // {_ROWS}),
e as (select distinct least_id as a, doc_id as b from (select doc_id, min(doc_id) over (partition by band, key) as least_id from bk) where doc_id <> least_id)"""
_CLUSTERS_SQL = f"""{_EDGES_SQL}, both_ways as (select a, b from e union select b, a from e),
reach(id, other) as (select a, a from both_ways union select r.id, x.b from reach r join both_ways x on r.other = x.a),
cc as (select id, min(other) as component from reach group by id)"""


# text and LaTeX -----------------------------------------------------------


def latex_normalize(spark, d):
    rows = _t(spark, d, "pipeline_output").select("record_id", "question", "raw_answer").distinct()
    return rows.select("record_id", latex.normalize_latex(F.col("question")).alias("question"), latex.normalize_latex(F.col("raw_answer")).alias("raw_answer"))


def _latex_sql(x: str) -> str:
    y = f"replace(replace(replace({x}, chr(160), ' '), chr(8201), ' '), chr(8203), '')"
    y = rf"regexp_replace({y}, '(?s)\\\((.+?)\\\)', '$\1$', 'g')"
    y = rf"regexp_replace(replace({y}, '^{{}}', ''), '([_^])\{{\s+', '\1{{', 'g')"
    return rf"regexp_replace({y}, '(^|[^.\\])\.\.\.', '\1\\cdots', 'g')"


def build_texts(spark, d):
    rows = _t(spark, d, "pipeline_output").select("record_id", "question", "raw_answer").distinct()
    return rows.select("record_id", text.build_text(F.col("question"), F.col("raw_answer")).alias("text"))


def previews(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.substring("text", 1, 120).alias("preview"))


def navigation_lines(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(text.without_navigation(F.col("text"))).alias("digest"))


_NAVIGATION = "[" + ", ".join("'" + p + "'" for p in text.NAVIGATION) + "]"


def eval_prompts(spark, d):
    return _t(spark, d, "benchmark").select("task_id", metrics.prompt(F.col("task")).alias("prompt"), F.col("answer").alias("target"))


def answer_accuracy(spark, d):
    """Accuracy of the last formula of each item's solution against its answer, item by item."""
    rows = _t(spark, d, "benchmark")
    last = F.try_element_at(F.regexp_extract_all("solution", F.lit(r"\$([^$]+)\$"), F.lit(1)), F.lit(-1))
    return rows.select("task_id", metrics.answer_form(F.col("answer")).alias("gold"), metrics.answer_form(last).alias("predicted"), metrics.same_answer(F.col("answer"), last).alias("same"))


def _form(x: str) -> str:
    y = rf"regexp_replace(coalesce({x}, ''), '{_SPACE}+|\$|\\\(|\\\)|\\\[|\\\]|\\,|\\!|\\left|\\right', '', 'g')"
    y = rf"regexp_replace({y}, '^\\boxed\{{(.*)\}}$', '\1')"
    y = rf"regexp_replace({y}, '\\[dt]?frac\{{([^{{}}]*)\}}\{{([^{{}}]*)\}}', '\1/\2', 'g')"
    return rf"regexp_replace(regexp_replace({y}, '(\d),(\d+)$', '\1.\2'), '\.$', '')"


def _number(x: str) -> str:
    return rf"case when regexp_full_match({x}, '-?\d{{1,15}}(\.\d{{1,15}})?') then try_cast({x} as double) when regexp_full_match({x}, '-?\d{{1,15}}/\d{{1,15}}') then try_cast(split_part({x}, '/', 1) as double) / nullif(try_cast(split_part({x}, '/', 2) as double), 0) end"


# protocols ----------------------------------------------------------------


def _records(spark, d, *columns):
    return _t(spark, d, "pipeline_output").select("record_id", *columns).distinct()


def parse_decision(spark, d):
    raw = F.concat(F.lit("Thinking.\n"), F.when(F.col("kept").isNotNull(), F.concat(F.lit(" DECISION: "), F.when(F.col("kept"), "yes").otherwise("no"), F.lit("\n"))).otherwise(""), F.lit("REASON:"), F.coalesce("filter_reason", F.lit("")))
    rows = _records(spark, d, "kept", "filter_reason").withColumn("raw", raw)
    return rows.select("record_id", protocol.decision(F.col("raw")).alias("keep"), protocol.reason(F.col("raw")).alias("reason"))


def parse_category(spark, d):
    raw = F.concat(F.lit("CATEGORY: other\nREASON: first\n  CATEGORY: "), F.lower(F.coalesce("category", F.lit("none"))), F.lit("\nREASON: "), F.coalesce("category_reason", F.lit("")))
    rows = _records(spark, d, "category", "category_reason").withColumn("raw", raw)
    return rows.select("record_id", protocol.category(F.col("raw")).alias("category"), protocol.reason(F.col("raw")).alias("reason"))


def parse_post_index(spark, d):
    raw = F.when(F.col("answer_post_index").isNull(), "NO_ANSWER").otherwise(F.concat(F.lit("POST_INDEX: x\nPOST_INDEX:  "), F.col("answer_post_index").cast("string"), F.lit(" \n POST_INDEX: 99")))
    return _records(spark, d, "answer_post_index").select("record_id", protocol.post_index(raw).alias("post_index"))


# threads ------------------------------------------------------------------


def _threads(spark, d):
    return _t(spark, d, "forum_example_fixed").dropDuplicates(["thread_id"])


def thread_assembly(spark, d):
    posts = _threads(spark, d).select("thread_id", "url", F.posexplode("posts").alias("pos", "p")).select("thread_id", "url", "pos", "p.author", "p.content")
    whole = threads.assemble(posts, ["thread_id", "url"], ["pos"], ["author", "content"])
    return whole.select("thread_id", F.size("posts").cast("bigint").alias("n_posts"), F.array_join(F.transform("posts", lambda p: F.concat(p["index"].cast("string"), F.lit(":"), F.coalesce(p["author"], F.lit("")))), "|").alias("authors"))


def thread_totals(spark, d):
    return threads.totals(_threads(spark, d), ["source"])


def thread_titles(spark, d):
    """Titles, with the thread's number where there is none, and whether the address is a thread's of the host that most threads have."""
    return _threads(spark, d).select("thread_id", threads.titled(F.col("title"), F.col("thread_id")).alias("title"), text.is_thread_url(F.col("url"), ".example").alias("by_page"))


def thread_prompts(spark, d):
    line = lambda p: F.concat(F.lit("#"), p["index"].cast("string"), F.lit(" "), p["author"], F.lit(": "), p["text"])
    return _threads(spark, d).select("thread_id", F.md5(F.array_join(F.transform(threads.brief(F.col("posts"), 500), line), "\n")).alias("digest"))


def relevant_posts(spark, d):
    near = threads.relevant(F.col("posts"), F.array(F.lit(0), F.lit(2)))
    return _threads(spark, d).select("thread_id", F.size(near).cast("bigint").alias("near"), threads.any_images(near).alias("images"), threads.post_content(F.col("posts"), F.lit(1)).alias("answer"))


def post_dates(spark, d):
    return _threads(spark, d).select("thread_id", F.explode("posts").alias("p")).select("thread_id", F.col("p.index").alias("post_index"), text.forum_date(F.col("p.date")).alias("date"))


def post_images(spark, d):
    return _threads(spark, d).select("thread_id", F.explode("posts").alias("p")).select("thread_id", F.col("p.index").alias("post_index"), text.has_image_link(F.col("p.content")).alias("links_image"))


def url_canonical(spark, d):
    urls = _t(spark, d, "pipeline_output").where("source_url is not null").select(text.canonical_url(F.col("source_url")).alias("url")).distinct()
    done = _t(spark, d, "forum_example_fixed").select(text.canonical_url(F.col("url")).alias("url"))
    return threads.not_done(urls, done)


def id_range_missing(spark, d):
    """Per source: the ids up to the last thread of all sources that the source has not given a thread for."""
    have = _t(spark, d, "forum_example_fixed").where("source is not null").select("source", F.col("thread_id").alias("id")).distinct()
    last = have.agg(F.max("id")).first()[0]
    # the sources are few, as the sites that are crawled
    sources = sorted(r["source"] for r in have.select("source").distinct().collect())
    grid = threads.id_range(spark, 1, last or 0, "https://pages.example/temat,%d").withColumn("source", F.explode(F.array(*map(F.lit, sources)) if sources else F.array().cast("array<string>")))
    return grid.join(have, ["source", "id"], "left_anti").select("source", "id", "url")


def consecutive_misses(spark, d):
    """Per source: the ids from its first thread on, up to five in a row that no thread has."""
    have = _t(spark, d, "forum_example_fixed").select("source", "thread_id").distinct()
    span = have.groupBy("source").agg(F.min("thread_id").alias("a"), F.max("thread_id").alias("b"))
    grid = threads.id_grid(span, "a", "b", "thread_id").select("source", "thread_id").join(have.withColumn("hit", F.lit(True)), ["source", "thread_id"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return threads.until_misses(grid, "source", "thread_id", "hit", 5).select("source", "thread_id", "hit")


def board_pages(spark, d):
    """Threads written as board pages and read again: posts, authors and image flags come back."""
    escape = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    post = lambda p: F.concat(F.lit('<div class="post"><a class="username">'), escape(p["author"]), F.lit('</a><time datetime="'), F.coalesce(p["date"], F.lit("")), F.lit('">t</time><div class="content">'), escape(p["content"]), F.when(F.coalesce(p["contains_images"], F.lit(False)), '<img class="postimage" src="x">').otherwise(""), F.lit("</div></div>"))
    page = F.concat(F.lit('<html><body><h2 class="topic-title">'), escape(F.col("title")), F.lit("</h2>"), F.array_join(F.transform("posts", post), ""), F.lit("</body></html>"))
    read = _threads(spark, d).select("thread_id", html.board_page(page).alias("page"))
    return read.select("thread_id", F.size("page.posts").cast("bigint").alias("n_posts"), F.array_join(F.transform("page.posts", lambda p: p["author"]), "|").alias("authors"), F.size(F.filter("page.posts", lambda p: p["contains_images"])).cast("bigint").alias("images"))


def curated_records(spark, d):
    full = curation.curate(_threads(spark, d), "thread_id")
    return full.select("thread_id", "task_idx", "status", "category", "answer_post_index", F.md5(F.coalesce("solution", F.lit(""))).alias("solution_digest"))


def _as_logged(spark, d):
    """The pipeline's records with the status that their fields tell."""
    rows = _records(spark, d, "source_url", "question", "kept", "category", "raw_answer", "solution")
    status = F.when(F.col("kept").isNull(), "error").when(~F.col("kept"), "discarded").when(~F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False)), "no_category").when(F.col("raw_answer").isNull(), "no_answer").when(F.col("solution").isNull(), "error").otherwise("kept")
    return rows.withColumn("status", status).withColumn("task_idx", F.lit(0)).withColumn("split_parsed", F.col("question").isNotNull())


def stage_stats(spark, d):
    return curation.statistics(_as_logged(spark, d), "record_id")


def clean_projection(spark, d):
    return curation.clean_records(_as_logged(spark, d)).distinct()


def accuracy_mean(spark, d):
    """Share of items whose solution ends in the right answer: answers and last formulas as two sides, joined by key."""
    rows = _t(spark, d, "benchmark")
    last = F.try_element_at(F.regexp_extract_all("solution", F.lit(r"\$([^$]+)\$"), F.lit(1)), F.lit(-1))
    return metrics.accuracy(rows.select("task_id", "answer").join(rows.select("task_id", last.alias("predicted")), "task_id"), "answer", "predicted")


def display_blocks(spark, d):
    """Questions put between display markers, and read again by the rules."""
    shown = F.concat(F.lit("Niech \\(\\displaystyle{ "), "record_id", F.lit(" + x_{1} }\\) oraz "), F.replace(F.coalesce("question", F.lit("")), F.lit("{"), F.lit("(")))
    rows = _t(spark, d, "pipeline_output").select("record_id", shown.alias("text")).distinct()
    return rows.select("record_id", F.md5(latex.normalize_latex(F.col("text"))).alias("digest"))


def json_records(spark, d):
    rows = _t(spark, d, "benchmark")
    return rows.select("task_id", text.json_line(F.col("task_id"), F.col("type")).alias("line"))


def category_ids(spark, d):
    """Every forum category with its label, its highest known id and how many threads' ids lie in its range."""
    from siftwork.sources.dimensions import CATEGORIES as FORUM

    known = F.array(*[F.struct(F.lit(c).alias("category"), F.lit(label).alias("label"), F.lit(top).cast("bigint").alias("max_id")) for c, label, top in FORUM])
    ids = _t(spark, d, "forum_example_fixed").select("thread_id").distinct()
    inside = ids.select(F.explode(F.filter(known, lambda c: c["max_id"] >= F.col("thread_id"))).alias("c"))
    return inside.groupBy("c.category", "c.label", "c.max_id").agg(F.count("*").alias("threads"))


# pieces of pages and answers -----------------------------------------------


def solution_split(spark, d):
    """Records written as one page, cut again into problem and solution."""
    page = F.concat(F.coalesce("question", F.lit("")), F.lit("\nRozwiązanie  \n"), F.coalesce("solution", F.lit("")))
    problem, solution = text.split_solution(F.col("page"))
    return _records(spark, d, "question", "solution").select("record_id", page.alias("page")).select("record_id", F.md5(problem).alias("problem"), F.md5(solution).alias("solution"))


def author_words(spark, d):
    return _threads(spark, d).select("thread_id", F.posexplode("posts").alias("pos", "p")).select("thread_id", "pos", text.first_word(F.col("p.author")).alias("author"))


def squeezed_texts(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(text.squeeze_blank_lines(F.replace("text", F.lit("\n"), F.lit("\n\n\n")))).alias("digest"))


_HREFS = ("../up/../x.html", "/root,%s?a=1", "?start=15", "#p7", "beside.html", "https://other.example/y", "//cdn.example/z")


def absolute_urls(spark, d):
    """Addresses of every form against each thread's own."""
    rows = _t(spark, d, "forum_example_fixed").where("url rlike '^https?://[^/]+/[^?#]*$'").select("url").distinct().select("url", F.posexplode(F.array(*map(F.lit, _HREFS))).alias("form", "href"))
    return rows.select("url", "form", text.folded_path(text.absolute_url(F.col("url"), F.col("href"))).alias("target"))


def shares_in_percent(spark, d):
    counted = _t(spark, d, "documents").groupBy("source").agg(F.count("lang").alias("n"), F.count("*").alias("of"))
    return counted.select("source", text.percent(F.col("n") / F.col("of")).alias("with_lang"))


def utc_stamps(spark, d):
    return _t(spark, d, "documents").select("doc_id", text.utc_stamp(F.timestamp_seconds(F.lit(1_500_000_000) + F.col("doc_id") * 86_399)).alias("stamp"))


def posts_across_pages(spark, d):
    """Posts cut into pages of two, numbered over all pages of their thread."""
    posts = _threads(spark, d).select("thread_id", F.posexplode("posts").alias("pos", "p"))
    pages = posts.groupBy("thread_id", F.floor(F.col("pos") / 2).alias("page")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("p.author").alias("author")))), lambda x: x["author"]).alias("posts"))
    return threads.across_pages(pages, "thread_id", "page", "posts").select("thread_id", "index", F.col("post").alias("author"))


def batch_numbers(spark, d):
    return threads.batches(_t(spark, d, "documents").select("doc_id"), ["doc_id"], 100).select("doc_id", "batch")


def problem_threads(spark, d):
    """The benchmark as threads of two posts."""
    made = threads.problem_thread(F.lit("bench"), F.concat(F.lit("https://bench.example/"), "task_id"), F.col("type"), F.concat(F.lit("Zadanie "), "task_id"), F.col("task"), F.col("solution"), F.lit(False), F.lit(None).cast("string"))
    return _t(spark, d, "benchmark").select("task_id", made.alias("t")).select("task_id", "t.url", "t.title", F.size("t.posts").alias("n"), F.get("t.posts", F.lit(0))["content"].alias("first"), F.get("t.posts", F.lit(1))["content"].alias("second"))


def task_lists(spark, d):
    """Answers of a model to the split: a JSON list in a fence for records that were kept, prose for the others, which become one task of the whole thread."""
    listed = F.concat(F.lit("```json\n"), F.to_json(F.array(F.struct(F.col("question").alias("question"), F.array(F.lit(0), F.lit(2)).alias("post_indices")), F.struct(F.lit("druga").alias("question"), F.array(F.lit(1)).alias("post_indices")))), F.lit("\n```"))
    rows = _records(spark, d, "question", "kept", "source_title").where("question is not null").withColumn("raw", F.when(F.col("kept"), listed).otherwise("One problem: [0]"))
    posts = F.array(*[F.struct(F.lit(i).alias("index"), F.concat(F.lit("post "), "record_id").alias("content")) for i in range(3)])
    tasks = rows.select("record_id", F.posexplode(protocol.tasks(F.col("raw"), posts, F.coalesce("source_title", F.lit("")))).alias("task_idx", "t"), protocol.is_task_list(F.col("raw")).alias("parsed"))
    return tasks.select("record_id", "task_idx", "parsed", F.md5("t.question").alias("question"), F.array_join(F.col("t.post_indices").cast("array<string>"), ",").alias("indices"))


def repaired_lines(spark, d):
    """JSON lines whose LaTeX commands are no escapes."""
    line = F.concat(F.lit('{"q":"\\alpha_'), "doc_id", F.lit(' \\cdot \\\\ \\"x\\" \\u0041"}'))
    return _t(spark, d, "documents").select("doc_id", F.from_json(latex.repair_json_escapes(line), "q string")["q"].alias("q"))


def flat_keys(spark, d):
    """Documents' marks as maps, whose keys differ by row, made columns again."""
    marks = F.map_filter(F.create_map(F.lit("lang"), F.col("lang"), F.lit("title"), F.col("title"), F.lit("_source_path"), F.lit("p")), lambda k, v: v.isNotNull())
    return threads.flat_metadata(_t(spark, d, "documents").select("doc_id", marks.alias("meta")), "meta")


def dated_cells(spark, d):
    """Posts written as cells under their date, cut into both again."""
    posts = _threads(spark, d).select("thread_id", F.posexplode("posts").alias("pos", "p"))
    date, rest = text.date_headed(F.col("cell"))
    cells = posts.select("thread_id", "pos", F.concat(F.coalesce("p.date", F.lit("")), F.lit("\n\n"), F.coalesce("p.content", F.lit(""))).alias("cell"))
    return cells.select("thread_id", "pos", date.alias("date"), F.md5(rest).alias("rest"))


def sitemaps(spark, d):
    """Boards in a sitemap that has a thread and a board for each thread."""
    loc = lambda u: F.concat(F.lit("<url><loc>"), u, F.lit("</loc></url>"))
    board = F.concat(F.lit("https://board.example/viewforum.php?f="), F.col("thread_id"))
    xml = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), loc(F.concat(F.lit("https://board.example/t"), F.col("thread_id"))), loc(board), F.lit("</urlset>"))
    return _threads(spark, d).select("thread_id", F.array_join(html.sitemap_locations(xml), " ").alias("boards"))


def page_links(spark, d):
    """Links, next page, page numbers and image flags of list pages written for each thread."""
    n = F.col("thread_id")
    page = F.concat(F.lit("<ul><li><A class='t' href='/t"), n, F.lit("?a=1&amp;b=2'>x</A></li><li><a href=\"board,7,"), n % 9, F.lit('">y</a></li></ul>'), F.when(n % 2 == 0, F.concat(F.lit('<a rel="next" href="/list?p='), n, F.lit('">next</a><img class="postimage" src="i.png">'))).otherwise(F.lit("<img src='logo.png'>")))
    rows = _threads(spark, d).select("thread_id", page.alias("page")).select("thread_id", html.links(F.col("page")).alias("links"), html.next_page(F.col("page")).alias("next"), html.has_post_image(F.col("page")).alias("image"))
    return rows.select("thread_id", F.array_join("links", " ").alias("links"), "next", "image", text.max_page(F.col("links"), F.lit(5)).alias("beyond_five"))


def visible_texts(spark, d):
    """Records as pages, read again without markup."""
    page = F.concat(F.lit("<html><head><title>no</title><style>p {}</style></head><body><h1>Zadanie "), "record_id", F.lit("</h1><script>var no;</script><p>a &lt; b &amp;amp; <b>c"), "record_id", F.lit("</b></p></body></html>"))
    return _t(spark, d, "pipeline_output").select("record_id").distinct().select("record_id", F.regexp_replace(html.html_text(page), r"\s+", " ").alias("text"))


# samples and unions -------------------------------------------------------


def train_val_split(spark, d):
    return sampling.exact_split(_t(spark, d, "documents").select("doc_id"), "doc_id", fraction=0.1).select("doc_id", "split")


def sft_samples(spark, d):
    rows = _t(spark, d, "pipeline_output").where("kept and question is not null and solution is not null").select("record_id", "question", "solution").distinct()
    split = sampling.exact_split(rows, "record_id", size=1000)
    return split.select("record_id", "split", F.md5(sampling.rendered_chat(sampling.chat(F.col("question"), F.col("solution")))).alias("digest"))


def source_union_counts(spark, d):
    frames = [_t(spark, d, "documents").select("source", "lang", F.lit("documents").alias("_source_path")), _t(spark, d, "forum_example_fixed").select("source", "title", F.lit("forum").alias("_source_path"))]
    return union_sources(frames).groupBy("_source_path", "source").agg(F.count("*").alias("rows"), F.count("lang").alias("with_lang"), F.count("title").alias("with_title"))


def source_heads(spark, d):
    rows = _t(spark, d, "documents").where("source is not null").select("source", "doc_id")
    return sampling.head_per_source(rows, "source", ["doc_id"], 3)


QUERIES = {
    f.__name__: f
    for f in (
        decontam_clean_docs, decontam_report, decontam_task_counts, benchmark_index, decontam_training_rows, minhash_signature, lsh_candidate_edges, dedup_clusters, dedup_clean, dedup_removed,
        exact_dup_groups, jaccard_best_match, latex_normalize, build_texts, previews, navigation_lines, eval_prompts, answer_accuracy, parse_decision, parse_category, parse_post_index,
        thread_assembly, thread_totals, thread_titles, thread_prompts, relevant_posts, post_dates, post_images, url_canonical, id_range_missing, consecutive_misses, board_pages, curated_records, stage_stats,
        solution_split, author_words, squeezed_texts, absolute_urls, shares_in_percent, utc_stamps, posts_across_pages, batch_numbers, problem_threads, task_lists, repaired_lines, flat_keys, dated_cells, sitemaps, page_links, visible_texts,
        clean_projection, accuracy_mean, display_blocks, json_records, category_ids, train_val_split, sft_samples, source_union_counts, source_heads,
    )
}

_FORUM = "t as (select * from (select *, row_number() over (partition by thread_id) as rn from forum_example_fixed) where rn = 1)"
_EXACT = "('EXACT_VALUE', 'EXPRESSION', 'PROOF', 'COMPLEX')"

_LAST_FORMULA = r"regexp_extract_all(solution, '\$([^$]+)\$', 1)[-1]"

_LOGGED = f"""with l as (select *, case when kept is null then 'error' when not kept then 'discarded' when not coalesce(category in {_EXACT}, false) then 'no_category' when raw_answer is null then 'no_answer' when solution is null then 'error' else 'kept' end as status
from (select distinct record_id, source_url, question, kept, category, raw_answer, solution from pipeline_output))"""


def _curated_sql() -> str:
    verbs = " or ".join(f"contains(low, '{w}')" for w in ("wykaż", "udowodnij", "uzasadnij", "prove"))
    finds = " or ".join(f"contains(low, '{w}')" for w in ("wyznacz", "uprość", "zapisz", "find"))
    return f"""with {_FORUM}, a as (select thread_id, coalesce(title, '') as title, list_transform(coalesce(posts, []), lambda p: {{'i': p.index, 'image': coalesce(p.contains_images, false), 'c': {_latex_sql("coalesce(p.content, '')")}}}) as ps from t),
q as (select *, list_filter(ps, lambda p: p.i between 0 and len(ps) - 1) as near, {_latex_sql("case when len(ps) > 0 then ps[1].c else title end")} as question from a),
g as (select *, length(substr(question, 1, 1000)) > 50 and len(list_filter(near, lambda p: p.image)) = 0 as kept, lower(substr({_strip("question")}, 1, 1000)) as low, list_filter(near, lambda p: p.i <> 0 and p.c <> '') as others from q),
k as (select *, case when {verbs} then 'PROOF' when {finds} then 'EXPRESSION' else 'EXACT_VALUE' end as kind, list_filter(others, lambda p: length(substr(p.c, 1, 800)) = list_max(list_transform(others, lambda o: length(substr(o.c, 1, 800)))))[1].i as best from g),
s as (select *, {_strip(f"substr({_strip('list_filter(ps, lambda p: p.i = best)[-1].c')}, 1, 2000)")} as solution from k)
select thread_id, 0 as task_idx, case when not kept then 'discarded' when best is null then 'no_answer' when solution = '' then 'error' else 'kept' end as status, case when kept then kind end as category,
case when kept then best end as answer_post_index, md5(case when kept and best is not null and solution <> '' then solution else '' end) as solution_digest from s"""


_SPLIT_SQL = rf"""with r as (select distinct record_id, question, solution from pipeline_output), p as (select record_id, coalesce(question, '') || chr(10) || 'Rozwiązanie  ' || chr(10) || coalesce(solution, '') as page from r),
h as (select record_id, regexp_extract(page, '(?ims)^(.*?)^Rozwi[ąa]zanie\s*$(.*)', ['a', 'b']) as g from p), x as (select record_id, {_strip("g.a")} as a, {_strip("g.b")} as b from h),
y as (select *, regexp_extract(a, '(?s)^(.*?)(\bOdpp?[.:].*)$', ['before', 'answer']) as o from x)
select record_id, md5(case when o.answer <> '' then {_strip("o.before")} else a end) as problem, md5(case when o.answer = '' then b when b = '' then {_strip("o.answer")} else {_strip("o.answer")} || chr(10) || b end) as solution from y"""


ORACLE = {
    "solution_split": _SPLIT_SQL,
    "dated_cells": rf"""with {_FORUM}, p as (select thread_id, unnest(posts) as p, unnest(range(len(posts)))::int as pos from t), c as (select thread_id, pos, {_strip("coalesce(p.date, '') || chr(10) || chr(10) || coalesce(p.content, '')")} as cell from p),
l as (select thread_id, pos, string_split(cell, chr(10)) as lines from c), f as (select *, {_strip("lines[1]")} as head from l), g as (select *, regexp_matches(head, '^\d{{4}}-\d{{2}}-\d{{2}}\s+\d{{2}}:\d{{2}}:\d{{2}}') as dated from f)
select thread_id, pos, case when not dated then '' when regexp_full_match(head, '\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}:\d{{2}}') and try_cast(head as timestamp) is not null then replace(head, ' ', 'T') || '+00:00' else head end as date,
md5(regexp_replace({_strip("array_to_string(case when dated then lines[2:] else lines end, chr(10))")}, '\n{{3,}}', chr(10) || chr(10), 'g')) as rest from g""",
    "sitemaps": f"with {_FORUM} select thread_id, 'https://board.example/viewforum.php?f=' || thread_id as boards from t",
    "page_links": f"""with {_FORUM} select thread_id, '/t' || thread_id || '?a=1&b=2 board,7,' || thread_id % 9 || case when thread_id % 2 = 0 then ' /list?p=' || thread_id else '' end as links, case when thread_id % 2 = 0 then '/list?p=' || thread_id end as next, thread_id % 2 = 0 as image, thread_id % 9 > 5 as beyond_five from t""",
    "visible_texts": "select distinct record_id, 'no Zadanie ' || record_id || ' a < b &amp; c' || record_id as text from pipeline_output",
    "author_words": rf"with {_FORUM}, p as (select thread_id, unnest(posts) as p, unnest(range(len(posts)))::int as pos from t) select thread_id, pos, coalesce(nullif(string_split_regex({_strip('p.author')}, '{_SPACE}+')[1], ''), 'unknown') as author from p",
    "squeezed_texts": r"select doc_id, md5(regexp_replace(replace(text, chr(10), repeat(chr(10), 3)), '\n{3,}', chr(10) || chr(10), 'g')) as digest from documents",
    "absolute_urls": r"""with u as (select distinct url from forum_example_fixed where regexp_matches(url, '^https?://[^/]+/[^?#]*$')), b as (select url, regexp_extract(url, '^https?://[^/]+') as root, regexp_replace(url, '[^/]*$', '') as folder, regexp_extract(url, '^https?:') as scheme from u),
f as (select *, regexp_replace(folder, '[^/]+/$', '') as above from b)
select url, form, case form when 0 then case when length(above) > length(root) then above else root || '/' end || 'x.html' when 1 then root || '/root,%s?a=1' when 2 then url || '?start=15' when 3 then url || '#p7' when 4 then folder || 'beside.html' when 5 then 'https://other.example/y' else scheme || '//cdn.example/z' end as target
from f, (select unnest(range(7))::int as form)""",
    "shares_in_percent": "select source, round(100.0 * count(lang) / count(*))::int || '%' as with_lang from documents group by source",
    "utc_stamps": "select doc_id, strftime(make_timestamp((1500000000 + doc_id * 86399) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as stamp from documents",
    "posts_across_pages": f"with {_FORUM} select thread_id, unnest(range(len(posts)))::int as index, unnest(list_transform(posts, lambda p: p.author)) as author from t",
    "batch_numbers": "select doc_id, (row_number() over (order by doc_id) - 1) // 100 as batch from documents",
    "problem_threads": "select task_id, 'https://bench.example/' || task_id as url, concat_ws(' – ', type, 'Zadanie ' || task_id) as title, 2 as n, task as first, solution as second from benchmark",
    "task_lists": """with r as (select distinct record_id, question, kept from pipeline_output where question is not null)
select record_id, 0 as task_idx, coalesce(kept, false) as parsed, md5(case when kept then question else 'post ' || record_id end) as question, case when kept then '0,2' else '0,1,2' end as indices from r
union all select record_id, 1, true, md5('druga'), '1' from r where kept""",
    "repaired_lines": r"""select doc_id, '\alpha_' || doc_id || ' \cdot \ "x" A' as q from documents""",
    "flat_keys": "select doc_id, lang, title from documents",
    "decontam_clean_docs": f"{_hits(9)} select doc_id, n_chars from documents where doc_id not in (select doc_id from hits)",
    "decontam_report": f"{_hits(9)} select doc_id, contaminated_task, contaminated_ngram from hits",
    "decontam_task_counts": f"{_hits(9)} select contaminated_task, count(*) as docs, min(contaminated_ngram) as example from hits group by contaminated_task",
    "benchmark_index": f"with {_index(9)} select gram, task_name from idx",
    "decontam_training_rows": f"""with {_index(9)}, r as (select distinct record_id, question, raw_answer from pipeline_output),
w as (select record_id, {_tokens("coalesce(question, '') || ' ' || coalesce(raw_answer, '')")} as w from r), g as (select record_id, unnest({_grams("w", 9)}) as gram from w where len(w) >= 9)
select record_id from r where record_id not in (select record_id from g where gram in (select gram from idx))""",
    "minhash_signature": f"with {_SIGNED_SQL} select doc_id, string_agg(v::varchar, '-' order by seed) as signature from m group by doc_id",
    "lsh_candidate_edges": f"with {_EDGES_SQL} select a, b from e",
    "dedup_clusters": f"with recursive {_CLUSTERS_SQL} select id, component from cc",
    "dedup_clean": f"with recursive {_CLUSTERS_SQL} select doc_id, n_chars from documents where doc_id not in (select id from cc where id <> component)",
    "dedup_removed": f"with recursive {_CLUSTERS_SQL} select id as doc_id, component as duplicate_of from cc where id <> component",
    "exact_dup_groups": "select md5(text) as digest, count(*) as copies, min(doc_id) as first_id from documents where text is not null group by md5(text) having count(*) > 1",
    "jaccard_best_match": rf"""with w as (select doc_id, list_filter(string_split(regexp_replace(lower(text), '{_SPACE}+', ' ', 'g'), ' '), lambda x: x <> '') as w from documents where text is not null),
g as (select doc_id, gram, count(*) as n from (select doc_id, unnest({_grams("w", 3)}) as gram from w where len(w) >= 3) group by doc_id, gram), z as (select doc_id, sum(n) as total from g group by doc_id),
s as (select q.doc_id as id, k.doc_id as kid, sum(least(q.n, k.n)) as b from g q join g k on q.gram = k.gram where q.doc_id % 50 = 0 and k.doc_id <> q.doc_id group by q.doc_id, k.doc_id),
r as (select id, kid, (b / (zq.total + zk.total - b))::double as score from s join z zq on zq.doc_id = id join z zk on zk.doc_id = kid),
best as (select id, kid, score from (select *, row_number() over (partition by id order by score desc, kid) as k from r) where k = 1)
select w.doc_id as id, kid as best_id, round(coalesce(score, 0.0), 6) as score from w left join best on best.id = w.doc_id where w.doc_id % 50 = 0""",
    "latex_normalize": f"select record_id, {_latex_sql('question')} as question, {_latex_sql('raw_answer')} as raw_answer from (select distinct record_id, question, raw_answer from pipeline_output)",
    "build_texts": f"select record_id, {_strip("coalesce(question, '') || ' ' || coalesce(raw_answer, '')")} as text from (select distinct record_id, question, raw_answer from pipeline_output)",
    "previews": "select doc_id, substr(text, 1, 120) as preview from documents",
    "navigation_lines": rf"""select doc_id, md5(array_to_string(list_filter(list_transform(string_split_regex(coalesce(text, ''), '\r\n|\r|\n'), lambda x: {_strip("x")}), lambda x: x <> '' and len(list_filter({_NAVIGATION}, lambda p: contains(lower(x), p))) = 0), chr(10))) as digest from documents""",
    "eval_prompts": "select task_id, '" + metrics.PROMPT.replace("\n", "' || chr(10) || '") + "' || coalesce(task, '') as prompt, answer as target from benchmark",
    "answer_accuracy": rf"""with a as (select task_id, {_form("answer")} as gold, {_form(_LAST_FORMULA)} as predicted from benchmark), v as (select *, {_number("gold")} as x, {_number("predicted")} as y from a)
select task_id, gold, predicted, gold <> '' and (gold = predicted or coalesce(abs(x - y) <= 1e-9 * greatest(1.0, abs(x)), false)) as same from v""",
    "parse_decision": rf"select record_id, coalesce(kept, true) as keep, {_strip("coalesce(filter_reason, '')")} as reason from (select distinct record_id, kept, filter_reason from pipeline_output)",
    "parse_category": f"select record_id, case when category in {_EXACT} then category end as category, {_strip("coalesce(category_reason, '')")} as reason from (select distinct record_id, category, category_reason from pipeline_output)",
    "parse_post_index": "select record_id, answer_post_index::int as post_index from (select distinct record_id, answer_post_index from pipeline_output)",
    "thread_assembly": f"with {_FORUM} select thread_id, len(posts) as n_posts, array_to_string(list_transform(range(1, len(posts) + 1), lambda i: (i - 1)::varchar || ':' || coalesce(posts[i].author, '')), '|') as authors from t where len(posts) > 0",
    "thread_totals": f"with {_FORUM} select source, count(*) as threads, coalesce(sum(len(coalesce(posts, []))), 0)::bigint as posts from t group by source",
    "thread_titles": rf"with {_FORUM} select thread_id, coalesce(nullif(trim(title), ''), 'Zadanie nr ' || thread_id) as title, coalesce(regexp_matches(url, '-t\d+\.html') and contains(url, '.example'), false) as by_page from t",
    "thread_prompts": f"with {_FORUM} select thread_id, md5(array_to_string(list_transform(posts, lambda p: '#' || p.index || ' ' || coalesce(p.author, '') || ': ' || substr(coalesce(p.content, ''), 1, 500)), chr(10))) as digest from t",
    "relevant_posts": f"""with {_FORUM} select thread_id, len(list_filter(posts, lambda p: p.index in (0, 2))) as near, coalesce(list_bool_or(list_transform(list_filter(posts, lambda p: p.index in (0, 2)), lambda p: coalesce(p.contains_images, false))), false) as images,
list_filter(posts, lambda p: p.index = 1)[-1].content as answer from t""",
    "post_dates": rf"""with {_FORUM}, p as (select thread_id, unnest(posts) as p from t), r as (select thread_id, p.index as post_index, {_strip("p.date")} as raw from p)
select thread_id, post_index, case when regexp_full_match(raw, '\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}(:\d{{2}})?') and try_cast(case when length(raw) = 16 then raw || ':00' else raw end as timestamp) is not null
then substr(raw, 1, 10) || 'T' || substr(raw, 12, 5) || case when length(raw) = 19 then substr(raw, 17, 3) else ':00' end || '+00:00' else raw end as date from r""",
    "post_images": rf"with {_FORUM}, p as (select thread_id, unnest(posts) as p from t) select thread_id, p.index as post_index, coalesce(regexp_matches(p.content, '(?i)https?://\S+\.(jpg|jpeg|png|gif|webp)'), false) as links_image from p",
    "url_canonical": "select distinct split_part(split_part(source_url, '?', 1), '#', 1) as url from pipeline_output where source_url is not null and split_part(split_part(source_url, '?', 1), '#', 1) not in (select split_part(split_part(url, '?', 1), '#', 1) from forum_example_fixed where url is not null)",
    "id_range_missing": """with h as (select distinct source, thread_id from forum_example_fixed where source is not null), r as (select unnest(range(1, (select max(thread_id) from h) + 1)) as id)
select s.source, r.id, 'https://pages.example/temat,' || r.id as url from (select distinct source from h) s cross join r where not exists (select 1 from h where h.source = s.source and h.thread_id = r.id)""",
    "consecutive_misses": """with h as (select distinct source, thread_id from forum_example_fixed), s as (select source, min(thread_id) as a, max(thread_id) as b from h group by source),
g as (select source, unnest(range(a, b + 1)) as thread_id from s), x as (select g.source, g.thread_id, h.thread_id is not null as hit from g left join h on h.source = g.source and h.thread_id = g.thread_id),
i as (select *, sum(hit::int) over (partition by source order by thread_id) as island from x), r as (select *, sum((not hit)::int) over (partition by source, island order by thread_id) as run from i),
e as (select source, min(thread_id) as stop_id from r where run >= 5 group by source) select r.source, r.thread_id, r.hit from r left join e on e.source = r.source where stop_id is null or r.thread_id <= stop_id""",
    "board_pages": f"with {_FORUM} select thread_id, len(posts) as n_posts, array_to_string(list_transform(posts, lambda p: coalesce(p.author, '')), '|') as authors, len(list_filter(posts, lambda p: coalesce(p.contains_images, false))) as images from t",
    "curated_records": _curated_sql(),
    "stage_stats": f"""{_LOGGED} select count(distinct record_id) as threads, count(*) as tasks, count(*) filter (where status = 'kept') as kept, count(*) filter (where status in ('discarded', 'no_category', 'no_answer')) as filtered_out,
count(*) filter (where status = 'no_category') as classification_errors, count(distinct record_id) filter (where question is null) as parse_errors, count(*) filter (where status = 'error') as errors from l""",
    "clean_projection": f"{_LOGGED} select distinct source_url, question, category, solution from l where status = 'kept'",
    "accuracy_mean": rf"""with a as (select {_form("answer")} as gold, {_form(_LAST_FORMULA)} as predicted from benchmark), v as (select *, {_number("gold")} as x, {_number("predicted")} as y from a)
select count(*) as n, coalesce(avg((gold <> '' and coalesce(gold = predicted or coalesce(abs(x - y) <= 1e-9 * greatest(1.0, abs(x)), false), false))::int), 0.0) as accuracy from v""",
    "display_blocks": rf"""select record_id, md5({_latex_sql("'Niech ' || '\\[' || chr(10) || record_id || ' + x_{1}' || chr(10) || '\\]' || ' oraz ' || replace(coalesce(question, ''), '{', '(')")}) as digest from (select distinct record_id, question from pipeline_output)""",
    "json_records": """select task_id, '{"task_id":' || task_id || ',"type":' || coalesce('"' || type || '"', 'null') || '}' as line from benchmark""",
    "category_ids": "select category, label, max_id, count(*) as threads from (values ('sp', 'Primary school', 1046), ('liceum', 'Secondary school', 6437), ('studia', 'University', 6630), ('zadania', 'Miscellaneous problems', 346)) c(category, label, max_id) join (select distinct thread_id from forum_example_fixed) t on t.thread_id <= c.max_id group by category, label, max_id",
    "train_val_split": "select doc_id, case when row_number() over (order by md5('42:' || doc_id), doc_id) <= ceil(0.1 * (select count(*) from documents)) then 'validation' else 'train' end as split from documents",
    "sft_samples": """with r as (select distinct record_id, question, solution from pipeline_output where kept and question is not null and solution is not null)
select record_id, case when row_number() over (order by md5('42:' || record_id), record_id) <= 1000 then 'validation' else 'train' end as split,
md5('<|im_start|>user' || chr(10) || question || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || solution || '<|im_end|>' || chr(10)) as digest from r""",
    "source_union_counts": """select _source_path, source, count(*) as rows, count(lang) as with_lang, count(title) as with_title from (select 'documents' as _source_path, source, lang, null as title from documents union all select 'forum', source, null, title from forum_example_fixed)
group by _source_path, source""",
    "source_heads": "select source, doc_id from (select source, doc_id, row_number() over (partition by source order by doc_id) as k from documents where source is not null) where k <= 3",
}
