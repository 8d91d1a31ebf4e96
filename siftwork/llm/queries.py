"""Queries over the text operators; ``__spark_entry__`` adds them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import tables as tb


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.neardups import near_duplicate_pairs

    return near_duplicate_pairs(tb.questions_and_posts(spark, sf_dir)).distinct()


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.neardups import near_duplicate_groups

    return near_duplicate_groups(tb.questions_and_posts(spark, sf_dir))


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.leaks import leaked

    return leaked(tb.texts(spark, sf_dir, "pipeline_output"), "record_id", ["question", "solution"], tb.table(spark, sf_dir, "benchmark"), "task_id", ["task", "solution"])


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select(F.col("id").alias("record_id"), F.col("item").alias("task_id"))


def p2_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(task_id, records) of every item that leaked."""
    return _leaks(spark, sf_dir).groupBy(F.col("item").alias("task_id")).agg(F.count("*").alias("records"))


def _p3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm import splits

    host, no = splits.thread_of(F.col("source_url"))
    rows = tb.table(spark, sf_dir, "pipeline_output").select("record_id", host.alias("host"), no.alias("thread_no")).distinct()
    known = rows.join(splits.sites(tb.table(spark, sf_dir, "forum_example_fixed")), "host", "left")
    known = known.withColumn("thread", F.concat_ws("/", F.when(F.col("thread_no").isNotNull(), F.col("site")), "thread_no"))
    known = known.withColumn("thread", F.when(F.col("site").isNotNull(), F.col("thread")))
    return splits.related_splits(known, "record_id", ["thread"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3(spark, sf_dir).where("site is not null and thread_no is not null").select("record_id", "site", "thread_no").distinct()


def p3_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p3(spark, sf_dir).select("record_id", "split")


def p3_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(site, thread_no, records, splits): every thread's records and how many splits they are in, which is one."""
    whole = _p3(spark, sf_dir).where("site is not null and thread_no is not null")
    return whole.groupBy("site", "thread_no").agg(F.count_distinct("record_id").alias("records"), F.count_distinct("split").alias("splits"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.encode import encode_corpus

    return encode_corpus(tb.texts(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.site_lines import site_lines

    return site_lines(tb.table(spark, sf_dir, "forum_example_fixed")).select("thread_id", "post_index", "line_no")


def p4_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.site_lines import without_site_lines

    return without_site_lines(tb.table(spark, sf_dir, "forum_example_fixed"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.defects import pair_defects

    kept = tb.texts(spark, sf_dir, "pipeline_output").where("kept").select("record_id", "question", "solution", "filter_reason")
    return pair_defects(kept).where(F.size("defects") > 0).select("record_id", F.element_at("defects", 1).alias("defect")).distinct()


def p5_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.defects import pair_defects

    kept = tb.texts(spark, sf_dir, "pipeline_output").where("kept").select("record_id", "question", "solution", "filter_reason")
    return pair_defects(kept).select("record_id", F.explode("defects").alias("defect")).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.unify import unify_text

    done = unify_text(tb.questions_and_posts(spark, sf_dir))
    # a case is a text that its repair changes, or that has a mixed-script word no known word explains
    changed = (F.col("unified") != F.col("text")) | F.array_contains("kinds", "mixed_script")
    return done.where((F.size("kinds") > 0) & changed).select("field", "id").distinct()


def p7_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.unify import unify_text

    return unify_text(tb.questions_and_posts(spark, sf_dir)).select("field", "id", "unified", F.array_join("kinds", ",").alias("kinds"))


def _mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.mixing import mix

    return mix(tb.texts(spark, sf_dir, "documents").select("doc_id", "source", "text"), tb.table(spark, sf_dir, "mix_targets"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.mixing import shares

    return shares(_mix(spark, sf_dir), tb.table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.spam_pages import spam_pages

    return spam_pages(tb.texts(spark, sf_dir, "documents").select("doc_id", "text")).where("spam").select("doc_id").distinct()


def p10_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwork.llm.spam_pages import spam_pages

    return spam_pages(tb.texts(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit()}


_ADDRESS = r"'^(?:https?://)?(?:(?:www|m)\.)*([a-z0-9.-]+?)(?::\d+)?/(?:temat/(\d+)|(?:[^?#]*-)?t(\d+)\.html|viewtopic\.php\?(?:[^#]*&)?t=(\d+)|forum\.php\?(?:[^#]*&)?id=(\d+))(?:\W|$)'"
_TIDY = "replace(lower(trim(regexp_replace({}, '\\s+', ' ', 'g'))), '&amp;', '&')"


#: Classes of characters, written out for SQL by properties and code points, not taken from the operators.
_INVISIBLE = r"[\p{Cf}\x{34f}\x{115f}\x{1160}\x{17b4}\x{17b5}\x{3164}\x{ffa0}]"
_BLANK = r"[\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"
_WIDE = r"[\x{ff10}-\x{ff19}\x{ff21}-\x{ff3a}\x{ff41}-\x{ff5a}\x{fb00}-\x{fb06}\x{132}\x{133}\x{1c4}-\x{1cc}\x{1f1}-\x{1f3}]"
_FOREIGN = r"[\p{Greek}\p{Cyrillic}\p{Armenian}\p{Cherokee}\p{Georgian}\p{Hebrew}\p{Arabic}\p{Coptic}\p{Lisu}]"
_LATIN = r"\p{Latin}"
_LOOK_ALIKES = ("аеорсухіјѕԁһԛԝүАВЕКМНОРСТУХІЈЅοαιυνκρτχγΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhqwyABEKMHOPCTYXIJSoaiuvkptxyABEZHIKMNOPTYX")


def _p3_sql() -> str:
    host = r"regexp_extract({}, '^(?:https?://)?(?:(?:www|m)\.)*([a-z0-9.-]+?)(?::\d+)?(?:[/?#]|$)', 1)".format(_TIDY.format("url"))
    number = "try_cast(coalesce(" + ", ".join(f"nullif(regexp_extract(u, {_ADDRESS}, {i}), '')" for i in (2, 3, 4, 5)) + ") as bigint)"
    return f"""with s as (select host, arg_max(source, (n, source)) as site from (select {host} as host, source, count(*) as n from forum_example_fixed where url is not null and source is not null group by 1, 2) where host <> '' group by host),
r as (select distinct record_id, {_TIDY.format("source_url")} as u from pipeline_output where source_url is not null),
t as (select record_id, regexp_extract(u, {_ADDRESS}, 1) as host, {number} as thread_no from r)
select distinct t.record_id, s.site, t.thread_no from t join s on s.host = t.host where t.thread_no is not null"""


def _p7_sql() -> str:
    """Only the cases; the repair by vocabulary has no short SQL."""
    bare = f"regexp_replace(t, '{_INVISIBLE}', '', 'g')"
    seam = f"{_LATIN}{_FOREIGN}|{_FOREIGN}{_LATIN}"
    return f"""with x as (select 'question' as field, record_id as id, question as t from pipeline_output union all select 'post', thread_id * 1000 + p.index, p.content from (select thread_id, unnest(posts) as p from forum_example_fixed)),
y as (select field, id, t, {bare} as b from x where t is not null)
select distinct field, id from y where regexp_matches(t, '{_WIDE}|{_BLANK}|{_INVISIBLE}') or length(nfc_normalize(b)) < length(b) or regexp_matches(nfc_normalize(b), '{seam}')"""


def _clean_sql(t: str) -> str:
    """The clean-up but for look-alikes, and but for ligatures that no table has."""
    wide = "".join(chr(x) for r in ((0xFF10, 0xFF19), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A)) for x in range(r[0], r[1] + 1))
    plain = "".join(chr(ord(x) - 0xFEE0) for x in wide)
    x = f"regexp_replace(regexp_replace({t}, '{_INVISIBLE}', '', 'g'), '{_BLANK}', ' ', 'g')"
    for ligature, letters in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl")):
        x = f"replace({x}, '{ligature}', '{letters}')"
    return f"nfc_normalize(translate({x}, '{wide}', '{plain}'))"


def _own_script_sql(w: str) -> str:
    """A word whose look-alikes are exchanged where it mixes scripts; every such word of the tables is a Latin one."""
    return f"case when regexp_matches({w}, '{_LATIN}') and regexp_matches({w}, '{_FOREIGN}') then translate({w}, '{_LOOK_ALIKES[0]}', '{_LOOK_ALIKES[1]}') else {w} end"


def _words_sql(t: str) -> str:
    return f"list_transform(regexp_extract_all({_clean_sql(t)}, '[\\p{{L}}\\p{{N}}]+'), lambda w: lower({_own_script_sql('w')}))"


_POSTS_SQL = "(select distinct source, thread_id, p.index as post_index, p.content from (select source, thread_id, unnest(posts) as p from forum_example_fixed))"


def _p1_sql() -> str:
    return f"""with x as (select distinct 'question' as field, record_id as id, question as t from pipeline_output where question is not null union select 'post', thread_id * 1000 + post_index, content from {_POSTS_SQL} where content is not null),
w as (select distinct field, id, unnest({_words_sql("t")}) as w from x), n as (select field, id, count(*) as n from w group by field, id having count(*) >= 30),
v as (select w.field, w.id, w.w from w join n on n.field = w.field and n.id = w.id),
p as (select a.field, a.id as id_a, b.id as id_b, count(*) as k from v a join v b on a.field = b.field and a.w = b.w and a.id < b.id group by a.field, a.id, b.id)
select p.field, id_a, id_b from p join n na on na.field = p.field and na.id = id_a join n nb on nb.field = p.field and nb.id = id_b where k >= 0.7 * (na.n + nb.n - k) - 1e-9"""


def _p1_groups_sql() -> str:
    return f"""with recursive x as (select distinct 'question' as field, record_id as id, question as t from pipeline_output where question is not null union select 'post', thread_id * 1000 + post_index, content from {_POSTS_SQL} where content is not null),
w as (select distinct field, id, unnest({_words_sql("t")}) as w from x), n as (select field, id, count(*) as n, string_agg(w, ' ' order by w) as words from w group by field, id having count(*) >= 30),
r as (select field, words, n, min(id) as least from n group by field, words, n), v as (select w.field, w.id, w.w from w join r on r.field = w.field and r.least = w.id),
p as (select a.field, a.id as a, b.id as b, count(*) as k from v a join v b on a.field = b.field and a.w = b.w and a.id < b.id group by a.field, a.id, b.id),
l as (select p.field, a, b from p join r ra on ra.field = p.field and ra.least = a join r rb on rb.field = p.field and rb.least = b where k >= 0.7 * (ra.n + rb.n - k) - 1e-9),
e as (select field, a, b from l union all select field, b, a from l), reach(field, id, other) as (select field, least, least from r union select c.field, c.id, e.b from reach c join e on e.field = c.field and e.a = c.other),
c as (select field, id, min(other) as group_id from reach group by field, id), d as (select field, a, count(*) as links from e group by field, a)
select n.field, n.id, c.group_id, coalesce(d.links, 0) as links from n join r on r.field = n.field and r.words = n.words join c on c.field = r.field and c.id = r.least left join d on d.field = r.field and d.a = r.least"""


def _p3_threads_sql() -> str:
    return f"select site, thread_no, count(distinct record_id) as records, 1 as splits from ({_p3_sql()}) group by site, thread_no"


def _p4_cleaned_sql() -> str:
    lines = _p4_sql().rsplit("select thread_id, post_index, line_no from f", 1)[0]
    return f"""{lines}, g as (select f.*, line, k is not null and k >= greatest(5, 0.05 * posts) as gone from f join l using (source, thread_id, post_index, line_no) join n using (source) left join c using (source, form)),
o as (select thread_id, post_index, coalesce(string_agg(line, chr(10) order by line_no) filter (where not gone), '') as content, (count(*) filter (where gone))::int as n_removed from g group by thread_id, post_index)
select p.thread_id, p.post_index, case when p.content is not null then o.content end as content, coalesce(o.n_removed, 0) as n_removed from p left join o on o.thread_id = p.thread_id and o.post_index = p.post_index"""


def _p2_sql() -> str:
    grams = "list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))"
    return f"""with b as (select task_id, unnest([task, solution]) as t from benchmark), bw as (select task_id, {_words_sql("t")} as w from b where t is not null),
bg as (select distinct task_id, unnest({grams}) as g from bw where len(w) >= 13), r as (select record_id, unnest([question, solution]) as t from pipeline_output),
rw as (select record_id, {_words_sql("t")} as w from r where t is not null), rg as (select distinct record_id, unnest({grams}) as g from rw where len(w) >= 13)
select distinct record_id, task_id from rg join bg on rg.g = bg.g"""


def _p4_sql() -> str:
    parts = f"list_transform(regexp_extract_all({_clean_sql('line')}, '\\p{{L}}+|\\P{{L}}+'), lambda w: {_own_script_sql('w')})"
    form = f"regexp_replace(regexp_replace(lower(array_to_string({parts}, '')), '[\\s\\p{{Z}}]+', '', 'g'), '\\d+', '0', 'g')"
    return f"""with p as (select * from {_POSTS_SQL} where source is not null and thread_id is not null and post_index is not null), n as (select source, count(*) as posts from p group by source),
l as (select source, thread_id, post_index, unnest(string_split(content, chr(10))) as line, unnest(range(1, len(string_split(content, chr(10))) + 1)) as line_no from p where content is not null),
f as (select source, thread_id, post_index, line_no::int as line_no, {form} as form from l), c as (select source, form, count(distinct thread_id * 1000 + post_index) as k from f where form <> '' group by source, form)
select thread_id, post_index, line_no from f join c on c.source = f.source and c.form = f.form join n on n.source = f.source where k >= greatest(5, 0.05 * posts)"""


def oracle_sql() -> dict[str, str]:
    items = f"select task_id, count(*) as records from ({_p2_sql()}) group by task_id"
    return {
        "p1_found": _p1_sql(), "p1_groups": _p1_groups_sql(), "p2_found": _p2_sql(), "p2_items": items, "p3_found": _p3_sql(), "p3_threads": _p3_threads_sql(),
        "p4_found": _p4_sql(), "p4_cleaned": _p4_cleaned_sql(), "p7_found": _p7_sql(),
    }
