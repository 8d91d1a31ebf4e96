"""Query of the general problem: timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.operators.timestamps import normalise_times


def p6_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(field, id, value, utc) of every post date and crawl time; utc is null where the value names no instant."""
    forum = spark.read.parquet(f"{sf_dir}/forum_example_fixed.parquet").select("source", "thread_id", "scraped_at", F.transform("posts", lambda p: F.struct(p["index"].alias("index"), p["date"].alias("date"))).alias("posts"))
    clock = spark.read.parquet(f"{sf_dir}/site_clock.parquet")
    crawls = normalise_times(forum.join(clock, "source", "left"), "scraped_at", "crawl_zone", "crawled")
    dates = crawls.select("thread_id", "site_zone", "date_order", "crawled", F.explode("posts").alias("p"))
    dates = dates.select((F.col("thread_id") * 1000 + F.col("p.index")).alias("id"), F.col("p.date").alias("value"), "site_zone", "date_order", "crawled")
    done = normalise_times(dates, "value", "site_zone", "utc", "date_order", "crawled")
    return done.select(F.lit("date").alias("field"), "id", "value", "utc").unionByName(crawls.select(F.lit("scraped_at").alias("field"), F.col("thread_id").alias("id"), F.col("scraped_at").alias("value"), F.col("crawled").alias("utc")))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.col("value").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$")
    return p6_times(spark, sf_dir).where(F.col("utc").isNotNull() & F.col("id").isNotNull() & ~plain).select("field", "id", "utc").distinct()


_MONTHS = ("sty|jan", "lut|feb", "mar", "kwi|apr", "maj|may", "cze|jun", "lip|jul", "sie|aug", "wrz|sep", "paź|paz|oct", "lis|nov", "gru|dec")
_OFFSETS = {"z|utc|gmt|wet": 0, "west|bst|cet": 60, "cest|eet": 120, "eest|msk": 180, "ist": 330, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420}
_UNITS = {"sek|sec": 1, "min": 60, "godz|hour": 3600, "dni|dzie|day": 86400, "tydz|tyg|week": 604800}
_GROUPS = "c n unit rel y1 m1 d1 a b y2 d3 m3 y3 m4 d4 y4 h i s half zone sign zh zm".split()


def _choice(x: str, table) -> str:
    return "case " + " ".join(f"when regexp_full_match({x}, '{k}') then {v}" for k, v in table) + " end"


def _read_sql(rows: str) -> str:
    """Rows (value, zone, ord, crawl, ...) with t, the seconds UTC."""
    month = "|".join(_MONTHS)
    pattern = (
        rf"^(?:([0-9]{{9,13}})|([0-9]+|an?|one)? ?({'|'.join(_UNITS)})\pL* (?:temu|ago)|(?:(dziś|dzis|dzisiaj|today|wczoraj|yesterday|przedwczoraj)|(?:\pL+\.?,? )?"
        rf"(?:([0-9]{{4}})[-/.]([0-9]{{1,2}})[-/.]([0-9]{{1,2}})|([0-9]{{1,2}})[-/.]([0-9]{{1,2}})[-/.]([0-9]{{4}})|([0-9]{{1,2}})(?:st|nd|rd|th)?\.?[ -]+({month})\pL*\.?,?[ -]+([0-9]{{4}})|({month})\pL*\.? ([0-9]{{1,2}})(?:st|nd|rd|th)?,? ([0-9]{{4}})))"
        rf"(?:t| ?,? ?(?:o|at|godz\.?|-)? ?)([0-9]{{1,2}})[:.]([0-9]{{2}})(?:[:.]([0-9]{{2}})(?:[.,][0-9]+)?)?(?: ?([ap])\.?m\.?)?(?: ?(?:({'|'.join(_OFFSETS)})|(?:utc|gmt)?([+-])([0-9]{{2}}):?([0-9]{{2}})?))?)$"
    )
    day = "coalesce(try_cast(g.y1 || '-' || lpad(g.m1, 2, '0') || '-' || lpad(g.d1, 2, '0') as date), try_cast(g.y2 || '-' || lpad(if(ord = 'mdy', g.a, g.b), 2, '0') || '-' || lpad(if(ord = 'mdy', g.b, g.a), 2, '0') as date), try_cast(g.y3 || g.y4 || '-' || lpad(mon::varchar, 2, '0') || '-' || lpad(g.d3 || g.d4, 2, '0') as date))"
    back = "case when g.rel in ('dziś', 'dzis', 'dzisiaj', 'today') then 0 when g.rel in ('wczoraj', 'yesterday') then 1 when g.rel = 'przedwczoraj' then 2 end"
    hour = "case when g.half = '' then try_cast(g.h as int) when try_cast(g.h as int) between 1 and 12 then try_cast(g.h as int) % 12 + if(g.half = 'p', 12, 0) end"
    clock = f"case when {hour} < 24 and try_cast(g.i as int) < 60 and coalesce(try_cast(g.s as int), 0) < 60 then {hour} * 3600 + try_cast(g.i as int) * 60 + coalesce(try_cast(g.s as int), 0) end"
    there = "epoch(timezone(zone, loc))::bigint"  # the later of two readings; the earlier one is an hour before
    return rf"""(select *, case when g.c <> '' then if(length(g.c) > 10, try_cast(g.c as bigint) // 1000, try_cast(g.c as bigint)) when g.unit <> '' then crawl - coalesce(try_cast(g.n as bigint), 1) * {_choice('g.unit', _UNITS.items())}
when g.zone <> '' then epoch(loc)::bigint - 60 * {_choice('g.zone', _OFFSETS.items())} when g.sign <> '' then epoch(loc)::bigint - if(g.sign = '-', -1, 1) * (try_cast(g.zh as int) * 3600 + coalesce(try_cast(g.zm as int), 0) * 60)
when timezone(zone, to_timestamp({there} - 3600)) = loc then {there} - 3600 else {there} end as t
from (select *, coalesce(cast(timezone(zone, to_timestamp(crawl)) as date) - ({back}), {day}) + to_seconds({clock}) as loc
from (select *, {_choice('g.m3 || g.m4', [(m, k) for k, m in enumerate(_MONTHS, 1)])} as mon from (select *, regexp_extract(lower(trim(regexp_replace(value, '\s+', ' ', 'g'))), '{pattern}', {_GROUPS}) as g from {rows}))))"""


def _times_sql() -> str:
    utc = "case when t between -62135596800 and 253402300799 then strftime(make_timestamp(t * 1000000), '%Y-%m-%dT%H:%M:%SZ') end"
    crawls = _read_sql("(select f.thread_id, f.posts, f.scraped_at as value, c.crawl_zone as zone, null as ord, null::bigint as crawl, c.site_zone, c.date_order from forum_example_fixed f left join site_clock c on c.source = f.source)")
    dates = _read_sql("(select thread_id * 1000 + p.index as id, p.date as value, site_zone as zone, date_order as ord, t as crawl from (select thread_id, unnest(posts) as p, site_zone, date_order, t from cr))")
    return f"with cr as (select * from {crawls}) select 'scraped_at' as field, thread_id as id, value, {utc} as utc from cr union all select 'date', id, value, {utc} from {dates}"


def oracle_sql() -> dict[str, str]:
    times = _times_sql()
    found = rf"select distinct field, id, utc from ({times}) where utc is not null and id is not null and not regexp_full_match(value, '\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\dZ')"
    return {"p6_times": times, "p6_found": found}
