"""Problem 6: timestamps of many formats, precisions and zones as one unambiguous UTC form.

Every format is part of one alternation with named groups.  One replacement by all groups extracts the
components of a value at once; they are checked against the calendar and put together by integer day
arithmetic.  A local time goes to UTC by its zone's clock changes.  All of it are column expressions: no shuffle,
no Python, only the columns asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Month names by their first letters, Polish and English.
MONTHS = {
    "sty": 1, "lut": 2, "mar": 3, "kwi": 4, "maj": 5, "cze": 6, "lip": 7, "sie": 8, "wrz": 9, "paź": 10, "paz": 10, "lis": 11, "gru": 12,
    "jan": 1, "feb": 2, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
#: Minutes east of UTC of the zone names that stand behind a time.
ZONES = {
    "z": 0, "utc": 0, "gmt": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "msk": 180, "ist": 330,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}
#: Words for a day told from the crawl.
DAYS = {"dziś": 0, "dzis": 0, "dzisiaj": 0, "today": 0, "wczoraj": 1, "yesterday": 1, "przedwczoraj": 2}
#: Seconds of the units in "N units ago".
UNITS = {"sek": 1, "sec": 1, "min": 60, "godz": 3600, "hour": 3600, "dni": 86400, "dzie": 86400, "day": 86400, "tydz": 604800, "tyg": 604800, "week": 604800}

#: Two-digit years below it are of this century.
PIVOT = 70

_MONTH = "|".join(sorted(MONTHS, key=len, reverse=True))
#: The components of a value and the groups that have them; of several groups one at most takes part in a match.
_PARTS = {
    "year": "y1 y2 y3 y4 y5", "month": "m1 m5", "name": "m3 m4", "day": "d1 d3 d4 d5", "n1": "n1", "n2": "n2", "hour": "h h5 h6", "minute": "i i5 i6", "second": "s s5 s6", "half": "half",
    "zone": "zone", "sign": "sign", "zh": "zh", "zm": "zm", "tz": "tz", "rel": "rel", "count": "count", "ago": "agoN", "unit": "agoUnit",
}
_FORMATS = rf"""(?ixU)^(?:
      (?<count>[0-9]{{9,13}}|[0-9]{{15,19}})(?:[.,][0-9]+)?
    | (?<agoN>[0-9]+|an?|one)?\s*(?<agoUnit>{"|".join(UNITS)})\p{{L}}*\s+(?:temu|ago)
    | (?:
        (?:
          (?:
            (?<rel>{"|".join(DAYS)})
          | (?:\p{{L}}{{2,}}+\.?,?\s+)?(?:
              (?<y1>[0-9]{{4}})[-/.](?<m1>[0-9]{{1,2}})[-/.](?<d1>[0-9]{{1,2}})
            | (?<n1>[0-9]{{1,2}})[-/.](?<n2>[0-9]{{1,2}})[-/.](?<y2>[0-9]{{4}}|[0-9]{{2}})
            | (?<d3>[0-9]{{1,2}})(?:st|nd|rd|th)?\.?[\s-]+(?<m3>{_MONTH})\p{{L}}*\.?,?[\s-]+(?<y3>[0-9]{{4}}|[0-9]{{2}})
            | (?<m4>{_MONTH})\p{{L}}*\.?\s+(?<d4>[0-9]{{1,2}})(?:st|nd|rd|th)?,?\s+(?<y4>[0-9]{{4}})
            )
          )
          (?:t|\s*,?\s*(?:o|at|godz\.?|-)?\s*)
          (?<h>[0-9]{{1,2}})[:.](?<i>[0-9]{{2}})(?:[:.](?<s>[0-9]{{2}})(?:[.,][0-9]+)?)?
          (?:\s*(?<half>[ap])\.?m\.?(?!\p{{L}}))?
        | (?<y5>[0-9]{{4}})(?<m5>[0-9]{{2}})(?<d5>[0-9]{{2}})(?:[t\s](?<h5>[0-9]{{2}})(?<i5>[0-9]{{2}})(?<s5>[0-9]{{2}}(?:[.,][0-9]+)?)?|(?<h6>[0-9]{{2}})(?<i6>[0-9]{{2}})(?<s6>[0-9]{{2}}))
        )
        (?:\s*(?:(?:(?<zone>{"|".join(sorted(ZONES, key=len, reverse=True))})|(?:utc|gmt)?(?<sign>[+-])(?<zh>[0-9]{{2}}):?(?<zm>[0-9]{{2}})?)(?:\[[^\[\]]*\])?|\[?(?<tz>[a-z]+(?:/[a-z0-9_+-]+)+)\]?))?
      )
    )$"""
#: Between the groups.
_CUT = "\u0001"
_MONTH_DAYS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def known_zone(zone: Column) -> Column:
    """The zone where the engine has clocks for its name, else null."""
    return F.when(F.try_make_timestamp(*[F.lit(x) for x in (1970, 1, 1, 0, 0)], F.lit(0).cast("decimal(8,6)"), zone).isNotNull(), zone)


def days_of(y: Column, m: Column, d: Column) -> Column:
    """Days from 1970-01-01; the year begins in March, so the leap day comes last."""
    year, month = y - F.when(m < 3, 1).otherwise(0), F.when(m > 2, m - 3).otherwise(m + 9)

    def whole(x: Column, n: int) -> Column:
        return F.floor(x / n)

    return 365 * year + whole(year, 4) - whole(year, 100) + whole(year, 400) + whole(153 * month + 2, 5) + d - 1 - 719468


def in_calendar(y: Column, m: Column, d: Column) -> Column:
    leap = (m == 2) & (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    length = F.try_element_at(F.array(*map(F.lit, _MONTH_DAYS)), F.when(m.between(1, 12), m).otherwise(13)) + F.when(leap, 1).otherwise(0)
    return (y >= 1) & m.between(1, 12) & (d >= 1) & (d <= length)


def to_utc(local: Column, zone: Column) -> Column:
    """Seconds UTC of local ones.  A local time that occurs twice is the earlier instant, a skipped one has the offset before the change."""
    return F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(local), zone))


def offset_at(instant: Column, zone: Column) -> Column:
    """Offset in force at an instant."""
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(instant), zone)) - instant


def written(instant: Column) -> Column:
    days, rest = F.floor(instant / 86400), F.pmod(instant, F.lit(86400))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    text = F.concat(F.date_from_unix_date(days.cast("int")).cast("string"), F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest / 60) % 60), F.lit(":"), two(rest % 60), F.lit("Z"))
    return F.when((instant >= -62135596800) & (instant < 253402300800), text)


def _lookup(table: dict[str, int], key: Column) -> Column:
    return F.try_element_at(F.expr("map(" + ", ".join(f"'{k}', {v}" for k, v in table.items()) + ")"), F.lower(key))


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The kept columns with new ones (time_...).  Each is worked out once a row: neither projections nor filters behind it are merged into its expression."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(f"time_{n}") for n, c in columns.items()]))))


def normalise_times(df: DataFrame, value_col: str, zone_col: str, out_col: str = "utc", order_col: str | None = None, crawled_col: str | None = None, calendar_col: str | None = None) -> DataFrame:
    """The rows with ``out_col``: the instant as ``2020-01-31T08:05:09Z``, null where the value names none.

    ``zone_col`` has the zone of values without one (null or unknown: such values name no instant); ``order_col`` has
    ``dmy`` or ``mdy`` for all-number dates that don't begin with the year; ``crawled_col`` has the crawl's instant in the
    written form, for values told from it, on the calendar of ``calendar_col`` (else of ``zone_col``).  A local time that
    occurs twice is the earlier instant; a skipped one has the offset before the change.  Parts of a second are cut
    off; a second 60 is the next minute's first.  Counts from 1970 are seconds with 9 or 10 digits, milliseconds with 11 to 13, microseconds with 15 or 16,
    nanoseconds with 17 to 19; 14 digits are a date and time.  Years of two digits are of 1970 to 2069.
    No instant: dates without a time, times without a date, dates that no calendar has, null, empty and meaningless
    values, of any length; rows stay as many as they were; a column ``out_col`` is replaced; names beginning with time_ are taken.
    """
    keep = [c for c in df.columns if c != out_col]
    absent = F.lit(None).cast("string")
    value, zone, order, crawled, calendar = (F.col(c).cast("string") if c else absent for c in (value_col, zone_col, order_col, crawled_col, calendar_col))
    tidy = F.trim(F.regexp_replace(F.translate(F.replace(value, F.lit(_CUT), F.lit("?")), "０１２３４５６７８９", "0123456789"), r"(?U)\s+", " "))
    slots = _CUT.join("".join(f"${{{g}}}" for g in groups.split()) for groups in _PARTS.values())
    parts = F.split(F.regexp_replace(tidy, _FORMATS, slots), _CUT)
    asked = _once(
        df.select(*keep, *[c.alias(f"time_{n}") for n, c in (("text", value), ("own", zone), ("order", order), ("crawl", crawled), ("cal", calendar))]),
        keep,
        p=F.when(F.size(parts) == len(_PARTS), parts),
        zone=known_zone(F.col("time_own")),
        mdy=F.coalesce(F.col("time_order") == "mdy", F.lit(False)),
        crawled=F.unix_seconds(F.col("time_crawl").try_cast("timestamp")),
        calendar=known_zone(F.coalesce("time_cal", "time_own")),
    )

    def part(name: str) -> Column:
        return F.nullif(F.get("time_p", F.lit(list(_PARTS).index(name))), F.lit(""))

    def number(name: str) -> Column:
        return part(name).try_cast("int")

    digits = F.length(part("count"))
    units = F.coalesce(number("ago"), F.when(F.coalesce(part("ago").rlike("[0-9]"), F.lit(False)), F.lit(None).cast("int")).otherwise(1))
    offset = F.when((number("zh") <= 15) & (F.coalesce(number("zm"), F.lit(0)) <= 59), number("zh") * 3600 + F.coalesce(number("zm"), F.lit(0)) * 60)
    read = _once(
        asked,
        [*keep, "time_crawled", "time_calendar"],
        y=F.when(F.length(part("year")) == 2, number("year") + F.when(number("year") < PIVOT, 2000).otherwise(1900)).otherwise(number("year")),
        m=F.coalesce(number("month"), F.when(F.col("time_mdy"), number("n1")).otherwise(number("n2")), _lookup(MONTHS, part("name"))),
        d=F.coalesce(number("day"), F.when(F.col("time_mdy"), number("n2")).otherwise(number("n1"))),
        h=F.when(part("half").isNull(), number("hour")).when(number("hour").between(1, 12), number("hour") % 12 + F.when(F.lower(part("half")) == "p", 12).otherwise(0)),
        i=number("minute"),
        s=F.coalesce(F.substring(part("second"), 1, 2).try_cast("int"), F.lit(0)),
        back=_lookup(DAYS, part("rel")),
        count=F.floor(part("count").try_cast("bigint") / F.when(digits <= 10, F.lit(1)).when(digits <= 13, 1000).when(digits <= 16, 1_000_000).otherwise(1_000_000_000)),
        ago=F.when(part("unit").isNotNull(), units * _lookup(UNITS, part("unit")).cast("bigint")),
        placed=part("sign").isNotNull() | part("zone").isNotNull(),
        east=F.coalesce(_lookup(ZONES, part("zone")) * 60, offset * F.when(part("sign") == "-", -1).otherwise(1)),
        zone=F.when(part("tz").isNotNull(), known_zone(part("tz"))).otherwise(F.col("time_zone")),
    )
    t = lambda k: F.col(f"time_{k}")
    clock = F.when((t("h") <= 23) & (t("i") <= 59) & ((t("s") <= 59) | ((t("s") == 60) & (t("i") == 59))), t("h") * 3600 + t("i") * 60 + t("s"))
    here = t("crawled") + offset_at(t("crawled"), t("calendar"))
    days = F.when(t("back").isNotNull(), F.floor(here / 86400) - t("back")).when(in_calendar(t("y"), t("m"), t("d")), days_of(t("y"), t("m"), t("d")))
    local = _once(read, [*keep, *(f"time_{k}" for k in ("crawled", "count", "ago", "placed", "east", "zone"))], local=days * 86400 + clock)
    instant = F.coalesce(t("count"), t("crawled") - t("ago"), F.when(t("placed"), t("local") - t("east")).otherwise(to_utc(t("local"), t("zone"))))
    return _once(local, keep, instant=instant).select(*keep, written(t("instant")).alias(out_col))
