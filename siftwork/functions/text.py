"""Text as column expressions: all of it stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prime of the min-hash family and of the portable gram hash's range.
PRIME = 2147483647
#: White space of any kind, as the regular expression (?U)\s has it.
_UNICODE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(c, F.lit(_UNICODE_SPACE))


def build_text(*keys: Column) -> Column:
    """The keys joined by spaces, null as empty, stripped; a separator stays beside an empty key."""
    return strip(F.concat_ws(" ", *[F.coalesce(k, F.lit("")) for k in keys]))


def norm_tokens(c: Column, numbers: bool = True) -> Column:
    """Lower-case runs of letters and digits; with ``numbers`` every number reads 0."""
    t = F.lower(F.coalesce(c, F.lit("")))
    if numbers:
        t = F.regexp_replace(t, r"[0-9]+([.][0-9]+)?", "0")
    return F.filter(F.split(F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " ")), " "), lambda w: w != "")


def space_tokens(c: Column) -> Column:
    """Lower-case runs of anything but white space."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"(?U)\s+"), lambda w: w != "")


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens joined by spaces, in order; none for shorter texts."""
    grams = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def overlap_ngrams(left: Column, right: Column, n: int) -> Column:
    """Grams that begin in ``left`` and end in ``right``."""

    def one(i: int) -> Column:
        gram = F.array_join(F.concat(F.slice(left, -(n - 1 - i), n - 1 - i), F.slice(right, 1, i + 1)), " ")
        return F.when((F.size(left) >= n - 1 - i) & (F.size(right) >= i + 1), gram)

    return F.filter(F.array(*[one(i) for i in range(n - 1)]), lambda g: g.isNotNull())


def gram_hash(c: Column) -> Column:
    """31-bit hash of a string that any engine with md5 gives."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint").bitwiseAND(F.lit(PRIME))


def split_lines(c: Column) -> Column:
    """Stripped lines that aren't empty."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\r\n|\r|\n"), lambda x: strip(x)), lambda x: x != "")


#: Phrases of navigation lines.
NAVIGATION = (
    "logowanie", "math.edu.pl", "arytmetyka", "algebra", "geometria",
    "analiza", "zadania matematyczne", "ciekawostki", "wzory matematyczne",
    "narzędzia", "szukaj", "matematyka »", "zbiór zadań", "powrót do",
    "wersja do druku", "następne zadanie", "poprzednie zadanie", "© 20", "kontakt",
)


def without_navigation(c: Column, phrases: tuple[str, ...] = NAVIGATION) -> Column:
    """The text's lines that hold none of the phrases."""
    known = F.array(*[F.lit(p) for p in phrases])
    return F.array_join(F.filter(split_lines(c), lambda line: ~F.exists(known, lambda p: F.contains(F.lower(line), p))), "\n")


def squeeze_blank_lines(c: Column) -> Column:
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def has_image_link(c: Column) -> Column:
    return F.coalesce(F.regexp_like(c, F.lit(r"(?i)https?://\S+\.(?:jpg|jpeg|png|gif|webp)")), F.lit(False))


def canonical_url(c: Column) -> Column:
    """Without query and fragment."""
    return F.substring_index(F.substring_index(c, "?", 1), "#", 1)


def absolute_url(base: Column, href: Column) -> Column:
    """Href against a page's address: absolute, scheme-relative, rooted, query or fragment only, or beside the page."""
    scheme, root = F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*:)", 1), F.regexp_extract(base, r"^([a-z][a-z0-9+.-]*://[^/?#]*)", 1)
    plain = canonical_url(base)
    folder = F.when(plain == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(plain, r"[^/]*$", ""))
    return (
        F.when(F.regexp_like(href, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href))
        .when(href == "", base)
        .when(F.startswith(href, F.lit("?")), F.concat(plain, href))
        .when(F.startswith(href, F.lit("#")), F.concat(F.substring_index(base, "#", 1), href))
        .otherwise(F.concat(folder, href))
    )


def folded_path(url: Column) -> Column:
    """An address without ``.`` and ``..`` in its path, as a browser asks for it; a path that goes above its root begins there."""
    root, rest = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?", 0), F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    tail = F.substring(url, F.length(root) + F.length(rest) + 1, F.length(url))
    steps = F.split(rest, "/")
    ends = F.when(F.try_element_at(steps, F.lit(-1)).isin(".", ".."), F.lit("/")).otherwise("")
    kept = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done).when((s == "..") & (F.size(done) > 1), F.slice(done, 1, F.size(done) - 1)).when(s == "..", done).otherwise(F.array_append(done, s)),
    )
    return F.concat(root, F.array_join(kept, "/"), ends, tail)


def is_thread_url(url: Column, host: Column | str) -> Column:
    """Whether an address on a host is that of a thread: it has ``-t``, a number and ``.html``."""
    return F.coalesce(F.regexp_like(url, F.lit(r"-t\d+\.html")) & F.contains(url, F.lit(host) if isinstance(host, str) else host), F.lit(False))


def max_page(hrefs: Column, page: Column) -> Column:
    """Whether any address ends in a comma and a higher page number."""
    return F.exists(hrefs, lambda h: F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(h, r",(\d{1,9})$", 1), F.lit("")), F.lit("999999999")) > page, F.lit(False)))


def forum_date(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm[:ss]`` as an ISO time in UTC; anything else stripped as it is."""
    raw = strip(c)
    iso = F.concat(F.substring(raw, 1, 10), F.lit("T"), F.substring(raw, 12, 5), F.when(F.length(raw) == 19, F.substring(raw, 17, 3)).otherwise(F.lit(":00")), F.lit("+00:00"))
    ok = F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull() | F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm")).isNotNull()
    return F.when(F.regexp_like(raw, F.lit(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}(:\d{2})?$")) & ok, iso).otherwise(raw)


def date_headed(c: Column) -> tuple[Column, Column]:
    """(date, rest) of a cell whose first line may be a date."""
    lines = F.split(strip(c), "\n")
    first = strip(F.element_at(lines, 1))
    dated = F.regexp_like(first, F.lit(r"^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}"))
    rest = F.when(dated, F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))).otherwise(lines)
    return F.when(dated, forum_date(first)).otherwise(F.lit("")), squeeze_blank_lines(strip(F.array_join(rest, "\n")))


def percent(score: Column) -> Column:
    return F.concat(F.round(score * 100).cast("int").cast("string"), F.lit("%"))


def json_line(*columns: Column) -> Column:
    """One JSON object that keeps its nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def split_solution(c: Column) -> tuple[Column, Column]:
    """(problem, solution): cut at the line that says solution, then at the answer mark, whose part goes to the solution."""
    parts = F.split(c, r"(?imu)^Rozwi[ąa]zanie\s*$", 2)
    problem, solution = strip(F.element_at(parts, 1)), strip(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")))
    at = F.regexp_instr(problem, F.lit(r"(?U)\bOdp[p]?[.:]"))
    answer = F.when(at > 0, strip(F.substring(problem, at, F.length(problem))))
    before = F.when(at > 0, strip(F.substring(problem, F.lit(1), at - 1))).otherwise(problem)
    return before, F.when(answer.isNull(), solution).when(solution == "", answer).otherwise(F.concat(answer, F.lit("\n"), solution))


def utc_stamp(t: Column | None = None) -> Column:
    """An instant (now, unless one is given) as ``2020-01-31T08:05:09Z``."""
    return F.date_format(F.to_utc_timestamp(t if t is not None else F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def first_word(c: Column, fallback: str = "unknown") -> Column:
    return F.coalesce(F.nullif(F.try_element_at(F.split(strip(c), r"(?U)\s+"), F.lit(1)), F.lit("")), F.lit(fallback))
