"""Line protocols in which a model answers, read by column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwork.functions.latex import strip_fences
from siftwork.functions.text import strip
from siftwork.schema import CATEGORIES, TASK


def _last(raw: Column, head: str, stripped: bool = True) -> Column:
    """What follows ``head`` on the last line that begins with it; null where none does."""
    lines = F.split(F.coalesce(raw, F.lit("")), r"\r\n|\r|\n")
    if stripped:
        lines = F.transform(lines, strip)
    found = F.filter(lines, lambda x: F.startswith(x, F.lit(head)))
    return F.substring(F.try_element_at(found, F.lit(-1)), len(head) + 1, 1 << 30)


def decision(raw: Column) -> Column:
    """Whether to keep; without a decision line, yes."""
    return F.coalesce(F.contains(F.upper(_last(raw, "DECISION:")), F.lit("YES")), F.lit(True))


def reason(raw: Column) -> Column:
    return F.coalesce(strip(_last(raw, "REASON:")), F.lit(""))


def category(raw: Column) -> Column:
    """One of the categories or null."""
    found = F.upper(strip(_last(raw, "CATEGORY:")))
    return F.when(found.isin(*CATEGORIES), found)


def post_index(raw: Column) -> Column:
    """The last index that reads as a number; null where there is none, the answer is empty or says that there is none."""
    heads = F.filter(F.split(strip(raw), r"\r\n|\r|\n"), lambda x: F.startswith(x, F.lit("POST_INDEX:")))
    numbers = F.filter(F.transform(heads, lambda x: strip(F.substring(x, 12, 1 << 30)).try_cast("int")), lambda n: n.isNotNull())
    return F.when(F.contains(raw, F.lit("NO_ANSWER")) | (strip(raw) == ""), F.lit(None).cast("int")).otherwise(F.try_element_at(numbers, F.lit(-1)))


def is_task_list(raw: Column) -> Column:
    """Whether the answer is a JSON list of tasks, empty or not."""
    clean = strip_fences(raw)
    return F.coalesce(F.startswith(clean, F.lit("[")) & F.from_json(clean, f"array<{TASK.simpleString()}>").isNotNull(), F.lit(False))


def tasks(raw: Column, posts: Column, title: Column) -> Column:
    """Tasks of a JSON list; anything else is one task: the first post (or the title) with all posts."""
    clean = strip_fences(raw)
    parsed = F.when(F.startswith(clean, F.lit("[")), F.from_json(clean, f"array<{TASK.simpleString()}>"))
    every = F.when(F.size(posts) > 0, F.transform(F.sequence(F.lit(0), F.size(posts) - 1), lambda i: i.cast("int"))).otherwise(F.array().cast("array<int>"))
    question = F.when(F.size(posts) > 0, F.try_element_at(posts, F.lit(1))["content"]).otherwise(title)
    whole = F.array(F.struct(question.alias("question"), every.alias("post_indices"), F.lit(False).alias("has_inline_solution")))
    return F.when(F.size(parsed) > 0, parsed).otherwise(whole)
