"""LaTeX of forum texts in one clean form.

Rules by regular expression run in the JVM.  Only display blocks need brace counting; their
Arrow function is reached by the rows that hold the marker alone.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.functions.text import strip

MARKER = "\\(\\displaystyle{"


def display_blocks(text: str) -> str:
    """``\\(\\displaystyle{x}\\)`` on lines of its own between display brackets; without its end, ``{\\displaystyle x}``; an unclosed brace runs to the end, nothing of it is lost."""
    head, *blocks = text.split(MARKER)
    out = [head]
    for i, block in enumerate(blocks):
        depth, end = 1, None
        for k, c in enumerate(block):
            depth += (c == "{") - (c == "}")
            if depth == 0:
                end = k
                break
        if end is None and i + 1 < len(blocks):
            # the brace closes behind the next marker, if at all: that block is part of this one
            blocks[i + 1] = block + MARKER + blocks[i + 1]
            continue
        inner, rest = (block, "") if end is None else (block[:end], block[end + 1 :])
        if rest.startswith("\\)"):
            out.append("\\[\n" + inner.strip() + "\n\\]" + rest[2:])
        else:
            out.append("{\\displaystyle " + inner.strip() + "}" + rest)
    return "".join(out)


@F.pandas_udf(T.StringType())
def _display_blocks(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else display_blocks(t))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _display_blocks_each(texts: pd.Series) -> pd.Series:
    return texts.map(lambda ts: None if ts is None else [None if t is None else display_blocks(t) for t in ts])


def plain_blanks(c: Column) -> Column:
    return F.replace(F.translate(c, "\u00a0\u2009", "  "), F.lit("\u200b"), F.lit(""))


# The four patterns below are the rules themselves.
def rules(c: Column) -> Column:
    """The rules but for blanks and display blocks: inline dollars, empty superscripts, blanks in index braces, dots."""
    c = F.regexp_replace(c, r"(?s)\\\((.+?)\\\)", r"\$$1\$")
    c = F.replace(c, F.lit("^{}"), F.lit(""))
    c = F.regexp_replace(c, r"(?U)([_^])\{\s+", "$1{")
    return F.regexp_replace(c, r"(?<![.\\])\.\.\.", r"\\cdots")


def normalize_latex(c: Column) -> Column:
    """All rules in order; null stays null."""
    c = plain_blanks(c)
    return rules(F.when(F.contains(c, F.lit(MARKER)), _display_blocks(c)).otherwise(c))


def normalize_latex_each(texts: Column) -> Column:
    """As normalize_latex, for an array of texts."""
    plain = F.transform(texts, plain_blanks)
    marked = F.exists(plain, lambda t: F.coalesce(F.contains(t, F.lit(MARKER)), F.lit(False)))
    return F.transform(F.when(marked, _display_blocks_each(plain)).otherwise(plain), rules)


def strip_fences(c: Column, language: str = "json") -> Column:
    """Without a code fence around it."""
    for pattern in (rf"^```{language}", r"^```", r"```$"):
        c = F.regexp_replace(strip(c), pattern, "")
    return strip(c)


def repair_json_escapes(c: Column) -> Column:
    """Doubles backslashes that begin no JSON escape, pair by pair."""
    return F.regexp_replace(c, r'(?<!\\)((?:\\\\)*)\\(?!["\\/bfnrt]|u[0-9a-fA-F]{4})', r"$1\\\\")
