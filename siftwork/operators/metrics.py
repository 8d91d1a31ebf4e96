"""Answers: prompts, normal forms and accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the prompt before a task.
PROMPT = "Rozwiąż zadanie matematyczne. Przedstaw swój tok rozumowania, a na samym końcu podaj ostateczną odpowiedź w formacie \\boxed{{wynik}}.\n\nZadanie: "


def prompt(task: Column) -> Column:
    return F.concat(F.lit(PROMPT), F.coalesce(task, F.lit("")))


def answer_form(c: Column) -> Column:
    """An answer as compared: without dollars, brackets, blanks, a box around it or a dot behind it; fractions as a/b; commas as dots.

    Equal forms mean equal answers; unlike a computer algebra system this does not see that two
    different expressions have one value, except for plain fractions and decimals.
    """
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+|\$|\\\(|\\\)|\\\[|\\\]|\\,|\\!|\\left|\\right", "")
    t = F.regexp_replace(t, r"^\\boxed\{(.*)\}$", "$1")
    t = F.regexp_replace(t, r"\\[dt]?frac\{([^{}]*)\}\{([^{}]*)\}", "$1/$2")
    t = F.regexp_replace(t, r"(\d),(\d+)$", "$1.$2")
    return F.regexp_replace(t, r"\.$", "")


def _value(form: Column) -> Column:
    whole = r"^-?\d{1,15}(?:\.\d{1,15})?$"
    top, bottom = F.regexp_extract(form, r"^(-?\d{1,15})/(\d{1,15})$", 1), F.regexp_extract(form, r"^(-?\d{1,15})/(\d{1,15})$", 2)
    fraction = F.try_divide(F.nullif(top, F.lit("")).try_cast("double"), F.nullif(bottom, F.lit("")).try_cast("double"))
    return F.when(F.regexp_like(form, F.lit(whole)), form.try_cast("double")).otherwise(fraction)


def same_answer(gold: Column, predicted: Column) -> Column:
    """Whether two answers agree; an empty gold answer agrees with nothing."""
    a, b = answer_form(gold), answer_form(predicted)
    return (a != "") & ((a == b) | F.coalesce(F.abs(_value(a) - _value(b)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(_value(a))), F.lit(False)))


def accuracy(df: DataFrame, gold: str, predicted: str, skip_empty_gold: bool = False) -> DataFrame:
    """(n, accuracy) in one row; 0 without rows."""
    rows = df.where(answer_form(F.col(gold)) != "") if skip_empty_gold else df
    return rows.agg(F.count("*").alias("n"), F.coalesce(F.avg(same_answer(F.col(gold), F.col(predicted)).cast("int")), F.lit(0.0)).alias("accuracy"))
