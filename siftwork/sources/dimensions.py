"""Small fixed tables of the crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Sections of a problem site and their addresses' parts.
SECTIONS = (
    ("zadania dla szóstoklasisty", "sp"),
    ("średnia arytmetyczna", "srednia-arytmetyczna"),
    ("procenty", "procenty"),
    ("prędkość, droga, czas", "predkosc-droga-czas"),
    ("zbiory", "zbiory"),
    ("permutacje", "permutacje"),
    ("wariacje", "wariacje"),
    ("kombinacje", "kombinacje"),
    ("równania z wartością bezwzględną", "rownania-wartosc-bezwzgledna"),
    ("ciąg arytmetyczny", "ciag-arytmetyczny"),
    ("przelewanie", "przelewanie"),
    ("zadania ciekawe", "ciekawe"),
    ("zadania różne", "rozne"),
)
#: Categories of a forum, their labels and highest known ids.
CATEGORIES = (
    ("sp", "Primary school", 1046),
    ("liceum", "Secondary school", 6437),
    ("studia", "University", 6630),
    ("zadania", "Miscellaneous problems", 346),
)


def sections(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SECTIONS, "section string, slug string")


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORIES, "category string, label string, max_id bigint")
