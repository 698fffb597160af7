"""Words of all lists against plain Python, and what it takes to pass over a text."""

import re

from pyspark.sql import functions as F

from siftstone.functions import lexicon as L
from siftstone.functions import text as T

LINES = "id int, lines array<struct<text:string,conf:double>>"
LISTS = {"ecommerce": L.PLATFORM_KEYWORDS, "watermarks": L.MARK_KEYWORDS, "watermark_weak": L.MARK_WEAK_KEYWORDS, "keep_terms": L.KEEP_LEXICON}


def test_words_stand_alone_or_are_cjk(spark):
    words = sorted({w for ws in T.WORDS for w in ws})
    forms = ("{}", "x{}", "{}9", "«{}»", "的{}的", "{} {}", "é{}é", "a.{}_b")
    rows = [(i, [("first line", 0.9), (form.format(w, w).upper(), 0.9)]) for i, (w, form) in enumerate((w, f) for w in words for f in forms)]
    got = {r.id: r for r in T.analyzed(spark.createDataFrame(rows, LINES)).collect()}
    for i, lines in rows:
        line = lines[1][0].lower()
        for name, listed in LISTS.items():
            assert got[i][f"_a_{name}"] == [w for w in listed if w in line and re.search(T.keyword_pattern(w), line)], (name, line)


def test_long_s_is_an_s_in_prices(spark):
    d = spark.createDataFrame([(1, [("now 12 uſd", 0.9)]), (2, [("now 12 usd", 0.9)])], LINES)
    assert [r.p for r in T.analyzed(d).orderBy("id").select(F.col("_a_prices").alias("p")).collect()] == [["12 uſd"], ["12 usd"]]


def test_a_text_is_not_searched_for_each_word(spark):
    """Searches of the whole text outside of lambdas would grow with the lists."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = T.analyzed(spark.createDataFrame([(1, [("x", 0.9)])], LINES))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("Contains(") < sum(map(len, T.WORDS))
