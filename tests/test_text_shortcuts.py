"""Clean texts take the short way through trimming and title case, with the results of the long one."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitalframe.functions import text

ODD = [
    "", " ", "a", " a ", "a ", " a", "\t x\n", "x\n", "o'neil-smith", "año y má", " ab　", "9abc d9e", "a\u0001 b", "ñandú/ÉCLAIR",
    " ", "İstanbul ß ǆ", "a  b", "\U0001F600 hi", "ab ", None, "_a.b", "étudé x", "MASCULINO", "menos de un mes",
]


def test_short_ways_give_the_long_ones_results(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    long_strip = F.btrim(F.col("t"), F.lit(text._WHITE_SPACE))
    marked = F.regexp_replace(long_strip, r"[^\p{L}\p{N} ]", "$0" + text._MARK)
    long_title = F.replace(F.initcap(marked), F.lit(text._MARK), F.lit(""))
    short = text.strip(F.col("t"))
    got = df.select("t", short.alias("s"), long_strip.alias("ls"), text.title_case(short).alias("c"), long_title.alias("lc")).collect()
    assert [(r.t, r.s, r.c) for r in got] == [(r.t, r.ls, r.lc) for r in got] and len(got) == len(ODD)
    assert {r.t: r.c for r in got}["MASCULINO"] == "Masculino"


def test_clean_texts_are_neither_trimmed_nor_marked(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    for step in (text.strip, text.title_case):
        plan = df.select(step(F.col("t")))._jdf.queryExecution().analyzed().toString()
        assert "CASE WHEN RLIKE" in plan
