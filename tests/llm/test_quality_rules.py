import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from candlewick.llm import quality


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(windows)
    cover = {i + k for i, g in enumerate(windows) if c[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover))


def test_counts(frame, texts):
    more = ["a b c " * 50, "a a a a", "x y z x y", "l\n" * 30, " ".join(map(str, range(60)))]
    every = [*texts, *more]
    out = quality.judge(frame(every)).collect()
    assert len(out) == len(every)
    for r in out:
        want = brute(every[r.word])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept <= (not r.base_failed)


def test_query_against_sql(spark, sf_dir):
    got = sorted(tuple(r) for r in quality.op8_quality_rules(spark, sf_dir).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert got == sorted(con.execute(quality.SQL).fetchall())


def test_rules_agree_with_labels(spark):
    d = "/root/testdata/sf0.01"
    j = quality.judge(spark.read.parquet(f"{d}/documents.parquet")).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id")
    r = j.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"),
                                 F.avg((F.col("base_failed")).cast("int")).alias("failed")).collect()
    by = {x.quality: x for x in r}
    assert by[0].kept < 0.02 and by[1].kept > 0.98 * (1 - by[1].failed)


def test_filter_keeps_columns(frame, texts):
    letters = "abcdefghijklmnopqrstuvwxyz"
    good = " ".join(f"the {a}nce of {a}lder" for a in letters) + "."
    d = frame([*texts, good, good])
    out = quality.keep_good(d)
    assert out.columns == d.columns and [r.text for r in out.collect()] == [good, good]
    assert quality.keep_good(d.limit(0)).collect() == []
    clash = d.withColumn("n_words", F.lit(1)).withColumn("kept", F.lit(2))
    assert quality.keep_good(clash).columns == clash.columns


def test_filter_keeps_books(frame):
    book = " ".join("the " + "".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(50_001))
    assert len(book.split()) == 100_002
    assert [r.text for r in quality.keep_good(frame([book])).collect()] == [book]
    clash = frame([book]).withColumnsRenamed({"word": "n_words", "source": "kept"})
    out = quality.judge(clash).collect()
    assert out[0].n_words == 100_002 and out[0].kept and len(out[0]) == 2 + 10 + 3


def test_no_user_functions(spark, sf_dir):
    plan = quality.op8_quality_rules(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_filter_computes_the_counts_once(spark, sf_dir):
    kept = quality.keep_good(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2
