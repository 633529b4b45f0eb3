import math
import random
import re
from collections import Counter

import duckdb
import pytest

from candlewick.llm import lexical_search as search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(items, docs, k):
    """Rows of (item place, rank, doc_id, score), documents told apart by place."""
    counts = [Counter(terms(t)) for _, t in docs]
    size = [sum(c.values()) for c in counts]
    n, total = sum(s > 0 for s in size), sum(size)
    df = Counter(t for c in counts for t in c)
    out = []
    for i, (_, text) in enumerate(items):
        scores = []
        for (doc_id, _), c, s in zip(docs, counts, size):
            m = 75 + (25 * s * n) // total if s else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                (1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(items[i][0], r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def run(spark, items, docs, **options):
    i = spark.createDataFrame([(a, b, "x", 1) for a, b in items], "item_id long, text string, term string, bundle int")
    d = spark.createDataFrame([(a, b, 7, "y") for a, b in docs], "doc_id long, text string, n int, slice string")
    out = search.search(i, d, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize("slice_docs,bundle_items", [(8192, 256), (40, 3)])
def test_against_brute_force(spark, slice_docs, bundle_items):
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.4)) % 400}" for _ in range(3000)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(300)]
    docs[7] = (7, "w1 " * 20_000)
    items = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(10)]
    got = run(spark, items, docs, k=5, slice_docs=slice_docs, bundle_items=bundle_items)
    assert got == brute(items, docs, 5) and len(got) == 50


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (3, " .,;\n"), (4, "Älter ÄLTER straße"), (5, "x_y-z X"), (5, "x_y-z X"), (None, "x y"),
            (8, "\x00\x7f漢字 漢字"), (9, "ﬁx x"), (10, None), (11, "other words here"), (12, "more of them")]
    items = [(0, None), (1, ""), (2, "X y x"), (2, "X y x"), (None, "漢字"), (3, "nowhere"), (4, "straße Älter")]
    got = run(spark, items, docs, k=4, slice_docs=4, bundle_items=2)
    assert got == brute(items, docs, 4)
    assert {r[0] for r in got} == {2, None, 4}


def test_empty_tables(spark):
    some = [(1, "a b")]
    assert run(spark, [], some) == run(spark, some, []) == run(spark, some, [(1, None)]) == []


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = sorted(tuple(r) for r in search.op13_pipelined_terms(spark, sf_dir).collect())
    assert got == sorted(con.sql(search.SQL).fetchall())
