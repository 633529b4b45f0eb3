import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import minhash


def words_of(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def brute(texts, width, pct=80):
    """Shingle counts, and groups by all pairs."""
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= pct * len(a | sets[j]):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def near_copies(seed, groups=6, size=12, words=60):
    rng = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(3, words))]
        for _ in range(size):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                t[rng.randrange(len(t))] = f"x{rng.randint(0, 9999)}"
            out.append(" ".join(t))
            base = t if rng.random() < 0.3 else base  # chains: far ends may differ
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_equal_all_pairs(frame, texts, seed):
    every = [*near_copies(seed), *texts]
    rows = minhash.group(frame(every), width=4).collect()
    sizes, groups = brute(every, 4)
    by = defaultdict(set)
    for r in rows:
        by[r.group_id].add(r.word)
        assert r.n_shingles == sizes[r.word]
    want = defaultdict(set)
    for i, g in enumerate(groups):
        want[g].add(i)
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, want.values()))


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    sizes, groups = brute([d.text for d in docs], 4)
    out = {r.doc_id: r for r in minhash.op10_superminhash(spark, sf_dir).collect()}
    for i, d in enumerate(docs):
        assert (out[d.doc_id].n_shingles, out[d.doc_id].component_id) == (sizes[i], docs[groups[i]].doc_id)
        assert out[d.doc_id].kept == (groups[i] == i)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    error = []
    for n in (1, 5, 30, 300, 3000):
        x = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        a, b = x[:n + n // 2], x[n // 2:]
        s = minhash.superminhash([a, b, a[::-1].copy()], 200)
        assert (s[0] == s[2]).all() and np.isfinite(s).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        error.append(abs((s[0] == s[1]).mean() - true))
    assert max(error) < 0.12
    # One element fills the slots with a permutation of all ranks.
    one = minhash.superminhash([np.array([7], np.uint64)], 64)[0]
    assert sorted(np.floor(one).astype(int).tolist()) == list(range(64))
    assert np.isinf(minhash.superminhash([np.empty(0, np.uint64)], 8)).all()


@pytest.mark.parametrize("seed", [0, 1])
def test_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(250)]
    edges += [(1000, i) for i in range(1001, 1100)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    rng.shuffle(edges)
    parent = {v: v for e in edges for v in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    d = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert {r.node: r.root for r in minhash.union_find(d).collect()} == {v: find(v) for v in parent}
    assert minhash.union_find(d.limit(0)).collect() == []


def test_hub_is_dealt_out(frame, monkeypatch):
    monkeypatch.setattr(minhash, "LINKS_PER_TASK_GROUP", 3)
    base = [f"w{i}" for i in range(80)]
    every = [" ".join(base[:i] + [f"y{i}"] + base[i + 1:]) for i in range(0, 80, 3)]
    rows = minhash.group(frame(every)).collect()
    assert len({r.group_id for r in rows}) == 1


def test_keep_one(frame, texts):
    d = frame(["a b c d e f", "A b c d e f", "", "", None, "other words here"], ids=[1, 1, 2, 2, None, None])
    out = minhash.keep_one(d)
    assert out.columns == d.columns
    assert sorted(r.word for r in out.collect()) == [0, 2, 3, 4, 5]
    assert minhash.keep_one(d.limit(0)).collect() == []
    clash = d.withColumnsRenamed({"word": "Group_ID", "source": "row_id"})
    assert minhash.group(clash).columns == ["doc_id", "text", "row_id", "n_shingles", "group_id"]
    kept = minhash.keep_one(clash)
    assert kept.columns == ["doc_id", "text", "row_id", "Group_ID"]
    assert sorted(r.Group_ID for r in kept.collect()) == [0, 2, 3, 4, 5]


def test_a_family_just_below_the_threshold_makes_no_pairs(spark):
    """Texts of one length that share three quarters of their shingles, all of
    them open: the positions in the join key keep them apart."""
    shared = " ".join(f"t{i}" for i in range(120))
    texts = [(i, f"{shared} " + " ".join(f"u{i}_{j}" for j in range(20))) for i in range(60)]
    docs = spark.createDataFrame(texts, "cls long, text string")
    grams = [[tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)] for _, t in texts]
    assert len(set(grams[0]) & set(grams[1])) / len(set(grams[0]) | set(grams[1])) < 0.76
    sides = docs.select("cls", F.lit(len(set(grams[0]))).cast("long").alias("n"), F.col("cls").alias("root"), F.lit(True).alias("outer"))
    assert minhash._prefix_pairs(sides, docs, 5, 80).count() == 0
    # Texts of one length that do share enough still meet.
    near = spark.createDataFrame([(i, f"{shared} {shared[::-1]} u{i}") for i in range(6)], "cls long, text string")
    n = near.select("cls", F.lit(len(f"{shared} {shared}".split()) + 1 - 4).cast("long").alias("n")).join(sides.drop("n"), "cls")
    assert minhash._prefix_pairs(n, near, 5, 80).count() == 15
