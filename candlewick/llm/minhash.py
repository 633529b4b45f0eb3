"""Near-duplicate groups: SuperMinHash signatures, banding, verification on the
full shingle sets and union-find grouping.

SuperMinHash gives each element a random permutation of the signature's slots;
the element offers rank + fraction to the slot at that rank, and a slot keeps
its smallest offer. Ranks are worked off level by level for all elements of a
batch: once every slot of a text lies below the next level, no later rank can
lower it and the text stops early.

Texts with equal sets form one class; only classes are compared. In every band
bucket all classes are compared with the bucket's most central one; verified links are
grouped; then the classes of buckets that are still split into several groups
are compared, as far as an exact prefix and position filter on their shingles
lets a link be possible. So no bucket emits all its pairs, no group is held by
one task, and no link between found candidates is lost.

With 40 bands of 5 slots a pair at similarity 0.8 shares no bucket with
probability (1 - 0.8^5)^40 = 1.3e-7.

Words are runs of anything but ASCII white space, A-Z lower-cased; shingles are
64-bit hashes of ``width`` words; a text with fewer words has its whole sequence
as the one shingle. Null texts and texts without words have empty sets and are
linked with nothing. Rows are told apart by an id given when they are written,
so repeated rows and null or repeated keys are fine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import materialise, portions, table, without

WIDTH = 5
SIMILARITY_PCT = 80
BANDS = 40
BAND_SLOTS = 5
CACHE_ENTRIES = 1_000_000
LINKS_PER_TASK_GROUP = 500

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHash(dict):
    """64-bit hashes of words, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_words = _WordHash()


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    out = []
    for t in texts:
        words = (t or "").encode().lower().split()
        n = len(words)
        if not n:
            out.append(np.empty(0, np.uint64))
            continue
        w = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
        size = min(n, width)
        h = np.full(n - size + 1, size, np.uint64)
        for i in range(size):
            h = h * _ODD + w[i:n - size + 1 + i]
        out.append(np.unique(_mix(h)))
    return out


def superminhash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` values per set (infinite for empty sets)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    best = np.full((len(sets), slots), np.inf)
    flat = best.reshape(-1)
    x = np.concatenate(sets) if len(sets) else np.empty(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    swaps: list[np.ndarray] = []  # the positions swapped with 0, 1, 2, ...
    order = None  # each element's permutation, once few elements are left
    for level in range(slots):
        if not len(x):
            break
        r = _mix(x + np.uint64(int(_ODD) * (level + 1) & 0xFFFFFFFFFFFFFFFF))
        pos = level + ((r >> np.uint64(32)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
        offer = level + (r & np.uint64(0xFFFFFFFF)).astype(np.float64) / 4294967296.0
        if order is None:
            # The slot at pos after the swaps so far, traced back.
            slot = pos
            for i in range(level - 1, -1, -1):
                slot = np.where(swaps[i] == slot, i, slot)
            swaps.append(pos)
        else:
            e = np.arange(len(x))
            slot = order[e, pos].astype(np.int64)
            order[e, pos] = order[:, level]
        np.minimum.at(flat, row * slots + slot, offer)
        # A text whose slots all lie below the next level is done.
        busy = (best.max(axis=1) >= level + 1)[row]
        if not busy.all():
            x, row = x[busy], row[busy]
            swaps = [s[busy] for s in swaps]
            order = None if order is None else order[busy]
        if order is None and level == 5:
            order = np.tile(np.arange(slots, dtype=np.int16), (len(x), 1))
            e = np.arange(len(x))
            for i, s in enumerate(swaps):
                a, b = order[e, i].copy(), order[e, s].copy()
                order[e, s], order[e, i] = a, b
            swaps = []
    return best


def band_hashes(signature: np.ndarray, bands: int) -> np.ndarray:
    """One signed 64-bit hash per band; the band's number is part of it."""
    v = signature.view(np.uint64).reshape(len(signature), bands, -1)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), v.shape[:2]).copy()
    for i in range(v.shape[2]):
        h = _mix(h * _ODD + v[:, :, i])
    return h.view(np.int64)


def signatures(df: DataFrame, text: str, width: int, bands: int, band_slots: int) -> DataFrame:
    """``df`` with n_shingles, the set's 128-bit fingerprint and the band hashes."""
    names = df.columns
    at = names.index(text)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for part in portions(batch, at):
                sets = shingle_sets(part.column(at).to_pylist(), width)
                hashes = band_hashes(superminhash(sets, bands * band_slots), bands)
                ends = pa.array(np.arange(0, len(sets) * bands + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(ends, pa.array(hashes.reshape(-1)))],
                    names=[*names, "n_shingles", "fingerprint", "bands"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(sign, f"{fields}, n_shingles long, fingerprint binary, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """a, b, both set sizes' shared count of each pair. ``texts``: cls, text.

    A pair's smaller class is read once for up to LINKS_PER_TASK_GROUP partners;
    beyond that it is dealt to several groups, so a hub fills no task."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")))
    right = salted.join(texts.withColumnRenamed("cls", "b"), "b").select("a", "salt", "b", "text")
    left = (salted.select("a", "salt").distinct().join(texts.withColumnRenamed("cls", "a"), "a")
            .select("a", "salt", F.lit(None).cast("long").alias("b"), "text"))
    both = left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.empty(0, np.uint64)
        for batch in batches:
            for part in portions(batch, 3):
                a, b = part.column(0).to_pylist(), part.column(2).to_pylist()
                out_a, out_b, shared, union = [], [], [], []
                for x, y, s in zip(a, b, shingle_sets(part.column(3).to_pylist(), width)):
                    if y is None:
                        own = s
                        continue
                    both = len(own) + len(s) - len(np.union1d(own, s))
                    out_a.append(x)
                    out_b.append(y)
                    shared.append(both)
                    union.append(len(own) + len(s) - both)
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64()),
                                                  pa.array(shared, pa.int64()), pa.array(union, pa.int64())],
                                                 names=["a", "b", "shared", "united"])

    return both.mapInArrow(compare, "a long, b long, shared long, united long")


def _parts(pairs: DataFrame) -> DataFrame:
    """Add the number of groups that a pair's first class is dealt to."""
    many = (pairs.groupBy("a").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > LINKS_PER_TASK_GROUP)
            .select("a", F.ceil(F.col("c") / LINKS_PER_TASK_GROUP).alias("parts")))
    return pairs.join(many, "a", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))


LENGTH_BAND = 1.05  # sets of one band differ by less than this in length


def _prefix_pairs(sides: DataFrame, texts: DataFrame, width: int, pct: int) -> DataFrame:
    """Pairs a < b of different roots, one of them ``outer``, that may be links.

    With the shingles of every set in one order, rarest first, two sets that
    are similar enough share one of their first n - ceil(n pct / 100) + 1
    shingles, and behind the first shared one enough shingles are left for the
    overlap needed. Exact: what this leaves out is no link. Passages that many
    texts share come last in the order, so they make no pairs; which places will
    do is part of the join's key, so pairs that can't be links are not formed."""
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 1):
                sets = shingle_sets(part.column(1).to_pylist(), width)
                cls = np.repeat(part.column(0).to_numpy(), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(np.concatenate(sets).view(np.int64))],
                                                 names=["cls", "gram"])

    every = texts.join(sides.select("cls"), "cls", "left_semi").select("cls", "text").mapInArrow(grams, "cls long, gram long")
    # Shingles of one set only match nothing; they hold the first places.
    common = every.groupBy("gram").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    own = Window.partitionBy("cls")
    # The planner cannot know how many shingles come out: no broadcast of them.
    ranked = (every.hint("merge").join(common, "gram").join(sides, "cls")
              .withColumn("place", F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("c", "gram")) - 1)
              .where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * pct / 100))
              .select("gram", "cls", "n", "root", "outer", "place"))
    ranked = materialise(ranked, "prefixes")
    # Both sides name, beside the shingle, the length bands of the two sets, and
    # only bands for whose shortest set enough shingles are left: a family of texts
    # just below the threshold shares shingles, but not at places that could do.
    band = F.floor(F.log("n") / math.log(LENGTH_BAND))

    def keyed(side: DataFrame, own: str, other: str) -> DataFrame:
        reach = math.ceil(math.log(100 / pct) / math.log(LENGTH_BAND)) + 1
        s = side.withColumn(own, band).withColumn(other, F.explode(F.sequence(F.col(own) - reach, F.col(own) + reach)))
        shortest = F.greatest(F.lit(1), F.floor(F.pow(F.lit(LENGTH_BAND), F.col(other)) - 1))
        return s.where((F.col("n") - F.col("place")) * (100 + pct) >= (F.col("n") + shortest) * pct)

    x = keyed(ranked.where("outer"), "x_band", "y_band").select(
        "gram", "x_band", "y_band", *(F.col(c).alias(f"x_{c}") for c in ("cls", "n", "root", "place")))
    y = keyed(ranked, "y_band", "x_band").select(
        "gram", "x_band", "y_band", *(F.col(c).alias(f"y_{c}") for c in ("cls", "n", "root", "outer", "place")))
    left = F.least(F.col("x_n") - F.col("x_place"), F.col("y_n") - F.col("y_place"))
    return (x.join(y, ["gram", "x_band", "y_band"]).where((F.col("x_root") != F.col("y_root"))
                   & (~F.col("y_outer") | (F.col("x_cls") < F.col("y_cls")))
                   & (F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * pct)
                   & (left * (100 + pct) >= (F.col("x_n") + F.col("y_n")) * pct))
            .select(F.least("x_cls", "y_cls").alias("a"), F.greatest("x_cls", "y_cls").alias("b")).distinct())


def union_find(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of ``edges``
    (a, b: long).

    Each task first joins its own edges by union-find and passes on a forest;
    then rounds of star contraction link every node to smaller ones until
    nothing changes. All state is in tables."""

    def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while (p := parent.setdefault(root, root)) != root:
                root = p
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for pdf in batches:
            for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist()):
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
        out = [(v, find(v)) for v in parent]
        yield pd.DataFrame([p for p in out if p[0] != p[1]], columns=["a", "b"], dtype="int64")

    now = materialise(edges.mapInPandas(forest, "a long, b long").distinct(), "forest")
    before = None
    while True:
        # Every edge is (larger, smaller). Large star: larger neighbours of a
        # node go to the node's smallest neighbour.
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(least.where("a > m")).distinct()
        # Small star: smaller neighbours of a node go to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = materialise(small.where("a <> b").distinct(), "stars")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def group(df: DataFrame, text: str = "text", width: int = WIDTH, similarity_pct: int = SIMILARITY_PCT,
          bands: int = BANDS, band_slots: int = BAND_SLOTS) -> DataFrame:
    """``df`` with ``row_id`` (unique), ``n_shingles`` and ``group_id`` (the
    smallest row_id of its group); columns of these names are replaced."""
    df = without(df, "row_id", "n_shingles", "group_id")
    # Own names for the input's columns; the text is the last.
    own = {c: f"o{i}" for i, c in enumerate(df.columns)}
    flat = df.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()), F.monotonically_increasing_id().alias("row_id"))
    signed = materialise(signatures(flat, own[text], width, bands, band_slots), "signed")
    # Classes: equal sets. Only sets with shingles take part.
    classes = materialise(
        signed.where("n_shingles > 0").groupBy("fingerprint", "n_shingles")
        .agg(F.min("row_id").alias("cls"), F.first("bands").alias("bands")), "classes")
    buckets = classes.select("cls", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    together = materialise(buckets.join(shared, "bucket").select("bucket", "cls", "n", "c"), "buckets")
    # A bucket's head is its most central class: the one that meets most others
    # over all bands. Of copies of one text that is the text itself, so its
    # links join them even where two copies are too far apart.
    weight = together.groupBy("cls").agg(F.sum("c").alias("w"))
    weighed = together.join(weight, "cls")
    heads = weighed.groupBy("bucket").agg(F.max(F.struct("w", (-F.col("cls")).alias("cls"), "n")).alias("head")).select(
        "bucket", (-F.col("head.cls")).alias("head"), F.col("head.n").alias("head_n"))
    members = materialise(together.join(heads, "bucket").select("bucket", "cls", "n", "head", "head_n"), "members")
    texts = (members.select("cls").distinct()
             .join(signed.select(F.col("row_id").alias("cls"), F.col(own[text]).alias("text")), "cls"))
    texts = materialise(texts, "texts")

    def linked(p):
        return p.where(F.col("shared") * 100 >= F.col("united") * similarity_pct).select("a", "b")

    # 1. Every class against the head of each of its buckets.
    spokes = members.where(F.col("cls") != F.col("head")).select(
        F.col("head").alias("a"), F.col("cls").alias("b")).distinct()
    first = materialise(_verified(_parts(spokes), texts, width), "spokes")
    roots = union_find(linked(first))
    # 2. Pairs of one bucket that are not yet in one group: each has a side
    # outside the group of its bucket's head.
    label = roots.withColumnRenamed("node", "cls")
    placed = (members.join(label, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
              .join(label.select(F.col("cls").alias("head"), F.col("root").alias("head_root")), "head", "left")
              .withColumn("outer", F.col("root") != F.coalesce("head_root", "head")))
    open_buckets = placed.where("outer").select("bucket").distinct()
    sides = materialise(placed.join(open_buckets, "bucket").groupBy("cls", "n", "root").agg(F.max("outer").alias("outer")),
                        "sides")
    pairs = _prefix_pairs(sides, texts, width, similarity_pct).join(first.select("a", "b"), ["a", "b"], "left_anti")
    second = materialise(linked(_verified(_parts(materialise(pairs, "pairs")), texts, width)), "links")
    roots = union_find(linked(first).union(second))
    # Back to rows: fingerprint -> class -> group.
    ids = classes.select("fingerprint", "n_shingles", "cls").join(
        roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "fingerprint", "n_shingles", F.coalesce("root", "cls").alias("__group"))
    out = signed.join(ids, ["fingerprint", "n_shingles"], "left")
    return out.select(*(F.col(n).alias(c) for c, n in own.items()), "row_id", "n_shingles",
                      F.coalesce("__group", "row_id").alias("group_id"))


def keep_one(df: DataFrame, text: str = "text", **parameters) -> DataFrame:
    """The rows without later copies: of each group the row of smallest row_id
    stays, with its own columns."""
    g = group(df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("own"), F.col(f"`{text}`").alias("text")),
              **parameters)
    return g.where(F.col("row_id") == F.col("group_id")).select("own.*")


def op10_superminhash(spark, sf_dir) -> DataFrame:
    """Groups of all documents on 4-word shingles."""
    g = materialise(group(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4)
                    .select("doc_id", "n_shingles", "group_id"), "grouped")
    least = g.groupBy("group_id").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("c"))
    several = least.where("c > 1").select("group_id", "component_id")
    out = g.join(several, "group_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
