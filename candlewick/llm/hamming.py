"""Exact top-k by Hamming distance with incremental multi-index hashing.

Vectors become binary codes (sign bits). A code is cut into 16-bit segments; an
index holds the codes by the value of each segment. If a code lies within
``m (r + 1) - 1`` bits of a query over ``m`` segments, one of its segments lies
within r bits. So a search tries all segment values within radius 0, 1, 2, ...,
verifies the codes found there, and stops once the k-th verified distance is
covered by the radius: the result is exact.

Equal codes are one entry that holds its k + 1 smallest ids, so groups of copies
cost no more than one vector. The entries are dealt into blocks of bounded size;
every block answers every block of queries by itself, and only each block's best
k + 1 rows are merged. Ties are broken by id. Null vectors and null ids take no
part; null and NaN elements count as not positive; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import materialise, table

K = 10
SEGMENT = 16
BLOCK_CODES = 1 << 16
QUERY_BLOCK = 1 << 10
QUERY_EVERY = 20
MAX_TASKS = 20_000


def codes(df: DataFrame, key: str, vector: str, bits: int) -> DataFrame:
    """id and code (binary): bit i is set where element i is positive."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                part = batch.slice(at, 2_000)
                positive = pc.fill_null(pc.greater(part.column(1).flatten(), 0), False).to_numpy(zero_copy_only=False)
                size = pc.list_value_length(part.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                x = np.zeros((len(size), -(-bits // 64) * 64), bool)
                own = place < bits
                x[row[own], place[own]] = positive[own]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c.tobytes() for c in np.packbits(x, axis=1)], pa.binary())],
                    names=["id", "code"])

    d = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return d.mapInArrow(sign, "id long, code binary")


def _segments(words: np.ndarray) -> np.ndarray:
    """(n, segments) 16-bit values of (n, words) 64-bit codes."""
    return np.ascontiguousarray(words).view(np.uint16).reshape(len(words), -1)


def _masks(radius: int) -> np.ndarray:
    """All 16-bit values with ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), radius)], np.uint16)


class Index:
    """The entries of one block by segment value."""

    def __init__(self, words: np.ndarray, weights: np.ndarray):
        self.words, self.weights, self.segments = words, weights, _segments(words)
        self.order = np.argsort(self.segments, axis=0, kind="stable")
        self.start = np.stack([np.concatenate([[0], np.cumsum(np.bincount(s, minlength=1 << SEGMENT))])
                               for s in self.segments.T])

    def search(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query, entry and distance of all entries up to each query's k-th
        distance (entries count with their weights)."""
        m, bits = self.segments.shape[1], 64 * self.words.shape[1]
        own = _segments(query)
        seen = np.zeros((len(query), bits + 1), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        left = np.arange(len(query))
        for radius in range(SEGMENT + 1):
            masks = _masks(radius)
            for s in range(m):
                # A few queries at a time, so that candidates stay few.
                for part in np.array_split(left, max(1, len(left) * len(masks) // 200_000 + len(left) // 64)):
                    probe = own[part, s][:, None] ^ masks[None, :]
                    a, b = self.start[s][probe], self.start[s][probe.astype(np.int64) + 1]
                    n = (b - a).ravel()
                    if not n.sum():
                        continue
                    hit = n > 0
                    first, n = a.ravel()[hit], n[hit]
                    q = np.repeat(np.repeat(part, len(masks))[hit], n)
                    at = np.arange(n.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
                    e = self.order[at, s]
                    # Found before if an earlier radius or segment reaches it.
                    apart = np.bitwise_count(self.segments[e] ^ own[q])
                    new = (apart[:, :s] > radius).all(axis=1) & (apart[:, s + 1:] >= radius).all(axis=1)
                    q, e, d = q[new], e[new], apart[new].sum(axis=1, dtype=np.int64)
                    np.add.at(seen, (q, d), self.weights[e])
                    found.append((q, e, d))
            total = seen[left].cumsum(axis=1)
            kth = np.where(total[:, -1] >= k, (total >= k).argmax(axis=1), bits + 1)
            left = left[kth > m * (radius + 1) - 1]
            if not len(left):
                break
        q, e, d = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
        total = seen.cumsum(axis=1)
        bound = np.where(total[:, -1] >= k, (total >= k).argmax(axis=1), bits)
        near = d <= bound[q]
        return q[near], e[near], d[near]


def _answer(k: int):
    def answer(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_code": [], "id": [], "distance": []}).astype(
            {"query_code": object, "id": np.int64, "distance": np.int32})
        if not len(entries) or not len(queries):
            return none

        def words(column) -> np.ndarray:
            return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), -1)

        ids = [np.asarray(i, np.int64) for i in entries["ids"]]
        index = Index(words(entries["code"]), np.array([len(i) for i in ids]))
        q, e, d = index.search(words(queries["code"]), k)
        n = np.array([len(i) for i in ids])[e]
        q, d = np.repeat(q, n), np.repeat(d, n)
        i = np.concatenate([ids[x] for x in e]) if len(e) else np.empty(0, np.int64)
        order = np.lexsort((i, d, q))
        q, d, i = q[order], d[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        best = place < k
        return pd.DataFrame({"query_code": queries["code"].to_numpy()[q[best]], "id": i[best],
                             "distance": d[best].astype(np.int32)})
    return answer


def top_k(coded: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), neighbor_id, distance: the k nearest other rows
    of every query. ``coded`` and ``queries``: id, code (materialised). Fewer
    rows than k + 1 give what there is; ids should be unique (a repeated id is
    several entries)."""
    least = Window.partitionBy("code").orderBy("id")
    entries = (coded.withColumn("r", F.row_number().over(least)).where(F.col("r") <= k + 1)
               .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    entries = materialise(entries, "entries")
    asked = materialise(queries.select("code").distinct(), "asked")
    blocks = max(1, -(-entries.count() // BLOCK_CODES))
    parts = max(1, -(-asked.count() // QUERY_BLOCK))
    e = entries.withColumn("e", F.pmod(F.xxhash64("code"), F.lit(blocks))).withColumn(
        "q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    a = asked.withColumn("q", F.pmod(F.xxhash64(F.lit(7), "code"), F.lit(parts))).withColumn(
        "e", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # The work of a pair of blocks has nothing to do with its bytes: as many tasks as
    # pairs, which the planner must not merge.
    tasks = min(MAX_TASKS, blocks * parts)
    e, a = (x.repartition(tasks, "e", "q") for x in (e, a))
    near = e.groupBy("e", "q").cogroup(a.groupBy("e", "q")).applyInPandas(
        _answer(k + 1), "query_code binary, id long, distance int")
    merge = Window.partitionBy("query_code").orderBy("distance", "id")
    near = materialise(near.withColumn("r", F.row_number().over(merge)).where(F.col("r") <= k + 1).drop("r"), "near")
    # One row per query code: a shared code's answer is looked up, not shuffled by query.
    answers = near.groupBy("query_code").agg(F.sort_array(F.collect_list(F.struct("distance", "id"))).alias("near"))
    own = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query_code")).join(answers, "query_code")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("p", "n")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("n.id").alias("neighbor_id"),
        F.col("n.distance").cast("int").alias("distance"))


def op4_multi_index_hashing(spark, sf_dir) -> DataFrame:
    """The 10 nearest of every 20th embedding among all others."""
    d = table(spark, sf_dir, "embeddings")
    bits = d.agg(F.max(F.size("embedding"))).first()[0] or 64
    coded = materialise(codes(d, "vec_id", "embedding", bits), "codes")
    return top_k(coded, coded.where(F.col("id") % QUERY_EVERY == 0))


SQL = f"""
WITH c AS (
  SELECT vec_id, CAST(array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 AND NOT isnan(x) THEN '1' ELSE '0' END), '') AS BIT) AS code
  FROM embeddings
), p AS (
  SELECT q.vec_id AS query_id, n.vec_id AS neighbor_id, CAST(bit_count(xor(q.code, n.code)) AS INTEGER) AS distance
  FROM c q JOIN c n ON q.vec_id <> n.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, neighbor_id, distance FROM r WHERE rank <= {K}
"""
