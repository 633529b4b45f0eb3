"""Ranked lexical search by pipelined term partitioning.

The index is cut twice. By term: every term of the items belongs to one owner,
rarest terms to the first, commonest to the last. By document: documents are
dealt by hash into slices of about ``SLICE_DOCS``, so a term that stands in every
document is a list of bounded pieces. A bundle of items visits the owners one
after the other; each stage is a cogroup of the bundle's accumulators with the
owner's postings on (bundle, slice). It adds integer contributions and passes the
accumulators on: sparse lists of (place in the slice, score so far). The last
stage selects each item's best of the slice, and a top-k over the slices follows.

As rare terms come first, accumulators stay few until the last stage. A stage
also drops a document whose score plus the most that later owners can add stays
below the item's k-th score of the slice: it can't reach the result, so nothing
is lost.

Documents and items are told apart by row, so repeated rows count as often as
they occur. Null or empty texts have no terms; items without a known term get no
rows. Equal scores go by ascending doc_id, null ids last. Extra columns are not
read. Empty tables give an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import materialise, portions, table

TOP = 20
SLICE_DOCS = 8_192
BUNDLE_ITEMS = 256
# Owners by the share of documents that hold the term: up to 1/64, 1/16, 1/4, all.
OWNER_SHARES = (64, 16, 4, 1)
FILTER_BITS = 1 << 22
SALTS = 16
UNIT = 1_000_000  # no document's part of a term's weight reaches it

# Bytes that end a term (those of other scripts never do).
SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
FOLD = bytes(0x20 if b in SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def term_counts(df: DataFrame, wanted: bytes | None = None) -> DataFrame:
    """Add to every row of (..., text) n, its number of terms, and the arrays
    terms and counts: the distinct terms and their occurrences. ``wanted`` (a
    bitmap over crc32) leaves out terms that no one asks for."""
    keys = [f for f in df.schema if f.name != "text"]
    bits = None if wanted is None else np.frombuffer(wanted, np.uint8)
    mask = FILTER_BITS - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bool] = {}

        def asked(term: bytes) -> bool:
            hit = known.get(term)
            if hit is None:
                at = zlib.crc32(term) & mask
                hit = known[term] = bool(bits[at >> 3] >> (at & 7) & 1)
            return hit

        for batch in batches:
            for part in portions(batch, len(keys)):
                n, ends, terms, counts = [], [0], [], []
                for text in part.column(len(keys)).to_pylist():
                    words = (text or b"").translate(FOLD).split()
                    n.append(len(words))
                    found = Counter(words)
                    if bits is not None:
                        found = {t: c for t, c in found.items() if asked(t)}
                    terms += found.keys()
                    counts += found.values()
                    ends.append(len(terms))
                if len(known) > 500_000:
                    known.clear()
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keys)], pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(terms, pa.binary()).cast(pa.string())),
                     pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))],
                    names=[*(f.name for f in keys), "n", "terms", "counts"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    return df.select(*(f.name for f in keys), F.col("text").cast("binary").alias("text")).mapInArrow(
        count, f"{kinds}, n long, terms array<string>, counts array<long>")


def bitmap(terms: DataFrame) -> bytes:
    """FILTER_BITS bits, set at the crc32 of each term: half a megabyte,
    however many terms there are."""
    at = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit(FILTER_BITS - 1))
    # Bucket numbers count from 1 and hold 32,768 bits.
    rows = terms.groupBy(F.bitmap_bucket_number(at + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits")).collect()
    out = bytearray(FILTER_BITS // 8)
    for r in rows:
        out[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = r["bits"]
    return bytes(out)


def _pieces(docs: int, terms: int):
    """Postings of one slice: for each term the places of its documents and
    their parts, in 32-bit binaries; under the empty term the doc_ids."""
    def pack(rows: pa.Table) -> pa.Table:
        order = pa.compute.sort_indices(rows, [("doc_id", "ascending"), ("row", "ascending")])
        rows = rows.take(order).combine_chunks()
        slice_no = rows.column("slice")[0].as_py()
        lists = rows.column("terms").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        place = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        m = 100 - 25 + (25 * rows.column("n").to_numpy() * docs) // terms
        tf = rows.column("counts").combine_chunks().flatten().to_numpy()
        part = ((1_000_000_000 * tf) // (1_000 * tf + 12 * m[place])).astype(np.int32)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        by_term = np.argsort(codes, kind="stable")
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        cut = [by_term[a:b] for a, b in zip(np.concatenate([[0], ends[:-1]]), ends)] if len(codes) else []
        ids = rows.column("doc_id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        names = coded.dictionary.to_pylist() if len(codes) else []
        return pa.table({
            "slice": pa.array([slice_no] * (len(cut) + 1), pa.int64()),
            "term": pa.array([*names, ""], pa.string()),
            "places": pa.array([*(place[c].tobytes() for c in cut), np.packbits(null).tobytes()], pa.binary()),
            "parts": pa.array([*(part[c].tobytes() for c in cut),
                               ids.fill_null(0).to_numpy().astype(np.int64).tobytes()], pa.binary())})
    return pack


def _visit(k: int, last: bool):
    """One owner's stage for one (bundle, slice)."""
    def visit(key: tuple, carried: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        bundle, slice_no = key
        scores: dict[int, np.ndarray] = {}
        rest: dict[int, int] = {}
        ids = None
        size = 0
        lists = []
        for row in postings.itertuples(index=False):
            if row.term == "":
                ids = np.frombuffer(row.parts, np.int64)
                null = np.unpackbits(np.frombuffer(row.places, np.uint8))[:len(ids)].astype(bool)
            else:
                places = np.frombuffer(row.places, np.int32)
                lists.append((row, places))
                size = max(size, int(places[-1]) + 1)
        held = [(r.item, np.frombuffer(r.places, np.int32), np.frombuffer(r.scores, np.int64))
                for r in carried.itertuples(index=False)]
        size = max([size, *(int(p[-1]) + 1 for _, p, _ in held)])
        for item, places, score in held:
            scores[item] = np.zeros(size, np.int64)
            scores[item][places] = score
        for row, places in lists:
            gain = np.frombuffer(row.parts, np.int32).astype(np.int64) * row.weight
            for item, repeats, most in zip(row.items, row.repeats, row.rests):
                if (own := scores.get(item)) is None:
                    own = scores[item] = np.zeros(size, np.int64)
                own[places] += gain * repeats
                rest[item] = most
        out = []
        for item, own in scores.items():
            places = np.flatnonzero(own)
            score = own[places]
            # An item without postings here goes on as it came.
            if len(places) > k and (last or item in rest):
                kth = np.partition(score, len(score) - k)[len(score) - k]
                near = score + rest.get(item, 0) >= kth
                places, score = places[near], score[near]
            if last:
                best = np.lexsort((places, -score))[:k]
                out += [(item, slice_no, int(p), None if null[p] else int(ids[p]), int(s))
                        for p, s in zip(places[best], score[best])]
            elif len(places):
                out.append((bundle, slice_no, item, places.astype(np.int32).tobytes(), score.tobytes()))
        names = (["item", "slice", "place", "doc_id", "score"] if last else
                 ["bundle", "slice", "item", "places", "scores"])
        return pd.DataFrame(out, columns=names, dtype=object)
    return visit


CARRIED = "bundle long, slice long, item long, places binary, scores binary"


def search(items: DataFrame, docs: DataFrame, k: int = TOP, slice_docs: int = SLICE_DOCS,
           bundle_items: int = BUNDLE_ITEMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item.
    ``items``: item_id, text; ``docs``: doc_id, text."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    asked = materialise(term_counts(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())),
                        "items")
    words = asked.select("item", F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(
        "item", F.col("t.terms").alias("term"), F.col("t.counts").alias("repeats"))
    counted = materialise(term_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                                      bitmap(words)).where("n > 0").withColumn("row", F.monotonically_increasing_id()),
                          "counted")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    slices = max(1, -(-n_docs // slice_docs))
    bundles = max(1, -(-asked.count() // bundle_items))

    # The plan of the visits: per (term, bundle) its weight, owner and items, each
    # with the most that later owners can add.
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(F.lit(1000) * F.log((F.lit(2) * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    owner = F.lit(len(OWNER_SHARES) - 1)
    for i, share in reversed(list(enumerate(OWNER_SHARES[:-1]))):
        owner = F.when(F.col("df") * share <= n_docs, F.lit(i)).otherwise(owner)
    visits = materialise(words.join(df.select("term", weight.alias("weight"), owner.alias("owner")), "term"), "visits")
    later = visits.groupBy("item", "owner").agg(F.sum(F.col("weight") * F.col("repeats") * UNIT).alias("most"))
    after = Window.partitionBy("item").orderBy("owner").rowsBetween(1, Window.unboundedFollowing)
    later = later.select("item", "owner", F.coalesce(F.sum("most").over(after), F.lit(0)).alias("rest"))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles))
    plan = (visits.join(later, ["item", "owner"]).withColumn("bundle", bundle)
            .groupBy("term", "bundle", "owner", "weight")
            .agg(F.collect_list(F.struct("item", "repeats", "rest")).alias("i"))
            .select("term", "bundle", "owner", "weight", F.col("i.item").alias("items"),
                    F.col("i.repeats").alias("repeats"), F.col("i.rest").alias("rests")))
    none = F.array().cast("array<bigint>")
    ids = spark.range(bundles).select(F.lit("").alias("term"), F.col("id").alias("bundle"),
                                      F.lit(len(OWNER_SHARES) - 1).alias("owner"), F.lit(0).cast("long").alias("weight"),
                                      none.alias("items"), none.alias("repeats"), none.alias("rests"))
    salted = plan.unionByName(ids).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    pieces = (counted.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices))).groupBy("slice")
              .applyInArrow(_pieces(n_docs, n_terms), "slice long, term string, places binary, parts binary"))
    routed = materialise(pieces.withColumn("salt", F.pmod(F.xxhash64("slice"), F.lit(SALTS)).cast("int"))
                         .join(salted, ["term", "salt"]).drop("salt"), "routed")

    carried = spark.createDataFrame([], CARRIED)
    for i in range(len(OWNER_SHARES)):
        last = i == len(OWNER_SHARES) - 1
        carried = carried.groupBy("bundle", "slice").cogroup(
            routed.where(F.col("owner") == i).groupBy("bundle", "slice")).applyInPandas(
            _visit(k, last), "item long, slice long, place int, doc_id long, score long" if last else CARRIED)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "slice", "place")
    ranked = carried.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select(
        F.col("item_id").cast(kind).alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_pipelined_terms(spark, sf_dir) -> DataFrame:
    """The 20 best of all documents for every benchmark item."""
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


# RE2 form of the term pattern; lower case of A-Z only.
SQL = rf"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM size),
m AS (SELECT doc_id, (75 + (25 * n * nn) // l)::BIGINT AS m FROM size, total),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM d GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
part AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS s FROM tf JOIN m USING (doc_id) JOIN w USING (term)),
score AS (SELECT item_id, doc_id, sum(s)::BIGINT AS score FROM i JOIN part USING (term) GROUP BY item_id, doc_id HAVING sum(s) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM score)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {TOP}
"""
