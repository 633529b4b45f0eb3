"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its subwords: the byte 2- to 4-grams
of its lower-cased words, word edges included, hashed into ``BUCKETS`` rows. A
linear softmax over that average gives the language. Embeddings and weights are
trained together by stochastic gradient descent in numpy; each step draws a few
of a text's subwords, so that short texts are met as well as long ones.

Training takes at most ``PER_LANGUAGE`` labelled rows of each language (a
documented bound; languages are a closed set), those of the smallest seeded hash
among about twice as many drawn by that hash. Their whole texts are counted by Spark, one task trains, and every fifth row is
kept aside to calibrate: a temperature is fitted to it, and the rejection
threshold is the lowest score at and above which its predictions are right
``TARGET`` of the time. Rejected rows keep their language and are marked.

Prediction reads the whole text, with embeddings and weights multiplied out, in
windows of bounded size. Null texts and texts without a letter are ``und`` with
score 0, and so is everything when nothing was learned. Rows are judged one by
one, so repeats and ties need no rule (equal scores go to the smaller name). Input
columns named like a result are replaced; the others stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import materialise, portions, table

PER_LANGUAGE = 1_000
BUCKETS = 1 << 16
DIM = 16
EPOCHS = 6
LEAST_STEPS = 1_500
BATCH = 8
RATE = 0.5
DRAWS = (6, 20, 80, 300)
TARGET = 0.99
SEED = 20240131
WINDOW_BYTES = 1 << 19
UNKNOWN = "und"
GRAMS = (2, 3, 4)

# ASCII that is no letter ends a word; bytes of other scripts belong to it.
FOLD = np.array([b if chr(b).isalpha() and b < 0x80 or b >= 0x80 else 0x20 for b in range(256)], np.uint8)


@dataclass
class Model:
    labels: list[str]
    embeddings: np.ndarray  # (BUCKETS, DIM)
    weights: np.ndarray  # (DIM, labels)
    bias: np.ndarray
    temperature: float
    threshold: float

    def table(self) -> np.ndarray:
        """What each subword adds to the logits; the last row is for none."""
        out = np.zeros((BUCKETS + 1, len(self.labels)), np.float32)
        out[:BUCKETS] = self.embeddings @ self.weights
        return out


def _grams(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per n, the bucket of the n-gram at each of the first ``size`` places of
    folded bytes; BUCKETS where it holds no letter or crosses a word's edge."""
    wide, space = data.astype(np.uint32), data == 0x20
    value, inner = wide[:size], np.zeros(size, bool)
    for n in range(2, GRAMS[-1] + 1):
        value = value | wide[n - 1:n - 1 + size] << np.uint32(8 * (n - 1))
        if n > 2:
            inner = inner | space[n - 2:n - 2 + size]
        out = (value * np.uint32(2_654_435_761)) >> np.uint32(16)
        out[(space[:size] & space[1:1 + size]) if n == 2 else inner] = BUCKETS
        yield out


def _windows(column: pa.Array) -> Iterator[tuple[np.ndarray, int, np.ndarray, int]]:
    """Windows over a binary column whose values begin and end with a space:
    folded bytes (with three to spare), number of places, the places where a
    row begins or goes on, and the first such row."""
    wide = pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    for a in range(0, len(data), WINDOW_BYTES):
        b = min(a + WINDOW_BYTES, len(data))
        part = np.full(b - a + 3, 0x20, np.uint8)
        seen = data[a:b + 3]
        part[:len(seen)] = FOLD[seen]
        first = int(np.searchsorted(offsets, a, "right")) - 1
        last = int(np.searchsorted(offsets, b, "left"))
        yield part, b - a, np.maximum(offsets[first:last], a) - a, first


def _prepared(text: str) -> Column:
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    return F.concat(F.lit(" "), lower, F.lit(" ")).cast("binary")


def _has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def subwords(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ids (uint16) and counts (uint32) of each row's distinct subwords."""
    keys = [f for f in df.schema if f.name != text]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                total = np.zeros(BUCKETS + 1, np.int64)
                for part, size, _, _ in _windows(one.column(len(keys))):
                    for g in _grams(part, size):
                        total += np.bincount(g, minlength=BUCKETS + 1)
                ids = np.flatnonzero(total[:BUCKETS])
                yield pa.RecordBatch.from_arrays(
                    [*one.columns[:len(keys)], pa.array([ids.astype("<u2").tobytes()], pa.binary()),
                     pa.array([total[ids].astype("<u4").tobytes()], pa.binary())],
                    names=[*(f.name for f in keys), "ids", "counts"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    return df.select(*(f.name for f in keys), _prepared(text).alias("prepared")).mapInArrow(
        count, f"{kinds}, ids binary, counts binary")


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int,
          seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embeddings, weights and bias from rows of (ids, counts)."""
    rng = np.random.default_rng(seed)
    e = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    w, bias = np.zeros((DIM, classes), np.float32), np.zeros(classes, np.float32)
    ends = [np.cumsum(c, dtype=np.int64) for _, c in rows]
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(rows)))
    steps = epochs * -(-len(rows) // BATCH)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            picked = order[at:at + BATCH]
            sizes = rng.choice(DRAWS, len(picked))
            ids = np.concatenate([rows[i][0][np.searchsorted(ends[i], rng.integers(0, ends[i][-1], n), "right")]
                                  for i, n in zip(picked, sizes)])
            owner = np.repeat(np.arange(len(picked)), sizes)
            start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(e[ids], start) / sizes[:, None]
            off = _softmax(mean @ w + bias)
            off[np.arange(len(picked)), labels[picked]] -= 1
            rate = np.float32(RATE * (1 - step / steps))
            back = (off @ w.T) / sizes[:, None]
            w -= (rate * mean.T @ off).astype(np.float32)
            bias -= (rate * off.sum(axis=0)).astype(np.float32)
            # Every draw moves its own row: the step is that of the sum over draws.
            np.subtract.at(e, ids, (rate * DIM * back[owner]).astype(np.float32))
            step += 1
    return e, w, bias


def calibrate(logits: np.ndarray, labels: np.ndarray, target: float = TARGET) -> tuple[float, float]:
    """Temperature of the least log loss, and the rejection threshold."""
    if not len(labels):
        return 1.0, 0.0
    at = np.arange(len(labels))
    loss = {t: -np.log(np.maximum(_softmax(logits / t)[at, labels], 1e-12)).mean() for t in np.geomspace(0.05, 20, 61)}
    temperature = float(min(loss, key=loss.get))
    p = _softmax(logits / temperature)
    score, right = p.max(axis=1), p.argmax(axis=1) == labels
    order = np.argsort(-score, kind="stable")
    share = np.cumsum(right[order]) / (at + 1)
    good = np.flatnonzero(share >= target)
    return temperature, float(score[order][good[-1]]) if len(good) else 1.0


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model | None:
    """A model of the labelled rows (None if there are none)."""
    labelled = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & _has_letter("text")).withColumn(
        "h", F.xxhash64(F.lit(SEED), "key", F.length("text")))
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}   # one row per language
    if not sizes:
        return None
    # About twice the rows wanted, by the hash alone: what is ranked stays small.
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, 2.0 * per_language / n)))[F.col("lang")]
    drawn = labelled.where(F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53)) < share)
    sample = subwords(drawn.select("lang", "h", "text")).where(F.length("ids") > 0)
    least = Window.partitionBy("lang").orderBy("h")
    sample = materialise(sample.withColumn("few", F.row_number().over(least) <= per_language).where("few").drop("few"),
                         "language-sample")

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "lang", "ids", "counts"], ignore_index=True)
        labels = sorted(set(pdf["lang"]))
        y = pdf["lang"].map({v: i for i, v in enumerate(labels)}).to_numpy()
        rows = [(np.frombuffer(i, "<u2"), np.frombuffer(c, "<u4")) for i, c in zip(pdf["ids"], pdf["counts"])]
        aside = np.arange(len(rows)) % 5 == 4
        fitted = np.flatnonzero(~aside)
        e, w, bias = train([rows[i] for i in fitted], y[fitted], len(labels))
        ew = e @ w
        kept = np.flatnonzero(aside)
        logits = np.array([(rows[i][1] @ ew[rows[i][0]]) / rows[i][1].sum() + bias for i in kept]).reshape(-1, len(labels))
        temperature, threshold = calibrate(logits, y[kept])
        return pd.DataFrame({"labels": [labels], "e": [e.tobytes()], "w": [w.tobytes()], "b": [bias.tobytes()],
                             "temperature": [temperature], "threshold": [threshold]})

    found = sample.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(
        learn, "labels array<string>, e binary, w binary, b binary, temperature double, threshold double").first()
    if found is None:
        return None
    labels = list(found["labels"])
    return Model(labels, np.frombuffer(found["e"], np.float32).reshape(BUCKETS, DIM),
                 np.frombuffer(found["w"], np.float32).reshape(DIM, len(labels)), np.frombuffer(found["b"], np.float32),
                 found["temperature"], found["threshold"])


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Add lang_pred, score (calibrated, 0 to 1) and rejected."""
    kept = [f for f in df.schema if f.name.lower() not in ("lang_pred", "score", "rejected")]
    asked = df.select(*(f"`{f.name}`" for f in kept), _has_letter(text).alias("__letter"), _prepared(text).alias("__prepared"))
    if model is None:
        return asked.drop("__letter", "__prepared").withColumns(
            {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0), "rejected": F.lit(True)})
    subword, bias, labels = model.table(), model.bias.astype(np.float64), np.array(model.labels, object)
    temperature, threshold, n = model.temperature, model.threshold, len(kept)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, n + 1, 2_000, WINDOW_BYTES):
                total = np.zeros((part.num_rows, len(labels)))
                count = np.zeros(part.num_rows)
                for data, size, starts, first in _windows(part.column(n + 1)):
                    gain = np.zeros((size, len(labels)), np.float32)
                    real = np.zeros(size, np.int64)
                    for g in _grams(data, size):
                        gain += subword[g]
                        real += g != BUCKETS
                    rows = slice(first, first + len(starts))
                    total[rows] += np.add.reduceat(gain, starts, axis=0, dtype=np.float64)
                    count[rows] += np.add.reduceat(real, starts)
                p = _softmax((total / np.maximum(count, 1)[:, None] + bias) / temperature)
                letter = part.column(n).to_numpy(zero_copy_only=False).astype(bool)
                score = np.where(letter, np.round(p.max(axis=1), 6), 0.0)
                name = np.where(letter, labels[p.argmax(axis=1)], UNKNOWN)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n], pa.array(name, pa.string()), pa.array(score), pa.array(score < threshold)],
                    names=[*(f.name for f in kept), "lang_pred", "score", "rejected"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return asked.mapInArrow(judge, f"{kinds}lang_pred string, score double, rejected boolean")


def op12_subword_softmax(spark, sf_dir) -> DataFrame:
    """The language of every document; learned from those not held out."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (fold == 2).alias("held_out"))
    model = fit(d.where("NOT held_out"))
    return predict(d.select("doc_id", "held_out", "text"), model).drop("text")
