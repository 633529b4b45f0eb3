"""Best-two-fit packing of token sequences.

A bin is filled greedily with the largest piece that fits; then, when two
unpacked pieces fit the gap left plus the room of the bin's smallest piece more
tightly, they replace that piece. Works on a histogram of lengths, so the cost
of a bin does not depend on the number of pieces.

Pieces are dealt by a hash into groups of about ``GROUP_PIECES`` and every group
is packed by itself: each group leaves at most a few half-filled bins, which is
below 0.1 % of its bins.
"""

from __future__ import annotations

import os
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.byte_bpe import byte_chars
from candlewick.llm.common import materialise, table, without

VOCABULARY = "word_bpe_49k.json"
SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 50_000
CACHE_ENTRIES = 400_000


# Upper case of ASCII to lower, and its breaks to blanks, before texts are cut.
FOLD = bytes(0x20 if b in b"\n\t\r" else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# ASCII marks that end a pre-token of letters; the apostrophe may go on with one.
MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordIds(dict):
    """Ids of whole texts by a tokenizers file that lower-cases, drops white
    space and splits letters from marks.

    Its pre-tokens never cross white space and its normaliser never joins what
    white space separates, so blank-separated chunks encode independently. This
    is a bounded cache of chunks to their ids, filled as chunks are met: a chunk
    of Latin letters is one pre-token and goes to the merges directly; one of
    letters and marks is the letters' ids and the marks'; anything else takes the
    whole tokenizer. Strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.merge = self.tok.model.tokenize
        self.chars = {b: ord(c) for b, c in enumerate(byte_chars())}
        self.four = [i.to_bytes(4, "little") for i in range(self.tok.get_vocab_size())]
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self._encode(chunk)
        self[chunk] = ids
        return ids

    def _encode(self, chunk: bytes) -> bytes:
        if chunk.isalpha():   # ASCII letters
            return self._merged(chunk.decode())
        letters = chunk.rstrip(MARKS)
        if letters and len(letters) < len(chunk) and (letters.isalpha() or self._latin(letters.decode())):
            return self[letters] + self[chunk[len(letters):]]
        text = chunk.decode()
        if self._latin(text):
            return self._merged(text.lower().encode().decode("latin-1").translate(self.chars))
        four = self.four
        return b"".join([four[i] for i in self.tok.encode(text, add_special_tokens=False).ids])

    @staticmethod
    def _latin(s: str) -> bool:
        # A capital I with dot turns into two characters in lower case.
        return s.isalpha() and max(s) < "\u0250" and "\u0130" not in s

    def _merged(self, s: str) -> bytes:
        four = self.four
        return b"".join([four[t.id] for t in self.merge(s)])

    def encode(self, texts: list[str | bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text (str or UTF-8)."""
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[b""] = b""
        get = self.__getitem__
        return [b"".join(map(get, (t.encode() if isinstance(t, str) else t or b"").translate(FOLD).split(b" ")))
                for t in texts]

    def forget(self) -> None:
        """Drop the cached chunks: a worker lives on and may have other work next."""
        self.older = {}
        self.clear()


@lru_cache(maxsize=2)
def word_ids(path: str | None = None) -> WordIds:
    import public_tokenizers

    return WordIds(path or public_tokenizers.path(VOCABULARY))


def tokenise(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SEQUENCE, end_id: int | None = END_ID,
             path: str | None = None, dtype: str = "<u4") -> DataFrame:
    """One row per piece: key, piece (from 0), start, length, ids (binary, of
    ``dtype``, little-endian unsigned 32-bit by default). A document is its ids and ``end_id``; only
    documents over ``size`` are cut, and only their last piece may be shorter.
    A null text is empty: it has the end id alone (no piece if there is none).
    Rows with equal or null keys stay separate rows."""
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    step = 4 * size
    recode = None if dtype == "<u4" else dtype

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = word_ids(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows, piece, ids = [], [], []
                for r, b in enumerate(w.encode(part.column(1).to_pylist())):
                    b += tail
                    for k in range(0, len(b), step):
                        rows.append(r)
                        piece.append(k // step)
                        ids.append(b[k:k + step] if len(b) > step else b)
                n = np.array(piece, dtype=np.int32)
                length = [len(x) // 4 for x in ids]
                if recode:
                    ids = [np.frombuffer(x, "<u4").astype(recode).tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(rows, pa.int32())), pa.array(n), pa.array(n.astype(np.int64) * size),
                    pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["key", "piece", "start", "length", "ids"])

    kind = df.schema[key].dataType.simpleString()
    out = df.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("key", key)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (all between 1 and ``capacity``)."""
    lengths = np.asarray(lengths, dtype=np.int64)
    n = len(lengths)
    if n and (lengths.min() < 1 or lengths.max() > capacity):
        raise ValueError("lengths must lie between 1 and the capacity")
    order = np.argsort(-lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1).tolist()
    there = [v for v, c in enumerate(left) if c]  # lengths with pieces left, ascending

    def largest(v: int) -> int:
        """The largest length up to v with pieces left (0: none)."""
        i = bisect_right(there, v)
        return there[i - 1] if i else 0

    def change(v: int, by: int) -> None:
        if not left[v]:
            insort(there, v)
        left[v] += by
        if not left[v]:
            del there[bisect_left(there, v)]

    def best_pair(room: int, more_than: int) -> tuple[int, int] | None:
        """Two unpacked pieces of the largest sum in (more_than, room]."""
        pair, best, i = None, more_than, bisect_right(there, room - 1)
        while i and 2 * (x := there[i - 1]) > best:
            y = largest(min(x, room - x))
            if y == x and left[x] < 2:
                y = largest(x - 1)
            if y and x + y > best:
                pair, best = (x, y), x + y
                if best == room:
                    break
            i -= 1
        return pair

    bins: list[list[int]] = []
    while there:
        own, gap = [], capacity
        while gap and (v := largest(gap)):
            take = min(left[v], gap // v)
            own += [v] * take
            change(v, -take)
            gap -= v * take
        if gap and len(own) > 1 and (pair := best_pair(gap + own[-1], own[-1])):
            change(own.pop(), 1)
            for v in pair:
                change(v, -1)
            own += pair
        bins.append(own)
    # Hand out the rows of each length in order.
    first = np.concatenate([[0], np.cumsum(np.bincount(lengths, minlength=capacity + 1)[::-1])])
    at = {v: int(first[capacity - v]) for v in set(lengths.tolist())}
    bin_of, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, own in enumerate(bins):
        used = 0
        for v in own:
            row = order[at[v]]
            at[v] += 1
            bin_of[row], offset[row] = k, used
            used += v
    return bin_of, offset


def pack(pieces: DataFrame, capacity: int = SEQUENCE, length: str = "length", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to every piece; other columns pass through.

    Rows get an id when they are written to the shared folder, so equal rows
    are packed as separate pieces. An empty table gives an empty table; columns
    named like those added are replaced."""
    pieces = without(pieces, "sequence_id", "offset")
    kept = materialise(pieces.withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-kept.count() // group_pieces))
    kept = kept.withColumn("__group", F.pmod(F.xxhash64("__uid"), F.lit(groups)))
    names = [c for c in pieces.columns]

    def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__uid", ignore_index=True)
        k, offset = best_two_fit(pdf[length].to_numpy(), capacity)
        out = pdf[names].copy()
        out["sequence_id"] = pdf["__group"].to_numpy() * (1 << 32) + k
        out["offset"] = offset
        return out

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return kept.groupBy("__group").applyInPandas(pack_group, f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """One row per sequence: its pieces' ids in order (binary)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    return packed.groupBy("sequence_id").agg(
        F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def op6_best_two_fit(spark, sf_dir) -> DataFrame:
    """Every document's pieces with their places."""
    p = tokenise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pack(p.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
