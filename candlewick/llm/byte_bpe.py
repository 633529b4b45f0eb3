"""Byte-level BPE through a sentencepiece model serialised from a rank file.

The vocabulary of a tiktoken rank file becomes a sentencepiece BPE model without
training: every token's bytes are mapped to printable characters (one per
byte), its score is the negative rank, normalisation is the identity, and the
unknown piece takes the first free id. Sentencepiece then merges the pair of
highest score first, leftmost on ties, which is the lowest-rank rule.

Texts are cut into pre-tokens; each is encoded by itself. Decoding maps ids to
pieces, pieces to bytes. Nulls encode like empty texts (no ids); texts are never
cut; extra columns pass through; an output name that exists is an error.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import portions, table, without

RANKS = "byte_bpe_50k.tiktoken"
CACHE_ENTRIES = 200_000

# Fixed value: the code points with the Unicode property White_Space.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_chars() -> list[str]:
    """One character for each byte value: printable Latin-1 characters stand
    for themselves, the others follow from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank; the ranks must be 0, 1, 2, ..."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    if any(not t for t in tokens):
        raise ValueError("ranks have gaps")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """One protocol-buffer field: varint, 32-bit float or length-delimited."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model. Field numbers and enum
    values of the public sentencepiece_model.proto (ModelProto: pieces 1, trainer_spec 2,
    normalizer_spec 3; piece 1, score 2, type 3; type NORMAL 1, UNKNOWN 2;
    model_type 3 with BPE 2; unk, bos, eos and pad ids 40 to 43; normaliser
    name 1, add_dummy_prefix 3, remove_extra_whitespaces 4, escape_whitespaces 5)."""
    chars = byte_chars()
    pieces = [_field(1, _field(1, "".join(chars[b] for b in t).encode()) + _field(2, -float(rank)) + _field(3, 1))
              for rank, t in enumerate(tokens)]
    pieces.append(_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(40, len(tokens)) + b"".join(_field(n, -1) for n in (41, 42, 43))
    normalizer = _field(1, b"identity") + b"".join(_field(n, 0) for n in (3, 4, 5))
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class ByteBPE:
    """Encoder and decoder of one process, with bounded caches.

    A chunk is a blank and the characters up to the next blank, where both
    blanks touch no other white space: no pre-token crosses a chunk's end and
    none looks beyond it, so chunks encode independently. Texts with other
    blanks are cut at the pre-tokens themselves."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.whole = {t: i for i, t in enumerate(ranks)}
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.chars = {b: ord(c) for b, c in enumerate(byte_chars())}
        # Decoding: an id's piece, each character mapped back to its byte.
        back = {c: b for b, c in enumerate(byte_chars())}
        self.tokens = [bytes(back[c] for c in self.sp.id_to_piece(i)) for i in range(len(ranks))]
        self.find = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]")
                                  .replace(r"\S", f"[^{WHITE}]"), regex.V0).findall
        self.odd_blank = re.compile(f" [{WHITE}]|[{WHITE}] |^ | $").search
        self.pre_tokens: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _pre_token(self, s: str) -> bytes:
        raw = s.encode()
        # A token of the vocabulary stands for itself, as in the rank file's library.
        i = self.whole.get(raw)
        ids = self.sp.encode(raw.decode("latin-1").translate(self.chars)) if i is None else [i]
        out = np.array(ids, dtype=np.int32).tobytes()
        if len(self.pre_tokens) >= CACHE_ENTRIES:
            self.pre_tokens.clear()
        self.pre_tokens[s] = out
        return out

    def _cut(self, s: str) -> bytes:
        get = self.pre_tokens.get
        return b"".join([get(m) or self._pre_token(m) for m in self.find(s)])

    def _chunk(self, s: str) -> bytes:
        out = self._cut(" " + s)
        if len(self.chunks) >= CACHE_ENTRIES:
            self.chunks.clear()
        self.chunks[s] = out
        return out

    def encode(self, text: str) -> np.ndarray:
        if self.odd_blank(text):
            return np.frombuffer(self._cut(text), dtype=np.int32)
        first, *rest = text.split(" ")
        get = self.chunks.get
        return np.frombuffer(b"".join([self._cut(first), *[get(c) or self._chunk(c) for c in rest]]), dtype=np.int32)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str | None = None) -> ByteBPE:
    import public_tokenizers

    return ByteBPE(path or public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def _fields(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)


def encode(df: DataFrame, text: str = "text", out: str = "ids", decoded: str | None = None, keep_text: bool = True,
           path: str | None = None) -> DataFrame:
    """Add the token ids of every text; with ``decoded`` also the bytes that
    these ids stand for, mapped back in the same worker. ``keep_text=False``
    leaves the text out of the result. Columns named like those added are replaced."""
    df = without(df, out, *([decoded] if decoded else []))
    names = df.columns
    at = names.index(text)
    kept = df if keep_text else df.drop(text)
    result = [*kept.columns, out, *([decoded] if decoded else [])]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for part in portions(batch, at):
                lists = [c.encode(t or "") for t in part.column(at).to_pylist()]
                ends = np.cumsum([0, *map(len, lists)], dtype=np.int64).astype(np.int32)
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists)))]
                if decoded:
                    new.append(pa.array([c.decode(x.tolist()) for x in lists], pa.binary()))
                own = [x for i, x in enumerate(part.columns) if keep_text or i != at]
                yield pa.RecordBatch.from_arrays([*own, *new], names=result)

    return df.mapInArrow(code, f"{_fields(kept)}`{out}` array<int>" + (f", `{decoded}` binary" if decoded else ""))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the bytes that the ids stand for. Null ids decode to nothing."""
    df = without(df, out)
    at = df.columns.index(ids)
    result = [*df.columns, out]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                new = pa.array([c.decode(x or ()) for x in part.column(at).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, new], names=result)

    return df.mapInArrow(code, f"{_fields(df)}`{out}` binary")


def op3_byte_bpe(spark, sf_dir) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    d = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded", keep_text=False)
    return d.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
