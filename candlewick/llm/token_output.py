"""Training-order materialisation of token sequences.

Sequences get gapless numbers; a keyed Feistel permutation with cycle-walking
maps each number to a global slot, so the training order is a fixed shuffle that
needs no sort key and no state. Slots are cut into shards of ``shard_rows``;
rows go to their shard's range partition, are written in slot order with a fixed
stride, and any slot can be found by arithmetic: reads resume anywhere.

A row of a shard is an unsigned 32-bit length and ``size`` ids, zero-filled. To
waste no stride, documents (their ids and the end id) follow each other in the
rows of their task, which are full but for the task's last; ``pieces`` tells what
of which document stands where in a row. On the way to their shard, ids are
compressed with a dictionary made from a few rows.

Shards are written under names that no other attempt uses; the manifest lists
those of the attempts that finished. Null texts hold the end id alone; repeated
rows are separate documents; an empty table has no shard. Columns named like those
that are added are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.config import scratch_path
from candlewick.llm.common import materialise, numbered, open_store, table
from candlewick.llm.packing import END_ID, word_ids

SIZE = 512
DTYPE = "<u2"  # the vocabulary has fewer than 65,536 ids
SHARD_ROWS = 8192
KEY = 20240131
ROUNDS = 6
MAX_TASKS = 20_000


SAMPLE_ROWS = 1_500  # of which the dictionary is made; the ids are the same with any
DICTIONARY_BYTES = 1 << 16
LEVEL = 1


def _dictionary(rows: DataFrame) -> bytes | None:
    """A dictionary for the ids of some rows (None: too few to make one)."""
    try:
        return zstandard.train_dictionary(
            DICTIONARY_BYTES, [bytes(r.ids) for r in rows.select("ids").limit(SAMPLE_ROWS).collect()]).as_bytes()
    except zstandard.ZstdError:
        return None


def _codec(kind: type, dictionary: bytes | None, **options):
    return kind(dict_data=dictionary and zstandard.ZstdCompressionDict(dictionary), **options)


def filled(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, end_id: int = END_ID,
           dtype: str = DTYPE, path: str | None = None) -> DataFrame:
    """Rows of up to ``size`` ids: pieces (array of key, start in the document,
    offset in the row, length), length, ids (binary, of ``dtype``)."""
    tail = int(end_id).to_bytes(4, "little")
    item = np.dtype(dtype).itemsize

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = word_ids(path)
        pieces: list[tuple] = []   # of the rows that are done and the open one
        ends, lengths, ids = [0], [], []
        row: list[bytes] = []
        used = 0
        kind = None

        def close() -> None:
            nonlocal row, used
            ends.append(len(pieces))
            lengths.append(used)
            ids.append(b"".join(row))
            row, used = [], 0

        def frame() -> pa.RecordBatch:
            nonlocal pieces, ends, lengths, ids
            done = pieces[:ends[-1]]
            keys, start, offset, length = zip(*done)
            struct = pa.StructArray.from_arrays(
                [pa.array(keys, kind), pa.array(start, pa.int64()), pa.array(offset, pa.int32()), pa.array(length, pa.int32())],
                names=[key, "start", "offset", "length"])
            out = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct),
                                              pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                                             names=["pieces", "length", "ids"])
            pieces, ends, lengths, ids = pieces[ends[-1]:], [0], [], []
            return out

        for batch in batches:
            kind = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for k, raw in zip(part.column(0).to_pylist(), w.encode(part.column(1).to_pylist())):
                    own = np.frombuffer(raw + tail, "<u4").astype(dtype).tobytes()
                    n, at_id = len(own) // item, 0
                    while at_id < n:
                        take = min(size - used, n - at_id)
                        pieces.append((k, at_id, used, take))
                        row.append(own[item * at_id:item * (at_id + take)])
                        at_id, used = at_id + take, used + take
                        if used == size:
                            close()
                if lengths:
                    yield frame()
        w.forget()
        if used:
            close()
            yield frame()

    field = df.schema[key].dataType.simpleString()
    return df.select(key, F.col(text).cast("binary").alias("text")).mapInArrow(
        fill, f"pieces array<struct<`{key}`:{field},start:long,offset:int,length:int>>, length long, ids binary")


def permute(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of the numbers ``i`` (all in 0..n-1): a bijection of 0..n-1.

    A balanced Feistel network permutes the smallest even-bit domain that holds
    n; results beyond n - 1 are permuted again until they fall inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) & (1 << 64) - 1) for r in range(ROUNDS)]

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            f = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        return left << shift | right

    out = network(i.astype(np.uint64))
    while (over := np.flatnonzero(out >= n)).size:
        out[over] = network(out[over])
    return out.astype(np.int64)


def placed(rows: DataFrame, key: int = KEY, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """``rows`` with slot, shard and position; and the number of rows."""
    kept, n = numbered(rows)

    @F.arrow_udf(T.LongType())
    def to_slot(numbers: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in numbers:
            yield pa.array(permute(batch.to_numpy(zero_copy_only=False), n, key))

    kept = kept.drop("shard", "position").withColumn("slot", to_slot("number"))
    return kept.select("*", F.expr(f"slot div {shard_rows}").alias("shard"), (F.col("slot") % shard_rows).alias("position")), n


def write(rows: DataFrame, n: int, folder: str, size: int = SIZE, dtype: str = DTYPE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Write the shards of placed rows (slot, length, ids); returns the
    manifest (shard, file, first_slot, rows)."""
    shards = max(1, -(-n // shard_rows))
    tasks = min(shards, MAX_TASKS)
    width = np.dtype(dtype).itemsize * size
    dictionary = _dictionary(rows)

    @F.arrow_udf(T.BinaryType())
    def squeezed(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pack = _codec(zstandard.ZstdCompressor, dictionary, level=LEVEL, write_checksum=False, write_dict_id=False).compress
        for batch in ids:
            yield pa.array([pack(x.as_py()) for x in batch], pa.binary())

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(folder)
        unpack = _codec(zstandard.ZstdDecompressor, dictionary).decompress
        out, shard, name, count = None, None, "", 0

        def closed() -> pa.RecordBatch:
            out.close()
            if count != min(shard_rows, n - shard * shard_rows):
                raise ValueError(f"shard {shard} has {count} rows")
            return pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "first_slot": [shard * shard_rows],
                                               "rows": [count]})

        for batch in batches:
            for slot, length, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if slot // shard_rows != shard:
                    if out is not None:
                        yield closed()
                    shard, count = slot // shard_rows, 0
                    fs.create_dir(root, recursive=True)
                    name = f"shard-{shard:08d}-{uuid.uuid4().hex}.bin"
                    out = fs.open_output_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20)
                if slot != shard * shard_rows + count:
                    raise ValueError(f"slot {slot} does not follow")
                out.write(length.to_bytes(4, "little") + unpack(ids).ljust(width, b"\0"))
                count += 1
        if out is not None:
            yield closed()

    # Range partitions: consecutive shards, in order.
    dealt = rows.select("slot", "length", squeezed("ids").alias("ids")).repartitionById(tasks, F.expr(f"int(slot div {shard_rows} * {tasks} div {shards})"))
    return materialise(dealt.sortWithinPartitions("slot").mapInArrow(
        save, "shard long, file string, first_slot long, rows long"), "shards")


def read(manifest: DataFrame, folder: str, size: int = SIZE, dtype: str = DTYPE, first: int = 0, last: int | None = None) -> DataFrame:
    """slot, length and ids (binary) of the slots from ``first`` up to and
    without ``last``: each shard is entered at its first wanted row."""
    width = np.dtype(dtype).itemsize * size
    stride, item = width + 4, np.dtype(dtype).itemsize
    schema = pa.schema([("slot", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(folder)
        for batch in batches:
            for name, start, rows in zip(*(c.to_pylist() for c in batch.columns)):
                at, end = max(first, start), start + rows if last is None else min(last, start + rows)
                with fs.open_input_file(f"{root}/{name}") as f:
                    f.seek((at - start) * stride)
                    while at < end:
                        raw = f.read(min(1000, end - at) * stride)
                        n = len(raw) // stride
                        if not n:
                            raise ValueError(f"{name} is cut off")
                        cells = [raw[i * stride:(i + 1) * stride] for i in range(n)]
                        lengths = [int.from_bytes(c[:4], "little") for c in cells]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(range(at, at + n), pa.int64()), pa.array(lengths, pa.int64()),
                            pa.array([c[4:4 + item * k] for c, k in zip(cells, lengths)], pa.binary())], schema=schema)
                        at += n

    wanted = manifest.where(F.col("first_slot") + F.col("rows") > first)
    if last is not None:
        wanted = wanted.where(F.col("first_slot") < last)
    tasks = max(1, min(manifest.count(), MAX_TASKS))
    return wanted.select("file", "first_slot", "rows").repartition(tasks, "file").mapInArrow(
        load, "slot long, length long, ids binary")


def op9_feistel_shards(spark, sf_dir, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Every training sequence with its slot, what it holds of which document, and
    the ids read back from the shards."""
    folder = scratch_path(spark, "tokens")
    rows, n = placed(filled(table(spark, sf_dir, "documents").select("doc_id", "text")), shard_rows=shard_rows)
    back = read(write(rows, n, folder, shard_rows=shard_rows), folder)
    back = back.select("slot", "length", F.crc32("ids").alias("ids_crc32"))
    # Rows that come out of a reader have no size the planner could know: no broadcast.
    return rows.select("slot", "shard", "position", "pieces").join(back.hint("merge"), "slot")
