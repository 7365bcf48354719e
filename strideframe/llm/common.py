"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strideframe.llm import textscan as ts
from strideframe.session import apply_if_unset, reliable_checkpoint, shared_dir

__all__ = ["read_table", "fold", "fresh", "append_columns", "bitmap", "in_bitmap", "passing",
           "gathered", "pack", "unpack", "reliable_checkpoint", "shared_dir"]

#: Rows that ``append_columns`` computes at a time, which bounds a worker's memory.
_ROWS = 256
#: Rows of an Arrow batch where the session does not say: whole texts are wider than the rows
#: that Spark's own 10,000 are meant for, and a task holds a batch in the JVM and in Python.
_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
#: Rows of batches that are put together: the more, the more work they share.
_MANY = 8_000
#: Bits of a Spark bitmap function's bucket.
_BUCKET_BITS = 32_768


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables.  Sets the session's Arrow batch size if it is unset."""
    apply_if_unset(spark, _BATCH)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % F.lit(modulus)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def append_columns(df: DataFrame, fields: Sequence[tuple[str, str]],
                   compute: Callable[[pa.RecordBatch], Sequence[pa.Array]]) -> DataFrame:
    """``df`` with columns computed per slice of an Arrow batch.  A column of ``df`` that
    has the name of a new one is replaced."""
    new = {name for name, _ in fields}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new])
    schema = T.StructType(list(kept.schema.fields))
    for name, ddl in fields:
        schema = schema.add(name, T.DataType.fromDDL(ddl))
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                b = batch.slice(lo, _ROWS)
                yield pa.RecordBatch.from_arrays([*b.columns, *compute(b)], names=names)

    return kept.mapInArrow(run, schema)


def bitmap(df: DataFrame, hash_col: str, bits: int = 24) -> np.ndarray:
    """Bits of the top ``bits`` bits of a 64-bit hash column, packed: a
    fixed-size membership filter (2**bits / 8 bytes, whatever the number of
    rows).  False positives only; the caller joins what passes."""
    pos = F.shiftrightunsigned(F.col(hash_col), 64 - bits) + 1
    rows = (df.select(pos.alias("p")).filter("p is not null")
              .groupBy(F.expr("bitmap_bucket_number(p)").alias("b"))
              .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("m")).collect())
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for r in rows:
        lo = (r.b - 1) * (_BUCKET_BITS // 8)
        part = np.frombuffer(r.m, dtype=np.uint8)[:len(out) - lo]
        out[lo:lo + len(part)] = part
    return out


def in_bitmap(bm: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Mask of the uint64 hashes whose bit is set."""
    bits = len(bm).bit_length() + 2
    p = hashes >> ts.U(64 - bits)
    return (bm[(p >> ts.U(3)).astype(np.int64)] >> (p & ts.U(7)).astype(np.uint8)) & 1 == 1


def passing(df: DataFrame, hash_col: str, bm: np.ndarray) -> DataFrame:
    """Rows of ``df`` whose 64-bit hash has its bit set."""
    at = df.columns.index(hash_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(in_bitmap(bm, b.column(at).to_numpy(zero_copy_only=False).view(ts.U))))

    return df.mapInArrow(run, df.schema)


def gathered(batches: Iterator[pa.RecordBatch], rows: int = _MANY, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches put together until they have so many rows or bytes; larger ones as they are."""
    held, n, m = [], 0, 0
    for b in batches:
        held.append(b)
        n, m = n + b.num_rows, m + b.nbytes
        if n >= rows or m >= size:
            yield pa.concat_batches(held)
            held, n, m = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def pack(v: np.ndarray) -> bytes:
    """Integers or floats, compressed by byte place."""
    planes = np.ascontiguousarray(np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(b: bytes, n: int, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    raw = pa.decompress(b, decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, n).T).reshape(-1).view(dtype)
