"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the filter of :func:`parted`: 8 MB at most, whatever the size of the data.
FILTER_BITS = 1 << 26
_ROW_BITS = 1 << 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, with underscores in front where ``df`` has them already."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        names.append(name)
    return names


def parted(df: DataFrame, column: str, values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose integer ``column`` may be in the only column of ``values``, and those where it is not.

    No row whose value is among them is in the second part.  A bitmap of fixed size is
    broadcast.  It saves shuffling rows that a join with ``values`` would drop, or keep
    as they are; with ever more values it only lets more pass into the first part.
    """
    row, bitmap = free_names(df, "_row", "_bitmap")

    def place(name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(FILTER_BITS))

    bits = (
        values.select(place(values.columns[0]).alias("_bit"))
        .groupBy(F.floor(F.col("_bit") / _ROW_BITS).alias(row))
        .agg(F.bitmap_construct_agg(F.col("_bit") % _ROW_BITS).alias(bitmap))
    )
    bit = place(column) % _ROW_BITS
    byte = F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (bit % 8).cast("int")) == 1
    found = (F.floor(place(column) / _ROW_BITS) == F.col(row)) & is_set
    return df.join(F.broadcast(bits), found, "left_semi"), df.join(F.broadcast(bits), found, "left_anti")


def likely(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """The rows whose integer ``column`` may be in the only column of ``values``; none of those is lost."""
    return parted(df, column, values)[0]


def share_of_hash(hashed: Column, wanted: Column | int, total: Column | int) -> Column:
    """Whether a row is in a share of the hash values that holds ``wanted`` of ``total`` rows four times over.

    It leaves few rows to sort for a sample of ``wanted`` rows, however many there are.
    """
    steps = 1 << 40
    part = F.pmod(hashed, F.lit(steps)) / steps
    return part * total < 4.0 * wanted + 100.0


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, field.type)
        for c, field in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one by one, NULL as the empty text."""
    for value in column:
        yield value.as_py() or ""


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The same as UTF-8 bytes."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def pack_ints(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers as compressed byte planes."""
    planes = np.ascontiguousarray(values, dtype="<u4").view(np.uint8).reshape(-1, 4)
    return zstandard.compress(np.ascontiguousarray(planes.T).tobytes(), 3)


def unpack_ints(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)
