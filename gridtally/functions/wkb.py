"""Polygons as well-known binary, read and written in Arrow batches.

Text of a polygon is parsed by column expressions; its binary form has no place in
them, so whole batches of it go through numpy: the points of all rings lie in one
array, and lists are cut from it by offsets.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, DataType, DoubleType, StructField, StructType

# executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RINGS = ArrayType(ArrayType(StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])))

# Fixed values of the format: geometry types, and flags of the extended form.
POLYGON, MULTIPOLYGON = 3, 6
WITH_Z, WITH_M, WITH_SRID = 0x80000000, 0x40000000, 0x20000000


def _doubled_area(ring: np.ndarray) -> float:
    """Twice the signed area, positive when the ring runs counter-clockwise."""
    if len(ring) < 2:
        return 0.0
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())


def _header(data: bytes, at: int) -> tuple[str, int, int, int]:
    """Byte order, type, coordinates per point, and where the body begins."""
    order = "<>"[data[at] == 0]
    if data[at] > 1:
        raise ValueError("unknown byte order")
    (code,) = struct.unpack_from(f"{order}I", data, at + 1)
    at += 5
    size = 2 + bool(code & WITH_Z) + bool(code & WITH_M)
    if code & WITH_SRID:
        at += 4
    code &= 0x0FFFFFFF
    thousands, kind = divmod(code, 1000)
    return order, kind, size + (0, 1, 1, 2)[thousands], at


def _polygon(data: bytes, at: int, rings: list[np.ndarray], order: str, size: int) -> int:
    """Append the rings of a polygon, the first counter-clockwise and its holes clockwise; where it ends."""
    (n,) = struct.unpack_from(f"{order}I", data, at)
    at += 4
    for i in range(n):
        (points,) = struct.unpack_from(f"{order}I", data, at)
        flat = np.frombuffer(data, f"{order}f8", points * size, at + 4)
        ring = flat.reshape(points, size)[:, :2].astype("<f8")
        rings.append(ring if (_doubled_area(ring) >= 0) == (i == 0) else ring[::-1])
        at += 4 + 8 * points * size
    return at


def decode(data: bytes) -> list[np.ndarray] | None:
    """Rings of a polygon or multipolygon; None if it is another geometry, empty, or not well formed."""
    rings: list[np.ndarray] = []
    try:
        order, kind, size, at = _header(data, 0)
        if kind == POLYGON:
            at = _polygon(data, at, rings, order, size)
        elif kind == MULTIPOLYGON:
            (n,) = struct.unpack_from(f"{order}I", data, at)
            at += 4
            for _ in range(n):
                own, kind, size, at = _header(data, at)
                if kind != POLYGON:
                    return None
                at = _polygon(data, at, rings, own, size)
        if at != len(data):
            return None
    except (ValueError, IndexError, struct.error):
        return None
    return rings or None


def encode(rings: list[np.ndarray]) -> bytes:
    """Little-endian binary: a counter-clockwise ring begins a part, the clockwise ones after it are its holes."""
    parts: list[list[np.ndarray]] = []
    for ring in rings:
        if not parts or _doubled_area(ring) >= 0:
            parts.append([])
        parts[-1].append(ring)
    written = [
        struct.pack("<BII", 1, POLYGON, len(part))
        + b"".join(struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in part)
        for part in parts
    ]
    if len(written) == 1:
        return written[0]
    return struct.pack("<BII", 1, MULTIPOLYGON, len(written)) + b"".join(written)


def _nested(rows: list[list[np.ndarray] | None]) -> pa.Array:
    """Arrow lists of rings of points, NULL where a row has none."""
    flat = [ring for rings in rows if rings for ring in rings]
    points = np.concatenate(flat) if flat else np.empty((0, 2))
    structs = pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], ["x", "y"])
    ends = np.cumsum([0, *[len(ring) for ring in flat]])
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
    outer = np.cumsum([0, *[len(rings or ()) for rings in rows]])
    absent = pa.array([rings is None for rings in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(outer, pa.int32()), lists, mask=absent)


def _with_column(df: DataFrame, source: str, out: str, kind: DataType, make) -> DataFrame:
    """``df`` with a column ``out`` that ``make`` derives from whole batches of ``source``."""
    at = df.columns.index(source)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            names = [*rows.schema.names, out]
            yield pa.RecordBatch.from_arrays([*rows.columns, make(rows.column(at))], names=names)

    return df.mapInArrow(add, StructType([*df.schema.fields, StructField(out, kind)]))


def _decode_all(column: pa.Array) -> pa.Array:
    return _nested([None if v is None else decode(v) for v in column.to_pylist()])


def _encode_all(column: pa.Array) -> pa.Array:
    out = []
    for rings in column:
        if not rings.is_valid or not len(rings):
            out.append(None)
            continue
        points = [ring.values for ring in rings.values]
        out.append(encode([np.column_stack([p.field("x"), p.field("y")]) for p in points]))
    return pa.array(out, pa.binary())


def with_rings_of_wkb(df: DataFrame, wkb: str = "wkb", out: str = "rings") -> DataFrame:
    """Add the rings of binary polygons and multipolygons in either byte order; only x and y are kept.

    Other geometries, empty ones, bytes that are not well formed and NULL give NULL.
    """
    return _with_column(df, wkb, out, _RINGS, _decode_all)


def with_wkb_of_rings(df: DataFrame, rings: str = "rings", out: str = "wkb") -> DataFrame:
    """Add the binary form of rings as the readers give them; NULL and no rings give NULL."""
    return _with_column(df, rings, out, BinaryType(), _encode_all)
