"""Stored spatial layers: files clustered by place, their boxes, and the cells of the points.

A layer is written once along a space-filling curve, so that a file holds rows of
one neighbourhood.  A small table of the files' boxes tells which of them can hold
a match, and the cell pyramid of a layer of points is stored beside it: a join reads
the files it needs and builds no index.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geometry as G
from ..operators.cells import BITS_PER_LEVEL, BOX, CellPyramid, build_pyramid, is_place
from ..operators.skew import BROADCAST_ROWS
from ..operators.staging import stage
from ..operators.within import no_pairs, points_within

ROWS_PER_FILE = 1_000_000
#: Bits per axis of the curve, and of the cells in which boxes are compared.
CURVE_BITS = 31
COARSE_BITS = 7


def morton_key(ix: Column, iy: Column) -> Column:
    """Two numbers of 31 bits with their bits in turns: near cells get near numbers."""

    def spread(v: Column) -> Column:
        for shift, mask in (
            (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
            (2, 0x3333333333333333), (1, 0x5555555555555555),
        ):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(ix.cast("long")).bitwiseOR(F.shiftleft(spread(iy.cast("long")), 1))


@dataclass(frozen=True)
class Frame:
    """The square that a layer lies in."""

    x0: float
    y0: float
    side: float

    def index(self, value: str, axis: str, bits: int) -> str:
        """Cell number along one axis at so many bits, kept within the frame."""
        origin, last = (self.x0 if axis == "x" else self.y0), (1 << bits) - 1
        return f"greatest(0L, least({last}L, floor(({value} - ({origin!r}D)) / {self.side / (1 << bits)!r}D)))"


@dataclass(frozen=True)
class SpatialLayer:
    """A stored layer; ``by`` are the columns within which places are compared."""

    spark: SparkSession
    path: str
    by: list[str]
    frame: Frame
    schema: StructType  # of the stored rows

    @property
    def files(self) -> DataFrame:
        """``file, by, minx, maxx, miny, maxy, n``: one row per file and group in it."""
        return self.spark.read.parquet(f"{self.path}/files")

    def read(self, names: Sequence[str] | None = None) -> DataFrame:
        """All rows, or those of some files."""
        if names is not None and not names:
            return self.spark.createDataFrame([], self.schema).select(*self.columns)
        paths = [f"{self.path}/rows"] if names is None else names
        return self.spark.read.schema(self.schema).parquet(*paths).select(*self.columns)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.schema.names if c not in (*BOX, "_key")]

    def cover(self, boxes: DataFrame) -> DataFrame:
        """``by, cx, cy`` and the box of what lies in each coarse cell: the summary of many boxes.

        At most 4 ** ``COARSE_BITS`` rows per group, whatever the number of boxes.
        """
        spans = {}
        for axis in ("x", "y"):
            low, high = (self.frame.index(f"{end}{axis}", axis, COARSE_BITS) for end in ("min", "max"))
            spans[f"c{axis}"] = F.expr(f"explode(sequence({low}, {high}))")
        known = boxes.where("minx <= maxx AND miny <= maxy").select(*self.by, *BOX)
        cells = known.withColumn("cx", spans["cx"]).withColumn("cy", spans["cy"])
        return cells.groupBy(*self.by, "cx", "cy").agg(*[F.expr(f"{c[:3]}({c}) AS {c}") for c in BOX])

    def files_near(self, boxes: DataFrame) -> list[str]:
        """Files that may hold rows whose box meets one of ``boxes`` (``by`` and the box columns).

        Both sides are compared in coarse cells; the driver gets names of files.
        """
        theirs = self.cover(boxes).withColumnsRenamed({c: f"b_{c}" for c in BOX})
        spans = self.files.select("file", *self.by, *BOX)
        for axis in ("x", "y"):
            low, high = (self.frame.index(f"{end}{axis}", axis, COARSE_BITS) for end in ("min", "max"))
            spans = spans.withColumn(f"c{axis}", F.expr(f"explode(sequence({low}, {high}))"))
        near = spans.join(theirs, [*self.by, "cx", "cy"]).where(
            "minx <= b_maxx AND maxx >= b_minx AND miny <= b_maxy AND maxy >= b_miny"
        )
        return sorted(r[0] for r in near.select("file").distinct().collect())

    def near(self, boxes: DataFrame) -> DataFrame:
        """The rows of :meth:`files_near`."""
        return self.read(self.files_near(boxes))

    def boxes(self) -> DataFrame:
        """Boxes of the files, as what another layer is compared with."""
        return self.files.select(*self.by, *BOX)

    def pyramid(self) -> CellPyramid | None:
        """The stored cells of a layer of points."""
        row = self.spark.read.parquet(f"{self.path}/frame").first()
        if row["depth"] is None or not row["n_points"]:
            return None
        cells = {
            level: self.spark.read.parquet(f"{self.path}/cells/level={level}") for level in row["levels"]
        }
        leaves = cells[row["depth"]].drop("leaf_ix", "leaf_iy")
        return CellPyramid(
            self.by, row["x0"], row["y0"], row["side"], row["depth"], row["n_points"], row["n_groups"],
            leaves, cells,
        )


def _write(
    rows: DataFrame, path: str, by: list[str], frame: Frame, n: int, pyramid: CellPyramid | None, rows_per_file: int
) -> SpatialLayer:
    """``rows`` with box columns in the order of the curve through the middle of their boxes."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c not in BOX]
    at = [F.expr(frame.index(f"((min{a} + max{a}) / 2)", a, CURVE_BITS)) for a in ("x", "y")]
    keyed = rows.withColumn("_key", morton_key(*at))
    # rows of one place are told apart by a hash, so that a crowded one fills several files
    order = [*by, "_key", F.xxhash64(*[F.col(c) for c in columns])]
    files = max(1, -(-n // rows_per_file))
    keyed.repartitionByRange(files, *order).sortWithinPartitions(*by, "_key").write.mode("overwrite").parquet(
        f"{path}/rows"
    )
    stored = spark.read.parquet(f"{path}/rows")
    stored.select("*", F.col("_metadata.file_path").alias("file")).groupBy("file", *by).agg(
        *[F.expr(f"{c[:3]}({c}) AS {c}") for c in BOX], F.count(F.lit(1)).alias("n")
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/files")
    levels = []
    if pyramid is not None:
        for level in range(pyramid.depth, -1, -1):
            levels.append(level)
            pyramid._cells(level).write.mode("overwrite").parquet(f"{path}/cells/level={level}")
            if pyramid.bound(level) <= BROADCAST_ROWS:
                break  # coarser ones are made of this one when they are needed
    numbers = (frame.x0, frame.y0, frame.side, pyramid and pyramid.depth, n, pyramid and pyramid.n_groups, levels)
    names = "x0 DOUBLE, y0 DOUBLE, side DOUBLE, depth INT, n_points LONG, n_groups LONG, levels ARRAY<INT>, schema STRING"
    spark.createDataFrame([(*numbers, stored.schema.json())], names).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/frame"
    )
    return SpatialLayer(spark, path, by, frame, stored.schema)


def write_points(
    points: DataFrame,
    path: str,
    x: str = "lon",
    y: str = "lat",
    by: Sequence[str] = (),
    rows_per_file: int = ROWS_PER_FILE,
) -> SpatialLayer:
    """Store points along the curve, with the boxes of the files and the cells of the points.

    Points without a place are kept; they are in no box.
    """
    by, path = list(by), path.rstrip("/")
    pyramid = build_pyramid(points, x, y, by)
    frame = Frame(pyramid.x0, pyramid.y0, pyramid.side) if pyramid else Frame(0.0, 0.0, 1.0)
    here = F.expr(is_place(x, y))
    box = {c: F.when(here, F.col(x if c.endswith("x") else y).cast("double")) for c in BOX}
    n = points.count()
    return _write(points.withColumns(box), path, by, frame, n, pyramid, rows_per_file)


def write_polygons(
    polygons: DataFrame,
    path: str,
    by: Sequence[str] = (),
    rings: str = "rings",
    rows_per_file: int = ROWS_PER_FILE // 100,
) -> SpatialLayer:
    """Store polygons along the curve, with the boxes of the files; those without rings are kept."""
    by, path = list(by), path.rstrip("/")
    rows = stage(polygons.withColumns(G.box(rings)), "boxes")
    m = rows.selectExpr("count(1) AS n", *[f"{c[:3]}({c}) AS {c}" for c in BOX]).first()
    side = max(m["maxx"] - m["minx"], m["maxy"] - m["miny"], 1e-9) if m["minx"] is not None else 1.0
    frame = Frame(m["minx"] or 0.0, m["miny"] or 0.0, side)
    return _write(rows, path, by, frame, m["n"], None, rows_per_file)


def open_layer(spark: SparkSession, path: str, by: Sequence[str] = ()) -> SpatialLayer:
    """A layer that was written before, with the same ``by``."""
    path = path.rstrip("/")
    row = spark.read.parquet(f"{path}/frame").first()
    schema = StructType.fromJson(json.loads(row["schema"]))
    return SpatialLayer(spark, path, list(by), Frame(row["x0"], row["y0"], row["side"]), schema)


def indexed_points_within(
    points: SpatialLayer,
    polygons: SpatialLayer,
    x: str = "lon",
    y: str = "lat",
    point_id: Sequence[str] = ("gridcell_idx",),
    polygon_id: Sequence[str] = ("geoid",),
    rings: str = "rings",
    keep: str = "inner",
    chosen: Column | None = None,
) -> DataFrame:
    """``points_within`` of two stored layers with the same ``by``.

    Polygons are read from files that lie near files of points, points from files
    that lie near the polygons; ``chosen`` is a condition on the polygons, and only
    files near the chosen ones are read.  With ``keep="left"`` the points without a
    polygon are read as well.
    """
    near = polygons.near(points.boxes())
    if chosen is not None:
        near = near.where(chosen)
    probes = points.near(near.withColumns(G.box(rings)))
    pyramid = points.pyramid()
    by = points.by
    ids = list(dict.fromkeys([*by, *point_id]))
    if pyramid is None:
        found = no_pairs(points.read(), ids, near, polygon_id)
    else:
        found = points_within(probes, near, by, x, y, point_id, polygon_id, rings, pyramid=pyramid)
    if keep == "inner":
        return found
    found = stage(found, "found")
    alone = points.read().select(*ids).join(found.select(*ids).distinct(), ids, "left_anti")
    return found.unionByName(alone, allowMissingColumns=True)
