"""Binary polygons, collections that are cut while they are read, files that arrive."""

import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally.functions import wkb
from gridtally.sources import readers, writers
from gridtally.streaming.arrivals import arrived_counts, arriving_panel, arriving_predictions, count_arrivals

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]


def plain_wkb(rings, order="<", size=2, code=3, srid=None):
    """A polygon written field by field."""
    head = struct.pack("B", order == "<") + struct.pack(f"{order}I", code)
    if srid is not None:
        head += struct.pack(f"{order}I", srid)
    out = head + struct.pack(f"{order}I", len(rings))
    for ring in rings:
        out += struct.pack(f"{order}I", len(ring))
        for x, y in ring:
            out += struct.pack(f"{order}{size}d", x, y, *[7.0] * (size - 2))
    return out


def multi(parts, order="<"):
    return struct.pack("B", order == "<") + struct.pack(f"{order}II", 6, len(parts)) + b"".join(parts)


def told(rings):
    return None if rings is None else [[tuple(p) for p in r] for r in rings]


@pytest.mark.parametrize("order", "<>")
def test_binary_polygons(order):
    assert told(wkb.decode(plain_wkb([SQUARE, HOLE], order))) == [SQUARE, HOLE]
    # outer rings run counter-clockwise, holes clockwise, whatever the file has
    assert told(wkb.decode(plain_wkb([SQUARE[::-1], HOLE[::-1]], order))) == [SQUARE, HOLE]
    for size, code, srid in (
        (3, 1003, None), (3, 2003, None), (4, 3003, None), (3, 0x80000003, None), (3, 0x40000003, None),
        (4, 0xC0000003, None), (2, 0x20000003, 4326), (3, 0xA0000003, 4326),
    ):
        assert told(wkb.decode(plain_wkb([SQUARE, HOLE], order, size, code, srid))) == [SQUARE, HOLE]
    both = multi([plain_wkb([SQUARE], "<"), plain_wkb([SQUARE, HOLE], ">")], order)
    assert told(wkb.decode(both)) == [SQUARE, SQUARE, HOLE]


def test_other_bytes_give_nothing():
    whole = plain_wkb([SQUARE, HOLE])
    point = struct.pack("<BI2d", 1, 1, 1.0, 2.0)
    bad = [b"", b"\x01", b"\x02" + whole[1:], point, multi([point]), plain_wkb([]), multi([]), whole + b"x"]
    bad += [whole[:n] for n in range(0, len(whole), 7)]
    bad += [struct.pack("<BII", 1, 3, 2**31), struct.pack("<BIII", 1, 3, 1, 2**31)]
    assert [wkb.decode(b) for b in bad] == [None] * len(bad)


def test_columns_of_binary_polygons(spark, tmp_path):
    rng = random.Random(2)
    star = [(float(i), rng.random()) for i in range(5000)]
    rings = {"a": [SQUARE, HOLE], "b": [SQUARE, HOLE, [(x + 9, y) for x, y in SQUARE]], "c": [[*star, (0.0, -9.0), star[0]]]}
    rows = [(k, bytearray(wkb.encode([np.array(r) for r in v]))) for k, v in rings.items()]
    rows += [("n", None), ("e", bytearray(b"")), ("x", bytearray(b"\x01\x02"))]
    spark.createDataFrame(rows * 3, "geoid STRING, geometry BINARY").repartition(4).write.parquet(str(tmp_path / "w"))
    found = readers.read_polygons(spark, str(tmp_path / "w"), {"geoid": "geoid"}, "parquet")
    again = wkb.with_rings_of_wkb(wkb.with_wkb_of_rings(found, "rings", "wkb"), "wkb", "again")
    assert again.count() == 18 and again.where("NOT rings <=> again").count() == 0
    for r in found.collect():
        wanted = rings.get(r.geoid)
        mine = told(r.rings)
        assert mine == (wanted if r.geoid != "c" else [w if mine[0] == w else w[::-1] for w in wanted])
    centres = readers.read_polygons(spark, str(tmp_path / "w"), {"geoid": "geoid"}, "parquet", centroids_only=True)
    assert centres.where("geoid = 'a'").first().cy == pytest.approx((16 * 2 - 1.5) / 15)
    assert found.limit(0).count() == 0


def features(n, start='{"type":"Feature",'):
    for i in range(n):
        x = i % 400
        ring = [[x, 0], [x + 1, 0], [x + 1, 1], [x, 0]]
        name = ['"Feature"', "{ [", 'type":"Feature', ", }"][i % 4]
        rest = {"properties": {"GEOID10": f"{i:07d}", "NAME": name}, "geometry": {"type": "Polygon", "coordinates": [ring]}}
        yield start + json.dumps(rest)[1:]


def test_one_large_collection_is_read_by_several_tasks(spark, tmp_path):
    n = 200_000
    body = list(features(n))
    head = '{"type":"FeatureCollection","name":"x","crs":{"type":"name"},"features":['
    (tmp_path / "one.json").write_text(head + ",\n".join(body) + "]}")
    (tmp_path / "lines.json").write_text("\n".join(body) + "\n")
    columns = {"GEOID10": "geoid", "NAME": "name"}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        whole = readers.read_polygons(spark, str(tmp_path / "one.json"), columns, "geojson_split")
        assert whole.rdd.getNumPartitions() >= 8
        lines = readers.read_polygons(spark, str(tmp_path / "lines.json"), columns)
        digest = [F.count("*"), F.count_distinct("geoid"), F.sum(F.xxhash64("geoid", "name", "rings") % 1000003)]
        assert whole.agg(*digest).collect() == lines.agg(*digest).collect()
        assert whole.count() == n
        # the cut also reads lines of features
        cut = readers.read_polygons(spark, str(tmp_path / "lines.json"), columns, "geojson_split")
        assert cut.agg(*digest).collect() == lines.agg(*digest).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_collections_in_several_spellings(spark, tmp_path):
    columns = {"GEOID10": "geoid"}
    head = '{ "type": "FeatureCollection",\n "features": [\n'
    (tmp_path / "a.json").write_text(head + ",".join(features(5, '{ "type": "Feature", ')) + "\n] }\n")
    (tmp_path / "b.json").write_text(head + ",".join(features(3)) + "," + ",".join(features(4, '{\n"type" :"Feature",')) + "]}")
    (tmp_path / "empty.json").write_text(head + "]}")
    null = '{"type":"Feature","properties":{"GEOID10":"z"},"geometry":null}'
    (tmp_path / "null.json").write_text('{"type":"FeatureCollection","features":[' + null + "]}")
    found = readers.read_polygons(spark, str(tmp_path), columns, "geojson_split")
    assert found.count() == 12 and found.where("rings IS NULL").count() == 0
    assert readers.rejected_lines(spark, str(tmp_path), "geojson_split") == 1
    alone = readers.read_polygons(spark, str(tmp_path / "empty.json"), columns, "geojson_split")
    assert alone.collect() == []


def test_a_feature_that_does_not_begin_with_its_type(spark, tmp_path):
    late = '{"properties":{"GEOID10":"1"},"type":"Feature","geometry":null}'
    (tmp_path / "late.json").write_text('{"type":"FeatureCollection","features":[' + late + "," + late + "]}")
    with pytest.raises(ValueError, match="begin with their type"):
        readers.read_polygons(spark, str(tmp_path / "late.json"), {"GEOID10": "geoid"}, "geojson_split")
    mixed = ",".join([*features(2), late])
    (tmp_path / "mixed.json").write_text('{"type":"FeatureCollection","features":[' + mixed + "]}")
    found = readers.read_polygons(spark, str(tmp_path / "mixed.json"), {"GEOID10": "geoid"}, "geojson_split")
    with pytest.raises(Exception, match="does not begin with its type"):
        found.collect()


def counts(df):
    return sorted((r.region, r.urban_rural, r.species, r.year, r.n) for r in df.collect())


def test_arriving_files_are_counted_once(spark, tmp_path):
    out, panel = str(tmp_path / "out"), str(tmp_path / "panel")
    schema = "year INT, lon DOUBLE, region STRING, urban_rural STRING, species STRING"
    first = [(y, 1.0, "NE1", "urban", s) for y in (2000, 2001, None) for s in ("ec", "no3") for _ in range(5)]
    second = [(y, 1.0, r, "urban", "ec") for y in (2001, 2002) for r in ("NE1", "P9") for _ in range(3)]
    with pytest.raises(FileNotFoundError):
        arrived_counts(spark, out)

    def arrive(rows):
        df = spark.createDataFrame(rows, schema).repartition(3)
        df.write.mode("append").partitionBy("region", "urban_rural", "species").parquet(panel)
        return count_arrivals(arriving_panel(spark, panel, files_per_batch=2), out)

    assert arrive(first) == 30
    assert counts(arrived_counts(spark, out)) == sorted(("NE1", "urban", s, y, 5) for s in ("ec", "no3") for y in (2000, 2001))
    assert arrive(second) == 12
    once = str(tmp_path / "once")
    assert count_arrivals(arriving_panel(spark, panel), once) == 42
    assert counts(arrived_counts(spark, out)) == counts(arrived_counts(spark, once))
    # nothing new: nothing is read, and no version is written
    before = writers.complete_versions(spark, f"{out}/counts")
    assert count_arrivals(arriving_panel(spark, panel), out) == 0
    assert writers.complete_versions(spark, f"{out}/counts") == before
    # a batch that broke off leaves no complete version
    (tmp_path / "out" / "counts" / "version=999").mkdir()
    assert counts(arrived_counts(spark, out)) == counts(arrived_counts(spark, once))


def test_arriving_prediction_files(spark, tmp_path):
    rows = spark.createDataFrame([(2000, 1.0), (2000, 2.0), (2001, 3.0)], "year INT, `final.predicted.ec` DOUBLE")
    rows.coalesce(1).write.parquet(str(tmp_path / "made"))
    data = next((tmp_path / "made").glob("*.parquet")).read_bytes()
    for name in ("2000.NE1.ec", "P9.no3.part2"):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{name}.parquet").write_bytes(data)
    out = str(tmp_path / "out")
    assert count_arrivals(arriving_predictions(spark, str(tmp_path / "in"), "rural"), out) == 6
    assert counts(arrived_counts(spark, out)) == [
        (r, "rural", s, y, n) for r, s in (("NE1", "ec"), ("P9", "no3")) for y, n in ((2000, 2), (2001, 1))]
