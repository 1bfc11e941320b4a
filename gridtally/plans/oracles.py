"""The same queries as plain SQL, by other means.

Point in polygon uses the closed form of a diamond, nearest points and buffers
compare all pairs, numbering uses one window.
"""

from __future__ import annotations

# Fixed values, written out so that the oracles do not lean on the code under test:
# state codes of the regions, and the constants of the conic projection.
STATES = {
    "NE1": "09 23 25 33 44 50",
    "MA2": "34 36 42",
    "NEC3": "17 18 26 39 55",
    "WNC4": "19 20 27 29 31 38 46",
    "SA5": "10 11 12 13 24 37 45 51 54",
    "ESC6": "01 21 28 47",
    "WSC7": "05 22 40 48",
    "M8": "04 08 16 30 32 35 49 56",
    "P9": "06 41 53",
}
CENTRAL_MERIDIAN = -96.0
SEMI_AXIS = 6378137.0
CONE = {"n": 0.6301028119133192, "ag": 11728013.971501153, "rho0": 7298484.941123908}
ARC = {"c0": 0.9983242984445848, "c2": 0.0025146070728448195, "c4": 2.6390466202308984e-06,
       "c6": 3.418046136775213e-09}

BLOCKS = """
b AS (
  SELECT c_custkey AS q,
         lpad((c_custkey % 56 + 1)::VARCHAR, 2, '0')
         || lpad(((c_custkey // 56) % 2 + 1)::VARCHAR, 3, '0')
         || lpad((c_custkey // 1120)::VARCHAR, 6, '0')
         || ((c_custkey // 112) % 2 + 1)::VARCHAR
         || lpad(((c_custkey // 224) % 5)::VARCHAR, 3, '0') AS geoid,
         CASE WHEN c_custkey % 97 = 13 THEN NULL WHEN c_acctbal < 0 THEN 0
              ELSE CAST(floor(c_acctbal / 10) AS BIGINT) END AS population,
         -125.0::DOUBLE + ((c_custkey * 37) % 6400) / 128.0::DOUBLE AS x,
         25.0::DOUBLE + ((c_custkey * 53) % 384) / 128.0::DOUBLE AS y,
         0.5::DOUBLE * pow(2, c_custkey % 3) AS hx,
         0.125::DOUBLE * pow(2, c_custkey % 3) AS hy
  FROM customer
)"""

CLASSES = """
k AS (
  SELECT geoid, CASE WHEN q % 4 = 0 THEN 0 ELSE 1 END AS urban,
         CASE WHEN q % 11 = 3 THEN 0 ELSE 1 END AS fully_predicted, population
  FROM b
)"""

URBAN = """
u AS (
  SELECT lpad(n_nationkey::VARCHAR, 5, '0') AS uace,
         -125.0::DOUBLE + 2 * n_nationkey AS x,
         25.0::DOUBLE + (n_nationkey % 6) / 2.0::DOUBLE AS y
  FROM nation
)"""

GRID = """
g AS (
  SELECT p_partkey AS p, p_partkey + 1 AS gridcell_idx,
         -125.0::DOUBLE + p_partkey % 50 AS lon,
         25.0::DOUBLE + (p_partkey // 50) / 16.0::DOUBLE AS lat,
         CASE WHEN p_partkey % 50 < 17 THEN 'NE1' WHEN p_partkey % 50 < 34 THEN 'MA2'
              ELSE 'P9' END AS region,
         CASE WHEN (p_partkey // 50) % 2 = 0 THEN 'rural' ELSE 'urban' END AS urban_rural,
         ((p_partkey // 500) % 3 + 1)::VARCHAR AS part_number
  FROM part
)"""

PREDICTIONS = """
pr AS (
  SELECT g.*, year, species,
         CASE WHEN p % 211 = 5 THEN NULL
              ELSE ((p * 7 + (year - 2000) * 13 + CASE species WHEN 'ec' THEN 0 ELSE 5 END) % 101)
                   / 4.0::DOUBLE END AS predicted
  FROM g, (SELECT unnest([2000, 2001, 2002, 2003, 2004]) AS year),
       (SELECT unnest(['ec', 'no3']) AS species)
)"""

WITHIN = """
w AS (
  SELECT gridcell_idx, geoid FROM g JOIN b
  ON abs(g.lon - b.x) / b.hx + abs(g.lat - b.y) / b.hy < 1
)"""

NEAREST = """
n AS (
  SELECT geoid, gridcell_idx, distance FROM (
    SELECT geoid, gridcell_idx, distance,
           row_number() OVER (PARTITION BY geoid ORDER BY distance, gridcell_idx) AS place
    FROM (SELECT geoid, gridcell_idx,
                 sqrt((g.lon - b.x) * (g.lon - b.x) + (g.lat - b.y) * (g.lat - b.y)) AS distance
          FROM b, g)
  ) WHERE place = 1
)"""

BLOCK_VALUES = """
wa AS (
  SELECT geoid, species, year,
         CASE WHEN count(predicted) = count(*) THEN avg(predicted) END AS predicted_within,
         count(*) AS n_gridcells_within
  FROM w JOIN pr USING (gridcell_idx) GROUP BY geoid, species, year
),
a AS (
  SELECT n.geoid, pr.species, pr.year, wa.predicted_within, wa.n_gridcells_within,
         pr.predicted AS predicted_nearest, n.distance AS distance_nearest
  FROM n JOIN pr USING (gridcell_idx)
  LEFT JOIN wa ON wa.geoid = n.geoid AND wa.species = pr.species AND wa.year = pr.year
)"""

LEVELS = """(VALUES ('block_groups', 12), ('tracts', 11), ('counties', 5)) AS l(level, len)"""

PARENTS = f"""
pa AS (
  SELECT species, level, year, geoid,
         CASE WHEN n_w = n AND n_p = n AND w <> 0 THEN pw / w END AS predicted, pct_pop_predicted
  FROM (
    SELECT species, level, year, left(geoid, len) AS geoid,
           sum(coalesce(predicted_within, predicted_nearest) * population) AS pw,
           sum(population)::DOUBLE AS w,
           count(coalesce(predicted_within, predicted_nearest)) AS n_p,
           count(population) AS n_w, count(*) AS n,
           count(predicted_within) / count(*) AS pct_pop_predicted
    FROM a JOIN k USING (geoid), {LEVELS}
    GROUP BY ALL
  )
)"""

PARENT_CLASSES = f"""
pk AS (
  SELECT level, left(geoid, len) AS geoid,
         CASE WHEN count(population) = count(*) THEN sum(population)::BIGINT END AS population,
         CASE WHEN count(population) = count(*) THEN sum(population * urban)::BIGINT END
           AS population_urban,
         min(fully_predicted) AS fully_predicted
  FROM k, {LEVELS} GROUP BY ALL
),
pc AS (
  SELECT level, geoid, population, population_urban,
         CASE WHEN population > 0 THEN population_urban / population END AS pct_population_urban,
         fully_predicted
  FROM pk
),
pcu AS (
  SELECT *, CAST(pct_population_urban > 0.75 AS INTEGER) AS urban FROM pc
)"""

_C = CONE | ARC


def _conic(lon: str, lat: str) -> tuple[str, str]:
    phi = f"radians({lat})"
    arc = (
        f"{SEMI_AXIS!r}::DOUBLE * ({_C['c0']!r}::DOUBLE * {phi} - {_C['c2']!r}::DOUBLE * sin(2 * {phi})"
        f" + {_C['c4']!r}::DOUBLE * sin(4 * {phi}) - {_C['c6']!r}::DOUBLE * sin(6 * {phi}))"
    )
    rho = f"({_C['ag']!r}::DOUBLE - {arc})"
    theta = f"({_C['n']!r}::DOUBLE * radians({lon} - ({CENTRAL_MERIDIAN!r})))"
    return f"{rho} * sin({theta})", f"{_C['rho0']!r}::DOUBLE - {rho} * cos({theta})"


def _corners(name: str, source: str, key: str, hx: str, hy: str) -> str:
    x, y = _conic(f"(x + sx * {hx})", f"(y + sy * {hy})")
    return f"""
{name} AS (
  SELECT {key}, i, {x} AS px, {y} AS py
  FROM {source}, (VALUES (0, 1, 0), (1, 0, 1), (2, -1, 0), (3, 0, -1)) AS s(i, sx, sy)
)"""


# areas are convex, so a block is in the buffer if its four corners are
BUFFER = (
    _corners("bc", "b", "geoid", "hx", "hy")
    + ","
    + _corners("uc", "u", "uace", "2", "1")
    + """,
ue AS (
  SELECT s.uace, s.px AS ax, s.py AS ay, e.px - s.px AS dx, e.py - s.py AS dy
  FROM uc s JOIN uc e ON s.uace = e.uace AND e.i = (s.i + 1) % 4
),
pd AS (
  SELECT geoid, uace, i,
         min(dx * (py - ay) - dy * (px - ax)) AS side,
         min(pow(ax + t * dx - px, 2) + pow(ay + t * dy - py, 2)) AS d2
  FROM (SELECT *, greatest(0, least(1, ((px - ax) * dx + (py - ay) * dy) / (dx * dx + dy * dy)))
                  AS t
        FROM bc, ue)
  GROUP BY geoid, uace, i
),
f AS (
  SELECT geoid, uace FROM pd GROUP BY geoid, uace
  HAVING max(CASE WHEN side >= 0 THEN 0 ELSE sqrt(d2) END) <= 1000
)"""
)

_REGION = (
    "CASE "
    + " ".join(
        f"WHEN left(geoid, 2) IN ({', '.join(repr(s) for s in states.split())}) THEN '{r}'"
        for r, states in STATES.items()
    )
    + " END"
)
_KNOWN = ", ".join(repr(s) for states in STATES.values() for s in states.split())

REGIONAL = f"r AS (SELECT *, {_REGION} AS region FROM b WHERE left(geoid, 2) IN ({_KNOWN}))"
REGIONAL_DISTANCES = """
d AS (
  SELECT r.region, kind AS urban_rural, geoid, gridcell_idx,
         sqrt(pow(g.lon - r.x, 2) + pow(g.lat - r.y, 2)) AS distance
  FROM r CROSS JOIN (SELECT unnest(['rural', 'urban']) AS kind)
  LEFT JOIN g ON g.region = r.region AND g.urban_rural = kind
)"""

CATALOG = r"""
names AS (
  SELECT '/d/' || p_partkey || '/'
         || CASE WHEN p_partkey % 5 = 0 THEN '' ELSE (2000 + p_partkey % 5) || '.' END
         || ['NE1', 'MA2', 'NEC3', 'WNC4', 'SA5', 'ESC6', 'WSC7', 'M8', 'P9'][p_partkey % 9 + 1]
         || '.' || ['ec', 'no3', 'so4'][(p_partkey // 9) % 3 + 1]
         || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '.part' || (p_partkey % 12) END
         || '.rds' AS path
  FROM part
),
bases AS (SELECT path, split_part(path, '/', -1) AS base FROM names),
files AS (
  SELECT path, nullif(regexp_extract(base, '^[0-9]{4}'), '') AS year,
         nullif(regexp_extract(base, '[A-Z]+[0-9]'), '') AS region,
         nullif(regexp_extract(base, 'part([0-9]+)', 1), '') AS part_number,
         nullif(regexp_extract(regexp_replace(base, '\.part[0-9]+', ''), '([^.]+)\.rds', 1), '')
           AS species
  FROM bases
)"""

YEARLY = """
panel AS (
  SELECT l_returnflag AS region, l_linestatus AS urban_rural, 'all' AS species,
         year(l_shipdate)::INTEGER AS year
  FROM lineitem
),
counts AS (
  SELECT region, urban_rural, species, year, count(*) AS n FROM panel
  WHERE year IS NOT NULL GROUP BY ALL
)"""

ORDERS = """
o AS (
  SELECT o_orderstatus AS region, o_orderpriority AS species, year(o_orderdate)::INTEGER AS year
  FROM orders
)"""

NUMBERED = """
numbered AS (
  SELECT region, urban_rural, lon, lat,
         row_number() OVER (PARTITION BY region, urban_rural ORDER BY part_number, lon, lat)
           AS gridcell_idx
  FROM g
)"""


def _sql(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


_VALUES = (BLOCKS, GRID, PREDICTIONS, WITHIN, NEAREST, BLOCK_VALUES)
_ROUNDED_PARENTS = "round(predicted, 6) AS predicted, round(pct_pop_predicted, 6) AS pct_pop_predicted"
_BEST = "round(coalesce(predicted_within, predicted_nearest), 6) AS predicted"

ORACLES: dict[str, str] = {
    **{
        name: _sql(
            *_VALUES,
            select="SELECT geoid, species, year, round(predicted_within, 6) AS predicted_within, "
            "n_gridcells_within, predicted_nearest, distance_nearest FROM a",
        )
        for name in ("block_aggregate", "bucketed_block_aggregate")
    },
    "parent_aggregate_all_levels": _sql(
        *_VALUES, CLASSES, PARENTS,
        select=f"SELECT species, level, year, geoid, {_ROUNDED_PARENTS} FROM pa",
    ),
    "parent_update": _sql(
        *_VALUES,
        """changed AS (
          SELECT geoid, species, year,
                 CASE WHEN q % 23 <> 4 THEN predicted_within + (q % 13 = 1)::INT END AS predicted_within,
                 CASE WHEN q % 23 <> 4 THEN predicted_nearest + (q % 13 = 1)::INT END AS predicted_nearest
          FROM a JOIN b USING (geoid) WHERE q % 17 <> 2
        )""",
        CLASSES, PARENTS.replace("FROM a JOIN k", "FROM changed JOIN k"),
        select=f"SELECT species, level, year, geoid, {_ROUNDED_PARENTS} FROM pa",
    ),
    "county_means": _sql(
        *_VALUES, CLASSES, PARENTS,
        select=f"SELECT species, level, year, geoid, {_ROUNDED_PARENTS} FROM pa "
        "WHERE level = 'counties'",
    ),
    "classify_blocks": _sql(
        BLOCKS, URBAN, BUFFER,
        select="""SELECT geoid,
          CAST(EXISTS (SELECT 1 FROM u WHERE abs(b.x - u.x) / 2 + abs(b.y - u.y) < 1) AS INTEGER)
            AS urban,
          CAST(geoid IN (SELECT geoid FROM f) AS INTEGER) AS fully_predicted, population FROM b""",
    ),
    "classify_parents": _sql(
        BLOCKS, CLASSES, PARENT_CLASSES,
        select="SELECT level, geoid, population, population_urban, "
        "round(pct_population_urban, 6) AS pct_population_urban, fully_predicted, urban FROM pcu",
    ),
    "distribute_urban": _sql(
        *_VALUES, CLASSES,
        select=f"SELECT species, geoid, year, {_BEST} FROM a "
        "WHERE geoid IN (SELECT geoid FROM k WHERE urban = 1)",
    ),
    "distribute_all": _sql(*_VALUES, select=f"SELECT species, geoid, year, {_BEST} FROM a"),
    "distribute_urban_parents": _sql(
        *_VALUES, CLASSES, PARENTS, PARENT_CLASSES,
        select="SELECT species, level, geoid, year, round(predicted, 6) AS predicted FROM pa "
        "WHERE (level, geoid) IN (SELECT (level, geoid) FROM pcu WHERE urban = 1)",
    ),
    **{
        name: _sql(
            BLOCKS, GRID, WITHIN,
            select="SELECT g.gridcell_idx, w.geoid FROM g LEFT JOIN w USING (gridcell_idx)",
        )
        for name in ("points_within", "indexed_points_within")
    },
    "centroids_urban": _sql(
        BLOCKS, URBAN,
        select="SELECT geoid, uace FROM b, u WHERE abs(b.x - u.x) / 2 + abs(b.y - u.y) < 1",
    ),
    "csv_round_trip": _sql(
        BLOCKS, CLASSES,
        select="SELECT geoid, fully_predicted, population, urban FROM k",
    ),
    "counts_round_trip": """
        SELECT l_returnflag AS region, l_linestatus AS urban_rural, 'all' AS species,
               year(l_shipdate)::INTEGER AS year, count(*) AS n
        FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY ALL
    """,
    "layer_round_trip": _sql(
        BLOCKS,
        select=f"SELECT geoid, population, {_REGION} AS region FROM b "
        f"WHERE left(geoid, 2) IN ({_KNOWN})",
    ),
    "query_export": _sql(BLOCKS, CLASSES, select="SELECT geoid, population FROM k WHERE population > 100"),
    "points_within_by_region": _sql(
        BLOCKS, GRID,
        select=f"""SELECT g.region, urban_rural, gridcell_idx, geoid
          FROM g JOIN (SELECT *, {_REGION} AS region FROM b WHERE left(geoid, 2) IN ({_KNOWN})) r
          ON g.region = r.region AND abs(g.lon - r.x) / r.hx + abs(g.lat - r.y) / r.hy < 1""",
    ),
    "nearest_k": _sql(
        BLOCKS, GRID, REGIONAL, REGIONAL_DISTANCES,
        select="""SELECT region, urban_rural, geoid, CASE WHEN gridcell_idx IS NOT NULL THEN place::INTEGER END
                 AS rank, gridcell_idx, round(distance, 9) AS distance
          FROM (SELECT *, row_number() OVER (PARTITION BY region, urban_rural, geoid
                                             ORDER BY distance, gridcell_idx) AS place FROM d)
          WHERE place <= 5""",
    ),
    "nearest_by_region": _sql(
        BLOCKS, GRID, REGIONAL, REGIONAL_DISTANCES,
        select="""SELECT region, urban_rural, geoid, gridcell_idx, round(distance, 9) AS distance
          FROM (SELECT *, row_number() OVER (PARTITION BY region, urban_rural, geoid
                                             ORDER BY distance, gridcell_idx) AS place FROM d)
          WHERE place = 1""",
    ),
    **{
        f"{kind}_rings": _sql(
            BLOCKS,
            select="""SELECT geoid, CASE WHEN q % 3 = 0 THEN 1 ELSE 2 END AS n_rings,
                CASE q % 3 WHEN 0 THEN 2.0 WHEN 1 THEN 1.5 ELSE 4.0 END * hx * hy AS area,
                CASE WHEN q % 3 = 2 THEN x + 2 * hx ELSE x END AS cx, y AS cy FROM b""",
        )
        for kind in ("wkt", "geojson", "wkb")
    },
    "split_features": _sql(
        BLOCKS,
        select="""SELECT geoid, CASE WHEN q % 3 = 0 THEN 1 ELSE 2 END AS n_rings,
            CASE q % 3 WHEN 0 THEN 2.0 WHEN 1 THEN 1.5 ELSE 4.0 END * hx * hy AS area,
            CASE WHEN q % 3 = 2 THEN x + 2 * hx ELSE x END AS cx, y AS cy FROM b""",
    ),
    "prediction_files": _sql(
        GRID, PREDICTIONS, select="SELECT region, urban_rural, species, year, lon, lat, predicted FROM pr"
    ),
    "imported_layers": _sql(
        BLOCKS,
        select="""SELECT vintage, geoid, population
          FROM b JOIN (VALUES (2000, 101), (2010, 50)) AS v(vintage, least) ON population >= least""",
    ),
    "wanted_tasks": _sql(
        CATALOG,
        select="""SELECT split_part(path, '/', 3)::BIGINT AS number, region, species, vintage, level
          FROM files, (VALUES (2000), (2010)) AS v(vintage), (VALUES ('counties'), ('tracts')) AS l(level)""",
    ),
    "arriving_counts": _sql(YEARLY, select="SELECT * FROM counts"),
    "population_text": _sql(
        BLOCKS,
        select="""SELECT q, CASE WHEN q % 7 IN (4, 5) THEN NULL WHEN q % 7 = 3 THEN (q % 9 + 1) * 100
            ELSE population END AS population FROM b""",
    ),
    "nearest_points": _sql(BLOCKS, GRID, NEAREST, select="SELECT geoid, gridcell_idx, distance FROM n"),
    "polygon_centroids": _sql(
        BLOCKS,
        select=f"SELECT geoid, {_REGION} AS region, x AS cx, y AS cy FROM b "
        f"WHERE left(geoid, 2) IN ({_KNOWN})",
    ),
    "conic_projection": _sql(
        GRID,
        select="SELECT gridcell_idx, round({0}, 2) AS x, round({1}, 2) AS y FROM g".format(
            *_conic("lon", "lat")
        ),
    ),
    "within_buffer": _sql(BLOCKS, URBAN, BUFFER, select="SELECT geoid, uace FROM f"),
    "extract_grid": _sql(
        GRID, NUMBERED, select="SELECT region, urban_rural, gridcell_idx, lon, lat FROM numbered"
    ),
    "panel_cells": _sql(
        GRID, PREDICTIONS, NUMBERED,
        select="SELECT region, urban_rural, species, year, numbered.gridcell_idx, predicted "
        "FROM pr JOIN numbered USING (region, urban_rural, lon, lat)",
    ),
    "position_cells": _sql(
        GRID, PREDICTIONS,
        select="SELECT region, urban_rural, species, year, lat, lon, predicted, row_number() OVER "
        "(PARTITION BY region, urban_rural, species, year ORDER BY lat, lon) AS gridcell_idx FROM pr",
    ),
    "yearly_counts": _sql(YEARLY, select="SELECT * FROM counts"),
    "inconsistent_groups": _sql(
        YEARLY,
        select="SELECT region, urban_rural, species, count(DISTINCT n) AS distinct_counts, "
        "min(n) AS min_n, max(n) AS max_n FROM counts GROUP BY ALL HAVING count(DISTINCT n) > 1",
    ),
    "coverage_matrix": _sql(
        ORDERS,
        select="""SELECT r.region, y.year, s.species, count(o.year) AS n
          FROM (SELECT DISTINCT region FROM o) r CROSS JOIN (SELECT DISTINCT year FROM o) y
          CROSS JOIN (SELECT DISTINCT species FROM o) s
          LEFT JOIN o ON o.region = r.region AND o.year = y.year AND o.species = s.species
          GROUP BY ALL""",
    ),
    "coverage_wide": _sql(
        ORDERS,
        select="SELECT region, species, "
        + ", ".join(f"count(*) FILTER (year = {y}) AS y{y}" for y in range(1992, 1998))
        + ", count(*) FILTER (year IS NULL OR year NOT BETWEEN 1992 AND 1997) AS other"
        + " FROM o GROUP BY region, species",
    ),
    "catalog_from_names": _sql(CATALOG, select="SELECT * FROM files"),
    "sample_files": _sql(
        CATALOG,
        select="""SELECT region, species, path, year, part_number FROM (
            SELECT *, min(year) OVER (PARTITION BY region) AS first FROM files WHERE species = 'no3')
          WHERE first IS NULL OR year = first""",
    ),
    "missing_population": _sql(
        BLOCKS,
        select="SELECT left(geoid, 2) AS state, count(*) AS n FROM b WHERE population IS NULL "
        f"AND left(geoid, 2) IN ({_KNOWN}) GROUP BY ALL",
    ),
    "supplied_population": _sql(
        BLOCKS,
        select="SELECT q % 3 AS value, count(*) AS n FROM b WHERE population IS NULL GROUP BY ALL",
    ),
    "geoid_pad": _sql(
        BLOCKS, select="SELECT q, CASE WHEN q % 50 <> 7 THEN geoid END AS geoid FROM b"
    ),
    "region_subset": _sql(
        BLOCKS,
        select=f"SELECT geoid, population, {_REGION} AS region FROM b "
        f"WHERE left(geoid, 2) IN ({_KNOWN})",
    ),
    "margins": _sql(
        BLOCKS, CLASSES,
        select="SELECT urban, round(count(*) * 100.0 / (SELECT count(*) FROM k), 6)::DOUBLE "
        "AS percent FROM k GROUP BY ROLLUP (urban)",
    ),
    "totals_agree": _sql(
        BLOCKS, CLASSES, PARENT_CLASSES,
        select="""SELECT pcu.population = t.population AS agree, count(*) AS n
          FROM (SELECT left(geoid, 11) AS geoid,
                       sum(population + CASE WHEN q % 40 = 9 THEN 1 ELSE 0 END) AS population
                FROM b GROUP BY ALL) t
          LEFT JOIN pcu ON pcu.geoid = t.geoid AND pcu.level = 'tracts'
          WHERE pcu.population IS NOT NULL AND t.population IS NOT NULL GROUP BY ALL""",
    ),
    "clean_population": _sql(
        BLOCKS, CLASSES,
        select="SELECT geoid, urban, fully_predicted, coalesce(population, 0) AS population FROM k "
        "WHERE left(geoid, 2) < '45'",
    ),
    "union_by_name": """
        SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance
        FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    "pending_tasks": _sql(
        CATALOG,
        """tasks AS (
          SELECT split_part(path, '/', 3)::BIGINT AS number, region, species FROM files
        )""",
        select="""SELECT number, region, species FROM tasks t WHERE NOT EXISTS (
          SELECT 1 FROM orders WHERE o_custkey = number AND ['ec', 'no3', 'so4'][o_orderkey % 3 + 1] = species)""",
    ),
    "restarted_counts": _sql(
        GRID, PREDICTIONS,
        select="""SELECT region, urban_rural, species, year, count(*) AS n FROM pr
          WHERE region <> 'MA2' AND NOT (region = 'NE1' AND species = 'ec') GROUP BY ALL""",
    ),
    "panel_check": _sql(
        GRID, PREDICTIONS,
        select="""SELECT region, urban_rural, species, count(*) AS n_rows,
            count(DISTINCT year) AS n_years, count(DISTINCT (lon, lat)) AS n_cells,
            count(*) FILTER (predicted IS NULL) AS n_missing,
            count(*) % count(DISTINCT year) = 0 AS divisible,
            count(*) = count(DISTINCT (lon, lat)) * count(DISTINCT year)
              AND count(*) = count(DISTINCT (lon, lat, year)) AS rectangular
          FROM pr GROUP BY region, urban_rural, species""",
    ),
    "panel_fingerprints": _sql(
        GRID, PREDICTIONS,
        """planted AS (
          SELECT region, urban_rural, species, year, lat,
                 CASE WHEN year = 2003 AND region = 'P9' AND p % 100 = 40 THEN lon + 0.5 ELSE lon END AS lon,
                 CASE WHEN year = 2002 AND region = 'NE1' AND p % 2 = 0 AND p % 50 < 16 THEN p + 1
                      WHEN year = 2002 AND region = 'NE1' AND p % 2 = 1 AND p % 50 < 17 THEN p - 1 ELSE p END AS place
          FROM pr WHERE NOT (year = 2004 AND region = 'MA2' AND p % 500 = 20)
        ), years AS (
          SELECT region, urban_rural, species, year, count(*) AS n, list((lon, lat) ORDER BY lon, lat) AS cells,
                 list((place, lon, lat) ORDER BY place) AS ordered
          FROM planted GROUP BY ALL
        ), votes AS (
          SELECT *, count(*) OVER (PARTITION BY region, urban_rural, species, n) AS vn,
                 min(year) OVER (PARTITION BY region, urban_rural, species, n) AS fn,
                 count(*) OVER (PARTITION BY region, urban_rural, species, cells) AS vc,
                 min(year) OVER (PARTITION BY region, urban_rural, species, cells) AS fc,
                 count(*) OVER (PARTITION BY region, urban_rural, species, ordered) AS vo,
                 min(year) OVER (PARTITION BY region, urban_rural, species, ordered) AS fo
          FROM years
        )""",
        select="""SELECT region, urban_rural, species, year, n,
            n = first_value(n) OVER (PARTITION BY region, urban_rural, species ORDER BY vn DESC, fn) AS same_count,
            cells = first_value(cells) OVER (PARTITION BY region, urban_rural, species ORDER BY vc DESC, fc)
              AS same_cells,
            ordered = first_value(ordered) OVER (PARTITION BY region, urban_rural, species ORDER BY vo DESC, fo)
              AS same_order FROM votes""",
    ),
    "polygon_validity": _sql(
        BLOCKS,
        select="""SELECT geoid, 1 AS n_rings,
            CASE q % 10 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 4 THEN 6 ELSE 5 END AS n_points,
            q % 10 <> 1 AS all_closed, q % 10 <> 2 AS enough_points,
            q % 10 NOT IN (2, 3, 5) AS has_area, q % 10 = 4 AS repeated_points,
            q % 10 IN (2, 3, 5) AS crosses, q % 10 NOT IN (1, 2, 3, 4, 5) AS valid FROM b""",
    ),
    "polygon_repair": _sql(
        BLOCKS,
        select="""SELECT geoid, CASE q % 3 WHEN 2 THEN 1 ELSE 2 END AS n_rings,
            CASE q % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 3.0 ELSE 2.0 END * hx * hy AS area,
            false AS crosses, true AS valid FROM b""",
    ),
}
