"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code, in the style of the published SQL:
ordinal ``GROUP BY`` over the snapped expressions, ``CASE`` zones, ``quantile_cont``.
``+ 0e0`` turns DuckDB's ``round(-0.4) = -0.0`` into 0.0 (both engines group the two
zeros together anyway). Every DOUBLE output is rounded to 6 digits, as on the
Spark side.
"""

from __future__ import annotations

from tidemart.sources.fixtures import EDGE_EXPRS, RAW_SLA_EXPRS, RAW_SST_EXPRS, RAW_SST_KELVIN_EXPR, select_sql


def _sel(exprs) -> str:
    return select_sql(exprs)


# lower edges of the zones from north to south; a latitude lies in the first zone whose edge it reaches
_EDGES = [(66.5, "Arctic"), (23.5, "N. Temperate"), (-23.5, "Tropical"), (-66.5, "S. Temperate")]
_EDGE_ROWS = ", ".join(f"({edge}e0, '{name}')" for edge, name in _EDGES)


def zone_sql(lat: str) -> str:
    """Range lookup in the edge table: the highest edge at or below the latitude."""
    return (f"coalesce((SELECT arg_max(e.zone, e.edge) FROM (VALUES {_EDGE_ROWS}) AS e(edge, zone) "
            f"WHERE e.edge <= {lat}), 'Antarctic')")


BASE = f"""
WITH raw_sst AS (SELECT {_sel(RAW_SST_EXPRS)} FROM lineitem),
raw_sla AS (SELECT {_sel(RAW_SLA_EXPRS)} FROM orders),
edge AS (SELECT {_sel(EDGE_EXPRS)} FROM lineitem),
staging_sst AS (
    SELECT make_date(cast(year AS BIGINT), cast(month AS BIGINT), 1) AS year_month,
           cast(year AS BIGINT) AS year, cast(month AS BIGINT) AS month,
           round(cast(latitude AS DOUBLE) / 0.25e0) * 0.25e0 + 0e0 AS latitude,
           round(cast(longitude AS DOUBLE) / 0.25e0) * 0.25e0 + 0e0 AS longitude,
           avg(sst_celsius) AS sst_celsius,
           avg(sea_ice_fraction) AS sea_ice_fraction
    FROM raw_sst GROUP BY 1, 2, 3, 4, 5),
staging_sla AS (
    SELECT make_date(year, month, 1) AS year_month,
           cast(year AS BIGINT) AS year, cast(month AS BIGINT) AS month,
           round(cast(latitude AS DOUBLE) / 0.25e0) * 0.25e0 + 0e0 AS latitude,
           round(cast(longitude AS DOUBLE) / 0.25e0) * 0.25e0 + 0e0 AS longitude,
           avg(sea_level_anomaly_m) AS sea_level_anomaly_m
    FROM raw_sla GROUP BY 1, 2, 3, 4, 5),
monthly AS (
    SELECT sla.year_month, sla.year, sla.month,
           avg(sla.sea_level_anomaly_m) AS avg_sla_m,
           avg(sst.sst_celsius) AS avg_sst_celsius,
           avg(sst.sea_ice_fraction) AS avg_sea_ice_fraction,
           count(*) AS grid_points
    FROM staging_sla AS sla
    JOIN staging_sst AS sst USING (year_month, latitude, longitude)
    GROUP BY 1, 2, 3),
zone_stats AS (
    SELECT sla.year_month, sla.year, sla.month,
           {zone_sql('sla.latitude')} AS latitude_zone,
           avg(sla.sea_level_anomaly_m) AS avg_sla_m,
           avg(sst.sst_celsius) AS avg_sst_celsius,
           avg(sst.sea_ice_fraction) AS avg_sea_ice_fraction,
           count(*) AS grid_points
    FROM staging_sla AS sla
    JOIN staging_sst AS sst USING (year_month, latitude, longitude)
    GROUP BY 1, 2, 3, 4),
latest_sla AS (
    SELECT year AS latest_year, month AS latest_month FROM raw_sla ORDER BY year DESC, month DESC LIMIT 1)
"""


def q(body: str, round_cols: list[str] | tuple = ()) -> str:
    if round_cols:
        rep = ", ".join(f"CASE WHEN isnan({c}) OR isinf({c}) THEN {c} "
                        f"ELSE cast(round(cast({c} AS DECIMAL(38, 12)), 6) AS DOUBLE) END AS {c}"
                        for c in round_cols)
        return f"{BASE}SELECT * REPLACE ({rep}) FROM ({body}) AS _q"
    return f"{BASE}{body}"


def _decade_case(edges, else_label, col="year") -> str:
    parts = " ".join(f"WHEN {col} BETWEEN {lo} AND {hi} THEN '{lab}'" for lo, hi, lab in edges)
    return f"CASE {parts} ELSE '{else_label}' END"


_DEFAULT_DECADE = _decade_case([(1993, 2002, "1993-2002"), (2003, 2012, "2003-2012")], "2013-2023")
_NARROW_DECADE = _decade_case([(1995, 1996, "1995-1996"), (1997, 1998, "1997-1998")], "1999-2001")

_LIMITS = """
    SELECT count(v) AS n, quantile_cont(v, 0.02) AS p02, quantile_cont(v, 0.98) AS p98 {extra}
    FROM (SELECT {col} AS v FROM {src}
          WHERE (year, month) = (SELECT (latest_year, latest_month) FROM latest_sla)
            AND {col} IS NOT NULL AND NOT isnan({col})) AS s"""


def _trend_body(src: str, where: str) -> str:
    return f"""
    WITH d AS (
        SELECT year_month, avg_sla_m * 100 AS avg_sla_cm, avg_sst_celsius
        FROM {src} WHERE {where}),
    x AS (SELECT *, cast(datediff('day', min(year_month) OVER (), year_month) AS DOUBLE) AS x_days FROM d)
    SELECT year_month, avg_sla_cm, avg_sst_celsius, x_days,
           regr_slope(avg_sla_cm, x_days) OVER () * x_days
             + regr_intercept(avg_sla_cm, x_days) OVER () AS trend_sla_cm,
           regr_slope(avg_sst_celsius, x_days) OVER () * x_days
             + regr_intercept(avg_sst_celsius, x_days) OVER () AS trend_sst_celsius
    FROM x"""


_RASTER_I = ("cast(least({hi}, greatest(0, cast(round_even((cast({c} AS DOUBLE) - ({o})) / 0.25e0, 0) "
             "AS INTEGER))) AS INTEGER)")


def _raster_i(c, origin, n) -> str:
    return _RASTER_I.format(c=c, o=f"{origin}e0", hi=n - 1)


_LATEST_STAGED = "(SELECT max(year_month) FROM staging_sst)"

_CHECKS = {
    "not_empty": "SELECT 'not_empty' AS \"check\", count(*) > 0 AS passed, "
                 "cast(CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS BIGINT) AS violations FROM monthly",
    "positive": "SELECT 'positive(grid_points)' AS \"check\", "
                "count_if(NOT coalesce(grid_points > 0, false)) = 0 AS passed, "
                "cast(count_if(NOT coalesce(grid_points > 0, false)) AS BIGINT) AS violations FROM monthly",
    "not_null": "SELECT 'not_null(year_month)' AS \"check\", count_if(year_month IS NULL) = 0 AS passed, "
                "cast(count_if(year_month IS NULL) AS BIGINT) AS violations FROM monthly",
    "unique": "SELECT 'unique(year_month)' AS \"check\", count(*) = count(DISTINCT year_month) AS passed, "
              "count(*) - count(DISTINCT year_month) AS violations FROM monthly",
    "accepted": "SELECT 'accepted_values(latitude_zone)' AS \"check\", "
                "count_if(NOT coalesce(latitude_zone IN ('Arctic', 'N. Temperate', 'Tropical', "
                "'S. Temperate', 'Antarctic'), false)) = 0 AS passed, "
                "cast(count_if(NOT coalesce(latitude_zone IN ('Arctic', 'N. Temperate', 'Tropical', "
                "'S. Temperate', 'Antarctic'), false)) AS BIGINT) AS violations FROM zone_stats",
    "zone_key": "SELECT 'zones.key_unique' AS \"check\", "
                "count(*) = (SELECT count(*) FROM (SELECT DISTINCT year_month, latitude_zone FROM zone_stats)) "
                "AS passed, count(*) - (SELECT count(*) FROM (SELECT DISTINCT year_month, latitude_zone "
                "FROM zone_stats)) AS violations FROM zone_stats",
}


#: longitudes of the fixture's lattice, spelled out (an independent list)
_LATTICE = ("-180.0", "-135.0", "-90.0", "-45.0", "0.0", "45.0", "90.0", "135.0", "180.0")


def _grid(value: str, src: str) -> str:
    """Latitude by longitude of the newest SLA month; a value off the lattice gets a row of its own."""
    cells = ", ".join(f'max({value}) FILTER (longitude = {x}e0) AS "{x}"' for x in _LATTICE)
    return q(f"""SELECT latitude, {cells} FROM {src}
                 WHERE year_month = (SELECT make_date(latest_year, latest_month, 1) FROM latest_sla)
                 GROUP BY latitude, longitude NOT IN ({", ".join(x + "e0" for x in _LATTICE)})""",
             ["latitude", *[f'"{x}"' for x in _LATTICE]])


def _raster_rows() -> str:
    return q(f"""
        SELECT {_LATEST_STAGED} AS year_month, lat_i, -90e0 + lat_i * 0.25e0 AS latitude,
               list(v ORDER BY lon_i) AS "values"
        FROM (SELECT cast(a.range AS INTEGER) AS lat_i, b.range AS lon_i, coalesce(c.v, 'NaN'::DOUBLE) AS v
              FROM range(721) AS a CROSS JOIN range(1441) AS b
              LEFT JOIN (SELECT round((latitude + 90e0) / 0.25e0) AS y, round((longitude + 180e0) / 0.25e0) AS x,
                                cast(round(cast(sst_celsius AS DECIMAL(38, 12)), 6) AS DOUBLE) AS v
                         FROM staging_sst WHERE year_month = {_LATEST_STAGED}) AS c ON c.y = a.range AND c.x = b.range)
        GROUP BY lat_i""")


def _named(sql: str, name: str) -> str:
    return f"SELECT '{name}' AS \"check\", passed, violations FROM ({sql}) AS c"


ORACLE: dict[str, str] = {
    "snap": q("""SELECT year, month, latitude, longitude,
                 round(cast(latitude AS DOUBLE) / 0.25e0) * 0.25e0 + 0e0 AS lat_snap,
                 round(cast(longitude AS DOUBLE) / 0.25e0) * 0.25e0 + 0e0 AS lon_snap
                 FROM raw_sst"""),
    "calendar": q("""SELECT year_month, strftime(year_month, '%Y-%m') AS month_label,
                     cast(substr(strftime(year_month, '%Y-%m'), 1, 4) AS INTEGER) AS label_year,
                     cast(substr(strftime(year_month, '%Y-%m'), 6, 2) AS INTEGER) AS label_month,
                     cast(strftime(year_month, '%Y-%m') || '-01' AS DATE) AS parsed_date,
                     cast(year(year_month) AS INTEGER) AS year
                     FROM (SELECT DISTINCT make_date(year, month, 1) AS year_month FROM raw_sla) AS m"""),
    "latitude_zone": q(f"""SELECT year_month, latitude, longitude, {zone_sql('latitude')} AS latitude_zone
                           FROM staging_sla"""),
    "decade": q(f"""SELECT year, {_DEFAULT_DECADE} AS decade, count(*) AS n_obs
                    FROM raw_sla GROUP BY year"""),
    "regrid_sst": q("SELECT * FROM staging_sst", ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "stage_sla": q("SELECT * FROM staging_sla", ["latitude", "longitude", "sea_level_anomaly_m"]),
    "cell_join": q("""SELECT year_month, sla.year, sla.month, latitude, longitude,
                      sla.sea_level_anomaly_m, sst.sst_celsius, sst.sea_ice_fraction
                      FROM staging_sla AS sla JOIN staging_sst AS sst USING (year_month, latitude, longitude)""",
                   ["latitude", "longitude", "sea_level_anomaly_m", "sst_celsius", "sea_ice_fraction"]),
    "monthly_global_trends": q("SELECT * FROM monthly",
                               ["avg_sla_m", "avg_sst_celsius", "avg_sea_ice_fraction"]),
    "monthly_global_trends_range": q(
        "SELECT * FROM monthly WHERE year_month BETWEEN DATE '1997-03-15' AND DATE '1999-06-30'",
        ["avg_sla_m", "avg_sst_celsius", "avg_sea_ice_fraction"]),
    "latitude_zone_stats": q("SELECT * FROM zone_stats",
                             ["avg_sla_m", "avg_sst_celsius", "avg_sea_ice_fraction"]),
    "monthly_from_partials": q("SELECT * FROM monthly",
                               ["avg_sla_m", "avg_sst_celsius", "avg_sea_ice_fraction"]),
    "zones_from_partials": q("SELECT * FROM zone_stats",
                             ["avg_sla_m", "avg_sst_celsius", "avg_sea_ice_fraction"]),
    "decadal_means": q(f"""SELECT {_DEFAULT_DECADE} AS decade, avg(avg_sla_m) AS avg_sla_m,
                           avg(avg_sst_celsius) AS avg_sst_celsius FROM monthly GROUP BY 1""",
                       ["avg_sla_m", "avg_sst_celsius"]),
    "decadal_means_narrow": q(f"""SELECT {_NARROW_DECADE} AS decade, avg(avg_sla_m) AS avg_sla_m,
                                  avg(avg_sst_celsius) AS avg_sst_celsius FROM monthly GROUP BY 1""",
                              ["avg_sla_m", "avg_sst_celsius"]),
    "raw_cell_join": q("""SELECT year, month, latitude, longitude, sea_level_anomaly_m, sst_celsius,
                          sea_ice_fraction FROM raw_sla JOIN raw_sst USING (year, month, latitude, longitude)""",
                       ["latitude", "longitude", "sea_level_anomaly_m", "sst_celsius", "sea_ice_fraction"]),
    "raw_monthly_trends": q("""SELECT make_date(sla.year, sla.month, 1) AS year_month,
                               avg(sla.sea_level_anomaly_m) AS avg_sla_m, avg(sst.sst_celsius) AS avg_sst_celsius
                               FROM raw_sla AS sla JOIN raw_sst AS sst USING (year, month, latitude, longitude)
                               GROUP BY sla.year, sla.month""", ["avg_sla_m", "avg_sst_celsius"]),
    "raw_zone_stats": q(f"""SELECT make_date(sla.year, sla.month, 1) AS year_month,
                            {zone_sql('sla.latitude')} AS latitude_zone,
                            avg(sla.sea_level_anomaly_m) AS avg_sla_m, avg(sst.sst_celsius) AS avg_sst_celsius
                            FROM raw_sla AS sla JOIN raw_sst AS sst USING (year, month, latitude, longitude)
                            GROUP BY sla.year, sla.month, latitude_zone""", ["avg_sla_m", "avg_sst_celsius"]),
    "misaligned_join": q("""SELECT count(*) AS joined_rows
                            FROM (SELECT year_month, latitude + 5e0 AS latitude, longitude + 15e0 AS longitude
                                  FROM staging_sla) AS sla
                            JOIN staging_sst AS sst USING (year_month, latitude, longitude)"""),
    "latest_month": q("SELECT latest_year, latest_month FROM latest_sla"),
    "sla_map_limits": q(_LIMITS.format(col="sea_level_anomaly_m", src="raw_sla",
                                       extra=", greatest(abs(quantile_cont(v, 0.02)), "
                                             "abs(quantile_cont(v, 0.98))) AS abs_max"),
                        ["p02", "p98", "abs_max"]),
    "sst_map_limits": q(_LIMITS.format(col="sst_celsius", src="raw_sst", extra=""), ["p02", "p98"]),
    "zone_percentiles": q(f"""SELECT latitude_zone, count(sst_celsius) AS n,
                              quantile_cont(sst_celsius, 0.02) AS p02, quantile_cont(sst_celsius, 0.5) AS p50,
                              quantile_cont(sst_celsius, 0.98) AS p98
                              FROM (SELECT {zone_sql('latitude')} AS latitude_zone, sst_celsius FROM staging_sst
                                    WHERE sst_celsius IS NOT NULL AND NOT isnan(sst_celsius)) AS z
                              GROUP BY 1""", ["p02", "p50", "p98"]),
    "linear_trend": q("""SELECT regr_slope(y, x) AS sla_slope, regr_intercept(y, x) AS sla_intercept,
                         count(y) AS sla_n_points
                         FROM (SELECT avg_sla_m * 100 AS y,
                                      cast(datediff('day', min(year_month) OVER (), year_month) AS DOUBLE) AS x
                               FROM monthly WHERE year(year_month) BETWEEN 1993 AND 2023) AS t""",
                      ["sla_slope", "sla_intercept"]),
    "linear_trend_ordinal": q("""
        WITH t AS (SELECT make_date(sla.year, sla.month, 1) AS year_month,
                          avg(sla.sea_level_anomaly_m) AS avg_sla_m, avg(sst.sst_celsius) AS avg_sst_celsius
                   FROM raw_sla AS sla JOIN raw_sst AS sst USING (year, month, latitude, longitude)
                   GROUP BY sla.year, sla.month),
        o AS (SELECT *, cast(row_number() OVER (ORDER BY year_month) - 1 AS DOUBLE) AS x_ordinal FROM t)
        SELECT year_month, avg_sla_m, avg_sst_celsius, x_ordinal,
               regr_slope(avg_sla_m, x_ordinal) OVER () * x_ordinal
                 + regr_intercept(avg_sla_m, x_ordinal) OVER () AS trend_sla_m,
               regr_slope(avg_sst_celsius, x_ordinal) OVER () * x_ordinal
                 + regr_intercept(avg_sst_celsius, x_ordinal) OVER () AS trend_sst_celsius
        FROM o""", ["avg_sla_m", "avg_sst_celsius", "x_ordinal", "trend_sla_m", "trend_sst_celsius"]),
    "trends": q(_trend_body("monthly", "year(year_month) BETWEEN 1993 AND 2023"),
                ["avg_sla_cm", "avg_sst_celsius", "x_days", "trend_sla_cm", "trend_sst_celsius"]),
    "trends_window": q(_trend_body("monthly", "year(year_month) BETWEEN 1997 AND 1999"),
                       ["avg_sla_cm", "avg_sst_celsius", "x_days", "trend_sla_cm", "trend_sst_celsius"]),
    "decades": q(f"""SELECT decade, avg_sla_m, avg_sst_celsius, avg_sla_m * 100 AS avg_sla_cm FROM (
                     SELECT {_DEFAULT_DECADE} AS decade, avg(avg_sla_m) AS avg_sla_m,
                            avg(avg_sst_celsius) AS avg_sst_celsius FROM monthly GROUP BY 1) AS d""",
                 ["avg_sla_m", "avg_sst_celsius", "avg_sla_cm"]),
    "zones": q("SELECT year_month, latitude_zone, avg_sst_celsius FROM zone_stats", ["avg_sst_celsius"]),
    "zone_markers": q("""SELECT latitude_zone, min(year_month) AS first_month,
                         arg_min(avg_sst_celsius, year_month) AS first_avg_sst_celsius
                         FROM zone_stats GROUP BY 1""", ["first_avg_sst_celsius"]),
    "distinct_zones": q("SELECT DISTINCT latitude_zone FROM zone_stats"),
    "sorted_axis": q("SELECT DISTINCT longitude FROM raw_sst ORDER BY 1"),
    "raster_index": q(f"""SELECT year_month, latitude, longitude,
                          {_raster_i('latitude', -90, 721)} AS lat_i,
                          {_raster_i('longitude', -180, 1441)} AS lon_i
                          FROM staging_sst"""),
    "sst_map": q(f"""
        WITH cells AS (
            SELECT {_raster_i('latitude', -90, 721)} AS lat_i, {_raster_i('longitude', -180, 1441)} AS lon_i,
                   sst_celsius
            FROM staging_sst WHERE year_month = {_LATEST_STAGED}),
        spine AS (SELECT cast(a.range AS INTEGER) AS lat_i, cast(b.range AS INTEGER) AS lon_i
                  FROM range(721) AS a, range(1441) AS b)
        SELECT {_LATEST_STAGED} AS year_month, lat_i, lon_i,
               -90e0 + lat_i * 0.25e0 AS latitude, -180e0 + lon_i * 0.25e0 AS longitude,
               coalesce(c.sst_celsius, 'NaN'::DOUBLE) AS sst_celsius
        FROM spine LEFT JOIN cells AS c USING (lat_i, lon_i)""", ["latitude", "longitude", "sst_celsius"]),
    "grid_flatten": q(f"""SELECT year_month, latitude, longitude, sst_celsius FROM staging_sst
                          WHERE year_month = {_LATEST_STAGED}""", ["latitude", "longitude", "sst_celsius"]),
    "latest_sla_grid": _grid("sea_level_anomaly_m", "staging_sla"),
    "latest_sst_grid": _grid("sst_celsius", "staging_sst"),
    "sst_map_month": q("""SELECT year_month, latitude, longitude, sst_celsius FROM staging_sst
                          WHERE year = 1997 AND month = 6""", ["latitude", "longitude", "sst_celsius"]),
    "grid_flatten_two": q(f"""SELECT year_month, latitude, longitude, sst_celsius, sea_ice_fraction FROM staging_sst
                              WHERE year_month = {_LATEST_STAGED}""",
                          ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "scan_range": q("""SELECT * FROM raw_sst WHERE (year = 1996 AND month >= 11) OR (year = 1997 AND month <= 2)""",
                    ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "published_range": q("""SELECT * FROM raw_sst WHERE (year = 1996 AND month >= 11) OR (year = 1997 AND month <= 2)""",
                         ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "newest_month_slice": q("""SELECT * FROM raw_sla WHERE year * 12 + month = (SELECT max(year * 12 + month) FROM raw_sla)""",
                            ["latitude", "longitude", "sea_level_anomaly_m"]),
    "staged_view": q("SELECT * FROM staging_sla", ["latitude", "longitude", "sea_level_anomaly_m"]),
    "ctas_table": q("""SELECT year, month, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY year) AS BIGINT) AS year_n,
                       max(sea_level_anomaly_m) AS top FROM raw_sla GROUP BY year, month""", ["top"]),
    "month_replacement": q("""SELECT * REPLACE (CASE WHEN year = 1996 THEN sst_celsius + 100 ELSE sst_celsius END AS sst_celsius)
                              FROM staging_sst WHERE year <> 1996 OR latitude >= 0
                              OR year_month NOT IN (SELECT year_month FROM staging_sst WHERE latitude >= 0)""",
                           ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "bulk_load": q("""SELECT * FROM raw_sla WHERE year IN (1995, 1997) UNION ALL
                      SELECT * FROM raw_sla WHERE year IN (1995, 1997)""", ["latitude", "longitude", "sea_level_anomaly_m"]),
    "rename_tag": q("""SELECT latitude, longitude, sst_celsius + 273.15 AS sst_celsius, sea_ice_fraction, year, month
                       FROM raw_sst WHERE year = 1997 AND month = 6""", ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "trends_ordered": q("SELECT year_month, row_number() OVER (ORDER BY year_month) AS position FROM monthly"),
    "concat_months": q("""SELECT * FROM raw_sla WHERE (year, month) IN ((1995, 3), (1996, 4))""",
                       ["latitude", "longitude", "sea_level_anomaly_m"]),
    "values_join": q("""SELECT latitude_zone, count(*) AS months, cast(CASE latitude_zone WHEN 'Arctic' THEN 1
                        WHEN 'Tropical' THEN 3 ELSE 5 END AS INTEGER) AS code FROM zone_stats
                        WHERE latitude_zone IN ('Arctic', 'Tropical', 'Antarctic') GROUP BY 1"""),
    "zone_slice": q("SELECT * FROM zone_stats WHERE latitude_zone = 'Tropical'",
                    ["avg_sla_m", "avg_sst_celsius", "avg_sea_ice_fraction"]),
    "point_lookup": q("""SELECT * FROM staging_sst WHERE abs(latitude - 7.5e0) < 0.01e0
                         AND abs(longitude + 45e0) < 0.01e0""",
                      ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "linear_trend_by_zone": q("""SELECT latitude_zone, regr_slope(avg_sst_celsius, year) AS slope,
                                 regr_intercept(avg_sst_celsius, year) AS intercept, count(avg_sst_celsius) AS n_points
                                 FROM zone_stats GROUP BY 1""", ["slope", "intercept"]),
    "sst_raster_rows": _raster_rows(),
    "zone_series_arrays": q("""SELECT latitude_zone, list(strftime(year_month, '%Y-%m-%d') ORDER BY year_month) AS months,
                               list(cast(round(cast(avg_sst_celsius AS DECIMAL(38, 12)), 6) AS DOUBLE) ORDER BY year_month)
                                 AS avg_sst_celsius FROM zone_stats GROUP BY 1"""),
    "edge_regrid": q("""SELECT make_date(year, month, 1) AS year_month, cast(year AS BIGINT) AS year,
                        cast(month AS BIGINT) AS month, round(latitude / 0.25e0) * 0.25e0 + 0e0 AS latitude,
                        round(longitude / 0.25e0) * 0.25e0 + 0e0 AS longitude, avg(sst_celsius) AS sst_celsius,
                        avg(sea_ice_fraction) AS sea_ice_fraction FROM edge
                        WHERE sst_celsius IS NOT NULL AND NOT isnan(sst_celsius) GROUP BY 1, 2, 3, 4, 5""",
                     ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "edge_zones": q(f"""SELECT {zone_sql('latitude')} AS latitude_zone, CASE WHEN year < 2003 THEN '1993-2002'
                        WHEN year < 2013 THEN '2003-2012' ELSE '2013-2023' END AS decade,
                        abs(latitude) IN (66.5e0, 23.5e0) AS on_edge, count(*) AS n FROM edge GROUP BY ALL"""),
    "edge_percentiles": q("""SELECT CASE WHEN month < 12 THEN month END AS grp, count(v) AS n,
                             quantile_cont(v, 0.02) AS p02, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.98) AS p98
                             FROM (SELECT month, CASE WHEN month <> 3 AND NOT isnan(sst_celsius) THEN sst_celsius END AS v
                                   FROM edge) AS e GROUP BY 1""", ["p02", "p50", "p98"]),
    "edge_checks": q(f"""
        SELECT 'unique(year,month)' AS "check", count(*) = count(DISTINCT (year, month)) AS passed,
               count(*) - count(DISTINCT (year, month)) AS violations FROM edge
        UNION ALL SELECT 'not_null(sst_celsius)', count(*) = count(sst_celsius), count(*) - count(sst_celsius) FROM edge
        UNION ALL SELECT 'accepted_values(latitude_zone)', count(*) FILTER (z NOT IN ('Arctic', 'Tropical')) = 0,
               count(*) FILTER (z NOT IN ('Arctic', 'Tropical')) FROM (SELECT {zone_sql('latitude')} AS z FROM edge)
        UNION ALL SELECT 'positive(v)', count(*) FILTER (year <= 2000) = 0, count(*) FILTER (year <= 2000) FROM edge
        UNION ALL SELECT 'not_empty', false, cast(1 AS BIGINT)"""),
    "quality_checks": q(" UNION ALL ".join([
        _named(_CHECKS["not_empty"], "monthly.not_empty"),
        _named(_CHECKS["positive"], "monthly.grid_points_positive"),
        _named(_CHECKS["not_null"], "monthly.year_month_not_null"),
        _named(_CHECKS["unique"], "monthly.year_month_unique"),
        _named(_CHECKS["accepted"], "zones.accepted_zone_names"),
        _CHECKS["zone_key"],
    ])),
    "quality_checks_marts": q(" UNION ALL ".join([
        _named(_CHECKS["not_empty"], "monthly.not_empty"),
        _named(_CHECKS["positive"], "monthly.grid_points_positive"),
        _named(_CHECKS["not_null"], "monthly.year_month_not_null"),
        _named(_CHECKS["unique"], "monthly.year_month_unique"),
        _named(_CHECKS["accepted"], "zones.accepted_zone_names"),
        _CHECKS["zone_key"],
    ])),
    "check_unique": q(_CHECKS["unique"]),
    "check_not_null": q(_CHECKS["not_null"]),
    "check_accepted_values": q(_CHECKS["accepted"]),
    "check_positive": q(_CHECKS["positive"]),
    "check_not_empty": q(_CHECKS["not_empty"]),
    "empty_typed": q("SELECT * FROM staging_sst", ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
    "month_spine": q("""SELECT cast(m AS DATE) AS year_month, cast(year(m) AS INTEGER) AS year,
                        cast(month(m) AS INTEGER) AS month
                        FROM generate_series(date_trunc('month', (SELECT min(o_orderdate) FROM orders)),
                                             date_trunc('month', (SELECT max(o_orderdate) FROM orders)),
                                             INTERVAL 1 MONTH) AS g(m)"""),
    "kelvin_to_celsius": q(f"""SELECT year, month, latitude, longitude, analysed_sst - 273.15e0 AS sst_celsius
                               FROM (SELECT {_sel([x for x in RAW_SST_EXPRS if x[0] != 'sst_celsius']
                                                   + [RAW_SST_KELVIN_EXPR])} FROM lineitem) AS k""",
                           ["latitude", "longitude", "sst_celsius"]),
    "drop_missing": q("""SELECT * FROM raw_sst WHERE sea_ice_fraction IS NOT NULL AND NOT isnan(sea_ice_fraction)""",
                      ["latitude", "longitude", "sst_celsius", "sea_ice_fraction"]),
}

# other ways to the same rows
ORACLE["bucketed_join"] = ORACLE["cell_join"]
ORACLE["raw_cell_join_filtered"] = ORACLE["raw_cell_join"]
