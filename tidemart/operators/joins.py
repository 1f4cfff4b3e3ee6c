"""Joins between the two observation variables.

* :func:`cell_join` (J1) — inner equi-join of staged SLA and SST on the integer cell
  key ``(year, month, lat_idx, lon_idx)``, i.e. ``USING (year_month, latitude,
  longitude)``. Both inputs come out of aggregates that are already
  hash-partitioned on exactly these keys, so Spark reuses that partitioning
  (no exchange at the join). Each key is unique per side, so there is no join skew
  even when one month holds a third of all rows: the hash spreads it over cells.
* :func:`raw_cell_join` (J2) — inner join of the *unsnapped* raw tables on
  ``(year, month, latitude, longitude)`` (float equality, as in ad-hoc exploration).
* :func:`misaligned_join_count` (J3) — the join of disjoint coordinate sets is empty.
* :func:`dense_fill` (J4) — the full cell grid with observations, missing cells as NaN
  (lives in ``operators.reshape``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.staging import CELL_KEYS

RAW_KEYS = ["year", "month", "latitude", "longitude"]


def cell_join(sla_keyed: DataFrame, sst_keyed: DataFrame) -> DataFrame:
    """``sla INNER JOIN sst USING (year_month, latitude, longitude)`` on cell indices.

    Both inputs arrive hash-partitioned on the cell key by their staging aggregates,
    so the join is partition-local. The ``merge`` hint keeps it that way: no run-time
    conversion to a broadcast (which would ship a whole month of SLA cells to every
    executor although nothing needs to move), and a sort-merge join spills instead
    of failing if a partition outgrows memory. Keys are unique per side, so no
    partition is skewed.
    """
    return sla_keyed.hint("merge").join(sst_keyed, on=CELL_KEYS, how="inner")


def key_filter(large: DataFrame, small: DataFrame, keys: list[str], log2_bits: int = 26) -> DataFrame:
    """``large`` without most of the rows whose key is not in ``small``: a Bloom filter of one hash function.

    The filter has ``2**log2_bits`` bits in words of 64, of which only those with a bit set are
    kept: at most ``2**log2_bits / 64`` rows of 16 bytes (16 MB at the default), so its broadcast is
    bounded whatever the tables' size. The keys of ``small`` are counted first (distinct ones, by a
    sketch): with more than one per eight bits the filter would pass too much, and ``large`` is
    returned as it is. Rows that pass without a partner are left to the join."""
    bits = 1 << log2_bits
    if small.agg(F.approx_count_distinct(F.struct(*keys))).first()[0] > bits // 8:
        return large
    taken = [c.lower() for c in large.columns]
    if {"_word", "_bit", "_bits"} & set(taken):
        raise ValueError("key_filter: _word, _bit and _bits are its own columns")
    place = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(bits))

    def placed(df):
        return df.withColumn("_bit", place).withColumn("_word", F.shiftright("_bit", 6))
    words = (placed(small.select(*keys)).groupBy("_word")
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_bit") % 64).cast("int"))).alias("_bits")))
    known = F.call_function("shiftrightunsigned", F.col("_bits"), (F.col("_bit") % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    return placed(large).join(F.broadcast(words), "_word").where(known).select(*large.columns)


def raw_cell_join(raw_sla: DataFrame, raw_sst: DataFrame, prefilter: bool = False,
                  shown: Callable[[Column], Column] | None = None) -> DataFrame:
    """``raw_sla JOIN raw_sst USING (year, month, latitude, longitude)``.

    Coordinates are compared as DOUBLE (a float32 source is widened first), the way
    a SQL engine compares FLOAT with FLOAT64. With ``prefilter`` the SST side passes
    :func:`key_filter` before it is shuffled, which pays when few of its points lie on the
    coarser grid (one in 25 of a 0.05 degree source).

    ``shown`` is applied to every DOUBLE of the result. Rows of a repeated key multiply in the
    join, and each value comes from one row of one side, so it is applied there, once for each
    input row; the coordinates join as they are, and SLA carries them along as shown.
    """
    def norm(df):
        return df.withColumns({
            "year": F.col("year").cast("int"), "month": F.col("month").cast("int"),
            "latitude": F.col("latitude").cast("double") + F.lit(0.0),  # -0.0 counts as 0.0, also in a hash
            "longitude": F.col("longitude").cast("double") + F.lit(0.0)})

    def made(df, columns):
        return df.withColumns({to: shown(F.col(c)) for c, to in columns.items() if isinstance(df.schema[c].dataType, T.DoubleType)})
    sla = norm(raw_sla.select(*RAW_KEYS, "sea_level_anomaly_m"))
    sst = norm(raw_sst.select(*RAW_KEYS, "sst_celsius", "sea_ice_fraction"))
    if prefilter:
        sst = key_filter(sst, sla, RAW_KEYS)
    if shown is None:
        return sla.join(sst, on=RAW_KEYS, how="inner")
    sla = made(sla, {"sea_level_anomaly_m": "sea_level_anomaly_m", "latitude": "_latitude", "longitude": "_longitude"})
    sst = made(sst, {c: c for c in ("sst_celsius", "sea_ice_fraction")})
    return sla.join(sst, on=RAW_KEYS, how="inner").select(
        "year", "month", F.col("_latitude").alias("latitude"), F.col("_longitude").alias("longitude"),
        "sea_level_anomaly_m", "sst_celsius", "sea_ice_fraction")


def misaligned_join_count(sla_keyed: DataFrame, sst_keyed: DataFrame) -> DataFrame:
    """One row ``joined_rows`` = size of the cell join (0 for disjoint grids)."""
    return cell_join(sla_keyed, sst_keyed).agg(F.count(F.lit(1)).alias("joined_rows"))


def shift_cells(keyed: DataFrame, dlat_idx: int, dlon_idx: int) -> DataFrame:
    """Move every cell by whole grid steps (used to build a misaligned copy)."""
    return keyed.withColumns({"lat_idx": F.col("lat_idx") + F.lit(dlat_idx),
                              "lon_idx": F.col("lon_idx") + F.lit(dlon_idx)})
