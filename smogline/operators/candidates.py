"""Candidate sites: the light pole of each priority for planned sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogline.functions.geo import geocode
from smogline.functions.values import quoted
from smogline.operators.joins import lookup_join

PRIORITIES = range(1, 6)

# Site columns and the pole columns they must equal.
SITE_KEYS = {
    "EPA Grid Point ID": "sensorID",
    "Community Area Number": "ComArea",
    "Ward Number": "Ward",
    "Zipcode": "Zip",
}

# The output columns of each priority.
FILLED = {
    "id": "Priority {} CDOT Light Pole ID",
    "geocode": "Priority {} CDOT Light Pole Location Geocode",
    "address": "Priority {} CDOT Light Pole Address",
}


def first_poles(poles: DataFrame, priorities=PRIORITIES, order_col: str = "_ord") -> DataFrame:
    """Per site key, the first pole of every priority by the explicit order column.

    The least (order, pole) pair is a map-side aggregate: one shuffle of one partial row
    per site key and task, however many poles a key has.
    """
    pole = F.struct(F.col(order_col).alias("ord"), F.col("FEATURE_ID").alias("id"),
                    F.col("Address").alias("address"), F.col("Latitude").alias("lat"), F.col("Longitude").alias("lon"))
    return (poles.filter(F.col("Candidate").isin(*priorities)).groupBy(*SITE_KEYS.values())
            .agg(*[F.min(F.when(F.col("Candidate") == p, pole)).alias(f"_p{p}") for p in priorities]))


def fill_candidates(sites: DataFrame, poles: DataFrame, priorities=PRIORITIES, order_col: str = "_ord") -> DataFrame:
    """Add id, geocode and address of the first matching pole for each priority.

    Poles are brought to one row per site key before the join, so the join adds columns
    and no rows.
    """
    filled = [c.format(p) for p in priorities for c in FILLED.values()]
    wide = first_poles(poles, priorities, order_col).select(
        *[F.col(p).alias(s) for s, p in SITE_KEYS.items()],
        *[(geocode(f"_p{p}.lat", f"_p{p}.lon") if part == "geocode" else F.col(f"_p{p}.{part}")).alias(name.format(p))
          for p in priorities for part, name in FILLED.items()])
    columns = [c for c in sites.columns if c not in filled]
    return lookup_join(sites.select(*[quoted(c) for c in columns]), wide, list(SITE_KEYS), "left").select(
        *[quoted(c) for c in [*columns, *filled]])


def unmatched_candidates(sites: DataFrame, poles: DataFrame, priorities=PRIORITIES, strict: bool = False) -> DataFrame:
    """Sites and priorities without a pole; ``strict`` raises when there are any."""
    keys = list(SITE_KEYS)
    wanted = sites.select(*[quoted(k) for k in keys],
                          F.explode(F.array(*[F.lit(p) for p in priorities])).alias("Candidate"))
    known = poles.select(*[F.col(p).alias(s) for s, p in SITE_KEYS.items()], "Candidate").distinct()
    left = lookup_join(wanted, known, [*keys, "Candidate"], "left_anti")
    if strict and (example := left.first()) is not None:
        raise LookupError(f"no pole for {example.asDict()}")
    return left
