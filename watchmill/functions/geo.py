"""Regions as points."""

from functools import reduce

from pyspark.sql import Column, functions as F

from watchmill import fixed_values as V


def _point(geo: tuple[float, float, str]) -> Column:
    lat, lng, city = geo
    return F.struct(F.lit(lat).alias("lat"), F.lit(lng).alias("lng"), F.lit(city).alias("city"))


def _known(region: Column, otherwise: Column) -> Column:
    cases = reduce(lambda c, kv: c.when(region == kv[0], _point(kv[1])), V.REGION_GEO.items(), F)
    return cases.otherwise(otherwise)


def source_geo(ip_region: Column) -> Column:
    return _known(ip_region, _point(V.NO_GEO))


def dest_geo(ip_region: Column, user_region: Column) -> Column:
    return F.when(ip_region.eqNullSafe(user_region), _point(V.SERVER_GEO)).otherwise(
        _known(user_region, _point(V.SERVER_GEO))
    )
