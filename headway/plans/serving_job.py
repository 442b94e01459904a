"""The serving layer over the published tables: batch view + speed view -> verdicts.

Reads what the batch job (``batch_view/``) and the speed layer (the speed
view) wrote; nothing is recomputed from events. Both tables are small
(routes x buckets, routes x windows) and keyed by route, so the merge is two
route-keyed aggregates joined once.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.columns import ts_literal
from headway.operators import serving as V
from headway.sources.published import read_view
from headway.streaming.jobs import read_speed_view


def route_verdicts(spark: SparkSession, speed_view_path: str, batch_view_path: str,
                   as_of: datetime, route_id: str | None = None,
                   apply_ttl: bool = False) -> DataFrame:
    """Merged row per route (or for one route) as of ``as_of``.

    ``apply_ttl`` drops speed-view rows whose one-hour TTL has passed at
    ``as_of`` (and prunes their date folders) before picking the newest.
    """
    alive = ts_literal(as_of) if apply_ttl else None
    speed = read_speed_view(spark, speed_view_path, alive_at=alive)
    base = read_view(spark, batch_view_path)
    if route_id is not None:
        speed = speed.filter(F.col("route_id") == route_id)
        base = base.filter(F.col("route_id") == route_id)
    return V.serving_merge(speed, base, as_of)
