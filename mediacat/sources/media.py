"""Media sources as tables: candidate addresses, fetch outcomes, probe results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import MANIFEST_SUFFIX
from ..schemas import PROBE
from .catalog import KEY


def candidate_urls(plan: DataFrame, gateways: Sequence[str]) -> DataFrame:
    """Addresses of each item in gateway order (input of ``fetch_plan``)."""
    path = F.when(F.col("route") == "hls", F.concat("fetch_cid", F.lit(MANIFEST_SUFFIX))).otherwise(
        F.col("fetch_cid")
    )
    bases = F.array(*[F.lit(g) for g in gateways])
    return plan.where(F.col("route") != "skip").select(
        *KEY, "route", path.alias("_path"), F.posexplode(bases).alias("gateway_ord", "_base")
    ).select(*KEY, "route", "gateway_ord", F.concat("_base", "_path").alias("url"))


def first_success(items: DataFrame, attempts: DataFrame, gateways: Sequence[str]) -> DataFrame:
    """First gateway that delivered each item, in gateway order; NULL if none did.

    ``items`` carries ``route`` and ``fetch_cid``. Over HLS an empty file is no success.
    """
    outcome = attempts.groupBy(*KEY).agg(
        F.min(F.when(F.col("ok"), F.col("ord"))).alias("_any"),
        F.min(F.when(F.col("ok") & (F.col("size_bytes") > 0), F.col("ord"))).alias("_filled"),
    )
    bases = F.array(*[F.lit(g) for g in gateways])
    hls = F.col("route") == "hls"
    return (
        items.join(outcome, KEY, "left")
        .withColumn("gateway_ord", F.when(hls, F.col("_filled")).otherwise(F.col("_any")))
        .withColumn("_base", F.get(bases, F.col("gateway_ord")))
        .select(
            *KEY, "gateway_ord",
            F.concat("_base", "fetch_cid", F.when(hls, F.lit(MANIFEST_SUFFIX)).otherwise("")).alias("url"),
        )
    )


def media_info(probes: DataFrame, probe: str = "probe") -> DataFrame:
    """Duration, size and first codecs from probe JSON; absent numbers are 0."""
    parsed = F.from_json(F.col(probe), PROBE)

    def first(kind: str):
        return F.get(F.filter(F.col("_p.streams"), lambda s: s["codec_type"] == kind), F.lit(0))

    return (
        probes.withColumn("_p", parsed)
        .withColumn("duration", F.coalesce(F.col("_p.format.duration").try_cast("double"), F.lit(0.0)))
        .withColumn("size", F.coalesce(F.col("_p.format.size").try_cast("bigint"), F.lit(0)))
        .withColumn("video_codec", first("video")["codec_name"])
        .withColumn("audio_codec", first("audio")["codec_name"])
        .withColumn("has_audio", F.coalesce(first("audio").isNotNull(), F.lit(False)))
        .drop("_p")
    )
