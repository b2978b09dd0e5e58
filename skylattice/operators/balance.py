"""Flight efficiency, rerouting suggestions and load balance of regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flight
from ..functions.numeric import fixed_text
from . import traffic

# Wording of the suggestions.
NO_REROUTING = "✅ No rerouting needed — all regions within capacity."
NO_LIGHT_REGION = "no light regions available"
VIA = "reroute via: "


def efficiency_score(
    df: DataFrame,
    *,
    ideal_speed: float = flight.IDEAL_SPEED_KMH,
    ideal_altitude: float = flight.IDEAL_ALTITUDE_M,
) -> DataFrame:
    """Rows with id, speed and altitude, each scored 0 to 100."""
    score = flight.efficiency(
        F.col("speed_kmh"),
        F.col("altitude"),
        ideal_speed=ideal_speed,
        ideal_altitude=ideal_altitude,
    )
    complete = df.dropna(subset=["icao24", "speed_kmh", "altitude"])
    return complete.withColumn("efficiency_score", score)


def mean_efficiency(rows: DataFrame) -> DataFrame:
    return traffic.mean_efficiency_of(traffic.traffic_totals(rows, ["region"]))


def lightest(metrics: DataFrame, *, light: float = 0.4, n: int = 3) -> DataFrame:
    return metrics.where(F.col("aci") < light).orderBy("aci", "region").limit(n)


def reroute(
    metrics: DataFrame,
    *,
    congested: float = 0.8,
    high: float = 1.2,
    light: float = 0.4,
    n: int = 3,
) -> DataFrame:
    """A suggestion per congested region: the same few lightest regions as alternatives.

    Without any congested region one row says so; without regions there is no row.
    Order by ``aci`` descending for the most urgent first.
    """
    # One row with at most n names, used as a scalar: no join is needed to spread it.
    ranked = F.array_sort(F.collect_list(F.struct("aci", "region")))
    names = F.concat_ws(", ", F.transform(ranked, lambda x: x["region"]))
    alternatives = lightest(metrics, light=light, n=n).agg(names).scalar()
    level = F.when(F.col("aci") > high, "HIGH").otherwise("MEDIUM")
    advice = F.when(F.col("alternatives") == "", NO_LIGHT_REGION).otherwise(
        F.concat(F.lit(VIA), F.col("alternatives"))
    )
    suggestion = F.concat(
        F.lit("["),
        F.col("level"),
        F.lit("] "),
        F.col("region"),
        F.lit(" (ACI="),
        fixed_text(F.col("aci"), 2),
        F.lit(") → "),
        advice,
    )
    suggestions = (
        metrics.where(F.col("aci") > congested)
        .select("region", level.alias("level"), "aci", alternatives.alias("alternatives"))
        .withColumn("suggestion", suggestion)
    )
    state = metrics.agg(
        F.count(F.lit(1)).alias("regions"), F.count_if(F.col("aci") > congested).alias("congested")
    )
    nothing = [F.lit(None).cast(suggestions.schema[c].dataType).alias(c) for c in suggestions.columns]
    quiet = state.where("regions > 0 and congested = 0").select(
        *nothing[:-1], F.lit(NO_REROUTING).alias("suggestion")
    )
    return suggestions.unionByName(quiet)


def first_reroutes(metrics: DataFrame, n: int = 2, **limits) -> DataFrame:
    """The suggestions of the most congested regions, the most urgent first."""
    return reroute(metrics, **limits).orderBy(F.col("aci").desc(), "region").limit(n)


def load_balance(metrics: DataFrame, *, over: float = 1.5, under: float = 0.5) -> DataFrame:
    """Each region against the unweighted mean index of all regions."""
    mean = metrics.agg(F.avg("aci").alias("mean_aci")).scalar()
    compared = metrics.select("region", "aci", mean.alias("mean_aci"))
    status = (
        F.when(F.col("aci") > F.col("mean_aci") * over, "OVERLOADED")
        .when(F.col("aci") < F.col("mean_aci") * under, "UNDERLOADED")
        .otherwise("BALANCED")
    )
    return compared.withColumn("load_status", status)


def overloaded(balance: DataFrame, n: int = 3) -> DataFrame:
    return balance.where("load_status = 'OVERLOADED'").orderBy("region").limit(n)
