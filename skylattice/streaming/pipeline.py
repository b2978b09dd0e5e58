"""The streaming job: prepared flights in, result tables out, one batch at a time.

Fan-out to airports happens inside the batch and only as far as it is needed. The rows
of the event table do not depend on airports, so they are written before the join; the
metrics read the joined rows once, counted by region rather than one per airport, as sums by
(region, country) that all reports roll up from; the learning steps join only the newest row of each
aircraft. Nothing of the batch is brought to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import Broadcast
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import alerts, balance, learning, traffic
from ..operators.anomalies import flag_outliers, isolation_scores
from ..operators.clusters import cluster, cluster_sizes
from ..operators.flights import stamp
from ..operators.forecast import forecast, top_forecasts
from ..operators.pick import upsert_view
from ..operators.proximity import CountedCells, counted_cells, stored_cells
from ..plans.enrich import aircraft, counted_at_airports, prepare
from ..sources.storage import ResultTables

#: Aircraft that a task of the learning steps takes, where there are more than one task each.
ROWS_PER_TASK = 50_000
Report = Callable[[int, dict[str, DataFrame]], None]


def previous_counts(spark: SparkSession, tables: ResultTables, batch_id: int) -> DataFrame | None:
    """Region counts of the last non-empty batch before this one.

    The stored metrics are the state: an empty batch stores nothing, a region missing
    from the previous batch has no previous count, and a replay finds what the first
    run found.
    """
    before = tables.batch_before(spark, "region_metrics", batch_id)
    if before is None:
        return None
    return tables.read_batch(spark, "region_metrics", before).select("region", "aircraft_count")


def event_rows(flights: DataFrame) -> DataFrame:
    """Rows of the event table: the last write of each (aircraft, time)."""
    timed = flights.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    return upsert_view(
        timed.select(
            "icao24",
            "timestamp",
            "altitude",
            "callsign",
            "country",
            "latitude",
            "longitude",
            "velocity",
            "vertical_rate",
        )
    )


def process_batch(
    batch_df: DataFrame,
    batch_id: int,
    *,
    airports: DataFrame,
    tables: ResultTables,
    cells: CountedCells | None = None,
    batch_time: datetime | None = None,
    report: Report | None = None,
) -> None:
    """Analyse one batch of prepared flights and write its rows of every table.

    A batch without flights has no results; the count comes from the first write itself. ``cells`` are
    the airports' ``counted_cells`` where the caller has them. ``report``
    receives the summaries that are shown but not stored; they are built only when it is given and
    are valid until it returns.
    """
    spark = batch_df.sparkSession
    now = batch_time or datetime.now(timezone.utc)
    flights = batch_df.persist()
    cached = [flights]
    forests: list[Broadcast] = []
    try:
        seen = Observation()
        counted = flights.observe(seen, F.count(F.lit(1)).alias("flights"))
        with tables.batch(spark, batch_id) as out:
            out.write("flight_events", event_rows(counted))
            if seen.get["flights"]:
                _analyse(flights, batch_id, out, cached, forests, airports, tables, cells, now, report)
    finally:
        for df in cached:
            df.unpersist()
        for forest in forests:
            forest.unpersist()


def _analyse(
    flights: DataFrame,
    batch_id: int,
    out,
    cached: list[DataFrame],
    forests: list[Broadcast],
    airports: DataFrame,
    tables: ResultTables,
    cells: CountedCells | None,
    now: datetime,
    report: Report | None,
) -> None:
    """The tables that need airports; ``cached`` and ``forests`` are released by the caller."""
    spark = flights.sparkSession
    if cells is None:
        cells = counted_cells(airports)
    rows = counted_at_airports(flights, cells)
    # A row per region and country, and one per aircraft: shuffles leave these in far more parts than they need.
    tasks = spark.sparkContext.defaultParallelism
    totals = traffic.traffic_totals(rows, ["region", "country"]).coalesce(tasks).persist()
    newest = aircraft(flights, cells).persist()
    cached += [totals, newest]

    by_region = traffic.roll_up(totals, ["region"])
    by_country = traffic.roll_up(totals, ["country"])
    metrics = traffic.region_metrics_of(by_region)

    out.write("country_metrics", stamp(traffic.country_metrics_of(by_country), now))
    out.write("alerts", stamp(alerts.alert_table(metrics), now))

    outliers = None
    aircraft_count = newest.count()
    if aircraft_count > learning.MIN_ROWS:
        newest = newest.coalesce(max(tasks, -(-aircraft_count // ROWS_PER_TASK)))
        scored = isolation_scores(newest, rows=aircraft_count, held=forests).persist()
        cached.append(scored)
        outliers = flag_outliers(scored)
        out.write("anomaly_logs", stamp(outliers, now))

    if report is not None:
        parts = _summaries(totals, by_region, metrics)
        alert_parts = [alerts.congestion_alerts(metrics)]
        if outliers is not None:
            clustered = cluster(newest)
            parts["cluster_sizes"] = cluster_sizes(clustered)
            parts["top_forecasts"] = top_forecasts(forecast(newest))
            parts["anomalies"] = outliers
            alert_parts.append(alerts.anomaly_alerts(outliers))
        before = previous_counts(spark, tables, batch_id)
        if before is not None:
            surges = alerts.surge_rows(metrics, before)
            alert_parts.append(alerts.surge_alerts(surges))
        parts["alerts"] = alerts.all_alerts(*alert_parts)
        report(batch_id, parts)

    # Last, because it is the state that the next batch compares against.
    out.write("region_metrics", stamp(metrics, now))


def _summaries(totals: DataFrame, by_region: DataFrame, metrics: DataFrame) -> dict[str, DataFrame]:
    counts = traffic.region_counts_of(by_region)
    balanced = balance.load_balance(metrics)
    return {
        "records": totals.agg(F.sum("rows").alias("records")),
        "top_regions": traffic.top_regions(counts),
        "avg_speed": traffic.speed_sample(traffic.region_avg_speed_of(by_region)),
        "efficiency": traffic.mean_efficiency_of(totals),
        "reroute": balance.first_reroutes(metrics),
        "overloaded": balance.overloaded(balanced),
    }


def start(
    events: DataFrame,
    *,
    airports: DataFrame,
    tables: ResultTables,
    checkpoint: str,
    trigger: dict | None = None,
    report: Report | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Run the pipeline on a stream of parsed events.

    ``compact_every`` merges older batches into the base of ``MaintainedTables`` whenever that many
    batches are outside of it.

    ``checkpoint`` is required: without it a restart would neither know what was
    processed nor continue the batch numbers that the tables are keyed by.
    """
    cells = stored_cells(counted_cells(airports))

    def run(batch_df: DataFrame, batch_id: int) -> None:
        process_batch(
            batch_df,
            batch_id,
            airports=airports,
            tables=tables,
            cells=cells,
            report=report,
        )
        if compact_every and len(tables.batches(spark, "flight_events")) >= compact_every:
            tables.compact(spark)

    spark = events.sparkSession
    writer = prepare(events).writeStream.outputMode("append").foreachBatch(run)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
