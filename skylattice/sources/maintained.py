"""Result tables that appear one whole batch at a time, over a compacted base.

A batch writes its rows of all tables into folders of its own, together with the change it makes to
the running totals, and then one small file, the commit. Readers follow commits only: rows of a
batch that stopped half-way are never seen, and its replay commits under the next attempt number.
A commit says for each table how many rows it has and the time range they cover, measured while they
were written, so readers know without opening a file which batches can hold the newest rows.

``compact`` merges the older commits into the base: rows by day, of which only the days touched are
rewritten and keyed rows are resolved, the newest row of each region and country, and the sums of
totals. A new base is one small file written last, so a compaction that stopped half-way changes
nothing and can be run again. The newest commits stay outside: they are the ones a restarted stream
may replay and compare against.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from ..functions.numeric import round_scaled
from ..operators.pick import latest, upsert_view
from ..schemas import KEYS, TABLES
from .storage import ResultTables, _file_system, folder_names

KEPT_COMMITS = 2
DAY_SECONDS = 86400
ROWS_PER_FILE = 1_000_000
#: Tables of which the newest row per key is maintained.
NEWEST_BY = {"region_metrics": "region", "country_metrics": "country"}
TOTALS = "event_totals"
_TOTALS = StructType(
    [
        StructField("country", StringType()),
        StructField("measure", StringType()),
        StructField("amount", DecimalType(38, 9)),
    ]
)


@dataclass
class Part:
    """Rows of one table in one place, with the time range they cover (microseconds)."""

    path: str
    rows: int
    oldest: int | None = None
    newest: int | None = None
    counted: dict[str, int] = field(default_factory=dict)


@dataclass
class State:
    """What readers see: the base and the commits after it, by batch."""

    version: int
    upto: int | None
    days: dict[str, list[Part]]  # table -> parts of the base
    newest: dict[str, str]  # table -> folder of its newest rows per key
    totals: str | None
    commits: dict[int, dict[str, Part]]


class MaintainedTables(ResultTables):
    """The result tables below one base folder, as ``process_batch`` maintains them.

    ``tallies`` names conditions on events that are counted in the running totals beside rows and
    altitudes; ``congested_above`` is the index from which region metrics count as congested.
    """

    COMMITS, BASES = "_commits", "_bases"

    def __init__(
        self,
        base: str,
        *,
        tallies: dict[str, Column] | None = None,
        congested_above: float = 0.8,
    ):
        super().__init__(base)
        self.tallies = tallies or {}
        self.counted = {"region_metrics": {"congested": F.col("aci") > congested_above}}

    # --- commits and bases

    def _text(self, spark: SparkSession, path: str) -> str:
        fs, at = _file_system(spark, path)
        size = fs.getFileStatus(at).getLen()
        source = fs.open(at)
        try:
            return bytes(source.readNBytes(size)).decode()
        finally:
            source.close()

    def _put(self, spark: SparkSession, path: str, content: dict) -> None:
        """The file appears whole, by a rename."""
        fs, at = _file_system(spark, path)
        _, fresh = _file_system(spark, f"{self.base}/_fresh/{uuid.uuid4().hex}")
        out = fs.create(fresh, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        fs.mkdirs(at.getParent())
        if not fs.rename(fresh, at):
            raise RuntimeError(f"{path} exists: another writer is at work")

    def _names(self, spark: SparkSession, folder: str) -> list[tuple[int, int, str]]:
        """(batch, attempt) of commits, or (version, 0) of bases, in order."""
        found = []
        for name in folder_names(spark, f"{self.base}/{folder}"):
            if name.endswith(".json") and not name.startswith((".", "_")):
                batch, _, attempt = name[:-5].partition("-")
                found.append((int(batch), int(attempt or 0), name))
        return sorted(found)

    def state(self, spark: SparkSession, before: int | None = None) -> State:
        """Base and commits, without commits from batch ``before`` on.

        Commits are listed first: a base that appears after the listing only covers some of them. A
        commit that a compaction has deleted meanwhile sends the reader back to the listing.
        """
        for attempt in range(5):
            listed = self._names(spark, self.COMMITS)
            bases = self._names(spark, self.BASES)
            base = json.loads(self._text(spark, f"{self.base}/{self.BASES}/{bases[-1][2]}")) if bases else {}
            upto = base.get("upto")
            last = {batch: name for batch, _, name in listed}  # the highest attempt
            try:
                commits = {
                    batch: {
                        table: Part(**part)
                        for table, part in json.loads(self._text(spark, f"{self.base}/{self.COMMITS}/{name}")).items()
                    }
                    for batch, name in sorted(last.items())
                    if (upto is None or batch > upto) and (before is None or batch < before)
                }
                break
            except Exception as error:  # the file is gone
                if "FileNotFound" not in str(error) or attempt == 4:
                    raise
        return State(
            bases[-1][0] if bases else 0,
            upto,
            {table: [Part(**p) for p in parts] for table, parts in base.get("days", {}).items()},
            base.get("newest", {}),
            base.get("totals"),
            commits,
        )

    # --- writing

    @contextmanager
    def batch(self, spark: SparkSession, batch_id: int):
        """Collects the tables of a batch; all appear together when the block ends well.

        A block that writes nothing, or no rows at all, commits nothing.
        """
        writer = _Batch(self, spark, batch_id)
        yield writer
        writer.commit()

    def write(self, name: str, df: DataFrame, batch_id: int) -> None:
        """One table as a batch of its own."""
        with self.batch(df.sparkSession, batch_id) as out:
            out.write(name, df)

    # --- reading

    def _rows(self, spark: SparkSession, name: str, commits: dict[int, dict[str, Part]]) -> DataFrame:
        schema = StructType([*TABLES[name].fields, StructField(self.KEY, LongType())])
        paths = [c[name].path for c in commits.values() if name in c and c[name].rows]
        if not paths:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema.add("attempt", StringType())).option("basePath", self.path(name))
        return reader.parquet(*paths).drop("attempt")

    def _days(self, spark: SparkSession, name: str, parts: Sequence[Part]) -> DataFrame:
        schema = StructType([*TABLES[name].fields, StructField(self.KEY, LongType())])
        paths = [p.path for p in parts]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """All rows; of the keyed table's base the resolved ones."""
        state = self.state(spark)
        self.path(name)
        return self._days(spark, name, state.days.get(name, [])).unionByName(
            self._rows(spark, name, state.commits)
        )

    def _meeting(
        self, name: str, state: State, low: int | None, high: int | None
    ) -> tuple[list[Part], dict[int, dict[str, Part]]]:
        """Days and commits of a table whose rows can lie in a time range."""

        def meets(part: Part) -> bool:
            if part.oldest is None:
                return low is None and high is None
            return (low is None or part.newest >= low) and (high is None or part.oldest <= high)

        commits = {b: {name: c[name]} for b, c in state.commits.items() if name in c and meets(c[name])}
        return [p for p in state.days.get(name, []) if meets(p)], commits

    def _current(
        self, spark: SparkSession, name: str, state: State, low: int | None = None, high: int | None = None
    ) -> DataFrame:
        """Rows of a table in a time range, one per key where it has keys.

        Equal keys have equal times, so only parts whose range meets that range are opened. Rows of the
        base are not shuffled but dropped where a later batch has their key.
        """
        days, commits = self._meeting(name, state, low, high)
        base = self._days(spark, name, days)
        late = self._rows(spark, name, commits)
        time = F.unix_micros("timestamp")
        if low is not None:
            base, late = base.where(time >= low), late.where(time >= low)
        if high is not None:
            base, late = base.where(time <= high), late.where(time <= high)
        if name in KEYS:
            keys = list(KEYS[name])
            late = upsert_view(late, keys)
            if any(c[name].rows for c in commits.values()):
                base = base.join(late.select(*keys), keys, "left_anti")
        return base.select(*late.columns).unionByName(late)

    def current(self, spark: SparkSession, name: str) -> DataFrame:
        """The table as a keyed store holds it: a later batch replaces rows of equal key."""
        return self._current(spark, name, self.state(spark))

    def since(self, name: str, state: State, n: int) -> int | None:
        """A time such that at least ``n`` current rows are not older; None for all of time.

        Parts are counted from the newest on. Of parts that overlap in time only one is, since rows of one
        may replace rows of another; keys are unique within a part.
        """
        parts = list(state.days.get(name, [])) + [c[name] for c in state.commits.values() if name in c]
        held, floor = 0, None
        for part in sorted((p for p in parts if p.rows and p.oldest is not None), key=lambda p: -p.oldest):
            if floor is None or part.newest < floor or name not in KEYS:
                held += part.rows
                floor = part.oldest if floor is None else min(floor, part.oldest)
                if held >= n:
                    return floor
        return None

    def newest(self, spark: SparkSession, name: str, order: Sequence[Column], n: int) -> DataFrame:
        """The first ``n`` current rows by ``order``, which must begin with the newest times.

        Only batches and days that can hold such rows are opened.
        """
        state = self.state(spark)
        rows = self._current(spark, name, state, low=self.since(name, state, n))
        return rows.orderBy(*order).limit(n)

    def newest_per_key(self, spark: SparkSession, name: str) -> DataFrame:
        """The newest row of each region or country: the base's, and those of later batches."""
        state = self.state(spark)
        late = self._rows(spark, name, state.commits)
        if name in state.newest:
            late = spark.read.schema(late.schema).parquet(state.newest[name]).unionByName(late)
        return latest(late, NEWEST_BY[name])

    def totals(self, spark: SparkSession) -> DataFrame:
        """``(country, measure, amount)`` of the current events, from the totals alone."""
        return self._totals(spark, self.state(spark))

    def _totals(self, spark: SparkSession, state: State) -> DataFrame:
        paths = [c[TOTALS].path for c in state.commits.values() if TOTALS in c]
        paths += [state.totals] if state.totals else []
        rows = spark.read.schema(_TOTALS).parquet(*paths) if paths else spark.createDataFrame([], _TOTALS)
        summed = rows.groupBy("country", "measure").agg(F.sum("amount").cast("decimal(38,9)").alias("amount"))
        return summed.where("amount <> 0")

    def counts(self, spark: SparkSession, name: str) -> dict[str, int]:
        """Rows written to a table and those counted beside, from commits and base alone."""
        state = self.state(spark)
        parts = state.days.get(name, []) + [c[name] for c in state.commits.values() if name in c]
        out = {"rows": sum(p.rows for p in parts)}
        for key in self.counted.get(name, {}):
            out[key] = sum(p.counted.get(key, 0) for p in parts)
        return out

    def kpis(self, spark: SparkSession) -> DataFrame:
        """The headline numbers, without reading events, metrics or logs."""
        amount = lambda name: F.coalesce(
            F.sum(F.when(F.col("measure") == name, F.col("amount"))), F.lit(0).cast("decimal(38,9)")
        )
        long = lambda n: F.lit(n).cast("bigint")
        mean = F.try_divide(amount("altitude").cast("double"), amount("levels").cast("double"))
        present = (F.col("measure") == "rows") & (F.col("amount") > 0)
        return self.totals(spark).agg(
            amount("rows").cast("bigint").alias("total_flights"),
            F.count_distinct(F.when(present, F.col("country"))).alias("total_countries"),
            F.coalesce(round_scaled(mean, 0), F.lit(0.0)).alias("avg_altitude"),
            long(self.counts(spark, "anomaly_logs")["rows"]).alias("total_anomalies"),
            long(self.counts(spark, "region_metrics")["congested"]).alias("congested_regions"),
            *[amount(name).cast("bigint").alias(name) for name in self.tallies],
        )

    def batches(self, spark: SparkSession, name: str) -> list[int]:
        """Committed batches after the base that have rows of the table."""
        commits = self.state(spark).commits
        return [b for b, c in commits.items() if name in c and c[name].rows]

    def batch_before(self, spark: SparkSession, name: str, batch_id: int) -> int | None:
        """Greatest committed batch below ``batch_id`` with rows of the table, as far as outside the base."""
        return max((b for b in self.batches(spark, name) if b < batch_id), default=None)

    def read_batch(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        state = self.state(spark)
        if batch_id in state.commits:
            rows = self._rows(spark, name, {batch_id: state.commits[batch_id]})
        else:
            rows = self._days(spark, name, state.days.get(name, [])).where(F.col(self.KEY) == batch_id)
        return rows.drop(self.KEY)

    # --- totals of a batch

    def _measured(self, events: DataFrame, sign: int) -> DataFrame:
        one = F.lit(1)
        summed = events.groupBy("country").agg(
            F.count(one).alias("rows"),
            F.coalesce(F.sum(F.col("altitude").cast("decimal(38,9)")), F.lit(0)).alias("altitude"),
            F.count("altitude").alias("levels"),
            *[F.count_if(condition).alias(name) for name, condition in self.tallies.items()],
        )
        names = ["rows", "altitude", "levels", *self.tallies]
        each = [
            F.struct(F.lit(n).alias("measure"), (F.col(n) * sign).cast("decimal(38,9)").alias("amount"))
            for n in names
        ]
        return summed.select("country", F.inline(F.array(*each)))

    def _change(self, spark: SparkSession, batch_id: int, part: Part, rows: DataFrame) -> DataFrame:
        """What a batch's events add to the totals, less the earlier rows that they replace.

        Only batches and days that overlap the batch in time are opened for that.
        """
        change = self._measured(rows, 1)
        state, name = self.state(spark, batch_id), "flight_events"
        days, commits = self._meeting(name, state, part.oldest, part.newest)
        if days or commits:
            held = self._current(spark, name, state, part.oldest, part.newest)
            keys = list(KEYS[name])
            old = self._measured(held.join(rows.select(*keys), keys, "left_semi"), -1)
            change = change.unionByName(old)
        summed = change.groupBy("country", "measure")
        return summed.agg(F.sum("amount").cast("decimal(38,9)").alias("amount")).where("amount <> 0")

    # --- compaction

    def compact(self, spark: SparkSession, keep: int = KEPT_COMMITS) -> bool:
        """Merge all but the newest ``keep`` commits into the base; False if there are none."""
        state = self.state(spark)
        ready = dict(list(state.commits.items())[: max(0, len(state.commits) - keep)])
        if not ready:
            return False
        run = uuid.uuid4().hex
        days = {name: list(parts) for name, parts in state.days.items()}
        newest = dict(state.newest)
        for name in TABLES:
            if any(c[name].rows for c in ready.values() if name in c):
                days[name] = self._merged(spark, name, state, ready, run)
                if name in NEWEST_BY:
                    newest[name] = self._newest_merged(spark, name, state, ready, run)
        summed = f"{self.base}/{TOTALS}/base={run}"
        part = State(0, None, {}, {}, state.totals, ready)
        self._totals(spark, part).coalesce(1).write.parquet(summed)
        content = {
            "upto": max(ready),
            "days": {name: [vars(p) for p in parts] for name, parts in days.items()},
            "newest": newest,
            "totals": summed,
        }
        self._put(spark, f"{self.base}/{self.BASES}/{state.version + 1:012d}.json", content)
        self._forget(spark, max(ready))
        return True

    def _forget(self, spark: SparkSession, upto: int) -> None:
        """Delete the commits that the base covers, so that listings stay short."""
        for batch, _, name in self._names(spark, self.COMMITS):
            if batch <= upto:
                fs, at = _file_system(spark, f"{self.base}/{self.COMMITS}/{name}")
                fs.delete(at, False)

    def _merged(
        self, spark: SparkSession, name: str, state: State, ready: dict[int, dict[str, Part]], run: str
    ) -> list[Part]:
        """The parts of the table's base after the commits: days without new rows stay as they are."""
        day = lambda: F.floor(F.unix_seconds("timestamp") / DAY_SECONDS)
        late = self._rows(spark, name, ready)
        touched = {r[0] for r in late.select(day()).distinct().collect()}  # one per day
        of = lambda part: part.oldest // (DAY_SECONDS * 1_000_000)
        old = [p for p in state.days.get(name, []) if of(p) in touched]
        rows = self._days(spark, name, old)
        if name in KEYS:
            keys = list(KEYS[name])
            late = upsert_view(late, keys)
            rows = rows.join(late.select(*keys), keys, "left_anti")
            spread = F.xxhash64(*keys)
        else:
            spread = F.xxhash64(*TABLES[name].names)
        count = sum(p.rows for p in old) + sum(c[name].rows for c in ready.values() if name in c)
        files = max(1, -(-count // ROWS_PER_FILE))
        columns = [*TABLES[name].names, self.KEY]
        rows = rows.select(*columns).unionByName(late.select(*columns)).withColumn("day", day())
        folder = f"{self.path(name)}/base={run}"
        dealt = rows.repartition(F.col("day"), F.pmod(spread, F.lit(files)))
        dealt.sortWithinPartitions("day", "timestamp").write.partitionBy("day").parquet(folder)
        counted = self.counted.get(name, {})
        time = F.unix_micros("timestamp")
        measured = spark.read.parquet(folder).groupBy("day").agg(
            F.count("*").alias("rows"),
            F.min(time).alias("oldest"),
            F.max(time).alias("newest"),
            *[F.count_if(condition).alias(f"n_{key}") for key, condition in counted.items()],
        )
        fresh = [
            Part(f"{folder}/day={r['day']}", r["rows"], r["oldest"], r["newest"], {k: r[f"n_{k}"] for k in counted})
            for r in measured.collect()  # one per day
        ]
        return [p for p in state.days.get(name, []) if of(p) not in touched] + fresh

    def _newest_merged(
        self, spark: SparkSession, name: str, state: State, ready: dict[int, dict[str, Part]], run: str
    ) -> str:
        late = self._rows(spark, name, ready)
        if name in state.newest:
            late = spark.read.schema(late.schema).parquet(state.newest[name]).unionByName(late)
        path = f"{self.path(name)}/newest={run}"
        latest(late, NEWEST_BY[name]).write.parquet(path)
        return path

    def vacuum(self, spark: SparkSession) -> int:
        """Delete folders that neither base nor commits name; only while nobody reads or writes."""
        state = self.state(spark)
        used = {p.path for parts in state.days.values() for p in parts} | set(state.newest.values())
        used |= {p.path for c in state.commits.values() for p in c.values()} | {state.totals}
        gone = 0
        for table in [*TABLES, TOTALS]:
            for folder in folder_names(spark, f"{self.base}/{table}"):
                top = f"{self.base}/{table}/{folder}"
                inner = [f"{top}/{x}" for x in folder_names(spark, top) if "=" in x] or [top]
                unused = [path for path in inner if path not in used]
                for path in unused if len(unused) < len(inner) else [top]:
                    fs, at = _file_system(spark, path)
                    fs.delete(at, True)
                gone += len(unused)
        return gone


class _Batch:
    """The tables of one batch, until they are committed."""

    def __init__(self, tables: MaintainedTables, spark: SparkSession, batch_id: int):
        self.tables, self.spark, self.batch_id = tables, spark, batch_id
        self.attempt = uuid.uuid4().hex
        self.parts: dict[str, Part] = {}
        upto = tables.state(spark).upto
        self.merged = upto is not None and batch_id <= upto

    def _path(self, name: str) -> str:
        return f"{self.tables.base}/{name}/{self.tables.KEY}={self.batch_id}/attempt={self.attempt}"

    def write(self, name: str, df: DataFrame) -> int:
        """Write the batch's rows of a table; the number of rows, measured on the way.

        Rows of a batch that the base holds already, as in a late replay, are not written again.
        """
        self.tables.path(name)
        seen, counted = Observation(), self.tables.counted.get(name, {})
        time = F.unix_micros("timestamp")
        rows = df.select(*TABLES[name].names).observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.min(time).alias("oldest"),
            F.max(time).alias("newest"),
            *[F.count_if(condition).alias(f"n_{key}") for key, condition in counted.items()],
        )
        rows.write.mode("overwrite").parquet(self._path(name))
        got = seen.get
        part = Part(
            self._path(name),
            got.get("rows") or 0,
            got.get("oldest"),
            got.get("newest"),
            {key: got.get(f"n_{key}") or 0 for key in counted},
        )
        self.parts[name] = part
        return part.rows

    def _totalled(self) -> None:
        part = self.parts.get("flight_events")
        if part and part.rows:
            columns = [*TABLES["flight_events"].fields]
            rows = self.spark.read.schema(StructType(columns)).parquet(part.path)
            change = self.tables._change(self.spark, self.batch_id, part, rows)
            change.coalesce(1).write.mode("overwrite").parquet(self._path(TOTALS))
            self.parts[TOTALS] = Part(self._path(TOTALS), 0)

    def commit(self) -> None:
        if self.merged or not any(p.rows for p in self.parts.values()):
            for part in self.parts.values():
                fs, at = _file_system(self.spark, part.path)
                fs.delete(at, True)
            return
        self._totalled()
        known = [a for b, a, _ in self.tables._names(self.spark, self.tables.COMMITS) if b == self.batch_id]
        name = f"{self.batch_id:020d}-{max(known, default=-1) + 1:06d}.json"
        content = {table: vars(part) for table, part in self.parts.items()}
        self.tables._put(self.spark, f"{self.tables.base}/{self.tables.COMMITS}/{name}", content)
