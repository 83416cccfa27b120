"""Streams over the files of a table, run to their end."""

from pyspark.sql import DataFrame, functions as F

from ..plans.demand import FLAGS
from ..sources.scratch import scratch_path
from ..streaming import demand, trailing as tr
from .base import DISPATCHES, INCIDENTS, Tables, query
from .intervals import _CONC
from .windows import _DAY


def _streamed(t: Tables, name: str) -> Tables:
    """The tables, one of them as a stream of its files."""

    class Streamed(Tables):
        def __getattr__(self, other: str) -> DataFrame:
            table = super().__getattr__(other)
            if other != name:
                return table
            # a stream reads a folder or a pattern; this one fits a table of one file, too
            return self.spark.readStream.schema(table.schema).parquet(f"{self.folder}/{name}.parque[t]")

    return Streamed(t.spark, t.folder)


@query(
    "stream_repeated_location_24h",
    f"SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts {_DAY}) AS trailing FROM events",
)
def _(t):
    events = tr.with_end(_streamed(t, "events").events, "ts")
    return tr.collected(tr.count_last_stream(events, "user_id", "ts", "event_id")).select("event_id", "trailing")


@query("stream_busy_units", f'WITH {DISPATCHES}, {_CONC} SELECT "at", unit, delta, busy FROM conc')
def _(t):
    dispatches = tr.with_end(_streamed(t, "lineitem").dispatches, ["sent", "clear"])
    path = scratch_path(t.spark, "busy")
    tr.run_to_end(tr.write_busy_units(tr.unit_changes_stream(dispatches, "unit", "sent", "clear"), path), path)
    return t.spark.read.parquet(f"{path}/changes").select("at", "unit", "delta", "busy")


@query(
    "stream_hourly_demand",
    f"""
    WITH {INCIDENTS}
    SELECT strftime(date_trunc('hour', time_created), '%Y-%m-%d %H:%M:%S') AS time_created, station_name, count(*) AS total_incidents,
           cast(sum(trns_to_hosp::int) AS bigint) AS trns_to_hosp, cast(sum(m_required::int) AS bigint) AS m_required,
           cast(sum(m_sent::int) AS bigint) AS m_sent
    FROM incidents GROUP BY ALL
    """,
)
def _(t):
    incidents = tr.with_end(_streamed(t, "events").incidents, "time_created")
    return tr.collected(demand.hourly_demand_stream(incidents, "time_created", "station_name", FLAGS))
