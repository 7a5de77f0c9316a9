"""DuckDB text of the derived line views, used as a CTE prefix by every oracle.

The driver registers only the base tables; the oracles rebuild the same
line views from ``events`` (FIXTURES.md §2). ``ev`` differs per engine
(time formatting functions); the three line views are the same text that
the Spark side builds in `linestream.sources.tables`.
"""

EV_DUCKDB = """ev AS (
select event_id, epoch_us(ts)//1000 as ms, event_type as topic,
  cast(event_id % 4 as int) as partition_id, cast(user_id as varchar) as key, user_id, event_type,
  strftime(ts,'%d-%b-%Y %H:%M:%S.%g') as dtg, strftime(ts,'%m/%d/%Y %I:%M:%S %p') as mdy,
  cast(cast((event_id*7919)%36000-18000 as decimal(7,0))*cast(0.01 as decimal(3,2)) as varchar) as lon,
  cast(cast((event_id*104729)%18000-9000 as decimal(7,0))*cast(0.01 as decimal(3,2)) as varchar) as lat
from events)"""

SIMFILE_LINES = """simfile_lines AS (
select event_id, ms, topic, partition_id, key, concat_ws(',', cast(ms as varchar),
  case when event_id % 50 = 1 then 'bad' else cast(user_id as varchar) end, dtg,
  case when event_id % 10 = 0 then concat('"', event_type, ',X"') else concat(event_type, '-X') end,
  lon, lat,
  case when event_id % 50 = 2 then cast(event_id % 900 as varchar)
       else concat(cast(event_id % 900 as varchar), ',', cast(event_id % 360 as varchar)) end) as value
from ev)"""

FAA_LINES = """faa_lines AS (
select event_id, ms, topic, partition_id, key, concat_ws(',', 'FAA-Stream', cast(event_id as varchar),
  concat('FL', key), case when event_id % 50 = 3 then 'not-a-date' else mdy end, lon, lat,
  '82.66', '540', '350', 'A343', 'DLH', 'KPHL', 'EDDF', 'JET', 'COMMERCIAL', 'ACTIVE', 'GA',
  concat('"', lon, ',', lat, ',350.0"')) as value
from ev)"""

LATENCY_LINES = """latency_lines AS (
select event_id, ms, topic, partition_id, key, concat_ws(',', cast(event_id as varchar), event_type,
  case when event_id % 400 = 7 then 'oops' else cast(ms - (event_id*37) % 5000 as varchar) end) as value
from ev)"""

# Fence rows from `nation` in closed form (FIXTURES.md §3): diamond centre and
# radius; odd keys carry a diamond hole of radius 4.
FENCES = """fences AS (
select n_nationkey as k, n_name as name,
  -170.0025 + 14.0 * n_nationkey as cx, -60.005 + 30.0 * (n_nationkey % 5) as cy
from nation)"""

# Tokens of a line in DuckDB (same pattern; group 1, outer quotes cut).
TOKENS_SQL = """list_transform(regexp_extract_all({v}, '(([^"][^,]*)|"([^"]*)"),?', 1),
  lambda t: case when starts_with(t, '"') then substr(t, 2, length(t) - 2) else t end)"""


def with_views(body: str, *extra: str) -> str:
    """Prefix a query with the line views (and any extra CTEs)."""
    ctes = [EV_DUCKDB, SIMFILE_LINES, FAA_LINES, LATENCY_LINES, FENCES, *extra]
    return "WITH " + ",\n".join(ctes) + "\n" + body
