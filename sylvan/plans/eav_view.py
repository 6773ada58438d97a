"""The long (EAV) test view derived from the ``events`` table.

Each event becomes one export row: purchases and signups are measurements
of traits 4 and 3116, every 97th other event one of an uncatalogued trait
99, the rest are covariates. Small domains and moduli put NULLs into keys
and values, unparsable and zero values, excluded items and a NULL data name
into the data, so the null and order semantics are exercised at any scale.
The same text serves Spark (here) and DuckDB (``duckdb_sql``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

EAV_SELECT = """
select event_id as ord, event_id div 20 as ObservationID,
  case when event_type='purchase' then 4 when event_type='signup' then 3116
       when event_id % 97 = 0 then 99 end as TraitID,
  case when event_id % 97 = 0 and event_type not in ('purchase','signup') then 3
       else case event_type when 'purchase' then 1 when 'signup' then 2
              when 'click' then (case when event_id % 50 = 0 then 1 else 7 end)
              when 'view' then 8 else 3646 + cast(event_id % 3 as int) end end as DataID,
  case event_type when 'view' then 'Light Level' when 'click' then 'latitude'
       when 'error' then (case when event_id % 4 = 0 then null else 'err' end)
       else event_type end as DataName,
  case when (event_id div 20) % 5 = 0 then null
       else concat('ds', cast((event_id div 20) % 4 as string)) end as Dataset,
  concat('sp', cast((event_id div 20) % 7 as string)) as AccSpeciesName,
  case when event_id % 13 = 0 then null when event_id % 17 = 0 then 'n/a' when event_id % 19 = 0 then '0'
       else cast(cast(round(value*100) as bigint) as string) end as OrigValueStr,
  case when event_type='signup' then 'mm2 mg-1' when event_type='purchase' then 'g/cm3' end as UnitName
from events
"""


def duckdb_sql() -> str:
    """The view's SELECT in DuckDB's dialect."""
    return EAV_SELECT.replace(" div ", " // ").replace("as string", "as varchar")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def eav_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The EAV view over ``<sf_dir>/events.parquet`` (reads 3 of its columns)."""
    events = read_table(spark, sf_dir, "events")
    return events.sparkSession.sql(EAV_SELECT.replace("from events", "from {events}"), events=events)
