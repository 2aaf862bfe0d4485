"""Queries of the general problems: 2 intervals, 3 nested records, 4 times, 7 quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals, nested, quantities, timestamps
from ..sources.tables import table
from .registry import Registry

R = Registry()


_NUM = r"try_cast(nullif(regexp_extract(trim({}), '(?i)^(?:\S*_|scan\s*)?0*(\d{{1,9}})\s*\.?$', 1), '') as int)"
_RANGE = r"nullif(regexp_extract(trim(scan_range), '^0*(\d{{1,9}})(?:\s*[-–—/]\s*0*(\d{{1,9}}))?$', {}), '')"
_P2 = (
    r"with v as (select upper(regexp_replace(inventory_number, '^\s+|\s+$', '', 'g')) as inv, " + f"{_NUM.format('scan_start')} as s, {_NUM.format('scan_end')} as e, cast({_RANGE.format(1)} as int) as rf, cast(coalesce({_RANGE.format(2)}, {_RANGE.format(1)}) as int) as rl, no_of_scans as n from doc_meta), "
    "c as (select inv, coalesce(s, rf) as a, coalesce(e, rl, case when n >= 1 then coalesce(s, rf) + n - 1 end) as b from v), "
    "iv as (select inv, least(a, b) as a, greatest(a, b) as b from c where inv <> '' and a is not null and b is not null), "
    "o as (select *, max(b) over (partition by inv order by a, b rows between unbounded preceding and 1 preceding) as m from iv), "
    "g as (select *, sum(case when a <= m + 1 then 0 else 1 end) over (partition by inv order by a, b rows between unbounded preceding and current row) as r from o), "
    "p as (select inv, min(a) as a, max(b) as b from g group by inv, r) "
    "select inv as inventory_number, 'period' as kind, a as first_scan, b as last_scan from p union all select inv, 'gap', b + 1, nx - 1 from (select *, lead(a) over (partition by inv order by a) as nx from p) where nx is not null"
)


@R.query("p2_found", _P2)
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    spans = intervals.scan_intervals(table(spark, d, "doc_meta"))
    return intervals.periods_and_gaps(spans, "inventory_number", "first_scan", "last_scan")


_P3 = (
    "with f as (select annotation_id, unnest(['body', 'target']) as field, unnest([body, target]) as t from web_annos), "
    "j as (select annotation_id, field, case when json_type(t) = 'VARCHAR' then json_extract_string(t, '$') else t end as t from f where json_valid(t)), "
    "k as (select annotation_id, field, n.fullkey as p, n.type as type, json_type(t) as root from (select distinct * from j where json_valid(t)) j, json_tree(j.t::json) n where n.type = 'OBJECT'), "
    "a as (select annotation_id, field || case when root = 'OBJECT' then '[0]' else '' end || replace(replace(substr(p, 2), '.selector.', '.selector[0].'), '.classified_as.', '.classified_as[0].') as x from k), "
    "b as (select distinct annotation_id, case when ends_with(x, '.selector') or ends_with(x, '.classified_as') then x || '[0]' else x end as node_path from a) "
    r"select annotation_id, node_path, case when q in ('body', 'target') then '' else q end as parent_path from (select *, regexp_replace(node_path, '(\.[^.\[\]]+)?(\[\d+\])*$', '') as q from b)"
)


@R.query("p3_found", _P3)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = nested.flatten(table(spark, d, "web_annos"), "annotation_id", ["body", "target"])
    return nodes.select(F.col("id").alias("annotation_id"), "node_path", "parent_path")


#: The zones in whose offset histories the archive's clocks can have run; UTC first, as TESTDATA.md's default. No record spans more than a day.
ZONES = ["UTC", "Europe/Amsterdam", "Asia/Jakarta", "America/Paramaribo"]
DAY_S = 86_400


def _zone_evidence(t: DataFrame) -> DataFrame:
    return timestamps.evidence(t, "span_id", "source_tz", "begin_of_the_begin", "end_of_the_end", DAY_S)


@R.query("p4_found")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Times are converted with the declared zone; rows without a (known) one with the zone that evidence tells of them."""
    t = table(spark, d, "time_spans").withColumn("source_tz", timestamps.known_zone("source_tz"))
    told = timestamps.estimate_zones(_zone_evidence(t.filter("source_tz is null")), ZONES).first()  # one group, so at most one row
    t = t.withColumn("source_tz", F.coalesce("source_tz", F.lit(told.zone if told else "UTC")))
    spans = timestamps.fields(t, "span_id", ["begin_of_the_begin", "end_of_the_end"], "source_tz")
    spans = timestamps.with_utc(spans, "text", "source_tz", F.col("field") == "end_of_the_end", "norm")
    dates = timestamps.fields(table(spark, d, "missives"), "id", ["datum", "datum_numeriek"])
    dates = timestamps.with_date(dates, "text", "norm")
    keys = ("rec_id", "field", "norm")
    return timestamps.readable(spans, "norm").select(*keys).unionByName(timestamps.readable(dates, "norm").select(*keys)).distinct()


@R.query("p4_zones")
def p4_zones(spark: SparkSession, d: str) -> DataFrame:
    """The zone that the times of each source_tz group tell, the declaration itself being no evidence; re-sent rows count once."""
    return timestamps.estimate_zones(_zone_evidence(table(spark, d, "time_spans")), ZONES).withColumnRenamed("group", "source_tz")


@R.query("p7_found")
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return quantities.to_common(table(spark, d, "quants"), table(spark, d, "units"), table(spark, d, "number_words"))
