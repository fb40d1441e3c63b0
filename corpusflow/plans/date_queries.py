"""Date and JSON function queries over ``orders`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import dates as D
from corpusflow.plans.registry import register
from corpusflow.session import load_table

_START = "2024-01-01 00:00:00"


def events(spark, sf):
    return load_table(spark, sf, "events")


@register("parse_meta_date", """
SELECT o_orderkey,
  strftime(strptime(strftime(o_orderdate, '%Y-%m-%d') || ' ' ||
    printf('%02d:%02d:%02d', o_orderkey % 24, o_orderkey % 60, (o_orderkey * 7) % 60),
    '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS meta_date
FROM orders""")
def q_parse_meta_date(spark, sf):
    o = load_table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "),
                    F.format_string("%02d:%02d:%02d", k % 24, k % 60, (k * 7) % 60))
    return o.select("o_orderkey", F.date_format(D.date_from_meta(text), D.META_DATE_FORMAT)
                    .alias("meta_date"))


@register("format_meta_date", """
SELECT event_id, coalesce(strftime(ts, '%Y-%m-%d %H:%M:%S'), '') AS date_text FROM events""")
def q_format_meta_date(spark, sf):
    return events(spark, sf).select("event_id", D.date_to_text(F.col("ts")).alias("date_text"))


@register("date_format_check", """
SELECT event_id,
  regexp_matches(strftime(ts, '%Y-%m-%d %H:%M:%S'), '\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') AS ts_ok,
  regexp_matches(props, '\\d{4}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') AS props_ok
FROM events""")
def q_date_format_check(spark, sf):
    e = events(spark, sf)
    return e.select("event_id", D.looks_like_meta_date(D.date_to_text(F.col("ts"))).alias("ts_ok"),
                    D.looks_like_meta_date(F.col("props")).alias("props_ok"))


@register("unify_date", """
WITH t AS (SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+03:00' AS s FROM events)
SELECT event_id, s AS date_text,
  strftime(CAST(replace(substr(s, 1, 19), 'T', ' ') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS wall_clock,
  CAST(epoch(strptime(s, '%Y-%m-%dT%H:%M:%S%z')) AS BIGINT) AS instant_epoch
FROM t""")
def q_unify_date(spark, sf):
    e = events(spark, sf).select("event_id", F.concat(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00")).alias("date_text"))
    return e.select("event_id", "date_text",
                    F.date_format(D.unify_date(F.col("date_text")), D.META_DATE_FORMAT).alias("wall_clock"),
                    F.unix_seconds(D.unify_date_instant(F.col("date_text"))).alias("instant_epoch"))


@register("date_functions", f"""
WITH t AS (
  SELECT event_id, ts, date_diff('microsecond', TIMESTAMP '{_START}', ts) + 180000000 AS x FROM events
)
SELECT event_id,
  strftime(ts, '%Y.%m.%d %H:%M:%S') AS custom_format,
  CAST((x - (x % 360000000)) // 360000000 AS DOUBLE) / 10.0 AS hours_since_start,
  strftime(CAST(regexp_extract('report_' || strftime(ts, '%Y-%m-%d') || '.txt',
                               'report_(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.txt', 1) AS DATE), '%Y-%m-%d') AS report_date
FROM t""")
def q_date_functions(spark, sf):
    e = events(spark, sf)
    start = F.lit(_START).cast("timestamp_ntz")
    name = F.concat(F.lit("report_"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".txt"))
    return e.select("event_id", D.custom_format(F.col("ts")).alias("custom_format"),
                    D.hours_between(start, F.col("ts")).alias("hours_since_start"),
                    F.date_format(D.date_from_report_name(name), "yyyy-MM-dd").alias("report_date"))


@register("json_fields", """
SELECT event_id, array_to_string(json_keys(props), ',') AS keys,
       json_extract_string(props, '$.k') AS k
FROM events""")
def q_json_fields(spark, sf):
    e = events(spark, sf)
    m = F.from_json("props", "map<string,string>")
    return e.select("event_id", F.array_join(F.map_keys(m), ",").alias("keys"),
                    F.get_json_object("props", "$.k").alias("k"))
