from pyspark.sql import functions as F

from corpusflow.functions import dates as D


def test_date_from_meta(spark):
    df = spark.createDataFrame([("2022-11-06 16:30:00",), ("",), (None,), ("2022-13-45 10:00:00",),
                                ("2022-1-6 1:3:0",)], "s string")
    got = [r[0] for r in df.select(F.date_format(D.date_from_meta(F.col("s")), D.META_DATE_FORMAT)).collect()]
    assert got == ["2022-11-06 16:30:00", None, None, None, "2022-01-06 01:03:00"]
    dflt = F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
    assert str(df.select(D.date_from_meta(F.col("s"), dflt)).collect()[1][0]) == "2000-01-01 00:00:00"


def test_unify_date_keeps_wall_clock(spark):
    df = spark.createDataFrame([("2024-05-01T10:20:30+03:00",), ("2024-05-01T10:20:30Z",),
                                ("2024-05-01T10:20:30+0300",), ("2024-05-01 10:20:30",),
                                ("2024-05-01T10:20:30.5+03:00",)], "s string")
    wall = [r[0] for r in df.select(F.date_format(D.unify_date(F.col("s")), D.META_DATE_FORMAT)).collect()]
    assert wall == ["2024-05-01 10:20:30"] * 3 + [None, None]
    inst = df.select(F.unix_seconds(D.unify_date_instant(F.col("s")))).first()[0]
    assert inst == 1714548030  # 07:20:30 UTC


def test_hours_report_and_format(spark):
    df = spark.createDataFrame([("2024-01-01 05:03:00", "report_2024-03-02.txt")], "t string, n string")
    r = df.select(
        D.hours_between(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("t").cast("timestamp_ntz")),
        F.date_format(D.date_from_report_name(F.col("n")), "yyyy-MM-dd"),
        D.custom_format(F.col("t").cast("timestamp_ntz")),
        D.date_to_text(F.lit(None).cast("timestamp_ntz"))).first()
    assert tuple(r) == (5.1, "2024-03-02", "2024.01.01 05:03:00", "")


def test_json_fields(spark):
    df = spark.createDataFrame([('{"k": 69, "b": "x"}',)], "p string")
    m = F.from_json("p", "map<string,string>")
    r = df.select(F.array_join(F.map_keys(m), ","), F.get_json_object("p", "$.k")).first()
    assert tuple(r) == ("k,b", "69")


def test_date_queries_do_not_depend_on_session_time_zone(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    keys = ["parse_meta_date", "unify_date", "date_functions"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        res = {}
        for tz in ["UTC", "America/New_York", "Asia/Kathmandu"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            res[tz] = {k: sorted(map(tuple, E.queries()[k](spark, sf).collect())) for k in keys}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert res["America/New_York"] == res["UTC"] == res["Asia/Kathmandu"]
