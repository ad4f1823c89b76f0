import datetime as dt

from pyspark.sql import functions as F

from delaykit.functions import scalars as S


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_hhmm_keeps_lost_zeros(spark, rows):
    df = spark.createDataFrame([(5,), (59,), (930,), (1000,), (2359,), (None,)], "t int")
    got = rows(df.select("t", S.padded_hhmm("t"), S.hour_text("t"), S.hour_of("t"), S.minute_of_day("t")))
    assert (5, "0005", "00", 0, 5) in got
    assert (59, "0059", "00", 0, 59) in got
    assert (930, "0930", "09", 9, 570) in got
    assert (2359, "2359", "23", 23, 1439) in got
    assert (None, None, None, None, None) in got


def test_gap_of_200_in_hhmm_is_two_hours(spark):
    """For every pair of clock times of one day: HHMM gap >= 200 exactly if >= 120 minutes."""
    t = spark.range(1440).select((F.floor(F.col("id") / 60) * 100 + F.col("id") % 60).alias("a"))
    pairs = t.join(t.withColumnRenamed("a", "b"), F.col("a") > F.col("b"))
    wrong = pairs.filter(
        ((F.col("a") - F.col("b")) >= 200) != ((S.minute_of_day("a") - S.minute_of_day("b")) >= 120)
    )
    assert wrong.count() == 0


def test_scheduled_hour(spark):
    got = one(
        spark,
        S.scheduled_hour(F.lit("2019-03-01T00:00:00"), F.lit(59)),
        S.scheduled_hour(F.lit("2019-03-01"), F.lit(2359)),
        S.scheduled_hour(F.lit("2019-03-01"), F.lit(2400)),
        S.scheduled_hour(F.lit("junk"), F.lit(100)),
    )
    assert got == (dt.datetime(2019, 3, 1), dt.datetime(2019, 3, 1, 23), None, None)


def test_utc_follows_daylight_saving(spark):
    got = one(
        spark,
        S.to_utc(F.lit("2019-01-15 12:00:00").cast("timestamp_ntz"), F.lit("America/New_York")),
        S.to_utc(F.lit("2019-07-15 12:00:00").cast("timestamp_ntz"), F.lit("America/New_York")),
    )
    assert got == (dt.datetime(2019, 1, 15, 17), dt.datetime(2019, 7, 15, 16))


def test_utc_ignores_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = one(
            spark,
            S.to_utc(F.lit("2019-07-15 12:00:00").cast("timestamp_ntz"), F.lit("Europe/Paris")).cast("string"),
            S.hour_floor(F.lit("2019-07-15 12:34:56").cast("timestamp_ntz")).cast("string"),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ("2019-07-15 10:00:00", "2019-07-15 12:00:00")


def test_slash_date(spark):
    got = one(spark, *[S.slash_date(F.lit(x)) for x in ("1/5/20", "12/25/2019", "no", "2/30/20")])
    assert got == (dt.date(2020, 1, 5), dt.date(2019, 12, 25), None, None)


def test_composite_id_is_null_with_a_null_part(spark):
    assert one(spark, S.composite_id(F.lit(1), F.lit("x"), F.lit(2.5))) == ("1-x-2.5",)
    assert one(spark, S.composite_id(F.lit(1), F.lit(None))) == (None,)


def test_flags_use_substrings(spark, rows):
    from delaykit.operators.weather import weather_flags

    df = spark.createDataFrame([("FZRA",), ("BLSN",), ("TSRA",), (None,), ("",)], "w string")
    got = rows(weather_flags(df, "w"))
    # columns: text, blowing snow, freezing rain, rain, snow, thunder
    assert ("FZRA", 0, 1, 1, 0, 0) in got
    assert ("BLSN", 1, 0, 0, 1, 0) in got
    assert ("TSRA", 0, 0, 1, 0, 1) in got
    assert (None, 0, 0, 0, 0, 0) in got and ("", 0, 0, 0, 0, 0) in got


def test_unit_hash_is_even_and_stable(spark):
    df = spark.range(20000).select("id", S.unit_hash("id").alias("u"))
    stats = df.agg(F.avg("u"), F.min("u"), F.max("u")).first()
    assert abs(stats[0] - 0.5) < 0.02 and stats[1] >= 0 and stats[2] < 1
    again = df.repartition(7).join(df.withColumnRenamed("u", "v"), "id")
    assert again.filter("u != v").count() == 0


def test_f_beta_guards(spark):
    got = one(spark, S.f_beta(0.5, F.lit(0.0), F.lit(0.0)), S.f_beta(1.0, F.lit(0.5), F.lit(0.5)))
    assert got == (0.0, 0.5)
    assert one(spark, S.ratio(F.lit(1.0), F.lit(0.0)), S.clamp_low(F.lit(-3.0))) == (0.0, 0.0)
