import datetime as dt

from pyspark.sql import functions as F

from delaykit.operators.lagged import carrier_effect, prior_period_join
from delaykit.operators.special_days import special_day_calendar, special_day_effect

SCHEMA = "YEAR int, OP_UNIQUE_CARRIER string, DEP_DEL15 double, flight_id string"


def flights(spark, counts):
    """counts: {(year, carrier): (flights, delayed)}"""
    data = []
    for (year, carrier), (n, late) in counts.items():
        data += [(year, carrier, float(i < late), f"{year}{carrier}{i}") for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


COUNTS = {
    (2015, "A"): (10, 1), (2015, "B"): (10, 5), (2015, "C"): (10, 9),
    (2016, "A"): (4, 4), (2016, "B"): (2, 1), (2016, "N"): (3, 0),
    (2017, "N"): (5, 5), (2017, "A"): (1, 0),
}


def result(spark, df=None, **options):
    out = carrier_effect(flights(spark, COUNTS) if df is None else df, **options)
    return {
        (r["YEAR"], r["OP_UNIQUE_CARRIER"]): (round(r["perc_delay"], 6), r["airline_type"])
        for r in out.collect()
    }


def test_first_year_uses_itself_and_tiers_are_strict(spark):
    got = result(spark)
    # quartiles of (10, 50, 90) are 30 and 70
    assert got[2015, "A"] == (10.0, "AboveAverage")
    assert got[2015, "B"] == (50.0, "Average")
    assert got[2015, "C"] == (90.0, "BelowAverage")


def test_later_years_use_the_prior_year(spark):
    got = result(spark)
    assert got[2016, "A"] == (10.0, "AboveAverage")
    assert got[2016, "B"] == (50.0, "Average")
    assert got[2017, "N"][0] == 0.0  # from 2016, not from its own delays


def test_new_carrier_gets_the_flight_weighted_mean(spark):
    got = result(spark)
    assert got[2016, "N"] == (round((4 * 10.0 + 2 * 50.0) / 6, 6), "Average")
    assert result(spark, plain_mean=True)[2016, "N"] == (30.0, "Average")


def test_no_row_is_lost_and_null_carriers_are_filled_later(spark):
    df = flights(spark, COUNTS).unionByName(
        spark.createDataFrame([(2016, None, 1.0, "x"), (2015, None, 1.0, "y")], SCHEMA)
    )
    out = carrier_effect(df)
    assert out.count() == df.count() - 1  # the null carrier of the first year
    assert out.filter("OP_UNIQUE_CARRIER is null").select("YEAR", "airline_type").collect() == [
        (2016, "Average")
    ]


def test_own_delays_never_enter(spark):
    """Changing a later year's labels leaves that year's features as they were."""
    base = flights(spark, COUNTS)
    flipped = base.withColumn(
        "DEP_DEL15", F.when(F.col("YEAR") == 2017, 1 - F.col("DEP_DEL15")).otherwise(F.col("DEP_DEL15"))
    )
    assert result(spark, base) == result(spark, flipped)


def test_start_year_may_be_given(spark):
    got = result(spark, first_period=2016)
    assert (2015, "A") not in got and got[2016, "A"][0] == 100.0


def test_prior_period_join_drops_rows_without_a_value(spark, rows):
    df = spark.createDataFrame([(2016, "X"), (2017, "X"), (2016, "Y")], "YEAR int, DEST string")
    ranks = spark.createDataFrame(
        [("X", "2015", "1.5"), ("X", "2015", "1.5"), ("Z", "2015", "9")], "id string, YEAR string, pagerank string"
    )
    out = prior_period_join(df, ranks, "YEAR", "DEST", "YEAR", "id", ["pagerank"])
    assert rows(out.select("YEAR", "DEST", "YEARLAG1", "pagerank")) == [(2016, "X", 2015, "1.5")]


def test_special_days(spark, rows):
    df = spark.createDataFrame([("2019-12-25", 1), ("2019-12-27", 2), ("2020-01-01", 3)], "FL_DATE string, n int")
    calendar = spark.createDataFrame(
        [("12/25/19", "Christmas", "NotBusy"), ("1/1/20", "NewYear", "NotBusy")],
        "SpecialDate string, SpecialDateType string, AssumedEffect_Text string",
    )
    got = rows(special_day_effect(df, calendar).select("n", "AssumedEffect_Text"))
    assert got == [(1, "NotBusy"), (2, "NONE"), (3, "NotBusy")]


def test_calendar_rules(spark):
    years = spark.createDataFrame([(2018,), (2018,), (2020,)], "YEAR int")
    days = {(r[1], r[0]) for r in special_day_calendar(years).collect()}
    assert ("Thanksgiving", "11/22/2018") in days and ("Thanksgiving", "11/26/2020") in days
    assert ("SunAfterThanksgiving", "11/25/2018") in days and ("Thanksgiving_m1", "11/25/2020") in days
    assert ("Christmas_m3", "12/22/2018") in days and ("Christmas_p3", "12/28/2020") in days
    assert len(days) == 22 and dt.date(2018, 11, 22).weekday() == 3


def test_tiers_and_fills_of_many_groups(spark):
    """Prior figures of 60 groups by hand: quartiles by place, means weighted by rows."""
    import random

    import numpy as np

    rng = random.Random(9)
    counts = {}
    for year in (2015, 2016, 2017):
        for c in range(60):
            if rng.random() < 0.8:
                n = rng.randrange(1, 9)
                counts[year, f"c{c}"] = (n, rng.randrange(n + 1))
    from delaykit.operators.lagged import carrier_rates, prior_rates

    rates = carrier_rates(flights(spark, counts))
    sums = {(r["YEAR"], r["OP_UNIQUE_CARRIER"]): (r["perc_delay"], r["n_rows"]) for r in rates.collect()}
    want = {}
    for (year, c), (_, _) in sums.items():
        source = year if year == 2015 else year - 1
        own = [p for (y, _), (p, _) in sums.items() if y == source]
        low, high = np.quantile(own, [0.25, 0.75])
        if (source, c) in sums:
            p = sums[source, c][0]
            want[year, c] = (p, "BelowAverage" if p > high else "AboveAverage" if p < low else "Average")
        else:
            known = [(sums[source, d][0], n) for (y, d), (_, n) in sums.items() if y == year and (source, d) in sums]
            want[year, c] = (sum(p * n for p, n in known) / sum(n for _, n in known), "Average")
    got = {(r[0], r[1]): (r[2], r[3]) for r in prior_rates(rates, "YEAR", "OP_UNIQUE_CARRIER").collect()}
    assert got.keys() == want.keys()
    assert all(got[k][1] == want[k][1] and abs(got[k][0] - want[k][0]) < 1e-9 for k in want)


def test_code_goes_by_the_greatest_flag_without_sorting_lines(spark, tmp_path):
    import datetime as dt

    from delaykit.catalogue.feature_queries import coded_flights

    flags = {1: ["A", "R"], 2: ["N", None, "A"], 3: [None], 4: ["A"], 5: ["R", "Z"], 6: ["B", "A"], 7: ["RA"], 8: ["O", "N"], 9: [], 10: [""]}
    lines = [(o, 1.0, 2.0, 0.1, 0.2, f) for o, fs in flags.items() for f in fs]
    orders = [(o, 1, dt.datetime(1996, 1, o), "1-URGENT", "F", 100.5) for o in flags]
    for name, rows, schema in (
        ("lineitem", lines, "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"),
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string, o_totalprice double"),
        ("customer", [(1, 0)], "c_custkey long, c_nationkey int"),
        ("nation", [(n, f"n{n}") for n in range(25)], "n_nationkey int, n_name string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    found = coded_flights(spark, str(tmp_path))
    greatest = {"R": "RA", "A": "-SN BLSN", "N": "FZRA|TS"}
    want = {o: greatest.get(max((f for f in fs if f is not None), default=None)) for o, fs in flags.items()}
    assert {r["o_orderkey"]: r["AggHourlyPresentWeatherType"] for r in found.collect()} == want
    assert "SortAggregate" not in found._jdf.queryExecution().toString()
