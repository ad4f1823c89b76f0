"""Prior-period rates, special days, previous events, code flags, PageRank features."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaykit.catalogue import standins as s
from delaykit.catalogue.registry import query, r9, tables
from delaykit.config import SPECIAL_DAY_EFFECTS
from delaykit.functions.scalars import code_flags, hour_text
from delaykit.operators.audits import prevalence
from delaykit.operators.lagged import carrier_effect, period_rates
from delaykit.operators.special_days import special_day_calendar, special_day_effect
from delaykit.operators.tracker import previous_status
from delaykit.plans.features import airport_pagerank, engineer_features, rebalance
from delaykit.sources.sinks import staged


def _effect_sql(group: str) -> str:
    return f"""
rates AS (
  SELECT "YEAR" AS y, {group} AS g, sum(DEP_DEL15) / count(o_orderkey) * 100 AS p
  FROM plain_orders GROUP BY ALL
),
quartiles AS (
  SELECT y, quantile_cont(p, 0.25) AS lo, quantile_cont(p, 0.75) AS hi FROM rates GROUP BY y
),
tiers AS (
  SELECT r.y, r.g, r.p, CASE WHEN r.p > q.hi THEN 'BelowAverage'
                             WHEN r.p < q.lo THEN 'AboveAverage' ELSE 'Average' END AS tier
  FROM rates r JOIN quartiles q USING (y)
),
joined AS (
  SELECT f.o_orderkey, f."YEAR", f.{group}, t.p, t.tier
  FROM plain_orders f LEFT JOIN tiers t
    ON t.g = f.{group}
   AND t.y = CASE WHEN f."YEAR" = (SELECT min("YEAR") FROM plain_orders) THEN f."YEAR"
                  ELSE f."YEAR" - 1 END
)
SELECT o_orderkey, "YEAR", {group},
       round(coalesce(p, avg(p) OVER (PARTITION BY "YEAR")), 9) AS perc_delay,
       coalesce(tier, 'Average') AS airline_type
FROM joined"""


@query("carrier_effect_lagged", f"WITH {s.PLAIN_ORDERS_SQL}, {_effect_sql('OP_UNIQUE_CARRIER')}")
def carrier_effect_lagged(spark, sf):
    rows = carrier_effect(s.plain_orders(spark, sf), row_id="o_orderkey")
    return rows.select(
        "o_orderkey", "YEAR", "OP_UNIQUE_CARRIER", r9("perc_delay").alias("perc_delay"), "airline_type"
    )


@query("customer_effect_lagged", f"WITH {s.PLAIN_ORDERS_SQL}, {_effect_sql('o_custkey')}")
def customer_effect_lagged(spark, sf):
    """Many groups, most with gaps between years, so the fill rule matters."""
    rows = carrier_effect(s.plain_orders(spark, sf), group="o_custkey", row_id="o_orderkey")
    return rows.select(
        "o_orderkey", "YEAR", "o_custkey", r9("perc_delay").alias("perc_delay"), "airline_type"
    )


@query(
    "carrier_report",
    f"""WITH {s.PLAIN_ORDERS_SQL}
SELECT "YEAR", OP_UNIQUE_CARRIER, sum(DEP_DEL15) AS "TotalDelay",
       count(o_orderkey) AS "TotalFlight",
       round(sum(DEP_DEL15) / count(o_orderkey) * 100, 9) AS perc_delay
FROM plain_orders GROUP BY "YEAR", OP_UNIQUE_CARRIER
ORDER BY perc_delay DESC, "YEAR", OP_UNIQUE_CARRIER""",
)
def carrier_report(spark, sf):
    rates = period_rates(
        s.plain_orders(spark, sf), "YEAR", "OP_UNIQUE_CARRIER", "DEP_DEL15", "o_orderkey"
    )
    return (
        rates.drop("n_rows")
        .withColumn("perc_delay", r9("perc_delay"))
        .orderBy(F.desc("perc_delay"), "YEAR", "OP_UNIQUE_CARRIER")
    )


_THANKSGIVING = "month({d}) = 11 AND dayofweek({d}) = 4 AND day({d}) BETWEEN 22 AND 28"


def _kind_sql(day: str) -> str:
    before = _THANKSGIVING.format(d=f"({day} + INTERVAL 1 DAY)")
    after = _THANKSGIVING.format(d=f"({day} - INTERVAL 3 DAY)")
    cases = [
        (f"month({day}) = 1 AND day({day}) = 1", "NewYear"),
        (before, "Thanksgiving_m1"),
        (_THANKSGIVING.format(d=day), "Thanksgiving"),
        (after, "SunAfterThanksgiving"),
        (f"month({day}) = 12 AND day({day}) = 25", "Christmas"),
    ]
    for n in (1, 2, 3):
        cases.append((f"month({day}) = 12 AND day({day}) = {25 - n}", f"Christmas_m{n}"))
        cases.append((f"month({day}) = 12 AND day({day}) = {25 + n}", f"Christmas_p{n}"))
    whens = " ".join(f"WHEN {c} THEN '{SPECIAL_DAY_EFFECTS[k]}'" for c, k in cases)
    return f"CASE {whens} ELSE 'NONE' END"


@query(
    "special_day_effect",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS FL_DATE,
       {_kind_sql('o_orderdate')} AS "AssumedEffect_Text" FROM orders""",
)
def special_days(spark, sf):
    (orders,) = tables(spark, sf, "orders")
    flights = orders.select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("FL_DATE"))
    years = orders.select(F.year("o_orderdate").alias("YEAR"))
    return special_day_effect(flights, special_day_calendar(years))


@query(
    "special_day_two_digits",
    f"""SELECT event_id, {_kind_sql('ts')} AS "AssumedEffect_Text" FROM events""",
)
def special_days_two_digits(spark, sf):
    """The calendar in the file's own form, month/day/two digits of the year."""
    (events,) = tables(spark, sf, "events")
    rows = events.select("event_id", F.to_date("ts").cast("string").alias("FL_DATE"))
    calendar = special_day_calendar(events.select(F.year("ts").alias("YEAR")))
    short = calendar.withColumn("SpecialDate", F.regexp_replace("SpecialDate", r"/..(\d\d)$", "/$1"))
    return special_day_effect(rows, short).select("event_id", "AssumedEffect_Text")


def _tracker_sql(kind: str, out: str) -> str:
    return f"""
WITH e AS (
  SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS FL_DATE,
         hour(ts) * 60 + minute(ts) AS m, CAST(event_type = '{kind}' AS INTEGER)::DOUBLE AS st
  FROM events
),
l AS (
  SELECT *, lag(st, 1) OVER w AS s1, lag(st, 2) OVER w AS s2, m - lag(m, 1) OVER w AS gap
  FROM e WINDOW w AS (PARTITION BY FL_DATE, user_id ORDER BY m, event_id)
)
SELECT event_id, user_id, FL_DATE, CAST(gap AS INTEGER) AS gap_minutes,
       coalesce(CASE WHEN gap >= 120 THEN s1 ELSE s2 END, 0.0) AS {out}
FROM l"""


def _track(spark, sf, kind, out):
    (events,) = tables(spark, sf, "events")
    rows = events.select(
        "event_id",
        "user_id",
        F.to_date("ts").cast("string").alias("FL_DATE"),
        (F.hour("ts") * 60 + F.minute("ts")).alias("m"),
        (F.col("event_type") == kind).cast("double").alias("st"),
    )
    tracked = previous_status(
        rows, "st", day="FL_DATE", unit="user_id", minutes="m", out=out, tie=["event_id"],
        keep_helpers=True,
    )
    return tracked.select(
        "event_id", "user_id", "FL_DATE", F.col(f"{out}_gap_minutes").alias("gap_minutes"), out
    )


@query("prev_event_tracker", _tracker_sql("error", "is_prev_delayed"))
def prev_event_tracker(spark, sf):
    return _track(spark, sf, "error", "is_prev_delayed")


@query("prev_diverted_tracker", _tracker_sql("view", "is_prev_diverted"))
def prev_diverted_tracker(spark, sf):
    return _track(spark, sf, "view", "is_prev_diverted")


_PART_FLAGS = {"is_promo": "PROMO", "has_st": "ST", "has_m": "M", "has_dar": "DAR"}


@query(
    "code_flags",
    "SELECT p_partkey, "
    + ", ".join(f"CAST(p_type LIKE '%{v}%' AS INTEGER) AS {k}" for k, v in _PART_FLAGS.items())
    + " FROM part",
)
def part_flags(spark, sf):
    (part,) = tables(spark, sf, "part")
    return part.select("p_partkey", *[c.alias(k) for k, c in code_flags("p_type", _PART_FLAGS).items()])


_EVENT_FLAGS = {"has_e": "e", "has_click": "click", "has_er": "er", "has_none": "zzz"}


@query(
    "flag_prevalence",
    "\nUNION ALL\n".join(
        f"""SELECT '{k}' AS flag, count(*) FILTER (WHERE h) AS n,
       round(count(*) FILTER (WHERE h) / count(*), 9) AS share,
       count(*) FILTER (WHERE h AND g) AS n_delayed,
       round(count(*) FILTER (WHERE h AND g) / count(*) FILTER (WHERE g), 9) AS share_delayed
FROM (SELECT event_type LIKE '%{v}%' AS h, value > 30 AS g FROM events)"""
        for k, v in _EVENT_FLAGS.items()
    ),
)
def flag_prevalence(spark, sf):
    (events,) = tables(spark, sf, "events")
    flagged = events.withColumns(code_flags("event_type", _EVENT_FLAGS))
    table = prevalence(flagged, list(_EVENT_FLAGS), F.col("value") > 30, given="delayed")
    return table.withColumns({"share": r9("share"), "share_delayed": r9("share_delayed")})


# -- PageRank ----------------------------------------------------------------

ROUNDS = 40  # of the SQL alone: pagerank_residual shows that nothing moves after them


def pagerank_ctes(source: str, period: str, rounds: int = ROUNDS, tol: float = 0.01) -> str:
    """The same rounds spelled out, one CTE each; rounds after convergence add nothing."""
    steps = [
        f"""edges AS MATERIALIZED (
  SELECT {period} AS p, DEST AS src, ORIGIN AS dst, count(*) AS n FROM {source} GROUP BY ALL),
links AS MATERIALIZED (
  SELECT p, src, dst, n / sum(n) OVER (PARTITION BY p, src) AS w FROM edges),
pr0 AS MATERIALIZED (
  SELECT p, id, 0.15::DOUBLE AS r, 0.15::DOUBLE AS d
  FROM (SELECT p, src AS id FROM links UNION SELECT p, dst FROM links))"""
    ]
    for k in range(rounds):
        steps.append(
            f"""pr{k + 1} AS MATERIALIZED (
  SELECT s.p, s.id, s.r + coalesce(a.v, 0) AS r, coalesce(a.v, 0) AS d
  FROM pr{k} s LEFT JOIN (
    SELECT x.p, l.dst AS id, sum(x.d * l.w) * 0.85::DOUBLE AS v
    FROM pr{k} x JOIN links l ON l.p = x.p AND l.src = x.id
    WHERE x.d > {tol} GROUP BY x.p, l.dst) a ON a.p = s.p AND a.id = s.id)"""
        )
    steps.append(
        f"""ranks AS (
  SELECT p, id, r * count(*) OVER (PARTITION BY p) / sum(r) OVER (PARTITION BY p) AS pagerank
  FROM pr{rounds})"""
    )
    return ",\n".join(steps)


@query(
    "pagerank_all_years",
    f"""WITH {s.ROUTES_SQL}, {pagerank_ctes('routes', "'all'")}
SELECT id, round(pagerank, 9) AS pagerank FROM ranks""",
)
def pagerank_all_years(spark, sf):
    ranks = airport_pagerank(s.routes(spark, sf), ())
    return ranks.select("id", r9("pagerank").alias("pagerank"))


@query(
    "pagerank_by_year",
    f"""WITH {s.ROUTES_SQL}, {pagerank_ctes('routes', '"YEAR"')}
SELECT p AS "YEAR", id, round(pagerank, 9) AS pagerank FROM ranks""",
)
def pagerank_by_year(spark, sf):
    ranks = airport_pagerank(s.routes(spark, sf), ("YEAR",))
    return ranks.select("YEAR", "id", r9("pagerank").alias("pagerank"))


@query(
    "pagerank_by_quarter",
    f"""WITH {s.ROUTES_SQL}, {pagerank_ctes('routes', '"YEAR" * 10 + "QUARTER"')}
SELECT CAST(p // 10 AS INTEGER) AS "YEAR", CAST(p % 10 AS INTEGER) AS "QUARTER", id,
       round(pagerank, 9) AS pagerank FROM ranks""",
)
def pagerank_by_quarter(spark, sf):
    ranks = airport_pagerank(s.routes(spark, sf), ("YEAR", "QUARTER"))
    return ranks.select("YEAR", "QUARTER", "id", r9("pagerank").alias("pagerank"))


@query(
    "pagerank_residual",
    f"""WITH {s.ROUTES_SQL}, {pagerank_ctes('routes', '"YEAR"')}
SELECT p AS "YEAR", count(*) AS n_vertices, count(*) FILTER (WHERE d > 0.01) AS n_moving
FROM pr{ROUNDS} GROUP BY p""",
)
def pagerank_residual(spark, sf):
    """Vertices whose last change is still above the tolerance: none on either side."""
    ranks = airport_pagerank(s.routes(spark, sf), ("YEAR",), with_change=True, link_bytes=-1)
    return ranks.groupBy("YEAR").agg(
        F.count(F.lit(1)).alias("n_vertices"), F.count_if(F.col("change") > 0.01).alias("n_moving")
    )


_HUB_SQL = """hub AS (
  SELECT 1 AS "YEAR", 'c' || c_custkey AS "DEST", 'n' || c_nationkey AS "ORIGIN" FROM customer
  UNION ALL
  SELECT 1, 'n' || n_nationkey, 'n' || (n_nationkey + 1) % 3 FROM nation)"""


@query(
    "pagerank_hub",
    f"""WITH {_HUB_SQL}, {pagerank_ctes('hub', '"YEAR"', rounds=80)}
SELECT id, round(pagerank, 6) AS pagerank FROM ranks""",
)
def pagerank_hub(spark, sf):
    """A skewed graph: all customers point at their nation, all nations at three of them, which
    point at each other, so changes go round for long."""
    customer, nation = tables(spark, sf, "customer", "nation")
    key = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    edges = customer.select(key("c", "c_custkey").alias("DEST"), key("n", "c_nationkey").alias("ORIGIN")).unionByName(
        nation.select(
            key("n", "n_nationkey").alias("DEST"),
            F.concat(F.lit("n"), ((F.col("n_nationkey") + 1) % 3).cast("string")).alias("ORIGIN"),
        )
    )
    return airport_pagerank(edges, (), link_bytes=-1).select("id", F.round("pagerank", 6).alias("pagerank"))


@query(
    "pagerank_lagged_join",
    f"""WITH {s.ORDER_FLIGHTS_SQL}, {pagerank_ctes('order_flights', '"YEAR"')}
SELECT o_orderkey, "YEAR" - 1 AS "YEARLAG1", DEST, round(pagerank, 9) AS pagerank
FROM order_flights JOIN ranks ON p = "YEAR" - 1 AND id = DEST""",
)
def pagerank_lagged_join(spark, sf):
    from delaykit.operators.lagged import prior_period_join

    flights = s.order_flights(spark, sf)
    ranks = airport_pagerank(flights, ("YEAR",))
    joined = prior_period_join(flights, ranks, "YEAR", "DEST", "YEAR", "id", ["pagerank"])
    return joined.select("o_orderkey", "YEARLAG1", "DEST", r9("pagerank").alias("pagerank"))


# -- the whole feature stage -------------------------------------------------

_CODE_SQL = "CASE l.f " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in
                                   {"R": "RA", "A": "-SN BLSN", "N": "FZRA|TS"}.items()) + " END"

FEATURE_SQL = f"""{s.ORDER_FLIGHTS_SQL}, {pagerank_ctes('order_flights', '"YEAR"')},
coded AS (
  SELECT f.*, {_CODE_SQL} AS codes, l.f IS NOT NULL AS has_lines
  FROM order_flights f
  LEFT JOIN (SELECT l_orderkey, max(l_returnflag) AS f FROM lineitem GROUP BY l_orderkey) l
    ON l.l_orderkey = f.o_orderkey
),
c_rates AS (
  SELECT "YEAR" AS y, OP_UNIQUE_CARRIER AS g, sum(DEP_DEL15) / count(*) * 100 AS p
  FROM coded GROUP BY ALL
),
c_tiers AS (
  SELECT y, g, c_rates.p, CASE WHEN c_rates.p > hi THEN 'BelowAverage'
                               WHEN c_rates.p < lo THEN 'AboveAverage' ELSE 'Average' END AS tier
  FROM c_rates JOIN (SELECT y, quantile_cont(p, 0.25) AS lo, quantile_cont(p, 0.75) AS hi
                     FROM c_rates GROUP BY y) q USING (y)
),
tracked AS (
  SELECT *, CASE WHEN m - lag(m) OVER w >= 120 THEN lag(DEP_DEL15) OVER w
                 ELSE lag(DEP_DEL15, 2) OVER w END AS prev
  FROM (SELECT *, CRS_DEP_TIME // 100 * 60 + CRS_DEP_TIME % 100 AS m FROM coded)
  WINDOW w AS (PARTITION BY FL_DATE, TAIL_NUM ORDER BY m, flight_id)
),
features AS (
  SELECT f.o_orderkey, f.flight_id, f."YEAR", f.DEP_DEL15, f.has_lines, f.DEP_DATETIME_LAG,
         f."QUARTER", f."MONTH", CAST(dayofweek(f.DEP_DATETIME_LAG) + 1 AS INTEGER) AS "DAY_OF_WEEK",
         f.OP_UNIQUE_CARRIER, lpad(CAST(f.CRS_DEP_TIME // 100 AS VARCHAR), 2, '0') AS "DEP_HOUR",
         {_kind_sql('CAST(f.FL_DATE AS DATE)')} AS "AssumedEffect_Text",
         t.p AS perc_delay, t.tier AS airline_type, coalesce(f.prev, 0.0) AS is_prev_delayed,
         r.pagerank,
         CAST(coalesce(codes LIKE '%BLSN%', false) AS INTEGER) AS "Blowing_Snow",
         CAST(coalesce(codes LIKE '%FZRA%', false) AS INTEGER) AS "Freezing_Rain",
         CAST(coalesce(codes LIKE '%RA%', false) AS INTEGER) AS "Rain",
         CAST(coalesce(codes LIKE '%SN%', false) AS INTEGER) AS "Snow",
         CAST(coalesce(codes LIKE '%TS%', false) AS INTEGER) AS "Thunder"
  FROM tracked f
  JOIN c_tiers t ON t.g = f.OP_UNIQUE_CARRIER
    AND t.y = CASE WHEN f."YEAR" = (SELECT min("YEAR") FROM coded) THEN f."YEAR" ELSE f."YEAR" - 1 END
  JOIN ranks r ON r.p = f."YEAR" - 1 AND r.id = f.DEST
)"""

_FEATURE_COLUMNS = [
    "o_orderkey", "YEAR", "DEP_DEL15", "AssumedEffect_Text", "perc_delay", "airline_type",
    "is_prev_delayed", "pagerank", "Blowing_Snow", "Freezing_Rain", "Rain", "Snow", "Thunder",
]
_ROUNDED = {"perc_delay", "pagerank"}


def coded_flights(spark, sf):
    """Order flights with weather codes and measures taken from their lines."""
    (lineitem,) = tables(spark, sf, "lineitem")
    # the code goes by the greatest flag; its place among the three flags grows with it and, being a number,
    # is aggregated by hash, where text would have all lines sorted
    flag = F.col("l_returnflag")
    place = F.when(flag.isNotNull(), sum((F.when(c, 1).otherwise(0) for f in "ANR" for c in (flag >= f, flag > f)), F.lit(0)))
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(place).alias("__f"),
        F.avg("l_quantity").alias("HourlyDryBulbTemperature"),
        F.avg("l_extendedprice").alias("DISTANCE"),
        F.avg("l_discount").alias("HourlyPrecipitation"),
        F.avg("l_tax").alias("HourlyVisibility"),
        F.count(F.lit(1)).cast("double").alias("HourlyWindSpeed"),
    )
    code = (
        F.when(F.col("__f") == 5, "RA")
        .when(F.col("__f") == 1, "-SN BLSN")
        .when(F.col("__f") == 3, "FZRA|TS")
    )
    return (
        s.order_flights(spark, sf)
        .join(per_order, "o_orderkey", "left")
        .withColumn("AggHourlyPresentWeatherType", code)
        .withColumn("DEP_TIME_CLEANED", F.col("CRS_DEP_TIME"))
        .drop("__f")
    )


def engineered(spark, sf):
    """PageRank, rates and tracker all read the joined stage, not the plan that makes it."""
    joined = staged(coded_flights(spark, sf), "joined")
    calendar = special_day_calendar(s.plain_orders(spark, sf))
    return engineer_features(joined, calendar, airport_pagerank(joined, ("YEAR",)))


def feature_stage(spark, sf):
    """Engineered features, written as a stage."""
    rows = engineered(spark, sf).withColumn("DEP_HOUR", hour_text("CRS_DEP_TIME"))
    return staged(rows, "features", "YEAR")


def _feature_output(df):
    return df.select(*[r9(c).alias(c) if c in _ROUNDED else F.col(c) for c in _FEATURE_COLUMNS])


def _feature_select(tail: str = "") -> str:
    shown = ", ".join(f'round({c}, 9) AS {c}' if c in _ROUNDED else f'"{c}"' for c in _FEATURE_COLUMNS)
    return f"WITH {FEATURE_SQL}\nSELECT {shown} FROM features {tail}"


@query("engineered_features", _feature_select())
def engineered_features(spark, sf):
    return _feature_output(engineered(spark, sf))


@query(
    "rebalanced_features",
    _feature_select(
        """WHERE "YEAR" = 2001 OR DEP_DEL15 = 1 OR
  ('0x' || substr(md5(flight_id), 1, 13))::UBIGINT / 4503599627370496.0 <
  (SELECT count(*) FILTER (WHERE DEP_DEL15 = 1) / count(*) FILTER (WHERE DEP_DEL15 = 0)
   FROM features WHERE "YEAR" <> 2001)"""
    ),
)
def rebalanced_features(spark, sf):
    """Both passes of the rebalancing read the stage, not the plan that made it."""
    rows = feature_stage(spark, sf)
    return _feature_output(rebalance(rows, is_holdout=F.col("YEAR") == s.HOLDOUT))
