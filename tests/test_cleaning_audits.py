from pyspark.sql import functions as F

from delaykit.operators import audits, cleaning, keys
from delaykit.operators.labels import index_labels, label_dictionary


def test_dedup_whole_rows_then_project(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", 9), (1, "a", 9), (1, "a", 8), (2, None, 7), (2, None, 7)], "k int, v string, x int"
    )
    assert rows(cleaning.exact_dedup(df)) == [(1, "a", 8), (1, "a", 9), (2, None, 7)]
    # rows that differ only in a column that is not kept are different rows
    assert rows(cleaning.exact_dedup(df, ["k", "v"])) == [(1, "a"), (1, "a"), (2, None)]
    # nulls that change places make different rows
    swapped = spark.createDataFrame([(1, None, 5), (1, 5, None), (1, None, 5)], "k int, a int, b int")
    assert rows(cleaning.exact_dedup(swapped, ["k"])) == [(1,), (1,)]


def test_fill_keeps_types(spark, rows):
    df = spark.createDataFrame([(None, None), (2.0, "x")], "d double, s string")
    filled = cleaning.fill_constants(df, {"d": 1, "s": "NONE"})
    assert dict(filled.dtypes) == {"d": "double", "s": "string"}
    assert rows(filled) == [(1.0, "NONE"), (2.0, "x")]


def test_outliers_and_unreadable_values_go(spark, rows):
    df = spark.createDataFrame([("200",), ("201",), (None,), ("VRB",), ("7.5",)], "w string")
    assert rows(cleaning.drop_above(df, "w", 200)) == [("200",), ("7.5",)]


def test_mean_impute_may_learn_from_training_rows_only(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, None), (2, 100.0)], "y int, v double")
    assert (1, 2.0) in rows(cleaning.mean_impute(df, ["v"], where=F.col("y") == 1))
    assert (1, 104.0 / 3) in rows(cleaning.mean_impute(df, ["v"]))


def test_first_known_aligns_types(spark, rows):
    df = spark.createDataFrame([(None, "000930"), (1000, "000930")], "a int, b string")
    out = cleaning.first_known(df, "t", "a", "b")
    assert dict(out.dtypes)["t"] == "int" and rows(out, "t") == [(1000,), (930,)]


def test_null_audit_is_type_aware(spark, rows):
    df = spark.createDataFrame(
        [("", 1.0, 1), ("None", float("nan"), None), (None, None, 3), ("a NULL b", 2.0, 4)],
        "s string, d double, i int",
    )
    got = {r[0]: r[1:] for r in rows(audits.null_audit(df))}
    # null, blank, spelled, nan, missing, rows
    assert got["s"] == (1, 1, 2, 0, 4, 4)
    assert got["d"] == (1, 0, 0, 1, 2, 4)
    assert got["i"] == (1, 0, 0, 0, 1, 4)


def test_unparseable_follows_whole_number_reading(spark, rows):
    df = spark.createDataFrame(
        [("12",), ("-3",), ("29.92",), (".5",), ("T",), ("1e5",), (None,), ("",), ("99999999999",)],
        "m string",
    )
    assert rows(audits.unparseable_audit(df, ["m"])) == [("m", 5, 1, 9)]


def test_key_and_dependency_audits(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    assert rows(audits.key_audit(df, ["k", "v"])) == [(5, 4, 1, False)]
    assert rows(audits.dependency_audit(df, "k", "v", top=1)) == [(2, 2)]
    assert rows(audits.distinct_counts(df, {"k": ["k"], "kv": ["k", "v"]})) == [("k", 3), ("kv", 4)]


def test_co_nullity_and_unequal(spark, rows):
    df = spark.createDataFrame([(None, 1), (2, None), (None, None), (3, 4), (5, 5)], "a int, b int")
    got = audits.co_nullity(df, F.col("a").isNull(), F.col("b").isNull())
    assert rows(got) == [(1, 1, 1, 2)]
    assert rows(audits.unequal_rows(df, "a", "b")) == [(1, 5)]


def test_prevalence_counts_and_shares(spark, rows):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 1.0), (0, 0.0)], "Rain int, y double")
    got = rows(audits.prevalence(df, ["Rain"], F.col("y") == 1, given="delayed"))
    assert got == [("Rain", 2, 0.5, 1, 0.5)]


def test_group_reports(spark, rows):
    df = spark.createDataFrame([("a", 5.0), ("a", 6.0), ("b", 20.0)], "k string, v double")
    assert [tuple(r) for r in audits.group_counts(df, "k").collect()] == [("a", 2), ("b", 1)]
    assert rows(audits.group_sums(df, "k", "v", at_least=12)) == [("b", 20.0)]
    assert rows(audits.describe_numeric(df, ["v"]))[0][:2] == ("v", 3)


def test_describe_text(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", None), (None, None), ("", None)], "x string, y string")
    got = {r["column_name"]: tuple(r)[1:] for r in audits.describe_text(df, ["x", "y"]).collect()}
    assert got == {"x": (4, 3, "", "b"), "y": (0, 0, None, None)}


def test_label_dictionary(spark):
    values = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + [None] * 9 + [f"x{i}" for i in range(50)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    known = label_dictionary(df, "v")
    got = [r["label"] for r in known.orderBy("index").collect()]
    assert got == ["c", "a", "b"] + sorted(f"x{i}" for i in range(50))
    assert sorted(r["index"] for r in known.collect()) == list(range(53))
    new = spark.createDataFrame([("c",), ("?",), (None,), ("x7",)], "v string")
    assert {r["v"]: r["i"] for r in index_labels(new, "v", known, "i").collect()} == {"c": 0.0, "x7": float(got.index("x7"))}
    assert index_labels(new, "v", known, "i", keep_unseen=True).filter("i IS NULL").count() == 2


def test_key_search(spark):
    rows = [(i, i % 4, i // 4, (i % 4) // 2, "c", None if i == 3 else 1) for i in range(16)]
    df = spark.createDataFrame(rows, "id int, a int, b int, half int, same string, hole int")
    got = {tuple(r) for r in keys.key_search(df, df.columns, 3).collect()}
    assert {r[1] for r in got if r[0] == "key"} == {"id", "a,b"}
    assert {r[1:] for r in got if r[0] == "dependency"} == {("", "same"), ("a", "half")} | {r[1:] for r in got if r[2] == "hole"}
    assert ("dependency", "half", "a") not in got and ("dependency", "a", "hole") not in got
    assert [tuple(r) for r in keys.key_search(df.limit(1), ["a"]).collect()] == [("key", "", None)]


def test_sets_are_counted_without_making_text(spark, monkeypatch):
    df = spark.createDataFrame([(0.0, 1, None), (-0.0, 1, "x"), (0.5, 2, None), (None, None, "x")], "a double, b int, c string")
    sets = [("a",), ("b",), ("c",), ("a", "b"), ("b", "c"), ("a", "b", "c")]
    want = dict(zip(sets, [3, 3, 2, 3, 4, 4]))  # 0 and -0 are one number
    assert keys.distinct_counts(df, sets) == want
    monkeypatch.setattr(keys, "PASS_COLUMNS", 2)
    assert keys.distinct_counts(df, sets) == want
    wide = spark.range(5).select(*[(F.col("id") % (i % 4 + 1)).alias(f"c{i}") for i in range(70)])
    monkeypatch.setattr(keys, "PASS_COLUMNS", 48)
    assert keys.distinct_counts(wide, [(c,) for c in wide.columns]) == {(f"c{i}",): i % 4 + 1 for i in range(70)}
