import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaykit.session import checkpoint_dir, cut_lineage
from delaykit.sources import readers, schemas, sinks, versions


def test_stage_and_reload(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 2019), (2, 2020), (3, 2021)], "id int, YEAR int")
    path = str(tmp_path / "stage")
    sinks.write_stage(df, path, "YEAR")
    sinks.write_stage(df, path, "YEAR")  # overwrites
    again, periods = sinks.reload_stage(spark, path, "YEAR", holdout=2021)
    assert rows(again.select("id", "YEAR")) == [(1, 2019), (2, 2020), (3, 2021)]
    assert rows(periods) == [(2019,), (2020,)]
    pruned = again.filter("YEAR = 2020")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in pruned


def test_slices_and_globs(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "flights_3m"))
    spark.range(9).write.parquet(str(tmp_path / "flights"))
    assert readers.read_parquet(spark, str(tmp_path / "flights"), slice_name="3 months").count() == 3
    assert readers.read_parquet(spark, str(tmp_path / "flights")).count() == 9
    assert readers.read_parquet(spark, str(tmp_path / "flights*")).count() == 12


def test_csv_is_text_by_declared_schema(spark, rows, tmp_path):
    (tmp_path / "d.csv").write_text("SpecialDate,SpecialDateType,AssumedEffect_Text\n1/1/20,NewYear,NotBusy\n")
    df = readers.read_csv(spark, str(tmp_path / "d.csv"), schemas.SPECIAL_DAYS)
    assert {t for _, t in df.dtypes} == {"string"} and rows(df) == [("1/1/20", "NewYear", "NotBusy")]
    readers.csv_to_parquet(spark, str(tmp_path / "d.csv"), str(tmp_path / "p"), schemas.SPECIAL_DAYS)
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1


def test_tabbed_text(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "src string, dst int")
    sinks.write_tabbed(df, str(tmp_path / "t"))
    assert rows(readers.read_tabbed(spark, str(tmp_path / "t"), ["src", "dst"])) == [("a", "1"), ("b", "2")]


def test_metrics_log_backup_and_reset(spark, tmp_path):
    run = spark.createDataFrame(
        [(dt.datetime(2022, 1, 1), 0.5, 0.4, 0.3, 0.8, 0.0, 0.0, 5, 0.5)], schemas.METRICS_LOG
    )
    path = str(tmp_path / "log")
    sinks.log_metrics(run, path)
    sinks.log_metrics(run, path)
    assert versions.read(spark, path).count() == 2
    backup = sinks.reset_metrics(spark, path, str(tmp_path / "backups"), stamp="x")
    assert versions.read(spark, backup).count() == 2
    left = versions.read(spark, path).collect()
    assert len(left) == 1 and left[0]["precision"] == 0.0 and left[0]["maxIter"] == 0


def test_an_append_during_the_reset_is_not_lost(spark, tmp_path, monkeypatch):
    path, backup, calls = str(tmp_path / "log"), str(tmp_path / "backup"), []
    versions.append(spark.range(3), path)
    publish = versions.Store.publish

    def late(store, number, folders, columns=None):
        # somebody appends after the copy was made and before the new log is published
        if store.root.endswith("/log") and not calls:
            calls.append(number)
            versions.append(spark.range(10, 12), path)
        return publish(store, number, folders, columns)

    monkeypatch.setattr(versions.Store, "publish", late)
    versions.start_anew(spark, path, spark.range(99, 100), backup)
    assert sorted(r[0] for r in versions.read(spark, backup).collect()) == [0, 1, 2, 10, 11]
    assert [r[0] for r in versions.read(spark, path).collect()] == [99]


def test_a_failed_overwrite_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([(1, 2019), (2, 2020)], "id int, YEAR int")
    assert versions.overwrite(df, path, "YEAR") == 1
    broken = df.select(F.when(F.col("id") == 2, F.raise_error("lost")).otherwise(F.col("id")).alias("id"), "YEAR")
    with pytest.raises(Exception, match="lost"):
        versions.overwrite(broken, path, "YEAR")
    again, periods = sinks.reload_stage(spark, path, "YEAR")
    assert sorted(map(tuple, again.select("id", "YEAR").collect())) == [(1, 2019), (2, 2020)] and periods.count() == 2
    assert versions.append(df, path, "YEAR") == 2 and versions.read(spark, path).count() == 4
    assert versions.overwrite(df.limit(1), path, "YEAR") == 3
    assert versions.read(spark, path).count() == 1 and versions.read(spark, path, 2).count() == 4
    pruned = versions.read(spark, path).filter("YEAR = 2019")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in pruned


def test_two_writers_do_not_take_the_same_number(spark, tmp_path):
    store = versions.Store(spark, str(tmp_path / "stage"))
    assert store.publish(1, ["a"]) and not store.publish(1, ["b"])
    assert store.latest() == (1, ["a"]) and store.commit(lambda old: [*old, "c"]) == 2
    assert store.latest() == (2, ["a", "c"]) and len(store.listed("_versions")) == 2


def test_clear_and_release(spark, tmp_path):
    path = str(tmp_path / "stage")
    for n in (1, 2, 3):
        versions.overwrite(spark.range(n), path)
    assert versions.clear(spark, path) == []  # all of them are young
    assert len(versions.clear(spark, path, older_than=-60)) == 2
    assert versions.read(spark, path).count() == 3 and versions.Store(spark, path).numbers() == [3]
    sinks.release_stages(spark)
    kept = sinks.staged(spark.range(4), "kept")
    assert kept.count() == 4 and sinks.release_stages(spark) == 1 and sinks.release_stages(spark) == 0
    with pytest.raises(FileNotFoundError):
        versions.read(spark, str(tmp_path / "none"))


def test_checkpoints_are_reliable_ones(spark):
    df = cut_lineage(spark.range(5))
    assert df.count() == 5
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
    assert checkpoint_dir(spark) == checkpoint_dir(spark)


def test_a_large_file_of_a_stage_is_read_by_several_tasks(spark):
    rows = spark.range(0, 3_000_000, 1, 1).select((F.col("id") % 1).alias("YEAR"), F.xxhash64("id").alias("x"))
    kept = sinks.staged(rows, "long", "YEAR")
    assert len(kept.inputFiles()) == 1
    counts = [r["n"] for r in kept.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(counts) > 1 and sum(counts) == 3_000_000
