"""Streams against their batch results, and late rows."""

from pyspark.sql import functions as F

from thermolens.operators.features import add_physical_features
from thermolens.operators.impute import GroupMedianImputer
from thermolens.operators.rules import recommendations, rule_diagnosis
from thermolens.schema import ID, TIME, ZONE
from thermolens.streaming import jobs


def test_stream_scoring_equals_batch_and_resumes(spark, readings, tmp_path):
    medians = GroupMedianImputer().fit(readings)
    source, out, log = (f"{tmp_path}/{n}" for n in ("in", "out", "log"))
    columns = [ID, "tvoc_ppb", "predicted", "recommendations"]

    def run():
        stream = jobs.read_stream(spark, source, readings.schema, files_per_batch=1)
        jobs.run_to_files(jobs.diagnose_stream(stream, medians).select(*columns), out, log)

    readings.filter(f"{ID} % 2 = 0").repartition(3).write.parquet(source)
    run()
    readings.filter(f"{ID} % 2 = 1").repartition(2).write.mode("append").parquet(source)
    run()
    run()  # nothing new: nothing is written twice
    batch = recommendations(rule_diagnosis(add_physical_features(medians.transform(readings))))
    got, want = spark.read.parquet(out), batch.select(*columns)
    assert got.count() == 1000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_null_profile_updates_equal_batch(spark, readings, tmp_path):
    source, out, log = (f"{tmp_path}/{n}" for n in ("in", "out", "log"))
    # Many files in one batch each, out of order: a wide delay accepts all of them.
    readings.repartition(4).write.parquet(source)
    stream = jobs.read_stream(spark, source, readings.schema, files_per_batch=1)
    jobs.run_updates_to_files(jobs.null_profile_stream(stream, delay="60 days"), out, log)
    got = jobs.latest_updates(spark, out, ["window_start", ZONE])
    want = jobs.batch_null_profile(readings)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_late_rows_are_dropped_in_append_mode(spark, readings, tmp_path):
    source, out, log = (f"{tmp_path}/{n}" for n in ("in", "out", "log"))

    def at(when, n):
        return readings.limit(n).withColumn(TIME, F.lit(when).cast("timestamp_ntz"))

    def run():
        stream = jobs.read_stream(spark, source, readings.schema)
        jobs.run_to_files(jobs.null_profile_stream(stream), out, log)

    for when, n in (("2024-03-01 10:05:00", 20), ("2024-03-01 14:00:00", 5),
                    ("2024-03-01 10:06:00", 7), ("2024-03-01 13:30:00", 4),
                    ("2024-03-01 20:00:00", 1)):
        at(when, n).coalesce(1).write.mode("append").parquet(source)
        run()
    rows = spark.read.parquet(out).groupBy("window_start").agg(F.sum("n").alias("n")).collect()
    assert {str(r.window_start): r.n for r in rows} == {
        "2024-03-01 10:00:00": 20, "2024-03-01 13:30:00": 4, "2024-03-01 14:00:00": 5}
