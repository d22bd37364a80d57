"""The layered run on the seed rows and the generator's rows, control rows, schema plans, migration and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratiform.functions import expr
from stratiform.operators import quality, scd2
from stratiform.operators.watermark import Control, Mark, profile
from stratiform.plans import datagen, pipeline, schema
from stratiform.plans.audit import Recorder
from stratiform.sources import tables
from stratiform.streaming import stream


def config(root, **more):
    derived = {
        "age_years": expr.year_difference("year_of_birth", dt.date(2026, 1, 1)),
        "nhs_age_band": expr.band(expr.year_difference("year_of_birth", dt.date(2026, 1, 1)), expr.BANDS_3),
        "ecds_compliant": expr.compliance_flag("person_id", "gender_concept_id"),
    }
    return pipeline.Config(table="person", key="person_id", watermark="updated_timestamp", root=str(root), rules=quality.person_rules(dt.date(2026, 6, 1)), attributes=["gender_concept_id", "age_years", "nhs_age_band", "ecds_compliant"], derived=derived, pseudonymize="person_source_value", effective="business_effective_date", **more)


def test_seed_batches(spark, tmp_path):
    clean, bad, late = datagen.seed_rows(spark)
    c = config(tmp_path)
    first = pipeline.run(spark, clean.unionByName(bad), c, dt.datetime(2026, 1, 31), "run-1")
    assert first.rows == {"bronze": 18, "silver": 15, "gold": 15, "dim": 15} and first.quarantined == 3
    q = spark.read.parquet(c.path("quarantine"))
    assert q.count() == 3 and q.where("resolution_status = 'NEW'").count() == 3 and q.select("quarantine_id").distinct().count() == 3
    source = clean.unionByName(bad).unionByName(late)
    second = pipeline.run(spark, source, c, dt.datetime(2026, 2, 28), "run-2")
    assert second.rows["bronze"] == 5
    dim = spark.read.parquet(c.path("dim"))
    assert (dim.count(), dim.where("is_current").count()) == (20, 15)
    assert dim.where("NOT is_current AND effective_to = DATE'2026-01-12'").count() == 5
    for check in (scd2.several_current(dim, ["person_key"]), scd2.gaps(dim, ["person_key"]), scd2.bad_order(dim), scd2.bad_current(dim)):
        assert check.count() == 0
    assert pipeline.run(spark, source, c, dt.datetime(2026, 3, 1), "run-3").rows == {"bronze": 0, "silver": 0, "gold": 0}
    assert spark.read.parquet(f"{tmp_path}/audit_trail").where("event_type = 'RUN'").count() == 3


def test_failed_run_commits_no_mark(spark, tmp_path):
    clean, _, _ = datagen.seed_rows(spark)
    c = config(tmp_path)
    broken = pipeline.Config(**{**c.__dict__, "derived": {"x": F.col("no_such_column")}})
    with pytest.raises(Exception, match="no_such_column"):
        pipeline.run(spark, clean, broken, dt.datetime(2026, 1, 31), "run-1")
    assert Control(spark, f"{tmp_path}/etl_control").get("person", "bronze") is None
    assert spark.read.parquet(f"{tmp_path}/rca_errors").where("stage = 'gold'").count() == 1
    assert pipeline.run(spark, clean, c, dt.datetime(2026, 1, 31), "run-1").rows["silver"] == 15
    assert spark.read.parquet(c.path("bronze")).count() == 15  # the rerun did not load Bronze twice


def test_another_run_goes_on_where_a_failed_one_ended(spark, tmp_path):
    clean, bad, _ = datagen.seed_rows(spark)
    c = config(tmp_path)
    with pytest.raises(Exception, match="no_such_column"):
        pipeline.run(spark, clean.unionByName(bad), pipeline.Config(**{**c.__dict__, "derived": {"x": F.col("no_such_column")}}), dt.datetime(2026, 1, 31), "run-1")
    out = pipeline.run(spark, clean.unionByName(bad), c, dt.datetime(2026, 1, 31), "run-2")
    assert out.rows == {"bronze": 0, "silver": 0, "gold": 15, "dim": 15}
    assert [spark.read.parquet(c.path(t)).count() for t in ("bronze", "silver", "quarantine", "gold", "dim")] == [18, 15, 3, 15, 15]


def test_late_log(spark, tmp_path):
    clean, _, late = datagen.seed_rows(spark)
    c = config(tmp_path, max_backdate_days=100, notify_late_rows=2)
    pipeline.run(spark, clean, c, dt.datetime(2026, 1, 31), "run-1")
    old = late.where("person_id = 502").withColumn("business_effective_date", F.lit(dt.date(2020, 1, 1)))
    out = pipeline.run(spark, clean.unionByName(late.where("person_id <> 502")).unionByName(old), c, dt.datetime(2026, 2, 28), "run-2")
    assert out.late == {"PROCESSED": 4, "REJECTED": 1}
    log = {r["person_id"]: r for r in spark.read.parquet(f"{tmp_path}/late_arrival_log").collect()}
    assert set(log) == {501, 502, 503, 504, 505} and log[502]["status"] == "REJECTED" and "gender_concept_id" in log[501]["changed_attributes"]
    assert log[501]["days_late"] == 47 and log[501]["old_values"] != log[501]["new_values"]
    assert spark.read.parquet(c.path("dim")).count() == 19
    assert spark.read.parquet(f"{tmp_path}/audit_trail").where("event_type = 'LATE' AND status = 'WARNING'").count() == 1


def test_generator(spark):
    rows = datagen.people(spark, 500, dt.datetime(2026, 1, 1), first_id=2_000_001)
    assert rows.select("person_id").distinct().count() == 500 and rows.where("month_of_birth = 12").count() > 0
    assert quality.evaluate(rows, quality.person_rules(dt.date(2026, 1, 1))).where("dq_status <> 'PASS'").count() == 0
    broken = datagen.with_errors(rows, 0.6)
    status = {r[0]: r[1] for r in quality.evaluate(broken, quality.person_rules(dt.date(2026, 1, 1))).groupBy("dq_status").count().collect()}
    assert sum(status.values()) == 500 and 220 < 500 - status["PASS"] < 380
    assert datagen.scd_updates(rows, 2, dt.datetime(2026, 2, 1)).count() == 2
    assert abs(datagen.weights(rows, "gender_concept_id").agg(F.max("upto")).first()[0] - 1) < 1e-9


def test_control(spark, tmp_path):
    at = dt.datetime(2026, 1, 1)
    control = Control(spark, f"{tmp_path}/control")
    assert control.init(["dbo.person"], at) == 4 and control.init(["person", "visit"], at) == 8
    assert control.get("dbo.person", "silver") is None
    control.put_all("person", {"bronze": Mark(dt.datetime(2026, 1, 2), 5), "silver": Mark(None, 0, status="RUNNING")}, "s", at)
    assert control.get("person", "bronze") == dt.datetime(2026, 1, 2) and control.get("person", "silver") is None
    assert control.ready().count() == 7 and control.history("person").count() == 4
    with pytest.raises(LookupError):
        control.get("person", "platinum")
    assert profile(spark.range(0).withColumn("w", F.current_timestamp()), "w").first()["total"] == 0


def test_rules_keep_every_failure(spark):
    rows = spark.createDataFrame([(1, 8507, 1980, 2, 29), (None, 9999, 1899, 15, 35), (3, None, None, None, None), (4, 8507, 2027, 1, 1), (5, 8507, 1900, 1, 1)], "person_id int, gender_concept_id int, year_of_birth int, month_of_birth int, day_of_birth int")
    found = {r["person_id"]: (r["dq_status"], r["n"]) for r in quality.evaluate(rows, quality.person_rules(dt.date(2026, 1, 1))).selectExpr("person_id", "dq_status", "size(dq_failures) n").collect()}
    assert found == {1: ("PASS", 0), None: ("FAIL", 6), 3: ("PASS", 0), 4: ("WARNING", 1), 5: ("PASS", 0)}


def test_schema_plans(spark, tmp_path):
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    new = spark.createDataFrame([("7", 1.5), (None, 2.5)], "id string, extra double")
    plan, frame = schema.prepare(new, old.schema)
    assert plan.action == schema.EVOLVED and frame.columns == ["id", "name", "extra"] and [r[0] for r in frame.collect()] == [7, None]
    lossy = spark.createDataFrame([("7", 1.5), ("x", 2.5)], "id string, extra double")
    plan, frame = schema.prepare(lossy, old.schema)
    assert plan.action == schema.FAILED and frame is None and plan.problems == ["id: 1 values can't become int"]
    assert schema.prepare(lossy, old.schema, True)[0].action == schema.RECREATE
    assert schema.inspect(None, new.schema).action == schema.CREATE and schema.inspect(old.schema, old.schema).action == schema.MERGE
    nested = spark.createDataFrame([([1],)], "id array<int>")
    assert schema.prepare(nested, old.schema)[1] is None and schema.inspect(old.schema, nested.schema, True).action == schema.RECREATE
    path = f"{tmp_path}/t"
    old.write.parquet(path)
    assert schema.migrate(spark, path, backup=f"{path}.before") == 1 and "is_deleted" in spark.read.parquet(path).columns
    assert spark.read.parquet(f"{path}.before").columns == ["id", "name"]
    with pytest.raises(ValueError, match="as it was"):
        tables.replace(spark.read.parquet(path).limit(0), path, expected=1)
    assert spark.read.parquet(path).count() == 1


def test_tables(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = tables.rows(spark, [(1, "a"), (2, "b")], ["id", "name"])
    tables.append(df, path, ["name"])
    assert tables.replace(spark.read.parquet(path).where("id > 1"), path) == 1 and spark.read.parquet(path).count() == 1
    other = f"{tmp_path}/u"
    df.write.parquet(other)
    with pytest.raises(ValueError, match="lacks"):
        tables.append_aligned(df.withColumn("x", F.lit(1)), other)
    tables.append_aligned(df.drop("name"), other)
    tables.append_evolving(df.withColumn("x", F.lit(1)), other)
    assert tables.read_evolving(spark, other).count() == 6 and "x" in tables.read_evolving(spark, other).columns
    assert tables.empty(spark, "a int").count() == 0 and tables.sample_head(spark.range(100), 0.5, 5, 1).count() <= 5
    df.createOrReplaceTempView("some_rows")
    assert "some_rows" in tables.list_tables(spark) and tables.describe(spark, "some_rows")[0] == ("id", "bigint")
    assert tables.cast_existing(df, tables.empty(spark, "id int").schema).schema["id"].dataType.simpleString() == "int"


def test_append_spreads_a_value_over_tasks(spark, tmp_path):
    tables.append(spark.range(1000).withColumn("day", F.lit("d")), f"{tmp_path}/t", ["day"])
    assert spark.read.parquet(f"{tmp_path}/t").groupBy("day").count().collect()[0]["count"] == 1000


def test_catalog(spark, tmp_path):
    wide = tables.empty(spark, "id int, name string, extra double").schema
    tables.drop_tables(spark, ["people_a", "people_b"])
    tables.create_table(spark, "people_a", "id int, name string")
    tables.create_table(spark, "people_a", "id int")  # there already
    spark.createDataFrame([(1, "a")], "id int, name string").write.insertInto("people_a")
    assert tables.add_table_columns(spark, "people_a", wide) == ["extra"] and tables.add_table_columns(spark, "people_a", wide) == []
    tables.rename_table(spark, "people_a", "people_b")
    assert [tuple(r) for r in spark.table("people_b").collect()] == [(1, "a", None)]
    assert tables.drop_tables(spark, ["people_a", "people_b"]) == ["people_b"]
    spark.range(3).write.parquet(f"{tmp_path}/one")
    assert tables.reset(spark, str(tmp_path), ["one", "two"]) == ["one"] and not tables.exists(spark, f"{tmp_path}/one")


def test_quotas_draws_and_updates(spark):
    at = dt.datetime(2026, 1, 1)
    rows = datagen.people(spark, 400, at, first_id=1000)
    quotas = {"null_id": 7, "bad_gender": 11, "future_year": 3, "old_year": 5, "bad_month": 2, "bad_day": 13}
    broken = datagen.with_error_quotas(rows, quotas, 400, 1000)
    got = broken.agg(*[F.count_if(F.expr(c)).alias(k) for k, c in {"null_id": "person_id IS NULL", "bad_gender": "gender_concept_id = 9999", "future_year": "year_of_birth > 2026", "old_year": "year_of_birth < 1900", "bad_month": "month_of_birth = 13", "bad_day": "day_of_birth = 32"}.items()]).first().asDict()
    assert got == quotas
    with pytest.raises(ValueError, match="kinds"):
        datagen.with_error_quotas(rows, {"other": 1}, 400)
    learned = datagen.learned_people(spark, rows.where("gender_concept_id <> 8551 AND year_of_birth < 1950"), 2000, at)
    assert learned.where("gender_concept_id = 8551 OR year_of_birth >= 1950").count() == 0
    share = learned.where("gender_concept_id = 8507").count() / 2000
    want = rows.where("gender_concept_id = 8507 AND year_of_birth < 1950").count() / rows.where("gender_concept_id <> 8551 AND year_of_birth < 1950").count()
    assert abs(share - want) < 0.06
    updates = datagen.scd_updates(rows, 10, dt.datetime(2026, 2, 1), year_shift=-16)
    merged = datagen.merge_updates(rows, updates)
    assert merged.count() == 400 and merged.where("updated_timestamp = TIMESTAMP_NTZ'2026-02-01'").count() == 10
    before = {r["person_id"]: r["year_of_birth"] for r in rows.collect()}
    assert all(r["year_of_birth"] == before[r["person_id"]] - 16 for r in updates.collect())


def test_recorder():
    r = Recorder("s", lambda: dt.datetime(2026, 1, 1))
    r.log("X", "one")
    r.log("X", "two", status="FAILED")
    r.error("gold", ValueError("no"))
    assert r.summary() == {"SUCCESS": 1, "FAILED": 1} and r.errors[0][-1]


def test_event_time_streams(spark, tmp_path):
    rows = [(1, dt.datetime(2026, 1, 1, 10, 1)), (1, dt.datetime(2026, 1, 1, 10, 2)), (2, dt.datetime(2026, 1, 1, 10, 7))]
    spark.createDataFrame(rows, "k int, at timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    source = lambda: spark.readStream.schema("k int, at timestamp").parquet(f"{tmp_path}/in")
    for name, frame, mode in (("once", stream.deduplicated(source(), ["k"], "at", "1 hour"), "append"), ("counts", stream.windowed_counts(source(), "at", "1 hour", "5 minutes", "k"), "update")):
        q = frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    assert spark.table("once").count() == 2
    assert sorted((r["k"], r["n"]) for r in spark.table("counts").collect()) == [(1, 2), (2, 1)]


def test_stream(spark, tmp_path):
    clean, bad, _ = datagen.seed_rows(spark)
    clean.unionByName(bad).coalesce(1).write.parquet(f"{tmp_path}/in")
    c = config(tmp_path / "out")
    q = stream.available_now(spark, f"{tmp_path}/in", clean.schema, c, f"{tmp_path}/cp", lambda n: dt.datetime(2026, 1, 31))
    q.awaitTermination(300)
    assert q.exception() is None and spark.read.parquet(c.path("dim")).count() == 15
