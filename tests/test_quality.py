import json

import pytest
from pyspark.sql import functions as F

from jsonloom.functions.scores import arrival_score, efficiency, overall_score, quality_score, recommendation, schema_complexity
from jsonloom.operators.quality.capacity import CapacityRule, capacity_checks, capacity_violations, entity_limit_checks
from jsonloom.operators.quality.consistency import field_rule_checks, null_rates, table_checks, uniqueness_check
from jsonloom.operators.quality.distribution import distribution_checks
from jsonloom.operators.quality.integrity import Reference, integrity_checks
from jsonloom.operators.quality.rows import literal_checks, union_checks
from jsonloom.operators.quality.suite import Rules, gate
from jsonloom.plans import school
from jsonloom.plans.validate import validate
from jsonloom.sources.reports import quality_report_json, quality_report_markdown
from jsonloom.sources.tables import read_tables


@pytest.mark.parametrize("nulls, severity", [(5, None), (6, "WARNING"), (19, "WARNING"), (20, "ERROR")])
def test_null_rate_bands(spark, nulls, severity):
    df = spark.range(100).select(F.when(F.col("id") >= nulls, F.col("id")).alias("x_id"))
    rows = table_checks("t", df).collect()
    assert [r.severity for r in rows] == ([severity] if severity else [])
    assert null_rates(df, "t", ["x_id"]).first().null_percentage == nulls


def test_empty_table(spark):
    rows = table_checks("t", spark.range(0).withColumnRenamed("id", "x_id")).collect()
    assert [(r.check_name, r.severity) for r in rows] == [("Table Population: t", "WARNING")]


@pytest.mark.parametrize("n, passed", [(8, True), (9, False)])
def test_entity_limit(spark, n, passed):
    df = spark.range(n).select(F.lit("s1").alias("student_id"))
    row = entity_limit_checks({"student_classes": df}, school.LIMITS)[0].first()
    assert row.passed is passed and row.severity == ("INFO" if passed else "WARNING")
    if not passed:
        assert row.affected_records == ["s1"] and row.details["max_enrollments"] == "9"


@pytest.mark.parametrize("n, passed", [(20, True), (21, False)])
def test_capacity(spark, n, passed):
    tables = {
        "classes": spark.createDataFrame([("c1", 20), ("c2", None)], "class_id string, max_capacity bigint"),
        "student_classes": spark.range(n).select(F.lit("c1").alias("class_id")),
    }
    row = capacity_checks(spark, tables, school.CAPACITIES)[0].first()
    assert row.passed is passed
    if not passed:
        assert row.details["max_excess"] == "1" and json.loads(row.details["over_capacity_classes"])[0]["class_id"] == "c1"
    assert capacity_violations(tables["classes"], "class_id", "max_capacity", tables["student_classes"], "class_id").count() == (not passed)


def test_capacity_preconditions(spark):
    rule = CapacityRule("classes", "class_id", "max_capacity", "student_classes", "class_id")
    row = capacity_checks(spark, {}, [rule])[0].first()
    assert (row.check_name, row.severity) == ("Capacity Validation Setup", "WARNING")
    tables = {"classes": spark.createDataFrame([("c",)], "class_id string"), "student_classes": spark.createDataFrame([("c",)], "class_id string")}
    assert capacity_checks(spark, tables, [rule])[0].first().check_name == "Capacity Validation Columns"


def test_integrity(spark):
    tables = {
        "classes": spark.createDataFrame([("c1", "t1", "k1"), ("c2", "t9", "k2"), ("c3", None, "k3")], "class_id string, teacher_id string, classes_id string"),
        "teachers": spark.createDataFrame([("t1",), ("t2",)], "teacher_id string"),
        "numbers": spark.createDataFrame([(1,)], "teacher_id bigint"),
        "bare": spark.createDataFrame([(1,)], "x bigint"),
    }
    references = [
        Reference("classes", "teacher_id", "teachers"), Reference("classes", "teacher_id", "nowhere"),
        Reference("classes", "room_id", "teachers"), Reference("classes", "teacher_id", "bare"),
        Reference("classes", "teacher_id", "numbers"),
    ]
    rows = {r.check_name: r for r in union_checks(spark, integrity_checks(spark, tables, references, {})).collect()}
    found = rows["Referential Integrity: classes.teacher_id → teachers.teacher_id"]
    assert (found.passed, found.severity, found.affected_count, found.affected_records) == (False, "ERROR", 1, ["k2"])
    assert found.details["orphaned_values"] == '["t9"]' and found.details["total_primary_keys"] == "2"
    assert rows["Table Existence for classes → nowhere"].severity == "ERROR"
    assert rows["Foreign Key Column room_id"].severity == "ERROR"
    assert rows["Primary Key Detection for bare"].severity == "WARNING"
    assert rows["Referential Integrity: classes.teacher_id → numbers.teacher_id"].affected_count == 2
    assert rows["Key Types: classes.teacher_id"].severity == "WARNING"


def test_duplicate_keys_count_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k_id string")
    row = uniqueness_check("t", df, "k_id").first()
    assert (row.passed, row.affected_count) == (False, 4)
    assert row.details == {"duplicate_count": "4", "unique_duplicates": "2"}
    assert uniqueness_check("t", df.where("k_id = 'b'"), "k_id").first().passed


@pytest.mark.parametrize("age, year, bad", [(13, 10, 1), (20, 11, 1), (13, 9, 0), (20, 12, 0), (None, 12, 0)])
def test_age_grade(spark, age, year, bad):
    df = spark.createDataFrame([(age, year)], "age int, year int")
    row = field_rule_checks({"students": df}, school.FIELD_RULES)[0].first()
    assert (row.passed, row.affected_count) == (not bad, bad)


@pytest.mark.parametrize(
    "values, note",
    [
        ([7], ""), ([7, None], ""), ([1] * 10 + [2] * 10, None), ([1] * 10 + [2] * 11, " (low variation)"),
        ([1, 2, 3] * 10, None), ([None, None], None), ([0.0, -0.0], ""),
    ],
)
def test_variation(spark, values, note):
    kind = "double" if any(isinstance(v, float) for v in values) else "bigint"
    df = spark.createDataFrame([(v, "x", i) for i, v in enumerate(values)], f"n {kind}, s string, k_id bigint")
    rows = distribution_checks("t", df).collect()
    assert [r.check_name for r in rows] == ([] if note is None else [f"Data Variation: t.n{note}"])
    if note == " (low variation)":
        assert json.loads(rows[0].details["most_common_values"]) == {"2": 11, "1": 10}


@pytest.mark.parametrize("total, errors, warnings, score", [(10, 1, 2, 85.0), (0, 0, 0, 100.0), (1, 1, 0, 0.0), (4, 0, 4, 75.0)])
def test_scores(spark, total, errors, warnings, score):
    df = spark.createDataFrame([(total, errors, warnings)], "t bigint, e bigint, w bigint")
    assert df.select(quality_score(F.col("t"), F.col("e"), F.col("w"))).first()[0] == score


def test_other_scores(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c).first()[0]
    assert pick(arrival_score(F.lit(1), F.lit(2), F.lit(3), F.lit(0))) == 80.0
    assert pick(arrival_score(F.lit(0), F.lit(30), F.lit(0), F.lit(0))) == 0.0
    assert pick(schema_complexity(F.lit(4), F.lit(34), F.lit(2))) == 100.0
    assert pick(efficiency(F.lit(2.0), F.lit(10.0), F.lit(90.0))) == pytest.approx(39.6)
    assert pick(overall_score(F.lit(90.0), F.lit(True), F.lit(40.0))) == pytest.approx(87.0)
    assert [pick(recommendation(F.lit(s))) for s in (90.5, 90.0, 70.5, 70.0)] == ["Excellent", "Good", "Good", "Poor"]


def test_suite_summary_reports_and_gate(spark):
    tables = {
        "students": spark.createDataFrame([("s1", 15, 10), ("s2", 16, 11)], "student_id string, age int, year int"),
        "classes": spark.createDataFrame([("c1", 1)], "class_id string, max_capacity bigint"),
        "student_classes": spark.createDataFrame([("e1", "s1", "c1"), ("e2", "s9", "c1")], "student_class_id string, student_id string, class_id string"),
    }
    extra = lambda tables: literal_checks(spark, [(4, "Mine", "always", "WARNING")])
    rules = Rules([Reference("student_classes", "student_id", "students")], {"students": "student_id"}, school.CAPACITIES, school.LIMITS, school.FIELD_RULES, [extra])
    result = validate(spark, tables, rules)
    s = result.summary.first()
    assert (s.errors, s.overall_status, s.total_records, s.tables_validated) == (2, "FAIL", 5, 3)
    assert gate(result.summary) == 1
    report = json.loads(quality_report_json(result.checks, result.summary, "now"))
    assert report["summary"]["total_checks"] == len(report["detailed_results"]) == s.total_checks
    assert [r["check_name"] for r in report["detailed_results"]][0].startswith("Referential Integrity")
    text = quality_report_markdown(result.checks, result.summary, "now")
    assert "### Failed" in text and "**Mine**: always" in text


def test_unreadable_table_stops_validation(spark, tmp_path):
    assert read_tables(spark, str(tmp_path), ["missing"]) is None
    result = validate(spark, None, Rules())
    assert [r.check_name for r in result.checks.collect()] == ["Table Loading"] and gate(result.summary) == 1


def test_key_names_with_blanks(spark):
    df = spark.createDataFrame([("a",), ("a",)], "`my id` string")
    assert uniqueness_check("t", df, "my id").first().affected_count == 2
