import datetime as dt
from decimal import Decimal as D

from conftest import make_fleet
from convoy.operators.audit import Rule, apply_defaults, audit
from convoy.plans import quality as Q

T = dt.datetime


def test_validation_checks_find_bad_rows(spark):
    f = make_fleet(
        spark,
        vehicles=[(1, "V1", "Van", D("50.00"), "diesel", None, "active")],
        trips=[(1, 1, 1, 1, T(2001, 1, 1, 8), T(2001, 1, 1, 7), D("1"), D("60.00"), "completed"),
               (2, 9, 1, 1, T(2001, 1, 1, 8), None, D("1"), D("1.00"), "in_progress"),
               (3, None, 1, 1, T(2001, 1, 1, 8), None, D("1"), D("1.00"), "in_progress")],
        deliveries=[(1, 1, "", "c", "a", D("1"), None, None, "pending", False),
                    (2, 7, None, "c", "a", D("1"), None, None, "pending", False),
                    (3, 1, "FL3", "c", "a", D("1"), None, None, "pending", False)])
    got = {r.check_name: r.bad_rows for r in Q.validation_checks(f).collect()}
    assert got == {"trips_without_vehicle": 2, "deliveries_without_trip": 1,
                   "trips_arrival_before_departure": 1, "trips_over_capacity": 1,
                   "deliveries_without_tracking_number": 2}
    assert not any(r.all_valid for r in Q.validation_checks(f).collect())


def test_rule_audit_and_defaults(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", "x"), (None, "c", "y"), (2, None, "z")],
                               "id int, code string, status string")
    parent = spark.createDataFrame([(1,)], "id int")
    rules = [Rule("primary_key", "t", "id"), Rule("unique", "t", "code"),
             Rule("not_null", "t", "code"), Rule("default", "t", "status", default="active"),
             Rule("foreign_key", "t", "id", "p", "id")]
    got = {r.rule: r.violations for r in audit({"t": df, "p": parent}, rules).collect()}
    assert got == {"primary_key": 3, "unique": 0, "not_null": 1, "default": 1, "foreign_key": 1}
    filled = apply_defaults(df, "t", rules)
    assert filled.where("status is null").count() == 0


def test_every_rule_has_a_row_on_empty_tables(spark):
    df = spark.createDataFrame([], "id int, code string")
    rules = [Rule("primary_key", "t", "id"), Rule("unique", "t", "code"), Rule("not_null", "t", "code"),
             Rule("max_length", "t", "code", length=3), Rule("foreign_key", "t", "id", "t", "id")]
    got = {r.rule: (r.violations, r.ok) for r in audit({"t": df}, rules).collect()}
    assert got == dict.fromkeys([r.rule for r in rules], (0, True))
    rows = spark.createDataFrame([(1, "four"), (1, None), (None, "é23")], "id int, code string")
    assert {r.rule: r.violations for r in audit({"t": rows}, rules).collect()} == {
        "primary_key": 3, "unique": 0, "not_null": 1, "max_length": 1, "foreign_key": 0}
