import pytest

from strata.operators.integrity import (IntegrityError, check_orphans, check_unique, enforce,
                                        integrity_report, row_conservation)


def test_unique_and_orphans(spark):
    child = spark.createDataFrame([("o1", 1), ("o1", 1), ("o2", 1), (None, 2), ("o9", 1)], "k string, i int")
    parent = spark.createDataFrame([("o1",), ("o2",), ("o2",)], "k string")
    rep = integrity_report([check_unique(child, ["k", "i"], "child"),
                            check_orphans(child, parent, "k", "child", "parent")])
    got = {r.check: (r.violations, r.severity) for r in rep.collect()}
    assert got["unique k,i"] == (1, "error")
    assert got["rows without match in parent (k)"] == (2, "warn")   # NULL key and o9
    with pytest.raises(IntegrityError):
        enforce(rep)
    enforce(check_orphans(child, parent, "k", "child", "parent"))     # warnings never fail


def test_row_conservation_detects_cancelling_errors(spark):
    before = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, i int")
    after = spark.createDataFrame([("a", 1), ("a", 1), (None, 1)], "k string, i int")   # b lost, a doubled
    r = row_conservation(before, after, ["k", "i"]).first()
    assert (r.rows_before, r.rows_after, r.missing, r.extra) == (3, 3, 1, 1)
