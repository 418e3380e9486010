import pytest

from strata.operators.domains import (ANYTHING, above, at_least, between, broken_references, domain_report, key_of, like,
                                      one_of, quarantine, with_members)


@pytest.fixture(scope="module")
def tables(spark):
    return {"item": spark.createDataFrame([(1, 5.0, "a", "p1"), (2, 0.0, "b", "p9"), (3, None, None, None), (0, -1.0, "z", "p1")],
                                          "n int, price double, kind string, product string"),
            "product": spark.createDataFrame([("p1",), ("p1",), (None,), ("p2",)], "id string")}


DOMAINS = {"item": {"n": between(1, 3), "price": above(0).needed(), "kind": one_of("a", "b"),
                    "product": key_of("product", "id").needed()},
           "product": {"id": like("^p[0-9]$")}}


def test_violations_are_counted(tables):
    got = {(r["table"], r["column"]): (r["rows"], r["empty"], r["violations"]) for r in domain_report(tables, DOMAINS).collect()}
    assert got == {("item", "n"): (4, 0, 1), ("item", "price"): (4, 1, 3), ("item", "kind"): (4, 1, 1),
                   ("item", "product"): (4, 1, 2), ("product", "id"): (4, 1, 0)}


def test_rows_go_to_quarantine_once(tables):
    rows = {r.n: r["_violations"] for r in quarantine(tables["item"], DOMAINS["item"], tables).collect()}
    assert rows == {2: ["price", "product"], 3: ["price", "product"], 0: ["kind", "n", "price"]}
    assert quarantine(tables["item"], {"n": ANYTHING}, tables).count() == 0


def test_one_pass_a_table(tables):
    own = {"item": {c: d for c, d in DOMAINS["item"].items() if d.reference is None}}
    plan = domain_report(tables, own)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") <= 1


def test_texts_and_members():
    assert between(1, 5).text == "1 to 5" and above(0).needed().text == "required, above 0" and at_least(1).text == "at least 1"
    more = with_members(DOMAINS, [("item", "kind")], ["x"])
    assert more["item"]["kind"].text == "one of x" and DOMAINS["item"]["kind"].members == ("a", "b")


def test_empty_tables(spark, tables):
    empty = {t: df.limit(0) for t, df in tables.items()}
    assert {(r["rows"], r["violations"]) for r in domain_report(empty, DOMAINS).collect()} == {(0, 0)}


def test_a_broken_domain_is_found_in_gold(spark, small_dir):
    from strata.plans.medallion import Medallion
    from strata.plans.specs import gold_domains
    m = Medallion(spark, small_dir)
    report = domain_report(m.gold, gold_domains(m.region_map)).where("violations > 0").collect()
    assert {("fact_order_items", "item_price"), ("fact_order_items", "lead_time_days")} & {(r["table"], r["column"]) for r in report}


def test_broken_references_stand_for_the_parents(tables, monkeypatch):
    from strata.operators import domains as D
    broken = broken_references(tables, DOMAINS)
    assert [tuple(r) for r in broken.collect()] == [("item", "product", "p9", 1)]
    assert sorted(domain_report(tables, DOMAINS, broken).collect()) == sorted(domain_report(tables, DOMAINS).collect())
    for most in (D.BROADCAST_KEYS, 0):
        monkeypatch.setattr(D, "BROADCAST_KEYS", most)
        rows = {r.n: r["_violations"] for r in quarantine(tables["item"], DOMAINS["item"], {}, broken=broken, table="item").collect()}
        assert rows == {2: ["price", "product"], 3: ["price", "product"], 0: ["kind", "n", "price"]}


def test_quarantine_query_reads_written_tables(spark, small_dir, monkeypatch):
    """The checked columns are written once, with the shuffles of one table gone
    before the next; the rows then meet the lacking keys without a shuffle."""
    from strata import queries as Q
    from strata.plans import medallion

    monkeypatch.setattr(medallion, "buckets_for", lambda bronze: 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = Q.domain_quarantine(spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan
    assert all("/strata/gold-" in f or "/strata/broken-references-" in f for f in df.inputFiles())
    assert spark.conf.get("spark.sql.shuffle.partitions") == before

    m = medallion.Medallion(spark, small_dir)
    plain = []
    for t, of in Q.gold_domains(m.region_map).items():
        for r in quarantine(m.gold[t], of, m.gold).groupBy("_violations").count().collect():
            plain.append((t, ",".join(r["_violations"]), r["count"]))
    assert sorted(tuple(r) for r in df.collect()) == sorted(plain) and plain


def test_quarantine_names_only_broken_rows(tables):
    """The rows are chosen by the tests, not by the names made for every row."""
    df = quarantine(tables["item"], DOMAINS["item"], tables)
    filters = [x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x]
    assert filters and not any("array(" in x for x in filters)
