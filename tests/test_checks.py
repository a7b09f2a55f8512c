import pytest

from dialtone.operators.checks import (apply_cascade, apply_set_null, duplicate_keys, not_null_violations,
                                       null_counts, orphans, primary_key_faults, propagate)


def test_duplicates_ignore_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), ("c", 2)], "k string, v int")
    assert [tuple(r) for r in duplicate_keys(df, ["k", "v"]).collect()] == [("a", 1, 2)]


def test_orphans_cascade_set_null(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None), (13, 2)], "cid int, pid int")
    assert [r.cid for r in orphans(child, parent, "pid", "id").collect()] == [11]
    deleted = spark.createDataFrame([(2,), (2,)], "id int")
    assert sorted(r.cid for r in apply_cascade(child, deleted, "pid", "id").collect()) == [10, 11, 12]
    nulled = {r.cid: r.pid for r in apply_set_null(child, deleted, "pid", "id").collect()}
    assert nulled == {10: 1, 11: 3, 12: None, 13: None}


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int")
    assert not_null_violations(df, ["a", "b"]).count() == 2
    r = null_counts(df, ["a", "b"]).collect()[0]
    assert (r.rows, r.nulls_a, r.nulls_b) == (3, 1, 1)


def test_hangup_cause_dimension(spark):
    from dialtone.sources.dims import hangup_causes
    df = hangup_causes(spark)
    rows = {r.itut_q850_code: r for r in df.collect()}
    assert len(rows) == 65 == df.count()
    assert rows[17].sip_equiv == 486 and rows[17].enumeration == "USER_BUSY"
    assert rows[0].sip_equiv is None and rows[609].enumeration == "GATEWAY_DOWN"


def test_primary_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id int")
    assert tuple(primary_key_faults(df, "id").first()) == (5, 2, 2)
    assert tuple(primary_key_faults(df.where("false"), "id").first()) == (0, 0, 0)


EDGES = (("company", "owner", "person", "id", "set null"), ("unit", "company_id", "company", "id", "cascade"),
         ("desk", "unit_id", "unit", "id", "cascade"), ("phone", "desk_id", "desk", "id", "set null"))
KEYS = {"person": "id", "company": "id", "unit": "id", "desk": "id", "phone": "id"}


def _graph(spark):
    make = lambda rows, cols: spark.createDataFrame(rows, cols)
    return {"phone": make([(1, 10), (2, 11), (3, 12), (4, None)], "id int, desk_id int"),
            "desk": make([(10, 20), (11, 21), (12, 22), (13, None)], "id int, unit_id int"),
            "unit": make([(20, 30), (21, 31), (22, 30)], "id int, company_id int"),
            "company": make([(30, 40), (31, 41), (32, 40)], "id int, owner int"),
            "person": make([(40,), (41,)], "id int")}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_deletions_and_changes_go_on_to_grandchildren(spark):
    one = lambda v, n="id": spark.createDataFrame([(v,), (v,)], f"{n} int")
    done = propagate(_graph(spark), EDGES, KEYS, deleted={"company": one(30), "person": one(41), "desk": one(99)},
                     changed={"unit": spark.createDataFrame([(21, 210), (77, 1)], "old int, new int"),
                              "person": spark.createDataFrame([(40, 400)], "old int, new int")})
    assert _rows(done["person"]) == [(400,)]
    assert _rows(done["company"]) == [(31, None), (32, 400)]
    assert _rows(done["unit"]) == [(210, 31)]            # 20 and 22 went with company 30
    assert _rows(done["desk"]) == [(11, 210), (13, None)]  # 10 and 12 went with their units
    assert _rows(done["phone"]) == [(1, None), (2, 11), (3, None), (4, None)]


def test_nothing_changes_without_deletions(spark):
    before = _graph(spark)
    after = propagate(before, EDGES, KEYS)
    assert all(_rows(after[n]) == _rows(before[n]) for n in before)


def test_cycles_are_refused(spark):
    tables = {n: _graph(spark)[n] for n in ("unit", "company")}
    with pytest.raises(ValueError, match="cycle"):
        propagate(tables, [("unit", "company_id", "company", "id", "cascade"), ("company", "owner", "unit", "id", "cascade")], KEYS)


def test_children_are_joined_to_changes_only(spark):
    """Orphans stay as they are: a missing parent is no deletion."""
    done = propagate({"unit": spark.createDataFrame([(1, 5), (2, None)], "id int, company_id int"),
                      "company": spark.createDataFrame([(6, 1)], "id int, owner int")}, EDGES, KEYS)
    assert _rows(done["unit"]) == [(1, 5), (2, None)]
