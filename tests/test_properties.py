"""Properties that tie reports and operators together."""

from pyspark.sql import functions as F

from dialtone.catalog import params as P
from dialtone.catalog.compare import normalise
from dialtone.catalog.queries import queries
from dialtone.functions.timefx import local_date
from dialtone.sources.fixtures import tables
from conftest import SMOKE_DIR


def test_abandoned_plus_dropped_is_queued_unanswered(spark):
    rows = queries()["abandoned_vs_dropped"](spark, SMOKE_DIR).collect()
    assert rows and all(r.abandoned + r.dropped == r.queued_unanswered for r in rows)


def test_unit_rows_add_up_to_all_units(spark):
    perf = queries()["call_performance"](spark, SMOKE_DIR)
    by_unit = perf.groupBy("date", "tenant", "company").agg(
        F.sum("total_inbound").alias("a"), F.sum("total_queued").alias("b"))
    legs = tables(spark, SMOKE_DIR).cdr.filter(
        (F.col("created_time") >= F.lit(P.FROM_TS).cast("timestamp_ntz"))
        & (F.col("created_time") <= F.lit(P.TO_TS).cast("timestamp_ntz")))
    direct = legs.groupBy(local_date("created_time", P.TZ).alias("date"),
                          F.col("tenant_id").alias("tenant"), F.col("company_id").alias("company")) \
        .agg(F.count_if(F.col("direction") == "inbound").alias("a"),
             F.count_if(F.col("is_queued")).alias("b"))
    assert sorted(map(tuple, by_unit.collect())) == sorted(map(tuple, direct.collect()))


def test_per_unit_login_totals_add_up_to_all_units(spark):
    all_units = queries()["agent_productivity_all"](spark, SMOKE_DIR)
    per_unit = queries()["agent_productivity_bu"](spark, SMOKE_DIR)
    keys = ["summary_date", "tenant", "company", "agent"]
    summed = per_unit.groupBy(*keys).agg(F.sum("login_total_count").alias("n"),
                                         F.sum("inbound_total_count").alias("i"))
    base = all_units.select(*keys, F.col("login_total_count").alias("n"),
                            F.col("inbound_total_count").alias("i"))
    assert sorted(map(tuple, summed.collect())) == sorted(map(tuple, base.collect()))


def _index_rows(n, seed):
    import random
    rnd = random.Random(seed)
    return [(f"d{rnd.randrange(5)}" if rnd.random() < 0.5 else "hot", rnd.choice([None, 1, 2, 3]), rnd.choice([None, "a", "b"]), i)
            for i in range(n)]


def test_ordered_index_equals_global_row_number(spark):
    from pyspark.sql import Window
    from dialtone.operators.index import ordered_index
    order = ["day", "t", "u", "k"]
    for n, partitions in ((0, None), (1, 7), (300, None), (300, 1), (3000, 40)):
        df = spark.createDataFrame(_index_rows(n, n), "day string, t int, u string, k int")
        got = ordered_index(df, order, "id", partitions).select("k", "id").collect()
        assert [r.id for r in got] == list(range(1, n + 1))  # in order, without orderBy
        expected = df.select("k", F.row_number().over(
            Window.orderBy(*[F.col(x).asc_nulls_last() for x in order])).cast("int").alias("id"))
        assert sorted(map(tuple, got)) == sorted(map(tuple, expected.collect()))


def test_ordered_index_refuses_to_number_wrongly(spark):
    """Without a shared exchange the two readers may see different partitions: then it fails, or is right."""
    from dialtone.operators.index import ordered_index
    df = spark.createDataFrame(_index_rows(3000, 1), "day string, t int, u string, k int")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        ids = [r.id for r in ordered_index(df, ["day", "t", "u", "k"], "id", 40).collect()]
        assert ids == list(range(1, 3001))
    except Exception as e:  # noqa: BLE001
        assert "range exchange was not shared" in str(e)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_ordered_index_runs_its_input_once(spark):
    from dialtone.operators.index import ordered_index
    from plan_nodes import count, executed, scans
    legs = spark.read.parquet(f"{SMOKE_DIR}/events.parquet").groupBy("user_id").agg(F.count("*").alias("n"))
    found = executed(ordered_index(legs, ["n", "user_id"]))
    assert len(scans(found)) == 1 and count(found, "ReusedExchange") == 1
    assert not count(found, "Window") and not count(found, "Join")


def test_bitmaps_count_like_count_distinct(spark):
    from dialtone.operators import bitmaps as bm
    t = tables(spark, SMOKE_DIR)
    first = bm.agent_roles(t.cdr, P.FROM_TS, P.MID_FROM_TS, P.TZ)
    numbers = bm.agent_numbers(first)
    whole = bm.agent_roles(t.cdr, P.FROM_TS, P.TO_TS, P.TZ)
    more = bm.agent_numbers(whole, numbers)
    kept = {r.agent: r.number for r in numbers.collect()}
    all_numbers = {r.agent: r.number for r in more.collect()}
    assert all(all_numbers[a] == n for a, n in kept.items())
    assert sorted(all_numbers.values()) == list(range(1, len(all_numbers) + 1))
    # far-off numbers fall into several buckets of 32,768
    spread = more.withColumn("number", F.col("number") * 20_000)
    days = bm.agent_bitmaps(whole, spread)
    for keys in (["date", "tenant"], ["bu"], ["tenant", "company", "bu"]):
        got = bm.count_agents(days, keys).select(*keys, "in_agents", "out_agents").collect()
        want = whole.groupBy(*keys).agg(*[F.count_distinct(F.when(F.col("way") == w, F.col("agent"))).alias(f"{w}_agents")
                                          for w in ("in", "out")]).collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert days.groupBy().agg(F.max(F.length("agents"))).first()[0] == 4096
