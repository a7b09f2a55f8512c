import glob
import os

from pyspark.sql import functions as F

from dialtone import schemas
from dialtone.catalog.queries import queries
from dialtone.sources.sink import read_agent_summary, write_agent_summary
from dialtone.sources.tables import read_evolving
from conftest import SMOKE_DIR


def test_schema_evolution_reads_missing_column_as_null(spark, tmp_path):
    old = tmp_path / "cdr" / "v1"
    new = tmp_path / "cdr" / "v2"
    base = spark.createDataFrame([("a", 1)], "uuid string, tenant_id int")
    base.write.parquet(str(old))
    base.withColumn("queue_priority", F.lit(5)).withColumn("uuid", F.lit("b")) \
        .write.parquet(str(new))
    from pyspark.sql import types as T
    schema = T.StructType([schemas.CDR["uuid"], schemas.CDR["tenant_id"],
                           T.StructField("queue_priority", T.IntegerType())])
    got = {r.uuid: r.queue_priority for r in read_evolving(spark, [str(old), str(new)], schema).collect()}
    assert got == {"a": None, "b": 5}


def _days(report):
    return sorted(r.summary_date for r in report.select("summary_date").distinct().collect())


def test_summary_sink_replaces_its_range_only(spark, tmp_path):
    path = str(tmp_path / "agent_summary")
    report = queries()["agent_productivity"](spark, SMOKE_DIR)
    dates = _days(report)
    write_agent_summary(report, path, dates[0], dates[-1], bu="ALL")
    table = read_agent_summary(spark, path)
    assert table.schema == schemas.AGENT_SUMMARY and len(table.columns) == 86
    n_all = report.count()
    assert table.count() == n_all
    # a rerun of one day leaves the others, and the same rows
    write_agent_summary(report.filter(F.col("summary_date") == dates[0]), path, dates[0], dates[0], bu="ALL")
    assert read_agent_summary(spark, path).count() == n_all
    # a day of the range that has no rows any more becomes empty; days beyond the range stay
    write_agent_summary(report.filter(F.col("summary_date") != dates[1]), path, dates[0], dates[1], bu="ALL")
    again = read_agent_summary(spark, path)
    assert _days(again) == [d for d in dates if d != dates[1]]
    assert _days(read_agent_summary(spark, path, dates[2], dates[3])) == dates[2:4]


def test_summary_sink_runs_the_report_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(rows):
        runs.add(1)
        return rows

    report = queries()["agent_productivity"](spark, SMOKE_DIR)
    rows = spark.createDataFrame(report.collect()[:4], report.schema).coalesce(1)
    once = rows.mapInArrow(lambda batches: counted(batches), rows.schema)
    first, last = min(_days(rows)), max(_days(rows))
    written = write_agent_summary(once, str(tmp_path / "once"), first, last, bu="ALL")
    assert written == _days(rows) and runs.value == 1


def test_large_date_has_several_writers(spark, tmp_path):
    path = str(tmp_path / "large")
    report = queries()["agent_productivity"](spark, SMOKE_DIR)
    day = _days(report)[0]
    rows = (report.filter(F.col("summary_date") == day).limit(1)
            .crossJoin(spark.range(4000)).withColumn("agent", F.col("id").cast("int")).drop("id"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_agent_summary(rows, path, day, day, bu="ALL")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = [f for f in glob.glob(os.path.join(path, "data", f"summary_date={day}", "write=*", "*.parquet"))]
    assert len(files) > 1 and read_agent_summary(spark, path).count() == 4000
