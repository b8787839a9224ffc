from martwright.sources import write_mart
from martwright.streaming import compact, current_state, log_adjustments, trim

DDL = "id int, amount int, version int"


def drain(spark, folder):
    updates = spark.readStream.schema(DDL).parquet(f"{folder}/in")
    query = log_adjustments(updates, f"{folder}/log", f"{folder}/state", "id", "version", tie="amount")
    query.awaitTermination(120)
    assert query.exception() is None


def test_adjustment_stream(spark, table, tmp_path):
    folder = str(tmp_path)
    base = table(DDL, [(1, 10, 1), (2, 20, 1), (3, 30, 5)])
    write_mart(table(DDL, [(1, 11, 2), (1, 12, 3), (3, 31, 4)]), f"{folder}/in", mode="append")
    drain(spark, folder)
    write_mart(table(DDL, [(2, 21, 2), (2, 25, 2), (4, 40, 1)]), f"{folder}/in", mode="append")
    drain(spark, folder)
    log = spark.read.parquet(f"{folder}/log")
    assert log.count() == 4 and {r.batch_id for r in log.select("batch_id").distinct().collect()} == {0, 1}
    want = [(1, 12, 3), (2, 25, 2), (3, 30, 5), (4, 40, 1)]
    assert sorted(map(tuple, current_state(base, log, "id", "version").collect())) == want
    assert compact(base, log, f"{folder}/base_2", "id", "version") == 1
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/base_2").collect())) == want
    trim(log, f"{folder}/log", 0)
    left = spark.read.parquet(f"{folder}/log")
    assert {r.batch_id for r in left.select("batch_id").distinct().collect()} == {1}
