"""Renewing a subset holds its keys in a task, never the sorted rows of the table."""

from mainstay.sources import standing as S


def test_rows_of_the_table_are_not_sorted(spark, tmp_path, monkeypatch):
    plans, path = [], f"{tmp_path}/out"
    write = S.written

    def spy(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(S, "written", spy)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(2000).selectExpr("id", "id % 100 AS compkey", "1.0D AS score")
        S.publish(rows, path, "id < 100", buckets=4)
        S.renew(rows.selectExpr("id", "compkey", "2.0D AS score"), spark.range(3).toDF("compkey"), path, "id < 100")
        found = S.read_standing(spark, path)
        assert found.count() == 2000 and found.filter("score = 2").count() == 60
        assert found.filter("(compkey < 3) <> (score = 2)").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert any("ShuffledHashJoin" in p for p in plans) and not any("SortMergeJoin" in p for p in plans)
