"""A run's cuts are written with code that the JVM compiles; no other table is, and the session is left as it was."""

from mainstay import scratch, session

KEY = "spark.sql.codegen.hugeMethodLimit"


def test_only_cuts_change_the_setting_and_put_it_back(spark, monkeypatch):
    seen, write = [], scratch.written
    monkeypatch.setattr(session, "written", lambda df, label: seen.append(spark.conf.get(KEY)) or write(df, label))
    before = spark.conf.get(KEY)
    assert session.cut_lineage(spark.range(3)).count() == 3
    assert seen == ["8000"] and spark.conf.get(KEY) == before != "8000"
    spark.conf.set(KEY, "9000")
    session.cut_lineage(spark.range(3))
    assert spark.conf.get(KEY) == "9000"
    spark.conf.unset(KEY)
