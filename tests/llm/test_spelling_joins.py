"""No side of op11's joins passes through the driver, however small the files of the words are."""

from loomspark.llm import spelling


def test_no_join_is_broadcast(spark, monkeypatch):
    plans, write = [], spelling.written
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def written(df, name, *more):
        plans.append((name, plan(df)))
        return write(df, name, *more)

    monkeypatch.setattr(spelling, "written", written)
    words = spark.createDataFrame([(f"word{c}{'x' * k}", 3 * 4**k) for c in "abcdef" for k in range(3)], "word string, n bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
        found = spelling.spelling_variants(words)
        plans.append(("result", plan(found)))
        assert found.count() == 18 and found.where("root = 'wordaxx'").count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {"forms", "roots", "result"} <= {n for n, _ in plans}
    assert not [(n, p) for n, p in plans if "Broadcast" in p]
