"""Table keys are laid out by bounded tasks, however few files the classes are in; no query is long."""

from voltweave.llm import components, minhash


def test_keys_are_dealt_out_before_they_are_counted(spark, monkeypatch):
    monkeypatch.setattr(minhash, "KEYED", 4)
    classes = spark.range(10).coalesce(1).selectExpr("id", f"transform(sequence(1, {minhash.SIGNATURE}), i -> cast(i * (id + 1) as int)) as sig")
    keyed = minhash._keyed(classes)
    assert ", 3), REPARTITION_BY_NUM" in keyed._jdf.queryExecution().executedPlan().toString()
    assert keyed.count() == 10 * minhash.COLLECTION**2 and keyed.select("id").distinct().count() == 10


def test_near_duplicates_are_written_in_steps_of_few_joins(spark, monkeypatch):
    """The driver plans a query anew after each of its shuffles: the long ones took the most of its memory."""
    joins, staged = {}, minhash.staged

    def spy(df, name, **kw):
        joins[name] = max(joins.get(name, 0), df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return staged(df, name, **kw)

    monkeypatch.setattr(minhash, "staged", spy)
    monkeypatch.setattr(components, "staged", spy)
    words = [" ".join(f"w{(i * 7 + j) % 400}" for j in range(60)) for i in range(6)]
    texts = words + [t + " more" for t in words] + words[:2]
    out = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    joins["out"] = out._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    assert max(joins.values()) <= 5, joins
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == {i: i % 12 % 6 for i in range(14)}
