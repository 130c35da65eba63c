from touchline import session


def test_scratch_belongs_to_the_application_and_can_be_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_scratch_base", lambda _: str(tmp_path))
    path = session.scratch_path(spark, "one")
    spark.range(3).write.parquet(path)
    (tmp_path / "of-others").mkdir()
    assert spark.sparkContext.applicationId in path and session.scratch_path(spark, "one") != path
    session.clear_scratch(spark)
    assert [p.name for p in tmp_path.iterdir()] == ["of-others"]
    session.clear_scratch(spark)  # nothing is left to delete


def test_shuffles_can_go_early(spark):
    session.free_shuffles(spark)
    counted = spark.range(100).groupBy("id").count()
    for _ in range(2):  # what was freed is made again
        assert counted.count() == 100
