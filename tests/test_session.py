from ferry import session


def test_scratch_root_comes_from_the_session(spark):
    root = session.scratch_root(spark)
    assert root == spark.sparkContext.getCheckpointDir()
    a, b = session.new_run_dir(spark, "x"), session.new_run_dir(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/ferry/x-")


def test_configure_is_idempotent_and_ships_once(spark):
    session.configure(spark)
    session.configure(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
