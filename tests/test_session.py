from lakecart.session import SESSION_DEFAULTS, configure, run_dir, session_key, shared_dir


def test_shared_dir_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    d = shared_dir(spark)
    if configured:
        assert d == configured.rstrip("/")
    assert shared_dir(spark) == d                                   # stable within a session


def test_run_dirs_are_fresh(spark):
    a, b = run_dir(spark, "x"), run_dir(spark, "x")
    assert a != b and a.startswith(shared_dir(spark)) and "/lakecart-runs/x-" in a


def test_session_settings(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert SESSION_DEFAULTS["spark.sql.adaptive.enabled"] == "true"
    assert session_key(spark) == session_key(spark)
