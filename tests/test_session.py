from sediment.session import apply_defaults, session


def test_settings_given_at_submit_survive(spark):
    name = "spark.sql.adaptive.skewJoin.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        apply_defaults(spark)
        assert spark.conf.get(name) == "false"
        assert session().conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)


def test_unset_settings_are_filled_in(spark):
    spark.conf.unset("spark.sql.session.timeZone")
    apply_defaults(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
