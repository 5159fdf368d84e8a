"""Checkpoint folder contract and package shipping."""
from quarry.session import ensure_checkpoint_dir, scratch_path, ship_package


def test_checkpoint_dir_comes_from_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    got = ensure_checkpoint_dir(spark)
    assert configured and got.startswith("file:" + configured) or got.startswith(configured)
    assert scratch_path(spark, "t").startswith(got)
    # reliable checkpoints land there
    df = spark.range(10).checkpoint(eager=True)
    assert df.count() == 10


def test_ship_package_idempotent(spark):
    ship_package(spark)
    ship_package(spark)
    # a worker can import the package
    got = spark.range(2).rdd.map(lambda _: __import__("quarry.functions.porter").__name__).collect()
    assert got == ["quarry", "quarry"]
