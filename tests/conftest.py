import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sediment.session import session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        master="local[8]",
        options={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            # Many small day folders: keep the cores busy and list in few tasks.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def namespace(spark, tmp_path):
    import uuid

    from sediment.sinks.tables import create_namespace

    name = f"t_{uuid.uuid4().hex}"
    create_namespace(spark, name, str(tmp_path / "db"))
    return name


def rows(df):
    """Rows as sorted tuples, NULLs first."""
    return sorted(
        (tuple(row) for row in df.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t)
    )


def plan(df, mode="formatted"):
    """The physical plan's text."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
