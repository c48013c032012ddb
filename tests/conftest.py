import pytest

from cratedig import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
