import pytest

from estatelens import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session.build("tests", **{
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
