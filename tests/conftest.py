import pytest

from shoplens.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "shoplens-tests", master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__ui__enabled="false",
        spark__shoplens__statePartitions="2",
        spark__sql__streaming__noDataMicroBatches__enabled="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
