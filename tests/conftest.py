import pytest

from crewcast.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__sql__codegen__wholeStage="false",  # compiling costs more than these tiny inputs
        spark__sql__maxMetadataStringLength="100000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def values():
    """Rows of a frame as a sorted list of plain tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
