import pytest

from coursemill import session


@pytest.fixture(scope="session")
def spark():
    spark = session.start("tests", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def folder(spark):
    return session.work_folder(spark, "test")


def rows(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
