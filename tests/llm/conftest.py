import os
import tempfile

import pytest


@pytest.fixture(scope="session")
def spark():
    """A small local session; workers import the package from the checkout."""
    from pyspark.sql import SparkSession

    from sparecast.llm.queries import importable

    s = (SparkSession.builder.master("local[4]").appName("llm-tests")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "6g")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="llm-wh-")).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    importable(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


#: Ties, repeated rows, nulls, empty and odd texts, a long one; extra columns that clash with the operators' own names.
ODD_TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away."),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away."),
    (2, "the QUICK brown fox jumps over the lazy dog and runs away."),
    (3, None), (4, ""), (5, " \n\t "), (None, "no id here, none at all"), (None, None), (6, "one"), (7, "one"), (8, "One two"),
    (9, "ünïcödé Ⅳ ٣ 漢字 \U0001F600 é​ it's we'll  DON'T <|endoftext|> x"),
    (10, "word " * 30000), (11, "a" * 70000), (12, "\x00\x01 token = \"0123456789abcdef01234567\""),
]
ODD_SCHEMA = "doc_id long, text string, n long, id string, cls string, key string, t string, keep_id int, part int, kept boolean"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, "x", "y", "z", None, None, 7, True) for i, t in ODD_TEXTS], ODD_SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
