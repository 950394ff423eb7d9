import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG, STRING = LongType(), StringType()
DOCUMENTS = StructType(
    [
        StructField("doc_id", LONG),
        StructField("text", STRING),
        StructField("lang", STRING),
        StructField("source", STRING),
        # names that the operators use inside
        *[StructField(n, STRING) for n in ("key", "_doc", "_hash", "node", "digest", "score", "row", "part")],
    ]
)
PAGES = StructType([StructField("page_id", LONG), StructField("url", STRING), StructField("html", STRING), StructField("path", STRING)])


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (id, text, lang, source) rows; extra columns are filled."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), *["x"] * 8) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x") for r in rows], PAGES)

    return make
