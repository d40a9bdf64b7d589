"""Documents for the tests: a given table plus rows with nulls, empty and long texts,
ties, repeated rows, and extra columns whose names the operators use themselves."""

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, key long, row long, n long"
LONG = "One very long text without an end, " * 30_000

ODD = [
    (None, "A row without an id, with words enough for shingles", "en", "src0"),
    (10_001, None, "en", "src0"),
    (10_002, "", None, "src1"),
    (10_003, " \t\n\x0b ", "en", None),
    (10_004, "two words", "en", "src0"),
    (10_005, "Two WORDS", "en", "src1"),
    (10_006, LONG, "en", "src1"),
    (10_007, LONG + "nearly the same", "en", "src2"),
    (10_008, "repeated row of some words that appear twice in the table", "en", "src2"),
    (10_008, "repeated row of some words that appear twice in the table", "en", "src2"),
    (-5, "ÉÉ éé ñandú 漢字 \U0001f600 ﬀ", "fr", "src3"),
    (2**62, "password = 'aB3dE5gH7jK9' token:abc mail me at x.y@ex-ample.co.uk +49 (30) 1234567", "en", "src3"),
]


def rows(table="documents"):
    return duckdb.sql(f"select * from '{SF}/{table}.parquet'").fetchall()


def corpus(spark):
    """The given documents and the odd ones, with clashing extra columns."""
    odd = [(*r, len(r[1]) if r[1] is not None else None, True, 0.5, 1, 2, 3) for r in ODD]
    given = [(*r, True, 0.5, 1, 2, 3) for r in rows()]
    return spark.createDataFrame(given + odd, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    out = corpus(spark).cache()
    out.count()
    return out


def table(df):
    """Rows as dictionaries, in a fixed order."""
    return sorted((r.asDict() for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r.values()))


def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", F.col("text")).collect()]
