import duckdb
import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents():
    return [tuple(r) for r in duckdb.sql(f"select doc_id, text, lang, source from '{SF001}/documents.parquet' order by doc_id").fetchall()]


EDGE_TEXTS = [None, "", "   \n\t ", "one", "one two three", "A b C d E f", "a b c d e f", "a b c d e f", "Été — naïve",
              "x\x1cy z", "word " * 3000, "\n".join(["same line here"] * 40)]


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, tiny, tied, repeated and long texts; a null and a repeated id; clashing columns."""
    rows = [(i, t, "en", "src1") for i, t in enumerate(EDGE_TEXTS)]
    rows += [(None, "one two three", None, None), (5, "A b C d E f", "en", "src1"), (5, "A b C d E f", "en", "src1")]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    schema = "doc_id bigint, text string, lang string, source string, score string, fp string, found string, u string, no string, n_tokens string"
    return spark.createDataFrame([r + ("s", "f", "g", "u", "n", "t") for r in edge_rows], schema)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
