import pytest

from riskweave.llm.common import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(llm):
    """Documents from (doc_id, text[, source]); extra columns with names that operators might use themselves."""
    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = llm.createDataFrame(full, DOCS)
        if extra:
            for c in ("t", "row", "host", "key", "h", "m", "n", "spans", "base", "words", "_row", "_m", "weight", "class"):
                df = df.selectExpr("*", f"'x' AS `{c}`")
        return df
    return make


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
