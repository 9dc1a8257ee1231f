import pytest

from cartcast.llm.common import prepare


@pytest.fixture(scope="session")
def llm(spark):
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def make(llm):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, with extra
    columns whose names clash with results."""
    def build(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", f"src{i % 3}", len(r[1] or ""), "x", 1)
                for i, r in enumerate(rows)]
        return llm.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, "
                  "component_id string, kept int")
    return build
