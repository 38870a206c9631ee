import pytest


@pytest.fixture
def docs(spark):
    """A maker of document tables, with extra columns whose names clash with the operators' own."""

    def make(rows):
        table = [(i, t, "en", "s", len(t or ""), "clash", 7) for i, t in rows]
        return spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, node string, sig int").repartition(3)

    return make
