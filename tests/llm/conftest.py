import pytest


@pytest.fixture
def frame(spark):
    """A DataFrame from a schema and rows, over several partitions."""

    def make(schema, rows, partitions=3):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture
def docs(frame):
    """Documents from texts; ids count from 0."""

    def make(*texts, **columns):
        rows = [
            (i, text, columns.get("lang", "en"), f"src{i % 3}", len(text or ""))
            for i, text in enumerate(texts)
        ]
        return frame("doc_id long, text string, lang string, source string, n_chars long", rows)

    return make
