import pytest


@pytest.fixture
def docs(spark):
    """documents with null, empty, blank, very long, repeated and oddly named content."""

    def make(rows, partitions=3):
        full = [(i, t, "en", "src0", len(t or ""), None, 1) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string, `odd name` int"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def odd_rows():
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (6, long), (7, long + " end"), (8, "A\nA\nA\n"),
        (None, "one two"), (None, None), (9, "é ñ 漢字 🙂 " * 40), (10, "x" * 5000), (11, "Tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie tie"),
    ]
