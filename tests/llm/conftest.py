import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for their own columns, now or in the past, and awkward ones.
CLASHES = (
    "fp", "bucket", "hits", "n_words", "line", "h", "words", "score", "root", "a", "b", "count", "row", "id", "th", "to_id", "to_th", "many", "stays", "gone", "pos", "site", "home",
    "kept", "n", "keys", "first", "label", "own", "other", "piece", "shard", "learn", "n_lines", "n_removed", "toxic", "node", "__h", "__g", "__f", "__fp", "__root", "__id", "__gone",
    "__lines", "__removed", "__stay", "__twice", "__own", "a.b", "doc id", "back`tick",
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of the given texts; ids are positions unless (id, text) pairs are given."""

    def make(texts, extra=False):
        rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        rows = [(i, t, ["en", "de", None][k % 3], f"src{k % 4}" if k % 5 else None, None) for k, (i, t) in enumerate(rows)]
        df = spark.createDataFrame(rows, COLUMNS)
        if extra:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("clash") for c in CLASHES})
        return df

    return make
