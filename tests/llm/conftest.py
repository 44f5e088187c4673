import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows (doc_id, text[, lang, source]) as a documents table with an extra column of a clashing name."""
    def make(rows, extra=True):
        full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if extra:
            for c in ("key", "th", "node", "size", "w", "rid", "idx", "chunk", "n_words", "target"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return make


@pytest.fixture(scope="session")
def table_dir(spark, tmp_path_factory):
    """Write tables into a folder like the driver's."""
    def make(**tables):
        d = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(f"{d}/{name}.parquet")
        return str(d)
    return make
