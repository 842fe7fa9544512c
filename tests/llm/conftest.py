import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text) with the common columns, and extra columns with names that operators use themselves."""
    def make(rows, lang="en", source="src0"):
        full = [(i, t, lang, source, len(t) if t is not None else None, "x", 1.5, "y") for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, row string, kept double, fp string")
    return make
