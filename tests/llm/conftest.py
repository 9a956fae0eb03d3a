import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Awkward documents with repeats, a null id and columns whose names clash with the operators' own."""
    from brute import ODD

    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else f"s{i % 3}", i, "x", 0.5, "h", 1, "s", 2, "k", 3) for i, t in enumerate(ODD)]
    rows += [rows[5], rows[5], (None, "no id at all", "en", "s1", 1, "x", 0.5, "h", 1, "s", 2, "k", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, fp string, score double, size string, _h int, _src string, _k0 int, _k1 string, row int")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int")
