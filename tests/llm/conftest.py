import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def shipped(spark):
    from clickweave.session import ship_package

    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def documents(shipped):
    return shipped.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(shipped):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with clashing names."""
    long = "long text of words " * 20_000
    rows = [(1, "Hello there, world", "en", "a", None), (2, None, "en", "a", 1), (3, "", None, None, 0), (None, "Hello there, world", "fr", "b", 3),
            (5, long, "en", None, 5), (5, long, "en", None, 5), (6, " \t\n", "de", "b", 3), (7, "\x00\x1f odd é  \U0001f600", None, "é", 1),
            (8, long + "end", "en", "b", 4), (None, None, None, None, None), (1, "another text under the same id", "de", "a", 2)]
    frame = shipped.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: frame["n_chars"] for c in ("row", "doc", "fp", "size", "score", "rank", "key", "h", "bucket", "lang_pred", "_key", "held_out", "part")}
    return frame.withColumns(clash)


def words(text):
    import re

    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


def lowered(text):
    import re

    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
