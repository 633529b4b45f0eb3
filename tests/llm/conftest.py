import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def texts():
    """Awkward texts: null, empty, blank, ties, long ones, other scripts."""
    return [None, "", " ", "\n\n \t", "one", "one", "a b c", "The the THE", "x" * 5000, "word " * 3000,
            "mañana  naïve straße 漢字 👍🏽\x00end", "a\tb\nc\r\nd\x0be\x0cf\x1cg\x85h",
            "### *** $$$ %%%", "it's we'll  'tis", "l1\nl1\n \nl1\nl2", "1 2 3 1 2 3 1 2 3"]


@pytest.fixture()
def frame(spark):
    """A documents frame of (text) with clashing extra columns and repeated rows."""
    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, None if i % 3 else "s", i) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, source string, word long")
    return make


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
