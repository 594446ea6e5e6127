import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Tests have no cluster: name a folder for written tables where the session has none."""
    if not (spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null id, null, empty, blank and long texts, repeated rows and ids, and columns that operators name themselves."""
    rows = [(1, "The cat sat on the mat and looked at the dog", "en"), (2, None, None), (3, "", "en"), (4, " \t\n", None),
            (5, "x" * 50_000, "de"), (5, "x" * 50_000, "de"), (6, "The cat sat on the mat and looked at the dog", "en"),
            (None, "the cat  sat", "en"), (7, "a b " * 3000, "fr"), (8, "1234 !!", "fr")]
    rows = [(*r, 1, 0.5, [1], "k") for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens int, score double, rare array<int>, key string")
