import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def llm(spark, tmp_path_factory):
    """The session with the settings of the training-data operators."""
    from crmlake.llm.shared import session

    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session(spark)


@pytest.fixture
def docs(llm):
    """Documents from texts, with null and clashing columns beside them."""

    def make(*texts, ids=None):
        rows = [(None if ids is not None and ids[i] is None else (ids[i] if ids is not None else i), t, "x", None, 1.5, "c")
                for i, t in enumerate(texts)]
        return llm.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, label string")

    return make
