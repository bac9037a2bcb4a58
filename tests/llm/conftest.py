import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def spark():
    from vidlens import get_spark
    return get_spark("local[*]", shuffle_partitions=4,
                     conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="vidlens-llm-ckpt-")})


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents table with all columns, and one more of a clashing name."""
    def make(rows, extra=True):
        cols = "doc_id long, text string, lang string, source string, n_chars long"
        df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in
                                    [(*r, "a")[:3] for r in rows]], cols)
        if extra:
            for c in ("size", "uid", "row", "key", "n", "comp"):
                df = df.selectExpr("*", f"'x' as {c}")
        return df
    return make
