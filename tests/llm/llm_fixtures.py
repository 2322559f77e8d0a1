import pyarrow as pa
import pytest

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def frame(spark):
    """Builds a DataFrame from a column -> (Arrow type, values) mapping."""
    def build(**columns):
        return spark.createDataFrame(pa.table({c: pa.array(v, t) for c, (t, v) in columns.items()}))
    return build


@pytest.fixture(scope="session")
def documents(frame):
    """documents rows from (doc_id, text) pairs, with a clashing extra column."""
    def build(rows, **more):
        n = len(rows)
        base = {"doc_id": (pa.int64(), [r[0] for r in rows]), "text": (pa.string(), [r[1] for r in rows]),
                "lang": (pa.string(), ["en"] * n), "source": (pa.string(), ["s"] * n),
                "n_chars": (pa.int64(), [len(r[1] or "") for r in rows]),
                "node": (pa.string(), ["x"] * n), "score": (pa.string(), ["y"] * n)}
        return frame(**{**base, **more})
    return build
