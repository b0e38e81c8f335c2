import os
from pathlib import Path

import pytest
from sample_texts import awkward_texts, prose

# Python workers find the packages wherever the tests start.
_ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [_ROOT, os.environ.get("PYTHONPATH")]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_hit long, score double, slot string, label string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with all of that, a null and a repeated id, a repeated row, and columns named like results."""
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 2}", None if t is None else len(t), i, 0.5, "x", None) for i, t in enumerate(awkward_texts())]
    rows += [(None, "no id " + prose(5, 20), None, None, 1, 0, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [rows[9], (9, "another text with the same id", "en", "s1", 30, 0, 0.0, "y", "z")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
