"""The driver contract without a part of the package, or without one of its libraries."""

import os
import subprocess
import sys

import pytest
from msgflow.plans.catalog import QUERIES
from msgflow.session import shared_base

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["xxhash", "regex", "public_tokenizers", "corpus_pipeline", "msgflow.llm"])
def test_the_other_queries_stay(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES))] * 2
    assert "without the operators over documents" in out.stderr


class Session:
    """Settings and master of a session, as far as the shared folder asks for them."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda name, *default: settings.get(name, *default))})


def test_the_shared_folder_is_asked_for_on_a_cluster():
    warehouse = {"spark.sql.warehouse.dir": "file:/here"}
    assert shared_base(Session("local[4]", **warehouse)) == "file:/here"
    assert shared_base(Session("yarn", **warehouse, **{"spark.checkpoint.dir": "s3a://b/c/"})) == "s3a://b/c"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_base(Session(master, **warehouse))
