import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from jsonloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("jsonloom-tests", cores="8", partitions=4)
    # plans over a handful of rows: compiling them would take most of the time
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """Write documents as files: ``folder(name=object or text)``."""

    def write(**documents):
        for name, document in documents.items():
            text = document if isinstance(document, str) else json.dumps(document, indent=2)
            (tmp_path / f"{name}.json").write_text(text)
        return str(tmp_path)

    return write
