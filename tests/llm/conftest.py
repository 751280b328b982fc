import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

DOCS = "doc_id bigint, text string"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, dealt over a few partitions."""

    def build(rows, parts=3):
        return spark.createDataFrame(list(rows), DOCS).repartition(parts)

    return build
