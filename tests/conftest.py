import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))
sys.path.insert(0, str(Path(__file__).parent))

from compare import connect  # noqa: E402

from roadlens.session import local_session  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = local_session(
        "8",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.sql.shuffle.partitions": "4",
        },
    )
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def make_passages(spark):
    """Passages from (car, monitor, time) or longer tuples (…, camera, speed, road, area)."""
    from roadlens.schema import PASSAGE_FIELDS

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            car, monitor, time, *rest = row
            camera, speed, road, area = (*rest, *("0", "50", "1", "01")[len(rest):])
            full.append((i, time.split(" ")[0] if time else None, monitor, camera, car, time, speed, road, area))
        schema = "event_id long, " + ", ".join(f"{f} string" for f in PASSAGE_FIELDS)
        return spark.createDataFrame(full, schema)

    return make
