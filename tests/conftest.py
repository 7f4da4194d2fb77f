import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyfold.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", 4, app_name="keyfold-tests",
                      extra={"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder only when the environment names none
    # (spark.checkpoint.dir is static: register the folder with the context)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def lines_df(spark, lines):
    """Fixture lines as a frame with ``value`` and ``seq`` (line number from 1)."""
    return spark.createDataFrame([(l, i + 1) for i, l in enumerate(lines)],
                                 "value string, seq long")
