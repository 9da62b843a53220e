import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from cargofeed.session import build_session, checkpoint_dir

    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # the configured shared folder, or a temp one in tests
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
