import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strideframe.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, order=None):
    """Collected rows as tuples, sorted for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if order is None else out


MOMENT_COLS = ("game_id long, event_id long, quarter int, game_clock double, shot_clock double, "
               "team_id long, player_id long, x_loc double, y_loc double, radius double")


def moments_df(spark, data):
    """data: tuples (game, event, quarter, clock, player, x, y[, radius[, team]])."""
    full = []
    for t in data:
        g, e, q, c, p, x, y = t[:7]
        r = t[7] if len(t) > 7 else 1.0
        team = t[8] if len(t) > 8 else 1
        full.append((g, e, q, float(c), 10.0, team, p, float(x), float(y), float(r)))
    return spark.createDataFrame(full, MOMENT_COLS)


@pytest.fixture(autouse=True)
def _join_limit(request):
    """A test may set the broadcast threshold; the next one finds the usual one."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").conf.unset("spark.sql.autoBroadcastJoinThreshold")
