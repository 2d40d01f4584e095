"""The live view's frames from running figures, against plain loops over each frame."""

import math
import time

import numpy as np
import pandas as pd
import pytest

from breathline.plans import frames
from breathline.streaming import live

NAN = math.nan


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_figures_equal_loops(width):
    rng = np.random.default_rng(width)
    times = np.cumsum(rng.choice([0, 1, 1, 2, 30], 400))
    values = rng.choice([1e9, 400.25, 400.5, 7.0], (400, 3))
    values[390:, 1], values[395, 2], values[398, 0] = np.nan, np.inf, -np.inf
    at = np.flatnonzero(rng.random(400) < 0.8)
    got = frames.figures(values, times, width, at)
    for row, i in enumerate(at):
        frame = values[:i + 1][times[:i + 1] >= times[i] - width]
        with np.errstate(invalid="ignore"):
            plain = frame.mean(axis=0), frame.std(axis=0), frame.min(axis=0), frame.max(axis=0)
        assert got[0][row] == len(frame)
        for mine, theirs in zip(got[1:], plain, strict=True):
            np.testing.assert_allclose(mine[row], theirs, rtol=1e-12, atol=1e-6)


class Kept:
    """A state that a test holds itself."""

    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    put = update

    def clear(self):
        self.value = None


def view(window_us, warmup):
    made = live.LiveView(window_us, warmup)
    made.lines, made.mark = Kept(), Kept()
    return made


def arrived(made, rows):
    out = list(made.handleInputRows(("d",), iter([pd.DataFrame(rows, columns=["us", "line_id", "vs"])]), None))
    return [tuple(r) for part in out for r in part.itertuples(index=False)]


def test_very_many_lines_in_a_window():
    """Every frame holds all lines so far: 60,000 lines would be 1.8 thousand million looked at."""
    n, made, began = 60_000, view(10**9, 2), time.monotonic()
    got = arrived(made, [(i, i, [float(i % 50), float(i)]) for i in range(n)])
    assert time.monotonic() - began < 20
    assert len(got) == 2 * (n - 1) and got[-1][1:5] == (n - 1, n - 1, 1, n - 1.0)
    assert got[-1][5] == pytest.approx((n - 1) / 2) and got[-1][6] == pytest.approx(math.sqrt((n * n - 1) / 12)) and got[-1][7:] == (n, 0.0, False)


def test_channels_change_within_a_batch_and_nulls():
    made = view(20_000_000, 2)
    rows = [(1, 1, [1.0, 2.0]), (2, 2, [2.0, 5.0]), (3, 3, [1.0]), (4, 4, [5.0]), (5, 5, []), (6, 6, []), (7, 7, [1.0, 1.0]), (8, 8, [1.0, None])]
    got = arrived(made, [(us, i, [NAN if v is None else v for v in vs]) for us, i, vs in rows])
    assert [(r[1], r[3], r[4], r[7]) for r in got[:3]] == [(2, 0, 2.0, 2), (2, 1, 5.0, 2), (4, 0, 5.0, 2)]
    assert [r[8] for r in got[:3]] == [0.0, 0.0, 0.0]
    assert [(r[1], r[3]) for r in got[3:]] == [(8, 0), (8, 1)] and math.isnan(got[3][8]) and math.isnan(got[4][5])
    assert [r[1] for r in arrived(made, [(8, 8, [1.0, 1.0]), (9, 9, [3.0, 4.0])]) if r[9]] == [8]
