"""Trailing frames over sorted times in linear time, for frames of very many rows.

A frame is a range of rows, found by binary search. Its sums are differences of running
sums, its extremes the minima of two overlapping stretches of a power of two of rows, so
the work hangs on the rows (times a logarithm for extremes), not on the frames' sizes.
"""

import numpy as np


def bounds(times: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the rows in ``[t - width, t]`` of each row; ``times`` rise, peers count."""
    return np.searchsorted(times, times - width, "left"), np.searchsorted(times, times, "right")


def counts(flags: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(flags)])
    return running[end] - running[first]


def mean_and_sd(values: np.ndarray, there: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, mean, population sd) of the values that are ``there``; NaN as sums of doubles have it.

    Running sums are of extended doubles and around a middle value, so that a small frame
    behind many rows keeps its digits.
    """
    n = counts(there, first, end)
    finite = there & np.isfinite(values)
    middle = np.median(values[finite]) if finite.any() else 0.0
    off = np.where(finite, values - middle, 0.0).astype(np.longdouble)
    sums, squares = (np.concatenate([[0], np.cumsum(x, dtype=np.longdouble)]) for x in (off, off * off))
    with np.errstate(invalid="ignore", divide="ignore"):
        shift = (sums[end] - sums[first]) / n
        spread = (squares[end] - squares[first]) / n - shift * shift
        mean = (shift + middle).astype(np.float64)
        sd = np.sqrt(np.maximum(spread, 0)).astype(np.float64)
    low, high = extreme(np.where(finite, values, np.nan), first, end, np.fmin), extreme(np.where(finite, values, np.nan), first, end, np.fmax)
    sd[low == high] = 0.0
    mean[low == high] = low[low == high]
    up, down, odd = (counts(there & x, first, end) > 0 for x in (values == np.inf, values == -np.inf, np.isnan(values)))
    mean[up], mean[down], sd[up | down] = np.inf, -np.inf, np.nan
    mean[odd | (up & down)], sd[odd] = np.nan, np.nan
    return n, mean, sd


def extreme(values: np.ndarray, first: np.ndarray, end: np.ndarray, of: np.ufunc) -> np.ndarray:
    """``of`` (a minimum or maximum) over the rows of each frame."""
    out = np.full(len(values), np.nan)
    size = end - first
    level = np.frexp(size.astype(np.float64))[1] - 1  # the greatest power of two within the frame
    reach = values.astype(np.float64)  # of the last 2**k rows up to each
    for k in range(int(level.max()) + 1 if len(values) else 0):
        rows = np.flatnonzero(level == k)
        out[rows] = of(reach[end[rows] - 1], reach[first[rows] + (1 << k) - 1])
        step = 1 << k
        reach = np.concatenate([reach[:step], of(reach[step:], reach[:-step])])
    return out


def _running(values: np.ndarray) -> tuple[np.ndarray, ...]:
    """(mean, sum of squares around it, minimum, maximum) of the rows up to each, by column."""
    first = np.where(np.isfinite(values[0]), values[0], 0.0)
    off, n = (values - first).astype(np.longdouble), np.arange(1, len(values) + 1)[:, None]
    sums = np.cumsum(off, axis=0)
    return sums / n + first, np.cumsum(off * off, axis=0) - sums * sums / n, np.minimum.accumulate(values), np.maximum.accumulate(values)


def figures(values: np.ndarray, times: np.ndarray, width: int, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(rows, mean, population sd, minimum, maximum) by column of the frames ``[t - width, t]`` that end in the rows ``at``.

    Rows are in order of time; later peers are not in a frame. Time is cut into blocks of
    ``width``, so a frame is the end of one block and the start of the next, and its figures
    come from running ones of its own rows alone: nothing outside of a frame touches them.
    """
    blocks = times // max(1, width)
    starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
    shape = values.shape
    forth, back = ([np.zeros(shape, t) for t in (np.longdouble, np.longdouble, np.float64, np.float64)] for _ in range(2))
    with np.errstate(invalid="ignore", over="ignore"):
        for a, b in zip(starts, [*starts[1:], len(values)], strict=True):
            for whole, part in zip(forth, _running(values[a:b]), strict=True):
                whole[a:b] = part
            for whole, part in zip(back, _running(values[a:b][::-1]), strict=True):
                whole[a:b] = part[::-1]
        begin = starts[np.searchsorted(starts, at, "right") - 1]
        first = np.minimum(np.searchsorted(times, times[at] - width, "left"), begin)
        two, n0, n1 = (first < begin)[:, None], (begin - first)[:, None], (at - begin + 1)[:, None]
        n = n0 + n1
        (m0, q0, low0, high0), (m1, q1, low1, high1) = ([x[i] for x in side] for side, i in ((back, first), (forth, at)))
        mean = np.where(two, (n0 * m0 + n1 * m1) / n, m1)
        squares = np.where(two, q0 + q1 + (m0 - m1) ** 2 * n0 * n1 / n, q1)
        sd = np.sqrt(np.maximum(squares, 0) / n)
    low, high = np.where(two, np.minimum(low0, low1), low1), np.where(two, np.maximum(high0, high1), high1)
    return n[:, 0], mean.astype(np.float64), sd.astype(np.float64), low, high
