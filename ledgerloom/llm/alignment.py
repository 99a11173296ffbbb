"""Edit distance of word sequences in a band of diagonals."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np


def banded_distance(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Insertions, deletions and substitutions between two sequences, None if over ``band``.

    Columns of the alignment table are bit vectors of differences, limited to the diagonals
    within ``band`` of the main one; the window of rows moves down one row a column.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > band:
        return None
    n = len(b)
    differ = np.flatnonzero(a[:n] != b)
    head = int(differ[0]) if len(differ) else n
    a, b = a[head:], b[head:]
    n = len(b)
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: n - tail]
    if not len(b):
        return len(a)
    rows = len(a)
    band = min(band, rows)
    width = 2 * band + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    places: dict[int, int] = defaultdict(int)
    for k, word in enumerate(a.tolist()):
        places[word] |= 1 << k
    up, down, distance = (full << (width - band - 1)) & full, 0, band
    for column, word in enumerate(b.tolist()):
        shift = column + band - width + 1
        match = places.get(word, 0)
        match = (match >> shift if shift >= 0 else match << -shift) & full
        same = ((((match & up) + up) ^ up) | match | down) & full
        right_up = (down | ~(same | up)) & full
        right_down = same & up
        bottom = column + 1 + band - rows  # rows of the window below the last one
        if bottom <= 0:
            distance += not same & top
        else:
            bit = top >> bottom
            distance += bool(right_up & bit) - bool(right_down & bit)
        moved = same >> 1
        up = (right_down | ~(moved | right_up)) & full
        down = moved & right_up
    return distance if distance <= band else None


def similar(a: np.ndarray, b: np.ndarray, least: float) -> float | None:
    """1 - distance / the longer length, None below ``least``."""
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    band = math.floor((1 - least) * longer + 1e-9)
    distance = banded_distance(a, b, band)
    return None if distance is None else 1 - distance / longer
