"""Edit distance by bit-parallel banded alignment; a column of the band is one Python integer."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


def _places(of: Sequence[Hashable]) -> dict[Hashable, int]:
    """For each symbol the places where it stands, as bits."""
    out: dict[Hashable, int] = {}
    for i, x in enumerate(of):
        out[x] = out.get(x, 0) | 1 << i
    return out


def banded_distance(a: Sequence[Hashable], b: Sequence[Hashable], most: int) -> int | None:
    """Edit distance of two sequences, None if it is over ``most``.

    Only cells at most ``most`` off the main diagonal are looked at.  Bit r of a column stands for row j - most + r, so
    the band keeps its place in the integer; "up" and "down" hold where a row is one more or less than the row above.
    """
    apart = len(a) - len(b)
    if abs(apart) > most:
        return None
    width = 2 * most + 1
    full, at = (1 << width) - 1, most + apart  # ``at``: the diagonal on which both sequences end
    down = (1 << (most + 1)) - 1
    up, edits, places = full ^ down, abs(apart), _places(a)
    for j, x in enumerate(b):
        up = up >> 1 | 1 << (width - 1)
        down >>= 1
        shift = j - most
        same = places.get(x, 0)
        same = (same >> shift if shift >= 0 else same << -shift) & full
        free = (((same & up) + up) ^ up | same | down) & full  # the diagonal step into the cell costs nothing
        right = down | full & ~(free | up)
        left = free & up
        edits += not free >> at & 1
        if edits > most:
            return None
        right = (right << 1 | 1) & full
        up = (left << 1 | ~(free | right)) & full
        down = right & free
    return edits


def _columns(pattern: Sequence[Hashable], text: Sequence[Hashable], anchored: bool):
    """Edits between the whole pattern and text ending at each place, beginning anywhere or (anchored) at the first."""
    m = len(pattern)
    full, top, places = (1 << m) - 1, m - 1, _places(pattern)
    up, down, edits = full, 0, m
    for x in text:
        same = places.get(x, 0)
        free = ((same & up) + up) ^ up | same | down
        right = down | full & ~(free | up)
        left = free & up
        edits += (right >> top & 1) - (left >> top & 1)
        right = right << 1 | anchored
        up = (left << 1 | ~(free | right)) & full
        down = right & free & full
        yield edits


def best_place(pattern: Sequence[Hashable], text: Sequence[Hashable], most: int) -> tuple[int, int, int] | None:
    """(edits, begin, end) of the part of the text closest to the pattern, None if it takes over ``most`` edits."""
    edits, end = min(((e, i + 1) for i, e in enumerate(_columns(pattern, text, False))), default=(most + 1, 0))
    if edits > most or not pattern:
        return None
    back = text[:end][::-1][: len(pattern) + most]
    long = next((i + 1 for i, e in enumerate(_columns(pattern[::-1], back, True)) if e == edits), 0)
    return edits, end - long, end
