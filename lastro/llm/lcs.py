"""Longest common subsequence of two lists, a machine word of cells at a time."""

from __future__ import annotations

from collections.abc import Hashable, Sequence

#: Cells kept for one trace back; larger tables are halved first (Hirschberg).
CELLS = 1 << 27


def _masks(b: Sequence[Hashable]) -> dict[Hashable, int]:
    masks: dict[Hashable, int] = {}
    for place, item in enumerate(b):
        masks[item] = masks.get(item, 0) | 1 << place
    return masks


def _rows(a: Sequence[Hashable], b: Sequence[Hashable], keep: bool) -> list[int]:
    """Bit j of row i is 0 where the common length grows from b[:j] to b[:j+1], over a[:i]."""
    masks, full = _masks(b), (1 << len(b)) - 1
    row, rows = full, [full]
    for item in a:
        both = row & masks.get(item, 0)
        row = ((row + both) | (row - both)) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _lengths(row: int, size: int) -> list[int]:
    out = [0]
    for bit in reversed(bin(row | 1 << size)[3:]):
        out.append(out[-1] + (bit == "0"))
    return out


def common(a: Sequence[Hashable], b: Sequence[Hashable], cells: int = CELLS) -> list[int]:
    """Places in ``a`` of one longest common subsequence, rising."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    head, tail = list(range(low)), list(range(len(a) - high, len(a)))
    a, b = a[low : len(a) - high], b[low : len(b) - high]
    if not a or not b:
        return head + tail
    if len(a) > 1 and len(a) * len(b) > cells:
        half = len(a) // 2
        ahead = _lengths(_rows(a[:half], b, False)[0], len(b))
        behind = _lengths(_rows(a[half:][::-1], b[::-1], False)[0], len(b))[::-1]
        cut = max(range(len(b) + 1), key=lambda j: ahead[j] + behind[j])
        found = common(a[:half], b[:cut], cells) + [half + i for i in common(a[half:], b[cut:], cells)]
    else:
        rows, found = _rows(a, b, True), []
        i, j = len(a), len(b)
        while i and j:
            if rows[i] >> j - 1 & 1:
                j -= 1
            elif not rows[i - 1] >> j - 1 & 1:
                i -= 1
            else:
                i, j = i - 1, j - 1
                found.append(i)
        found.reverse()
    return head + [low + i for i in found] + tail
