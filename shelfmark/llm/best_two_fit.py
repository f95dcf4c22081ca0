"""Best-two-fit packing of documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import texts
from .placing import Run, placed, stored_pieces

LIMIT = 2048


def best_two_fit(counts: dict[int, int], limit: int = LIMIT) -> list[Run]:
    """Pack pieces given as counts of their lengths.

    A sequence starts with the longest piece left and is filled greedily with the longest that
    fits. Then its smallest piece makes way for the two pieces left that fill the gap, grown by
    it, more tightly than it does; this is repeated while the gap shrinks. A filling is used as
    often as its pieces last, so the number of steps depends on the lengths, not on the pieces.
    """
    left = np.zeros(limit + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    taken = np.zeros(limit + 1, np.int64)  # pieces of each length that have a place
    runs: list[Run] = []
    sequence = 0
    while True:
        present = np.flatnonzero(left)
        if not len(present):
            return runs
        filling = _greedy(left, int(present[-1]), limit)
        _two_for_smallest(left, filling, limit)
        uses = np.bincount(filling, minlength=limit + 1)
        kinds = np.flatnonzero(uses)
        times = int((left[kinds] // uses[kinds]).min())
        offset = 0
        for length in filling:
            runs.append(Run(length, int(taken[length]), times, sequence, offset))
            taken[length] += times
            offset += length
        left[kinds] -= uses[kinds] * times
        sequence += times


def _greedy(left: np.ndarray, first: int, limit: int) -> list[int]:
    free = left.copy()
    filling, gap, longest = [], limit, first
    while True:
        while longest and (longest > gap or not free[longest]):
            fits = np.flatnonzero(free[: min(longest, gap + 1)])
            longest = int(fits[-1]) if len(fits) else 0
        if not longest:
            return filling
        n = min(int(free[longest]), gap // longest)
        filling += [longest] * n
        free[longest] -= n
        gap -= n * longest


def _two_for_smallest(left: np.ndarray, filling: list[int], limit: int) -> None:
    """Replace the smallest piece by two that fill its grown gap more tightly, while any do."""
    free = left - np.bincount(filling, minlength=len(left))
    gap = limit - sum(filling)
    while gap:
        smallest = min(filling)
        room = gap + smallest
        a = np.flatnonzero(free[: room + 1])
        if not len(a):
            return
        # For each a, the longest b <= a within the room; b = a needs two of them.
        most = np.minimum(room - a, a)
        at = np.searchsorted(a, most, side="right") - 1
        at = np.where((at >= 0) & (a[at] == a) & (free[a] < 2), at - 1, at)
        both = np.where(at >= 0, a + a[at], 0)
        best = int(np.argmax(both))
        if both[best] <= smallest:
            return
        one, two = int(a[best]), int(a[at[best]])
        filling.remove(smallest)
        filling += [one, two]
        free[smallest] += 1
        free[one] -= 1
        free[two] -= 1
        gap = limit - sum(filling)


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT
) -> DataFrame:
    """Cut all documents into pieces of at most ``limit`` tokens and pack these by best-two-fit.

    Returns per piece ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Every
    document ends with token 0; a null or empty text is that token alone. Repeated rows are packed
    as often as given. An empty table gives no rows.
    """
    cut = stored_pieces(texts(docs, doc_id, text), tokenizer, limit)
    return placed(cut, lambda counts: best_two_fit(counts, limit))
