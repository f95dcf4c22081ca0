"""Periodic runs: stretches of a text in which a few words are repeated over and over.

A run of period q repeats at least four times, so each of its words occurs four times in any segment
that holds the run. Words that occur less often in their segment split it; the parts are counted
again, until no word of a segment is too rare. Prose falls apart in a few rounds. What survives is
scanned lag by lag: a run of a lag between Q and 2Q covers two neighbouring places of a grid Q words
apart, so it is enough to compare the blocks at the grid's places with those a lag further on. Blocks
are compared by a number that equal blocks share, which is exact, and a scan of n words takes about
n log n steps however often its words repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, texts

COPIES = 4
WORDS = 6
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def surviving(ids: np.ndarray, copies: int = COPIES, least: int = WORDS) -> list[tuple[int, int]]:
    """Segments [a, b) of at least ``least`` words, each of which occurs ``copies`` times in it.

    Every stretch whose words all occur that often in it lies in one of them.
    """
    place = np.arange(len(ids))
    part = np.zeros(len(ids), np.int64)
    names = int(ids.max()) + 1 if len(ids) else 0
    found: list[tuple[int, int]] = []
    while len(place):
        key = part * names + ids[place]
        if part[-1] == 0:
            often = np.bincount(key)[key] >= copies
        else:
            _, inverse, number = np.unique(key, return_inverse=True, return_counts=True)
            often = number[inverse] >= copies
        stable = np.bincount(part, ~often) == 0
        size = np.bincount(part)
        start = np.cumsum(size) - size
        found += [(int(place[i]), int(place[i] + n)) for i, n in zip(start[stable], size[stable])]
        kept = often & ~stable[part]
        place, part = place[kept], part[kept]
        if len(place):
            new = np.ones(len(place), bool)
            new[1:] = (np.diff(place) != 1) | (np.diff(part) != 0)
            part = np.cumsum(new) - 1
            long = (np.bincount(part) >= least)[part]
            place, part = place[long], part[long]
            part = np.unique(part, return_inverse=True)[1]
    return sorted((a, b) for a, b in found if b - a >= least)


def block_names(ids: np.ndarray) -> list[np.ndarray]:
    """For each power of two the number of the block of so many words at each place; equal blocks share one."""
    names = [np.unique(ids, return_inverse=True)[1].astype(np.int64)]
    size = 1
    while 2 * size <= len(ids):
        last = names[-1]
        pair = last[:-size] * (int(last.max()) + 1) + last[size:]
        names.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        size *= 2
    return names


def _equal_ahead(names: list[np.ndarray], i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """How many words are equal from places ``i`` and ``k`` on; i < k."""
    i, k, from_ = i.copy(), k.copy(), k.copy()
    for level in range(len(names) - 1, -1, -1):
        name, size = names[level], 1 << level
        # The longest blocks may fit more than once.
        for _ in range(3 if level == len(names) - 1 else 1):
            inside = k < len(name)
            same = np.zeros(len(i), bool)
            same[inside] = name[i[inside]] == name[k[inside]]
            i[same] += size
            k[same] += size
    return k - from_


def _equal_behind(names: list[np.ndarray], i: np.ndarray, k: np.ndarray) -> np.ndarray:
    """How many words are equal before places ``i`` and ``k``."""
    i, k, from_ = i.copy(), k.copy(), i.copy()
    for level in range(len(names) - 1, -1, -1):
        name, size = names[level], 1 << level
        for _ in range(3 if level == len(names) - 1 else 1):
            inside = i >= size
            same = np.zeros(len(i), bool)
            same[inside] = name[i[inside] - size] == name[k[inside] - size]
            i[same] -= size
            k[same] -= size
    return from_ - i


def lag_scan(ids: np.ndarray, copies: int = COPIES, least: int = WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a segment, by start and period.

    A run repeats its smallest period ``copies`` times or more, at least 3, and no neighbouring word
    extends it.
    """
    if copies < 3:
        raise ValueError("runs of fewer than three copies are not searched for")
    n = len(ids)
    names = block_names(ids)
    starts, lengths, periods = [], [], []
    for level in range(len(names)):
        step = 1 << level  # lags from step to 2 * step - 1
        if copies * step > n:
            break
        # From its first place of the grid on, a run agrees with itself a lag later over this block.
        wide = names[min(len(names) - 1, level + (copies - 2).bit_length() - 1)]
        padded = np.full(-(-n // step) * step, -1, np.int64)
        padded[: len(wide)] = wide
        rows = padded.reshape(-1, step)
        row, offset = np.nonzero(rows[1:] == np.where(rows[:-1, :1] < 0, -2, rows[:-1, :1]))
        s, q = row * step, step + offset
        # Only the first place of the grid within the run reports it.
        name = names[level]
        earlier = s >= step
        back = s[earlier] - step
        first = np.ones(len(s), bool)
        first[earlier] = name[back] != name[back + q[earlier]]
        first &= copies * q <= n
        s, q = s[first], q[first]
        before, after = _equal_behind(names, s, s + q), _equal_ahead(names, s, s + q)
        length = before + q + after
        good = length >= np.maximum(least, copies * q)
        starts.append((s - before)[good])
        lengths.append(length[good])
        periods.append(q[good])
    if not starts:
        return []
    start, length, period = map(np.concatenate, (starts, lengths, periods))
    # A stretch found again with another period has it as a multiple of the smallest.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(start) != 0) | (np.diff(length) != 0)
    found = zip(start[new].tolist(), length[new].tolist(), period[new].tolist())
    return sorted(found, key=lambda run: (run[0], run[2]))


def runs_of(words: list[bytes], copies: int = COPIES, least: int = WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words, by start and period."""
    if len(words) < least:
        return []
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return [
        (a + start, length, period)
        for a, b in surviving(ids, copies, least)
        for start, length, period in lag_scan(ids[a:b], copies, least)
    ]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def find_runs(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    copies: int = COPIES,
    least: int = WORDS,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """Periodic runs of every text, and the text without their repeats.

    Words are what white space separates, as written. Returns ``doc_id, n_words, runs`` (a list of
    ``start, length, period`` by start and period, words numbered from 0; overlapping runs are all
    there) and ``collapsed`` (the words outside repeats, joined by one blank). Null, empty and blank
    texts have no words, no runs and an empty text. Repeated rows are searched each for itself; other
    columns are not looked at. ``rewrite`` may change the words of a text, by its id, before they are
    searched. One scan, no shuffle; a task holds one batch of texts, and of a very long text some 300
    bytes for each surviving word.
    """
    slim = texts(docs, doc_id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, offsets, fields, kept = [], [0], ([], [], []), []
            for key, raw in zip(batch["doc_id"], raw_texts(batch["text"])):
                words = (raw or b"").split()
                if rewrite is not None:
                    words = rewrite(key.as_py(), words)
                runs = runs_of(words, copies, least)
                for field, values in zip(fields, zip(*runs)):
                    field += values
                sizes.append(len(words))
                offsets.append(offsets[-1] + len(runs))
                kept.append(b" ".join(collapsed(words, runs)))
            structs = pa.StructArray.from_arrays(
                [pa.array(f, pa.int64()) for f in fields], names=["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )


def strongest(runs: Column) -> Column:
    """The run of the greatest length by period, compared exactly; the first in the list of equal ones, null of none."""

    def better(best: Column, run: Column) -> Column:
        return F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)
