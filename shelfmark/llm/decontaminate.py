"""Benchmark passages in documents, by a Wu-Manber search over words."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import WORD_TABLE, bounded_batches, column, raw_texts, texts

WINDOW = 10
# Words of benchmark items that one pass over the documents searches for. The broadcast tables of
# a pass hold about this many windows, whatever the size of the benchmark.
WORDS_PER_PASS = 1_000_000


class Machine(NamedTuple):
    """Tables for all windows of one length."""

    length: int
    block: int
    shift: dict  # block of words -> words the window may move on
    buckets: dict  # hash of the last block -> windows that end with it


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_TABLE).split() if text else []


def windows_of(words: list[bytes], window: int) -> Iterator[tuple[bytes, ...]]:
    """All windows of an item; one of fewer words is one window."""
    if words:
        for i in range(max(1, len(words) - window + 1)):
            yield tuple(words[i : i + window])


def _suffix(block: tuple[bytes, ...]) -> int:
    return zlib.crc32(b" ".join(block))


def machines(windows: dict[tuple, list]) -> list[Machine]:
    """Shift tables and suffix buckets, one machine for each length of window."""
    by_length = defaultdict(list)
    for window in windows:
        by_length[len(window)].append(window)
    made = []
    for length, group in sorted(by_length.items()):
        block = min(2, length)
        shift: dict = {}
        buckets = defaultdict(list)
        for window in group:
            for end in range(block, length + 1):
                key = window[end - block : end]
                shift[key] = min(shift.get(key, length), length - end)
            buckets[_suffix(window[-block:])].append(window)
        made.append(Machine(length, block, shift, dict(buckets)))
    return made


def occurrences(words: list[bytes], machine: Machine) -> Iterator[tuple[int, tuple]]:
    """Start and window of every occurrence."""
    length, block, shift, buckets = machine
    jump = length - block + 1
    end, n = length, len(words)
    while end <= n:
        key = tuple(words[end - block : end])
        move = shift.get(key, jump)
        if move:
            end += move
            continue
        start = end - length
        for window in buckets.get(_suffix(key), ()):
            if tuple(words[start:end]) == window:
                yield start, window
        end += 1


def _search(rows: list, window: int) -> tuple[list[tuple], dict]:
    """What a pass broadcasts, in plain types."""
    items = defaultdict(list)
    for item_id, text in rows:
        for w in windows_of(words_of(text.encode()), window):
            items[w].append(None if item_id is None else str(item_id))
    return [tuple(m) for m in machines(items)], dict(items)


def _pass(docs: DataFrame, block: list, window: int) -> DataFrame:
    """Number of words, hit word positions as [from, to) runs and item ids of each document."""
    search = docs.sparkSession.sparkContext.broadcast(_search(block, window))

    def scan(batches):
        found, items_of = search.value
        found = [Machine(*m) for m in found]
        for batch in batches:
            counts, runs, items, unnamed = [], [], [], []
            for text in raw_texts(batch["text"]):
                words = words_of(text)
                hits, seen = [], set()
                for machine in found:
                    for start, w in occurrences(words, machine):
                        hits.append((start, start + machine.length))
                        seen.update(items_of[w])
                counts.append(len(words))
                runs.append([{"a": a, "b": b} for a, b in joined(hits)])
                unnamed.append(None in seen)
                items.append(sorted(seen - {None}))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(counts, pa.int64()),
                 pa.array(runs, RUNS), pa.array(items, pa.list_(pa.string())), pa.array(unnamed, pa.bool_())],
                names=["row", "doc_id", "n_words", "runs", "items", "unnamed"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    shape = "runs array<struct<a:int,b:int>>, items array<string>, unnamed boolean"
    return docs.mapInArrow(scan, f"row long, doc_id {kind}, n_words long, {shape}").withColumn("n_hit", _n_hit())


RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with overlapping and touching ones made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _passes(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list]:
    """Benchmark items in blocks of about ``limit`` words."""
    rows = benchmark.select(column(item_id).cast("string"), column(text).cast("string")).where(column(text).isNotNull())
    block, size = [], 0
    for item, body in rows.toLocalIterator():
        block.append((item, body))
        size += len(body) // 2 + 1
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    words_per_pass: int = WORDS_PER_PASS,
) -> DataFrame:
    """Words of each document that lie in a benchmark window, and the items these come from.

    Returns ``doc_id, n_words, n_hit, runs`` (hit words as [a, b) runs), ``items`` (sorted as
    strings) and ``unnamed`` (an item without an id is found too), one row per input row. Words: A-Z lower-cased, runs of digits, letters and bytes
    beyond ASCII. An item of fewer than ``window`` words is one window.

    The benchmark is the query set: it is read in blocks of bounded size, and each block is one
    search over all documents without a shuffle. One block is the usual case; several are joined
    by row. Null and empty texts have no words and no hits; items without a text or without words
    are never found, those without an id are not in ``items``; repeated items and rows each count.
    """
    slim = texts(docs, doc_id, text).withColumn("row", F.lit(0).cast("long"))
    blocks = _passes(benchmark, item_id, item_text, words_per_pass)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return _pass(slim, first, window).drop("row")
    # Rows need a lasting number, by which the results of the passes are joined.
    slim = stored(slim.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    passes = [_pass(slim, block, window) for block in (first, second, *blocks)]
    merged = reduce(DataFrame.unionByName, passes).groupBy("row").agg(
        F.min("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("runs")).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("unnamed").alias("unnamed"),
    )
    return merged.drop("row").withColumn("runs", _one_run(F.array_sort("runs"))).withColumn("n_hit", _n_hit())


def _one_run(runs: Column) -> Column:
    """Sorted runs with overlapping and touching ones made one."""

    def add(done, run):
        last = F.element_at(done, -1)
        longer = F.struct(last["a"].alias("a"), F.greatest(last["b"], run["b"]).alias("b"))
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(longer))
        return F.when((F.size(done) > 0) & (run["a"] <= last["b"]), grown).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(runs, F.slice(runs, 1, 0), add)


def _n_hit() -> Column:
    return F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["b"] - r["a"])


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    words_per_pass: int = WORDS_PER_PASS,
) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs.

    Documents are filtered in place. A second block of the benchmark and later ones are searched
    for in what the pass before has left and written.
    """
    for number, block in enumerate(_passes(benchmark, item_id, item_text, words_per_pass)):
        docs = stored(docs, "decontaminate") if number else docs
        docs = docs.where(~_hit(docs, text, block, window))
    return docs


def _hit(docs: DataFrame, text: str, block: list, window: int) -> Column:
    search = bounded_batches(docs).sparkSession.sparkContext.broadcast(_search(block, window))

    @F.arrow_udf("boolean")
    def hit(batch: pa.Array) -> pa.Array:
        found = [Machine(*m) for m in search.value[0]]
        out = []
        for body in raw_texts(batch):
            words = words_of(body)
            out.append(any(True for m in found for _ in occurrences(words, m)))
        return pa.array(out, pa.bool_())

    return hit(column(text).cast("string"))
