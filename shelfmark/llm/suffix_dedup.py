"""Long repeats between and within texts: merged Burrows-Wheeler transforms of what may repeat.

A window of LENGTH bytes is judged by its bytes alone. The steps:

1. Every window has an anchor, the smallest hash of the short grams in it, so equal windows have
   equal anchors. Windows in a row with one anchor form a segment. Anchors that occur once in all
   texts have no repeats; that leaves a fraction of the text.
2. Equal segments are one, with a count. Different segments of one anchor go to one block.
3. In a block, each shard of segments has its suffixes sorted and its transform read off. The
   transforms are merged by iterative refinement of their interleave, without comparing suffixes
   again: each round extends the common prefix of every interval by one symbol to the left. What
   stands in intervals of LENGTH bytes with two occurrences or more is repeated.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import bounded_batches, raw_texts
from .decontaminate import joined

LENGTH = 400
GRAM = 128  # bytes of an anchor
SYMBOL = 16  # bytes of a symbol of the transforms
SHARD_BYTES = 1 << 18
BLOCK_BYTES = 1 << 20  # segments that one merge holds
# Different segments of one anchor that are merged in one block. The windows of anchors with more
# are counted one by one over all tasks, which needs no group in one place.
GROUP_LIMIT = 2_000
PART = 1 << 20  # bytes of a text whose anchors are found at once


# --- Anchors ---------------------------------------------------------------------------------


def gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the bytes [i, i + gram) for every i; ``gram`` is a power of two."""
    h = text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    size = 1
    while size < gram:
        h = (h[:-size] ^ (h[:-size] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[size:]
        size *= 2
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of x[i : i + width] for every i."""
    n = len(x) - width + 1
    full = -(-len(x) // width) * width
    padded = np.full(full, np.iinfo(x.dtype).max, x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments_of(text: bytes, length: int = LENGTH, gram: int = GRAM):
    """Anchor hash, first and beyond-last window and place of the anchor of every segment of a text."""
    anchors, firsts, beyonds, places = [], [], [], []
    windows = len(text) - length + 1
    raw = np.frombuffer(text, np.uint8)
    place_bits = np.uint64(21)
    for low in range(0, max(0, windows), PART):
        n = min(PART, windows - low)
        h = gram_hashes(raw[low : low + n + length - 1], gram)
        # The place breaks ties for the leftmost and comes along with the minimum.
        key = (h >> place_bits << place_bits) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_least(key, length - gram + 1) & np.uint64((1 << 21) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        anchors.append(h[at[first]])
        firsts.append(first + low)
        beyonds.append(np.r_[first[1:], n] + low)
        places.append(at[first] + low)
    if not anchors:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(map(np.concatenate, (anchors, firsts, beyonds, places)))


# --- Merging transforms ----------------------------------------------------------------------


def symbol_ranks(text: np.ndarray, symbol: int) -> np.ndarray:
    """The alphabet: dense rank, in byte order, of the ``symbol`` bytes (a power of two) from every place."""
    size = min(symbol, 8)
    words = np.lib.stride_tricks.sliding_window_view(text, size)
    rank = np.zeros(len(words), np.uint64)
    for i in range(size):
        rank = (rank << np.uint64(8)) | words[:, i]
    rank = np.unique(rank, return_inverse=True)[1]
    while size < symbol:
        pair = (rank[:-size] << 32) | rank[size:]
        rank = np.unique(pair, return_inverse=True)[1]
        size *= 2
    return rank


def shard_order(ranks: np.ndarray, left: np.ndarray, symbol: int) -> np.ndarray:
    """Suffixes of a shard, as places, sorted by their symbols; equal ones stay in order of place.

    ``left`` has the bytes from each place to its segment's end. Ties are sorted again by twice as
    many bytes each time, as the ranks of what follows are known.
    """
    rank = np.where(left >= symbol, ranks + 1, 0)
    order = _stable(rank)
    head = np.r_[True, rank[order][1:] != rank[order][:-1]]
    row = np.arange(len(order))
    group = np.maximum.accumulate(np.where(head, row, 0))
    rank[order] = group
    tied, depth = row, symbol
    while True:
        # Members of groups of two or more that have not ended.
        same = np.r_[False, group[tied][1:] == group[tied][:-1]]
        tied = tied[(same | np.r_[same[1:], False]) & (left[order[tied]] >= depth)]
        if not len(tied):
            return order
        places, own = order[tied], group[tied]
        key = own * (len(order) + 1) + rank[places + depth]
        by = _stable(key)
        order[tied] = places = places[by]
        key = key[by]
        new = np.r_[True, key[1:] != key[:-1]]
        group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        rank[places] = group[tied]
        depth *= 2


def repeated_windows(
    segments: list[bytes], weights: list[int], length: int = LENGTH, symbol: int = SYMBOL,
    shard_bytes: int = SHARD_BYTES,
) -> list[np.ndarray]:
    """For every window of every segment: does it occur twice, counting segments by weight?"""
    sizes = np.array([len(s) for s in segments])
    starts = np.cumsum(sizes + 1) - sizes - 1  # one place more per segment: its empty suffix
    text = np.zeros(int(sizes.sum()) + len(sizes) + symbol, np.uint8)
    for a, s in zip(starts.tolist(), segments):
        text[a : a + len(s)] = np.frombuffer(s, np.uint8)
    own = np.repeat(np.arange(len(sizes)), sizes + 1)
    left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(own))
    ranks = symbol_ranks(text, symbol)
    # Shards: neighbouring segments. Of each: suffix order, transform, and the step to the left, which
    # is read off the transform alone: rows before which one symbol stands keep their order when it is
    # put in front, as suffixes are sorted. So the n rows with a symbol before lead to the last n rows.
    shard = (starts // shard_bytes)[own]
    cuts = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(own)]
    suffix, before, step = [], [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        place = shard_order(ranks[a:b], left[a:b], symbol) + a
        has = place - starts[own[place]] >= symbol
        c = np.where(has, ranks[np.maximum(place - symbol, 0)], -1)
        rows = np.flatnonzero(has)
        to = np.full(len(place), -1)
        to[rows[_stable(c[rows])]] = np.arange(b - len(rows), b)
        before.append(c)
        step.append(to)
        suffix.append(place)
    suffix = np.concatenate(suffix)
    before, step = (np.concatenate(x).astype(np.int32) for x in (before, step))
    weight = np.array(weights, float)[own[suffix]]
    # The interleave begins as the shards one after the other, all in one interval.
    rows, interval = np.arange(len(suffix), dtype=np.int32), np.zeros(len(suffix), np.int32)
    for _ in range(length // symbol):
        c = before[rows]
        keep = c >= 0
        rows, interval, c = rows[keep], interval[keep], c[keep]
        by = _stable(c)
        rows, interval, c = rows[by], interval[by], c[by]
        new = np.r_[True, (c[1:] != c[:-1]) | (interval[1:] != interval[:-1])] if len(c) else np.zeros(0, bool)
        rows = step[rows]
        interval = np.cumsum(new, dtype=np.int32) - 1
        # An interval with one occurrence stays one however far it is extended: it is settled.
        often = np.bincount(interval, weight[rows], minlength=1) >= 2
        keep = often[interval]
        rows, interval = rows[keep], interval[keep]
    found = np.zeros(len(text), bool)
    found[suffix[rows]] = True
    return [found[a : a + max(0, n - length + 1)] for a, n in zip(starts.tolist(), sizes.tolist())]


def _stable(x: np.ndarray) -> np.ndarray:
    """Stable order of small numbers: sorted with their places in the lowest bits."""
    bits = len(x).bit_length()
    if not len(x) or int(x.max()).bit_length() + bits > 63:
        return np.argsort(x, kind="stable")
    return np.sort((x.astype(np.int64) << bits) | np.arange(len(x))) & ((1 << bits) - 1)


# --- Over all texts --------------------------------------------------------------------------


def _found_anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def find(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for text in raw_texts(batch["text"]):
                if text is None or len(text) < length:
                    continue
                uid = hashlib.md5(text).digest()
                anchors, first, beyond, place = segments_of(text, length, gram)
                digest = xxhash.xxh3_64_intdigest
                pieces = np.fromiter(
                    (digest(text[a : b + length - 1]) for a, b in zip(first.tolist(), beyond.tolist())),
                    np.uint64, len(first),
                )
                columns[0].append(anchors.view(np.int64))
                columns[1].append(pieces.view(np.int64))
                columns[2] += [uid] * len(first)
                columns[3].append(first.astype(np.int32))
                columns[4].append(beyond.astype(np.int32))
                columns[5].append((place - first).astype(np.int32))
            if columns[2]:
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c) if i != 2 else c, t) for i, (c, t) in enumerate(zip(columns, kinds))],
                    names=["anchor", "piece", "uid", "a", "b", "p"],
                )

    return docs.select("text").mapInArrow(find, "anchor long, piece long, uid binary, a int, b int, p int")


def _with_bytes(pieces: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of segments, cut from one copy of their text."""
    wanted = pieces.groupBy("uid").agg(F.collect_list(F.struct("anchor", "piece", "n", "a", "b", "p")).alias("cuts"))
    first = Window.partitionBy("uid").orderBy(F.lit(0))
    one = docs.withColumn("nth", F.row_number().over(first)).where("nth = 1").select("uid", "text")

    def cut(batches):
        for batch in batches:
            cuts = batch["cuts"]
            rows = cuts.flatten()
            counts = np.diff(cuts.offsets.to_numpy())
            bodies = list(raw_texts(batch["text"]))
            a, b = rows.field("a").to_pylist(), rows.field("b").to_pylist()
            out, i = [], 0
            for body, n in zip(bodies, counts.tolist()):
                out += [body[a[j] : b[j] + length - 1] for j in range(i, i + n)]
                i += n
            if out:
                yield pa.RecordBatch.from_arrays(
                    [*(rows.field(n) for n in ("anchor", "piece", "n", "p")), pa.array(out, pa.binary())],
                    names=["anchor", "piece", "n", "p", "body"],
                )

    return one.join(wanted, "uid").select("text", "cuts").mapInArrow(
        cut, "anchor long, piece long, n long, p int, body binary"
    )


RUNS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def _runs(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False])).tolist()
    return [{"a": a, "b": b} for a, b in zip(edges[::2], edges[1::2])]


def may_repeat(rows: list[tuple], length: int, gram: int) -> list[tuple]:
    """The segments ``(anchor, piece, n, p, body)`` that can hold a repeated window.

    A window reaches at least half of what it has besides the anchor's gram to its left or to its
    right. So it can only be repeated if the gram with that many bytes to one side is.
    """
    half = -(-(length - gram) // 2)
    keys: list[tuple] = []
    counts: dict[tuple, int] = {}
    for anchor, _, n, p, body in rows:
        sides = [("right", anchor, body[p : p + gram + half]), ("left", anchor, body[p - half : p + gram] if p >= half else b"")]
        sides = [(side, anchor, xxhash.xxh3_64_intdigest(x)) for side, anchor, x in sides if len(x) == gram + half]
        keys.append(tuple(sides))
        for side in sides:
            counts[side] = counts.get(side, 0) + n
    return [row for row, sides in zip(rows, keys) if any(counts[side] > 1 for side in sides)]


def _merged(bodies: DataFrame, length: int, gram: int, symbol: int, block: int, shard: int) -> DataFrame:
    """Repeated windows of segments, block by block; all segments of an anchor are in one block."""

    def merge(batches):
        held: list[tuple] = []
        group: list[tuple] = []
        size = 0

        def done():
            if held:
                found = repeated_windows([h[4] for h in held], [h[2] for h in held], length, symbol, shard)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
                     pa.array([_runs(f) for f in found], RUNS)],
                    names=["anchor", "piece", "runs"],
                )

        def taken():
            nonlocal held, group, size
            new = may_repeat(group, length, gram)
            held += new
            size += sum(len(row[4]) for row in new)
            group = []
            if size >= block:
                yield from done()
                held, size = [], 0

        for batch in batches:
            for row in zip(*(batch[n].to_pylist() for n in ("anchor", "piece", "n", "p", "body"))):
                if group and row[0] != group[0][0]:
                    yield from taken()
                group.append(row)
        yield from taken()
        yield from done()

    laid_out = bodies.repartition("anchor").sortWithinPartitions("anchor", "piece")
    return laid_out.mapInArrow(merge, "anchor long, piece long, runs array<struct<a:int,b:int>>")


def _counted(bodies: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the segments of very frequent anchors, by counting each window."""

    def windows(batches):
        for batch in batches:
            for row in zip(*(batch[n].to_pylist() for n in ("anchor", "piece", "n", "body"))):
                n = len(row[3]) - length + 1
                digests = [xxhash.xxh3_128_digest(row[3][i : i + length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]] * n, pa.int64()), pa.array([row[1]] * n, pa.int64()),
                     pa.array([row[2]] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(digests, pa.binary())],
                    names=["anchor", "piece", "n", "at", "digest"],
                )

    each = bodies.mapInArrow(windows, "anchor long, piece long, n long, at int, digest binary")
    often = each.groupBy("digest").agg(F.sum("n").alias("n")).where("n > 1").select("digest")
    hit = each.join(often, "digest", "left_semi").groupBy("anchor", "piece").agg(F.sort_array(F.collect_list("at")).alias("at"))
    return hit.select(
        "anchor", "piece", F.transform("at", lambda x: F.struct(x.alias("a"), (x + 1).alias("b"))).alias("runs")
    )


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, symbol: int = SYMBOL,
    block: int = BLOCK_BYTES, shard: int = SHARD_BYTES, group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """``uid, spans``: for each different text with repeats, the bytes [a, b) they cover.

    ``docs`` has ``uid`` (the MD5 of the text, as bytes) and ``text``.
    """
    anchors = stored(_found_anchors(docs, length, gram), "anchors")
    counts = anchors.groupBy("anchor").agg(
        F.count("*").alias("n"), (F.min("piece") != F.max("piece")).alias("mixed")
    )
    # Stored, its layout is not that of the join, which may then split a frequent anchor's rows.
    shared = stored(counts.where("n > 1").select("anchor", "mixed"), "anchors-often")
    linked = stored(anchors.join(shared, "anchor"), "anchors-shared")
    pieces = linked.where("mixed").groupBy("anchor", "piece").agg(
        F.count("*").alias("n"), F.min(F.struct("uid", "a", "b", "p")).alias("at")
    ).select("anchor", "piece", "n", "at.*")
    bodies = stored(_with_bytes(pieces, docs, length), "segments")
    many = bodies.groupBy("anchor").count().where(F.col("count") > group_limit).select("anchor")
    solved = _merged(bodies.join(many, "anchor", "left_anti"), length, gram, symbol, block, shard)
    counted = _counted(bodies.join(many, "anchor", "left_semi"), length)
    runs = solved.where(F.size("runs") > 0).union(counted)
    places = linked.select("anchor", "piece", "uid", "a", "b", "mixed").distinct()
    whole = places.where("NOT mixed").select("uid", F.col("a").alias("x"), F.col("b").alias("y"))
    some = places.where("mixed").join(runs, ["anchor", "piece"]).select(
        "uid", "a", F.explode("runs").alias("run")
    ).select("uid", (F.col("a") + F.col("run.a")).alias("x"), (F.col("a") + F.col("run.b")).alias("y"))
    return (
        whole.union(some).groupBy("uid")
        .agg(F.collect_list(F.struct("x", (F.col("y") + length - 1).alias("y"))).alias("spans"))
    )


def with_repeats_removed(
    docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, symbol: int = SYMBOL,
    block: int = BLOCK_BYTES, shard: int = SHARD_BYTES, group_limit: int = GROUP_LIMIT, as_text: bool = False,
) -> DataFrame:
    """``row`` (the given row as a struct) and ``cut``: its bytes after and numbers of the removal.

    ``cut`` has ``n_bytes, n_removed, n_spans`` and ``kept``, the remaining bytes in their order;
    ``as_text`` gives them as text, without the rests of characters that were cut apart.
    A byte goes if a string of ``length`` bytes that covers it starts anywhere else in the texts
    as given, overlaps included; matches never cross texts. A null text is empty and stays so;
    texts under ``length`` bytes stay whole, and the bytes of rows with equal texts all go if
    there are ``length`` of them. An empty table gives no rows.

    ``length`` is a multiple of ``symbol``; ``symbol`` and ``gram`` are powers of two.
    """
    if length % symbol or gram > length or gram & (gram - 1) or symbol & (symbol - 1):
        raise ValueError("length must be a multiple of symbol; symbol and gram powers of two")
    body = F.coalesce(F.col("row").getField(text).cast("string"), F.lit(""))
    rows = bounded_batches(docs).select(F.struct("*").alias("row"))
    keyed = rows.select("row", F.unhex(F.md5(body.cast("binary"))).alias("uid"))
    texts = rows.select(F.unhex(F.md5(body.cast("binary"))).alias("uid"), body.alias("text"))
    spans = repeated_spans(texts, length, gram, symbol, block, shard, group_limit)

    kind, shape = ("string", CUT_TEXT) if as_text else ("binary", CUT)

    @F.arrow_udf(f"struct<n_bytes:long,n_removed:long,n_spans:long,kept:{kind}>")
    def cut(bodies: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for body, own in zip(raw_texts(bodies), spans.to_pylist()):
            gone = joined([(s["x"], s["y"]) for s in own]) if own else []
            kept, at = [], 0
            for a, b in gone:
                kept.append(body[at:a])
                at = b
            kept.append(body[at:])
            removed = sum(b - a for a, b in gone)
            left = b"".join(kept)
            left = left.decode(errors="ignore") if as_text else left
            out.append({"n_bytes": len(body), "n_removed": removed, "n_spans": len(gone), "kept": left})
        return pa.array(out, shape)

    return keyed.join(spans, "uid", "left").select("row", cut(body, F.col("spans")).alias("cut"))


COUNTS = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())]
CUT = pa.struct([*COUNTS, ("kept", pa.binary())])
CUT_TEXT = pa.struct([*COUNTS, ("kept", pa.string())])
