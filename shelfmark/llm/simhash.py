"""SimHash near-duplicates: fingerprints, links by an inverted index of positional bytes, groups."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import TOKEN_TABLE, bounded_batches, column, raw_texts
from .components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BYTES = 8
# Members of one posting list that a task compares with each other. Longer lists are cut into
# blocks of this size, and every two blocks meet in a task of their own.
LIST_LIMIT = 20_000


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text; no words: zero."""
    words = text.translate(TOKEN_TABLE).split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops)
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """Add the fingerprint as a signed long. Null and word-less texts get zero."""

    @F.arrow_udf("long")
    def fingerprint(batch: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint_of(t, shingle) for t in raw_texts(batch)), np.uint64, len(batch))
        return pa.array(found.view(np.int64))

    return bounded_batches(df).withColumn(name, fingerprint(column(text).cast("string")))


def _postings(prints: DataFrame, shared: int) -> DataFrame:
    """Each fingerprint in the posting lists of every choice of ``shared`` byte positions.

    Two fingerprints meet in such a list exactly if they agree in all its positions, so a pair that
    meets at all has reached the count of shared positional bytes that the filter asks for.
    """
    masks = [
        (i, sum(0xFF << (8 * p) for p in chosen))
        for i, chosen in enumerate(combinations(range(BYTES), shared))
    ]

    def post(batches):
        numbers = np.array([i for i, _ in masks], np.uint64)
        wanted = np.array([m for _, m in masks], np.uint64)
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(prints), 4096):
                block = prints[i : i + 4096, None]
                # A list's number takes the place of masked bytes: mixed in, it keeps lists apart.
                key = _mixed((block & wanted) ^ _mixed(numbers + np.uint64(1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)),
                     pa.array(np.repeat(block.ravel().view(np.int64), len(masks)))],
                    names=["list", "fp"],
                )

    return prints.mapInArrow(post, "list long, fp long")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _forest(x: np.ndarray, start: np.ndarray, end: np.ndarray, shared: int, max_bits: int):
    """Links between members of the same run that join two parts not joined before.

    ``start`` and ``end`` bound the run of each element. Pairs are looked at by their distance in
    the run, all runs at once; a run is left once it is one part. Every pair's shared positional
    bytes are tallied, and only pairs that reach the minimum are verified bit by bit.
    """
    label = np.arange(len(x))
    parts = end - start  # at a run's first element: parts it still has
    at = np.flatnonzero(end - start > 1)
    links: list[tuple[int, int]] = []
    step = 1
    while True:
        at = at[(at + step < end[at]) & (parts[start[at]] > 1)]
        if not len(at):
            return links
        differ = x[at] ^ x[at + step]
        enough = _same_bytes(differ) >= shared
        near = at[enough][np.bitwise_count(differ[enough]) <= max_bits]
        for i in near.tolist():
            a, b = _root(label, i), _root(label, i + step)
            if a != b:
                label[max(a, b)] = min(a, b)
                parts[start[i]] -= 1
                links.append((i, i + step))
        step += 1


def _same_bytes(differ: np.ndarray) -> np.ndarray:
    return (differ[:, None].view(np.uint8) == 0).sum(1)


def _root(label: np.ndarray, i: int) -> int:
    while label[i] != i:
        label[i] = label[label[i]]
        i = label[i]
    return int(i)


def _linked(postings: DataFrame, shared: int, max_bits: int, limit: int | None) -> DataFrame:
    """Links ``a, b`` within each list; the members of lists over the limit come back as ``list, a``.

    Each task streams lists in order, holding whole lists of up to ``limit`` members.
    """

    def scan(batches):
        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        passing = None  # the long list that is being passed on

        def done(keys, prints):
            if not len(keys):
                return
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            length = np.diff(np.r_[first, len(keys)])
            keep = np.repeat(length > 1, length)
            keys, prints = keys[keep], prints[keep]
            length = length[length > 1]
            first = np.cumsum(length) - length
            start, end = np.repeat(first, length), np.repeat(first + length, length)
            links = _forest(prints.view(np.uint64), start, end, shared, max_bits)
            if links:
                i, j = np.array(links).T
                yield _rows(np.zeros(len(i), np.int64), prints[i], prints[j])

        for batch in batches:
            keys = np.r_[keys, batch["list"].to_numpy(zero_copy_only=False)]
            prints = np.r_[prints, batch["fp"].to_numpy(zero_copy_only=False)]
            if passing is not None:
                n = int(np.searchsorted(keys != passing, True))
                if n:
                    yield _rows(keys[:n], prints[:n], None)
                    keys, prints = keys[n:], prints[n:]
                passing = None if len(keys) else passing
            if not len(keys):
                continue
            last = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if (keys != keys[-1]).any() else 0
            yield from done(keys[:last], prints[:last])
            keys, prints = keys[last:], prints[last:]
            if limit is not None and len(keys) > limit:
                passing = keys[-1]
                yield _rows(keys, prints, None)
                keys, prints = keys[:0], prints[:0]
        yield from done(keys, prints)

    laid_out = postings.repartition("list").sortWithinPartitions("list", "fp")
    return laid_out.mapInArrow(scan, "list long, a long, b long")


def _rows(keys, a, b) -> pa.RecordBatch:
    other = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b)
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(a), other], names=["list", "a", "b"])


def _long_lists(members: DataFrame, limit: int) -> DataFrame:
    """Cut long lists into blocks; every member is sent to each pair of blocks it belongs to."""
    size = members.groupBy("list").agg(F.ceil(F.count("*") / limit).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    return (
        members.join(size, "list")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("list", F.least("own", "other"), F.greatest("own", "other")).alias("list"), "fp"
        )
    )


def fingerprint_groups(
    prints: DataFrame, max_bits: int = MAX_BITS, limit: int = LIST_LIMIT
) -> DataFrame:
    """``fp, root`` for every fingerprint that is linked to another; root is the group's smallest.

    ``prints`` holds distinct fingerprints in one long column ``fp``. With at most ``max_bits``
    differing bits at most that many bytes differ, so a linked pair shares 8 - max_bits positional
    bytes. Only links that join separate parts of a list leave a task, never all its pairs.
    """
    if not 0 <= max_bits < BYTES:
        raise ValueError("max_bits must be between 0 and 7")
    shared = BYTES - max_bits
    found = stored(_linked(_postings(prints, shared), shared, max_bits, limit), "simhash-links")
    links = found.where("b IS NOT NULL").select("a", "b")
    members = found.where("b IS NULL").select("list", F.col("a").alias("fp"))
    more = _linked(_long_lists(members, limit), shared, max_bits, None).select("a", "b")
    return components(links.union(more).distinct()).select(
        F.col("node").alias("fp"), F.col("root").alias("root")
    )


def _grouped(prints: DataFrame, max_bits: int, limit: int) -> DataFrame:
    """``fp, component_id, keeper``: smallest id of the group, and whether ``fp`` holds it.

    ``prints`` has ``fp`` and ``least``, the smallest id with that fingerprint.
    """
    roots = fingerprint_groups(prints.select("fp"), max_bits, limit)
    joined = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = joined.groupBy("root").agg(
        F.min(F.struct(F.col("least").isNull(), "least", "fp")).alias("first")
    )
    return joined.join(first, "root").select(
        "fp", F.col("first.least").alias("component_id"), (F.col("first.fp") == F.col("fp")).alias("keeper")
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    limit: int = LIST_LIMIT,
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` for every row.

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits; a component's
    id is its smallest ``doc_id``. Null, empty and word-less texts have fingerprint zero and are
    linked like others. Repeated rows come back as often as given. A null id is passed over in the
    choice of the smallest; a component of null ids only has a null id.
    """
    slim = with_fingerprint(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")), "text", "fp", shingle)
    rows = stored(slim.select("doc_id", "fp"), "simhash")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return rows.join(_grouped(prints, max_bits, limit), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    limit: int = LIST_LIMIT,
) -> DataFrame:
    """The rows of ``docs``, all columns, with one of each component: that of the smallest id.

    Of rows that share that id the first by fingerprint and text stays. Copies are dropped before
    the shuffle of the texts, one row per fingerprint and task being sent.
    """
    names = docs.columns
    packed = with_fingerprint(docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row").getField(doc_id).alias("id"), F.col("row").getField(text).alias("text")
    ), "text", "fp", shingle)
    prints = stored(packed.select("id", "fp").groupBy("fp").agg(F.min("id").alias("least")), "simhash")
    groups = _grouped(prints, max_bits, limit).where("keeper").select("fp")
    order = Window.partitionBy("fp").orderBy(F.col("id").asc_nulls_last(), "tie")
    ordered = packed.select("row", "id", "fp", F.xxhash64("text").alias("tie"))
    first = ordered.withColumn("n", F.row_number().over(order)).where("n = 1")
    kept = first.join(groups, "fp", "left_semi")
    return kept.select(*(F.col("row").getField(n).alias(n) for n in names))
