"""Language-model scoring: difference of cross-entropies under a target and a background model."""

from __future__ import annotations

from collections import Counter
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.shared import stored
from .common import column, free_memory, raw_texts, texts
from .decontaminate import words_of

# Words of the shared vocabulary; all others are one unknown word. None: every word of the texts.
VOCABULARY = None
WEIGHT = 0.8  # of the word before; the rest goes to the word's own frequency
# Numbers of words within a block; those of its texts follow.
START, UNKNOWN, FIRST = 0, 1, 2
MARKS = [b" ", b""]  # no word is one of these
# Documents are counted and scored in blocks of about so many bytes of text, stored in parts.
BLOCK_BYTES, PART_BYTES, PART_ROWS = 12 << 20, 256 << 10, 4096
# Grams are summed in buckets: so many at least, and one for so many words.
BUCKETS, BUCKET_WORDS = 512, 2_000_000
# Bits of hash that tell the grams of a bucket apart: it has some millions of them at most.
KEY_BITS = 56
# Words looked at in one step of the scoring, or one document.
STEP_WORDS = 1 << 17


def vocabulary(docs: DataFrame, size: int) -> list[str]:
    """The most frequent words of all texts; ties in the order of the words."""

    def count(batches):
        for batch in batches:
            counts: Counter = Counter()
            for text in raw_texts(batch["text"]):
                counts.update(words_of(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode(errors="replace") for w in counts]), pa.array(counts.values(), pa.int64())],
                names=["word", "n"],
            )

    counts = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in counts.orderBy(F.col("n").desc(), "word").limit(size).collect()]


def encoded(slim: DataFrame, known: list[str] | None, block_bytes: int) -> DataFrame:
    """Documents in blocks: parts with ids, numbers of words, and the words as numbers within the block.

    ``words`` are those that no earlier part of the block has, in the order of their numbers.
    """
    sent = None if known is None else slim.sparkSession.sparkContext.broadcast({w.encode() for w in known})
    kind = slim.schema["doc_id"].dataType
    shapes = [pa.int64(), pa.int32(), pa.list_(to_arrow_type(kind)), pa.list_(pa.int32()), pa.binary(), pa.binary()]
    names = ["block", "part", "doc_ids", "sizes", "codes", "words"]

    def run(batches):
        block = TaskContext.get().partitionId() << 33
        part = in_block = in_part = told = 0
        ids: dict[bytes, int] = {}
        rows, codes = [], []

        def flush():
            nonlocal part, in_part, told, rows, codes
            new = list(ids)[told:]
            whole = _planes(np.concatenate(codes), 4)
            values = [block, part, rows, [len(c) for c in codes], whole, b" ".join(new)]
            part, in_part, told, rows, codes = part + 1, 0, len(ids), [], []
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, shapes)], names=names)

        for batch in batches:
            for row, text in zip(batch["doc_id"].to_pylist(), raw_texts(batch["text"])):
                words = words_of(text)
                if sent is None:
                    code = [ids.setdefault(w, len(ids) + FIRST) for w in words]
                else:
                    code = [ids.setdefault(w, len(ids) + FIRST) if w in sent.value else UNKNOWN for w in words]
                rows.append(row)
                codes.append(np.array(code, "<u4"))
                in_part += len(text or b"")
                in_block += len(text or b"")
                if in_part >= PART_BYTES or len(rows) >= PART_ROWS:
                    yield flush()
                if in_block >= block_bytes:
                    if rows:
                        yield flush()
                    block, part, in_block, told, ids = block + 1, 0, 0, 0, {}
        if rows:
            yield flush()

    return slim.mapInArrow(
        run,
        f"block long, part int, doc_ids array<{kind.simpleString()}>, sizes array<int>, codes binary, words binary",
    )


class Block(NamedTuple):
    """The grams of a block: its words and its pairs of words, the first of a document after a start."""

    doc_ids: pa.Array
    places: np.ndarray  # (part, place in the part) of each document
    sizes: np.ndarray  # words of each document
    before: np.ndarray  # the word before every word, document by document
    after: np.ndarray
    pair: np.ndarray  # number of the pair of every word
    pairs: np.ndarray  # (word before, word after)
    buckets: np.ndarray  # of words, then of pairs
    order: np.ndarray  # grams by bucket and key
    keys: np.ndarray


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def block_of(parts: pa.Table, buckets: int) -> Block:
    """Number the grams of a block. A gram is known by its bucket and 56 further bits of its hash."""
    parts = parts.sort_by("part")
    lists = [x.as_py() for x in parts["sizes"]]
    sizes = np.array([n for x in lists for n in x], np.int64)
    numbers = parts["part"].to_pylist()
    places = np.array([(p, i) for p, x in zip(numbers, lists) for i in range(len(x))], np.int64).reshape(-1, 2)
    codes = np.concatenate([_numbers(x.as_py(), 4).astype(np.int32) for x in parts["codes"]])
    words = [*MARKS, *(w for x in parts["words"] for w in x.as_py().split())]
    hashes = np.frombuffer(b"".join(blake2b(w, digest_size=16).digest() for w in words), "<u8").reshape(-1, 2)

    full = sizes[sizes > 0]
    before = np.r_[np.int32(START), codes[:-1]][: len(codes)]
    before[np.cumsum(full) - full] = START
    pairs, pair = np.unique(before.astype(np.int64) << 32 | codes, return_inverse=True)
    pair = pair.astype(np.int32)
    a, b = pairs >> 32, pairs & 0xFFFFFFFF

    def hashed(own: np.ndarray) -> np.ndarray:
        mixed = own[a] * np.uint64(0x9E3779B97F4A7C15) + own[b] * np.uint64(0xD1342543DE82EF95)
        return np.concatenate([own, _mixed(mixed + np.uint64(0x632BE59BD9B4E019))])

    keys, cell = hashed(hashes[:, 0]) >> np.uint64(64 - KEY_BITS), (hashed(hashes[:, 1]) % np.uint64(buckets)).astype(np.int32)
    return Block(
        pa.concat_arrays([x.flatten() for x in parts["doc_ids"].chunks]), places, sizes, before, codes, pair,
        np.stack([a, b]), cell, np.lexsort((keys, cell)), keys,
    )


# Of words and pairs, and how often a word is the one before; each in all texts and in target texts.
COUNTS = ["n", "followed", "n_target", "followed_target"]


def _planes(n: np.ndarray, width: int) -> bytes:
    """Numbers by the place of their bytes: most bytes of a column are then zeros in a row."""
    return n.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _numbers(raw: bytes, width: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, by the place of their bytes."""
    return _planes(np.diff(keys, prepend=np.uint64(0)), 8)


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_numbers(raw, 8)).astype(np.uint64)


def gram_counts(parts: DataFrame, marks: DataFrame, buckets: int) -> DataFrame:
    """Grams of each block with their counts in all its texts and in target texts, by bucket."""

    def count(parts: pa.Table, marks: pa.Table) -> pa.Table:
        free_memory()
        b = block_of(parts, buckets)
        wanted = {*zip(marks["part"].to_pylist(), marks["place"].to_pylist())}
        target = np.repeat(np.array([tuple(p) in wanted for p in b.places.tolist()], bool), b.sizes)
        pairs = b.pairs.shape[1]
        words = len(b.keys) - pairs
        cells, keys = b.buckets[b.order], b.keys[b.order]
        counts = {}
        for end, s in (("", slice(None)), ("_target", target)):
            own, of_pair = np.bincount(b.after[s], minlength=words), np.bincount(b.pair[s], minlength=pairs)
            followed = np.bincount(b.before[s], minlength=words)
            counts["n" + end] = np.r_[own, of_pair][b.order]
            counts["followed" + end] = np.r_[followed, np.zeros(pairs, np.int64)][b.order]
        cut = np.r_[np.flatnonzero(np.diff(cells, prepend=-1)), len(cells)]
        spans = list(zip(cut[:-1], cut[1:]))
        number = parts["block"][0].as_py()
        return pa.table({
            "block": pa.array([number] * len(spans), pa.int64()),
            "bucket": pa.array([int(cells[i]) for i, _ in spans], pa.int64()),
            "keys": pa.array([_packed_keys(keys[i:j]) for i, j in spans], pa.binary()),
            **{k: pa.array([_planes(n[i:j], 4) for i, j in spans], pa.binary()) for k, n in counts.items()},
        })

    return parts.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(
        count, f"block long, bucket long, keys binary, {', '.join(f'{c} binary' for c in COUNTS)}"
    )


def gram_totals(counts: DataFrame) -> DataFrame:
    """The counts of every gram over all blocks, for each block that has it and in the order of its grams."""

    def total(chunks: pa.Table) -> pa.Table:
        free_memory()
        keys = [_unpacked_keys(x.as_py()) for x in chunks["keys"]]
        cut = np.cumsum([len(k) for k in keys])[:-1]
        grams, gram = np.unique(np.concatenate(keys), return_inverse=True)
        out = {}
        for name in COUNTS:
            own = np.concatenate([_numbers(x.as_py(), 4) for x in chunks[name]])
            sums = np.bincount(gram, own, len(grams)).astype(np.int64)
            out[name] = pa.array([_planes(x, 8) for x in np.split(sums[gram], cut)], pa.binary())
        return pa.table({"block": chunks["block"], "bucket": chunks["bucket"], **out})

    return counts.groupBy("bucket").applyInArrow(
        total, f"block long, bucket long, {', '.join(f'{c} binary' for c in COUNTS)}"
    )


def _narrow(n: np.ndarray) -> np.ndarray:
    """Counts in half the room where they fit."""
    return n.astype(np.int32) if not len(n) or n.max() < 1 << 31 else n


def _times(document: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often each place's gram stands in the document of the place."""
    order = np.lexsort((gram, document))
    d, g = document[order], gram[order]
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (g[1:] != g[:-1])])
    length = np.diff(np.r_[first, len(g)])
    out = np.empty(len(g), np.int64)
    out[order] = np.repeat(length, length)
    return out


def losses(pair: np.ndarray, before: np.ndarray, own: np.ndarray, places: np.ndarray, weight: float = WEIGHT) -> np.ndarray:
    """-log2 of the probability of steps, both models being made alike.

    A word's own frequency, each count raised by one (``places`` is the sum of these), is mixed with
    its share after the word before; after a word that the model has not seen, the frequency stands alone.
    """
    own = (own + 1.0) / places
    return -np.log2(np.where(before > 0, weight * pair / np.maximum(before, 1) + (1 - weight) * own, own))


def _distinct_words(parts: DataFrame) -> int:
    def run(batches):
        for batch in batches:
            words = {w for x in batch["words"] for w in x.as_py().split()}
            yield pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary())], names=["word"])

    return parts.select("words").mapInArrow(run, "word binary").distinct().count()


def score_documents(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_id: str = "doc_id",
    size: int | None = VOCABULARY,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, score`` for every row.

    ``target`` lists the ids whose texts the target model learns from; the background model learns
    from all texts. Neither has learnt from the text that it scores: what a row has told a model is
    taken out of the counts for it, so scores of targets and of other texts compare; a copy of a
    text stays in. Both are word-pair models over one vocabulary: all words of all texts, or the
    ``size`` most frequent and one unknown word for the others. A loss is bits per word; the score is
    target less background, so texts like the target are below zero. Null, empty and word-less texts
    have no losses and a null score. Without target texts both scores are those of an even target
    model. Null ids are never targets.

    Words and pairs are counted in each block of documents, summed over all blocks in buckets of
    their hash, and the sums go back to the blocks that have them. No part of a model is on the
    driver or broadcast, unless ``size`` is given, whose words are; a gram has one entry per block,
    however frequent it is. Grams are told apart by 56 bits of hash within a bucket of bounded size. A text longer than a
    block is a block of its own, and a task holds its words whole.
    """
    slim = texts(docs, doc_id, text)
    known = None if size is None else vocabulary(slim, size)
    # Stored: the numbers of blocks, parts and words have to be the same for counting and scoring.
    parts = stored(encoded(slim, known, block_bytes), "encoded")
    ids = target.select(column(target_id).alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    each = parts.select("block", "part", F.posexplode(F.arrays_zip("doc_ids", "sizes")).alias("place", "of")).select(
        "block", "part", "place", F.col("of.doc_ids").alias("doc_id"), F.col("of.sizes").alias("size")
    )
    # Joined by a merge at every size: ids of targets have no bound that would let them be broadcast.
    marks = stored(each.join(ids.hint("merge"), "doc_id", "left_semi").select("block", "part", "place", "size"), "marks")
    n_words = parts.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + x))).first()[0] or 0
    n_target = marks.agg(F.sum("size")).first()[0] or 0
    distinct = len(known) if known is not None else _distinct_words(parts)
    raised = distinct + 1  # the unknown word is one
    buckets = max(BUCKETS, -(-n_words // BUCKET_WORDS))
    totals = gram_totals(gram_counts(parts, marks.drop("size"), buckets))
    kind = slim.schema["doc_id"].dataType

    def score(parts: pa.Table, totals: pa.Table) -> pa.Table:
        free_memory()
        b = block_of(parts, buckets)
        words = len(b.keys) - b.pairs.shape[1]
        full = b.sizes > 0
        del parts
        totals = totals.sort_by("bucket")
        buckets_ = totals["bucket"].to_pylist()

        def sums(name):
            out = np.zeros(len(b.keys), np.int64)
            chunks = [_numbers(x.as_py(), 8) for k, x in zip(buckets_, totals[name]) if k >= 0]
            if chunks:
                out[b.order] = np.concatenate(chunks)
            return _narrow(out)

        targets = {
            (-1 - bucket, int(place))
            for bucket, n in zip(buckets_, totals["n"].to_pylist()) if bucket < 0
            for place in n.split(b",")
        }
        is_target = np.array([tuple(p) in targets for p in b.places.tolist()], bool)
        models = [("_target", n_target + raised, is_target), ("", n_words + raised, np.ones(len(b.sizes), bool))]
        models = [(sums("n" + end), sums("followed" + end)[:words], places, learned) for end, places, learned in models]
        # What named the grams has done its work.
        b = b._replace(pairs=None, buckets=None, order=None, keys=None)
        del totals
        means = np.zeros((len(models), len(b.sizes)))
        ends = np.cumsum(b.sizes)
        start = 0
        while start < len(b.sizes):
            # Some documents at a time: what a document has told the models is taken out again for it.
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - b.sizes[start] + STEP_WORDS, "right")))
            size = b.sizes[start:stop]
            place = slice(ends[start] - size[0], ends[stop - 1])
            document = np.repeat(np.arange(stop - start), size)
            grams = b.pair[place], b.before[place], b.after[place]
            own = [_times(document, g) for g in grams]
            for mean, (n, followed, places, learned) in zip(means, models):
                out = learned[start:stop][document]
                loss = losses(
                    n[words + grams[0]] - own[0] * out, followed[grams[1]] - own[1] * out, n[grams[2]] - own[2] * out,
                    places - size[document] * out,
                )
                mean[start:stop] = np.bincount(document, loss, stop - start) / np.maximum(size, 1)
            start = stop
        out = [pa.array(mean, mask=~full) for mean in means]
        return pa.table([b.doc_ids, pa.array(b.sizes), *out], names=["doc_id", "n_words", "target_loss", "background_loss"])

    # Which documents are targets comes along as rows of negative buckets, one for each part.
    lists = marks.groupBy("block", (-1 - F.col("part")).cast("long").alias("bucket")).agg(
        F.array_join(F.collect_list(F.col("place").cast("string")), ",").cast("binary").alias("n")
    )
    totals = totals.unionByName(lists, allowMissingColumns=True)
    scored = parts.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(
        score, f"doc_id {kind.simpleString()}, n_words long, target_loss double, background_loss double"
    )
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
