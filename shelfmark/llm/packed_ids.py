"""Binary token-id output: best-fit-decreasing packing into id matrices."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from .common import texts
from .placing import Run
from .tokens import kept_encoder

LIMIT = 2048
PADDING = 0
# Tokens of one block of pieces: at 4 bytes each 16 MB, and some 2000 sequences.
BLOCK_TOKENS = 4_000_000
NAMES = ["sequence_id", "n_tokens", "input_ids", "cu_seqlens", "position_ids", "doc_ids", "pieces", "starts"]


class CapacityTree:
    """A segment tree over free room: how many open groups have each, and the least that is enough."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.count = np.zeros(2 * self.size, np.int64)

    def add(self, room: int, n: int) -> None:
        node = self.size + room
        while node:
            self.count[node] += n
            node //= 2

    def least(self, room: int) -> int | None:
        """The smallest room of an open group that is at least ``room``."""
        node = self.size + room
        if not self.count[node]:
            # Up to the first ancestor with something to its right, then down to its leftmost leaf.
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not self.count[2 * node])
        return node - self.size


def best_fit_decreasing(counts: dict[int, int], limit: int = LIMIT) -> list[Run]:
    """Pack pieces given as counts of their lengths, longest first, each where it fits most tightly.

    Sequences filled alike are one group, a range of numbers; a group is split where pieces of a
    length run out. So steps and groups depend on the lengths only, and the packing is that of
    best-fit-decreasing over the single pieces.
    """
    tree = CapacityTree(limit)
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first, number)
    runs: list[Run] = []
    opened = 0

    def put_back(room: int, first: int, number: int) -> None:
        groups[room].append((first, number))
        tree.add(room, 1)

    for length in sorted(counts, reverse=True):
        number, done = counts[length], 0
        while done < number:
            room = tree.least(length)
            if room is None:
                per = limit // length
                each, rest = divmod(number - done, per)
                # What is left opens sequences that are filled with this length alone.
                for n, k in ((each, per), (1, rest)):
                    if n and k:
                        for j in range(k):
                            runs.append(Run(length, done, n, opened, j * length))
                            done += n
                        put_back(limit - k * length, opened, n)
                        opened += n
                continue
            first, n = groups[room].pop()
            tree.add(room, -1)
            # A sequence that takes a piece is the tightest for the next one, until it has no room.
            per = room // length
            each, rest = divmod(number - done, per)
            for bins, k in ((min(n, each), per), (1 if each < n else 0, rest)):
                if bins and k:
                    for j in range(k):
                        runs.append(Run(length, done, bins, first, limit - room + j * length))
                        done += bins
                    put_back(room - k * length, first, bins)
                    first, n = first + bins, n - bins
            if n:
                put_back(room, first, n)
    return runs


class _Block:
    """Pieces waiting to be packed."""

    def __init__(self, limit: int, padding: int):
        self.limit, self.padding = limit, padding
        self.pieces: dict[int, list] = defaultdict(list)
        self.tokens = 0

    def add(self, row, ids: np.ndarray) -> None:
        for piece, start in enumerate(range(0, len(ids), self.limit)):
            part = ids[start : start + self.limit]
            self.pieces[len(part)].append((row, piece, start, part))
            self.tokens += len(part)

    def packed(self):
        """Segments of each sequence, in the order of their offsets."""
        sequences = defaultdict(list)
        for run in best_fit_decreasing({k: len(v) for k, v in self.pieces.items()}, self.limit):
            for i in range(run.number):
                sequences[run.sequence + i].append((run.offset, self.pieces[run.length][run.first + i]))
        for _, segments in sorted(sequences.items()):
            yield [s for _, s in sorted(segments, key=lambda x: x[0])]

    def rows(self):
        """Columns of the matrix rows, a few hundred sequences at a time."""
        out: list[tuple] = []
        for segments in self.packed():
            matrix = np.full(self.limit, self.padding, "<u4")
            positions = np.zeros(self.limit, "<u2")
            ends = [0]
            for _, _, _, ids in segments:
                a, b = ends[-1], ends[-1] + len(ids)
                matrix[a:b] = ids
                positions[a:b] = np.arange(b - a)
                ends.append(b)
            rows, numbers, starts, _ = zip(*segments)
            out.append((ends[-1], matrix.tobytes(), ends, positions.tobytes(), rows, numbers, starts))
            if len(out) == 512:
                yield list(zip(*out))
                out = []
        if out:
            yield list(zip(*out))


def pack_ids(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = LIMIT,
    padding: int = PADDING,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Pack all documents by best-fit-decreasing and return the rows of the packed id matrix.

    One row per sequence: ``sequence_id, n_tokens``; ``input_ids``, a matrix row of ``limit``
    little-endian unsigned 32-bit ids, padded at its end; ``cu_seqlens``, the cumulative lengths of
    its segments from 0; ``position_ids``, ``limit`` unsigned 16-bit positions that start again at
    every segment (0 in the padding); and per segment ``doc_ids, pieces, starts``, so that each
    document can be put together again. Documents end with token 0 and are cut without loss where
    longer than ``limit``; a null or empty text is that token alone. Repeated rows are each packed.
    An empty table gives no rows.

    Every task packs its documents in blocks of about ``block_tokens`` tokens, so ids are not
    shuffled and memory is bounded; only the last sequences of a block are less than full.
    """
    if not 0 < limit <= 1 << 16:
        raise ValueError("limit must be between 1 and 65536")
    slim = texts(docs, doc_id, text)
    kind = slim.schema["doc_id"].dataType

    def pack(batches):
        encode = kept_encoder(tokenizer)
        first = TaskContext.get().partitionId() << 33
        block = _Block(limit, padding)

        def flush():
            nonlocal first, block
            for columns in block.rows():
                n = len(columns[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(first, first + n), pa.int64()), *map(pa.array, columns, shapes)], names=NAMES
                )
                first += n
            block = _Block(limit, padding)

        for batch in batches:
            for row, ids in zip(batch["doc_id"].to_pylist(), encode.all(batch["text"])):
                block.add(row, ids)
                if block.tokens >= block_tokens:
                    yield from flush()
        yield from flush()

    ints = pa.list_(pa.int32())
    shapes = [pa.int32(), pa.binary(), ints, pa.binary(), pa.list_(to_arrow_type(kind)), ints, pa.list_(pa.int64())]
    return slim.mapInArrow(
        pack,
        f"sequence_id long, n_tokens int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
        f"doc_ids array<{kind.simpleString()}>, pieces array<int>, starts array<long>",
    )


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet."""
    packed.write.parquet(path)
