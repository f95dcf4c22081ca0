"""A search index kept by cell, which a sync brings up to date by writing only the cells it touches.

Rows lie in the cell of a similar pivot (``pieces.py`` keeps cells as pieces of a table, small ones in
packs that are read together; of a pack whose cells have mostly been written anew the others are too).
For every cell the list of cells has its pivot, its number of rows, the similarity of its least similar member
and, for each attribute, a bitmap of the hashed values that occur. A sync embeds new and changed
texts, sends them to their nearest pivots and writes the touched cells anew under new numbers; cells
with too many rows are split in two by two-means, as often as needed: each in one task that makes all
its cuts, after cells too large for a task have been cut over all tasks. Bounds hold whichever cell a
row is in, so searches stay exact however cells were split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import pieces
from ..sources.shared import stored
from .catalogue import KEY, deduplicate
from .embedding import Embedder, with_embedding
from .index import TEXT, indexable
from .pruned import best_matches_in_cells, measured, nearest_cells, pivots_of, with_unit
from .similarity import matrix_of, unit

CELL_ROWS = 16_384
# Rounds of two-means for a split.
ROUNDS = 3
# Numbers in the vectors of a cell that one task cuts by itself; larger cells are first cut over all tasks.
NUMBERS = 1 << 21
# Rows of a pack, in which cells smaller than that are kept together.
PACK_ROWS = 16_384
# No half of a cut within a task has less than one in so many of the rows, so cuts never go deep.
LEAST = 16
# Bits of the bitmap of an attribute, as many as one bitmap aggregate has.
BITS = 32_768


@dataclass
class KeptCells:
    """Rows (key, text_hash, marks_hash, attributes, embedding, cell, pack if there are any) and cells of a kept index."""

    rows: DataFrame
    cells: DataFrame
    key: str
    attributes: list[str]


def _bitmap(attribute: str) -> str:
    return f"has_{attribute}"


def _bit(value: Column) -> Column:
    """The place of a value in a bitmap; null has one too."""
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit("\0null"))), F.lit(BITS))


def _bitmaps(attributes: Sequence[str]) -> list[Column]:
    return [F.bitmap_construct_agg(_bit(F.col(f"`{a}`"))).alias(_bitmap(a)) for a in attributes]


def _may_hold(attribute: str, values: Sequence) -> Column:
    """Whether a cell's bitmap has the bit of one of the values."""
    if not values:
        return F.lit(False)
    tests = []
    for value in values:
        bit = _bit(F.lit(value))
        byte = F.conv(F.hex(F.substring(F.col(_bitmap(attribute)), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
        tests.append(F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1)
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def _one_of(attribute: str, values: Sequence) -> Column:
    test = F.lit(False)
    for value in values:
        test = test | F.col(f"`{attribute}`").eqNullSafe(F.lit(value))
    return test


def open_cells(spark: SparkSession, name: str) -> KeptCells:
    """The kept index ``name`` as it stands."""
    listed = pieces.pieces(spark, name)
    if listed is None:
        raise ValueError(f"no kept index {name}")
    attributes = [c.removeprefix("has_") for c in listed.columns if c.startswith("has_")]
    rows = spark.table(name + pieces.ROWS).withColumnRenamed(pieces.PIECE, "cell")
    return KeptCells(rows, listed.withColumnRenamed(pieces.PIECE, "cell"), rows.columns[0], attributes)


def sync_cells(
    source: DataFrame,
    name: str,
    make_embedder: Callable[[], Embedder],
    key: str = KEY,
    text: str = TEXT,
    attributes: Sequence[str] = (),
    cell_rows: int = CELL_ROWS,
    partitions: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Bring the kept index ``name`` in step with the source, creating it if absent; returns the changes.

    A change is ``insert``, ``update`` (another text, embedded anew), ``relabel`` (other attributes,
    the vector stays) or ``delete``. Of copies of a key one row counts. The view ``name`` has the
    rows. No cell has more than ``cell_rows`` rows afterwards. A failed sync leaves the index as it
    was, and the next one does its work.
    """
    spark = source.sparkSession
    pieces.tidy(spark, name)
    listed = pieces.pieces(spark, name)
    marks = F.xxhash64(*(F.col(f"`{a}`") for a in attributes)) if attributes else F.lit(0).cast("long")
    wanted = indexable(source, key, text).select(
        key, text, F.xxhash64(text).alias("text_hash"), marks.alias("marks_hash"), *(f"`{a}`" for a in attributes)
    )
    once = deduplicate(wanted, key, [F.col("text_hash").desc(), F.col("marks_hash").desc()])
    columns = [key, "text_hash", "marks_hash", *attributes, "embedding"]
    before = open_cells(spark, name) if listed is not None else None
    if before is not None and before.attributes != list(attributes):
        raise ValueError(f"the index {name} is kept with the attributes {before.attributes}")
    if before is None or before.cells.isEmpty():
        fresh = stored(_embedded(once, make_embedder, text, partitions).select(*columns), "index-fresh")
        number = max(1, -(-fresh.count() // cell_rows))
        starts = stored(pivots_of(fresh, number, key).withColumn("cell", F.col("cell").cast("int")), "pivots")
        _write(spark, name, _placed(fresh, starts, key), starts, None, key, columns, attributes, cell_rows, path)
        return fresh.select(key, F.lit("insert").alias("change"))
    live = pieces.rows_in(spark, name).withColumnRenamed(pieces.PIECE, "cell")
    old = live.select(key, F.col("text_hash").alias("_text"), F.col("marks_hash").alias("_marks"), "cell")
    new = once.select(key, "text_hash", "marks_hash")
    change = (
        F.when(F.col("_text").isNull(), "insert").when(F.col("text_hash").isNull(), "delete")
        .when(F.col("text_hash") != F.col("_text"), "update").when(F.col("marks_hash") != F.col("_marks"), "relabel")
    )
    both = new.join(old, key, "full_outer").select(key, change.alias("change"), "text_hash", "marks_hash", "cell")
    changes = stored(both.where("change IS NOT NULL"), "index-changes")
    if changes.isEmpty():
        return changes.select(key, "change")
    asked = changes.where("change <> 'delete'").select(
        F.col(key).alias("_key"), "change", F.col("text_hash").alias("_text"), F.col("marks_hash").alias("_marks")
    )
    # A source that has changed again since the diff is left for the next sync.
    same = (F.col(key) == F.col("_key")) & (F.col("text_hash") == F.col("_text")) & (F.col("marks_hash") == F.col("_marks"))
    arrived = stored(once.join(asked, same).drop("_key", "_text", "_marks"), "index-arrived")
    fresh = _embedded(arrived.where("change <> 'relabel'").drop("change"), make_embedder, text, partitions)
    fresh = stored(fresh.select(*columns), "index-fresh")
    left = fresh.select(key).union(arrived.where("change = 'relabel'").select(key)).union(
        changes.where("change = 'delete'").select(key)
    )
    placed = _placed(fresh, before.cells, key)
    touched = changes.join(left, key, "left_semi").where("cell IS NOT NULL").select("cell").union(placed.select("cell")).distinct()
    if pieces.is_packed(spark, name):
        touched = _with_thin_packs(stored(touched, "touched"), before.cells)
    touched = stored(touched, "touched")
    held = pieces.rows_in(spark, name, touched.withColumnRenamed("cell", pieces.PIECE))
    held = held.withColumnRenamed(pieces.PIECE, "cell").select(*columns, "cell")
    kept = held.join(left, key, "left_anti")
    relabelled = held.select(key, "embedding", "cell").join(
        arrived.where("change = 'relabel'").select(key, "text_hash", "marks_hash", *attributes), key
    )
    rows = stored(kept.unionByName(relabelled.select(*columns, "cell")).unionByName(placed), "cells-held")
    _write(spark, name, rows, before.cells, touched, key, columns, attributes, cell_rows, path)
    return changes.select(key, "change")


def _with_thin_packs(touched: DataFrame, cells: DataFrame) -> DataFrame:
    """Cells to be written anew, and those of packs of which less than half is left without them."""
    left = cells.select("cell", "pack_cells").join(touched, "cell", "left_anti")
    pack = F.expr(f"cell div {pieces.PACKED}").alias("pack")
    thin = left.groupBy(pack).agg(F.count(F.lit(1)).alias("n"), F.max("pack_cells").alias("all")).where("2 * n < all")
    return touched.union(left.select("cell", pack).join(thin.select("pack"), "pack", "left_semi").select("cell"))


def _embedded(rows: DataFrame, make_embedder, text: str, partitions: int | None) -> DataFrame:
    rows = rows if partitions is None else rows.repartition(partitions)
    return with_embedding(rows, make_embedder, text)


def _placed(fresh: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    vectors = fresh.select(key, F.col("embedding").cast("array<double>"))
    near = nearest_cells(vectors, cells.select("cell", "pivot"))
    return stored(fresh.join(near.select(key, "cell"), key), "index-placed")


def _write(
    spark: SparkSession, name: str, rows: DataFrame, cells: DataFrame, touched: DataFrame | None, key: str,
    columns: list[str], attributes: Sequence[str], cell_rows: int, path: str | None,
) -> None:
    """Write stored rows of touched cells as new cells, split where they are too many, and publish the list."""
    rows, pivots = _split(rows, cells.select(F.col("cell").cast("int"), "pivot"), key, cell_rows)
    base = pieces.next_piece(spark, name)
    packed = pieces.is_packed(spark, name) or not spark.catalog.tableExists(name + pieces.ROWS)
    # A pack takes cells for about PACK_ROWS rows: the larger they are, the more numbers are left out between them.
    step = min(pieces.PACKED, max(1, cell_rows * pieces.PACKED // PACK_ROWS)) if packed else 1
    used = rows.select("cell", "_part").distinct()
    number = ((F.row_number().over(Window.orderBy("cell", "_part")) - 1) * step + base).cast("int").alias("_new")
    numbers = stored(used.select("cell", "_part", number), "cell-numbers")
    moved = rows.join(numbers, ["cell", "_part"]).withColumn("cell", F.col("_new")).select(*columns, "cell")
    pivots = pivots.join(numbers, ["cell", "_part"]).select(F.col("_new").alias("cell"), "pivot")
    about = measured(moved, pivots, key, "embedding", *_bitmaps(attributes))
    if packed:
        pack = F.expr(f"_new div {pieces.PACKED}")
        sizes = numbers.select(F.col("_new").alias("cell"), F.count(F.lit(1)).over(Window.partitionBy(pack)).alias("pack_cells"))
        about = about.join(sizes, "cell")
    if touched is not None:
        about = cells.join(touched, "cell", "left_anti").select(*about.columns).unionByName(about)
    pieces.add_rows(moved.withColumnRenamed("cell", pieces.PIECE), name, path, packed)
    pieces.publish(about.withColumnRenamed("cell", pieces.PIECE), name, columns, path)
    pieces.tidy(spark, name)


def _split(rows: DataFrame, cells: DataFrame, key: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows with the ``_part`` of their cell, and pivots of (cell, part): no part has more than ``limit`` rows.

    A cell that a task can hold is cut there, as often as needed, so the number of jobs does not follow
    the number of cuts. Only larger cells go through rounds that cut each of them in two over all tasks;
    the rows of other cells are not written again.
    """
    cells = stored(cells, "cells-pivots")
    one = rows.select(F.size("embedding")).first()
    within = max(limit, NUMBERS // max(1, one[0])) if one else limit
    parts, large = [], _larger(rows, within)
    while not large.isEmpty():
        parts.append(rows.join(large, "cell", "left_anti"))
        rows, cells = _halved(stored(rows.join(large, "cell"), "cells-split"), cells, large, key)
        large = _larger(rows, within)
    for part in parts:
        rows = rows.unionByName(part)
    cut = stored(_cut(rows, key, limit), "cells-cut")
    new = cut.where(F.col("_pivot").isNotNull()).select("cell", "_part", F.col("_pivot").alias("pivot"))
    same = cells.join(new.select("cell").distinct(), "cell", "left_anti").select("cell", F.lit(0).alias("_part"), "pivot")
    return cut.drop("_pivot"), same.unionByName(new)


def _larger(rows: DataFrame, limit: int) -> DataFrame:
    """The cells with more than ``limit`` rows."""
    sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("_rows"))
    return stored(sizes.where(F.col("_rows") > limit).select("cell"), "cells-large")


def _halved(rows: DataFrame, cells: DataFrame, large: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Every one of the ``large`` cells, whose rows are given, cut in two under new numbers; and all cells.

    A row as near to both halves' centres goes by the hash of its key, so that copies of one vector are
    cut as well.
    """
    centres = _two_means(rows, key)
    top = cells.agg(F.max("cell")).first()[0] + 1
    order = Window.orderBy("cell", "side")
    named = stored(
        centres.select(
            "cell", F.explode(F.array(
                F.struct(F.lit(0).alias("side"), F.col("a").alias("pivot")),
                F.struct(F.lit(1).alias("side"), F.col("b").alias("pivot")),
            )).alias("half"),
        ).select("cell", "half.side", "half.pivot").withColumn("_new", (F.row_number().over(order) - 1 + top).cast("int")),
        "cells-halves",
    )
    cut = _sided(rows, centres, key).join(named.select("cell", "side", "_new"), ["cell", "side"])
    cut = cut.withColumn("cell", F.col("_new")).select(*rows.columns)
    cells = stored(
        cells.join(large, "cell", "left_anti").unionByName(named.select(F.col("_new").alias("cell"), "pivot")),
        "cells-pivots",
    )
    return stored(cut, "cells-held"), cells


def _cut(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """Rows with the ``_part`` of their cell, of at most ``limit`` rows; one row of each part of a cut cell has its pivot."""
    more = [T.StructField("_part", T.IntegerType()), T.StructField("_pivot", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*rows.schema, *more])
    names = rows.columns

    def run(table: pa.Table) -> pa.Table:
        part, pivots = np.zeros(table.num_rows, dtype=np.int32), {}
        if table.num_rows > limit:
            vectors = unit(matrix_of(table["embedding"].combine_chunks()))
            part, pivots = _parts(vectors, table["_chance"].to_numpy(), limit)
        placed = pa.array([pivots.get(i) for i in range(table.num_rows)], pa.list_(pa.float64()))
        columns = [*(table[n] for n in names), pa.array(part), placed]
        return pa.Table.from_arrays(columns, names=schema.names)

    hashed = rows.withColumn("_chance", F.xxhash64(key))
    return hashed.groupBy("cell").applyInArrow(run, schema)


def _parts(vectors: np.ndarray, chance: np.ndarray, limit: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """The part of each row, cut in two until none has more than ``limit``, and the unit centre of each part by its first row."""
    part, pivots, open_ = np.zeros(len(vectors), dtype=np.int32), {}, [np.arange(len(vectors))]
    while open_:
        at = open_.pop()
        if len(at) > limit:
            second = _second_half(vectors[at], chance[at])
            open_ += [at[second], at[~second]]
        else:
            part[at] = len(pivots)
            pivots[int(at[0])] = unit(vectors[at].sum(axis=0, keepdims=True))[0]
    return part, pivots


def _second_half(vectors: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Which rows the second of two means gets, after some rounds from two of the rows; rows near to both go by ``chance``."""
    a, b = vectors[chance.argmin()], vectors[chance.argmax()]
    for _ in range(ROUNDS):
        difference = vectors @ (b - a)
        second = np.where(np.abs(difference) < 1e-9, chance & 1, difference > 0).astype(bool)
        # A side without rows keeps its centre.
        a = unit(vectors[~second].sum(axis=0, keepdims=True))[0] if not second.all() else a
        b = unit(vectors[second].sum(axis=0, keepdims=True))[0] if second.any() else b
    difference = np.round(vectors @ (b - a), 9)
    order, least = np.lexsort((chance, difference)), -(-len(vectors) // LEAST)
    middle = int((difference < 0).sum()) + int((difference == 0).sum()) // 2
    second = np.zeros(len(vectors), dtype=bool)
    second[order[min(max(middle, least), len(vectors) - least):]] = True
    return second


def _chance(key: str) -> Column:
    return F.pmod(F.xxhash64(key, "cell"), F.lit(2)).cast("int").alias("chance")


def _nearer(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of a batch, and which of ``a`` and ``b`` is nearer: of equally near ones ``chance``."""
    vectors = unit(matrix_of(batch["embedding"]))
    difference = np.einsum("ij,ij->i", vectors, matrix_of(batch["b"]) - matrix_of(batch["a"]))
    return vectors, np.where(np.abs(difference) < 1e-9, batch["chance"].to_numpy(), difference > 0).astype(np.int32)


def _sided(rows: DataFrame, centres: DataFrame, key: str) -> DataFrame:
    """Rows with ``side`` 0 or 1, the nearer centre of their cell."""
    schema = T.StructType([*rows.schema, T.StructField("side", T.IntegerType())])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sides = pa.array(_nearer(batch)[1])
                yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), sides], names=[*names, "side"])

    return rows.join(centres, "cell").select(*(f"`{n}`" for n in names), "a", "b", _chance(key)).mapInArrow(run, schema)


def _added(rows: DataFrame, key: str) -> DataFrame:
    """(cell, side, total): of each batch the sum of the unit vectors nearer to either centre of a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors, sides = _nearer(batch)
                half = batch["cell"].to_numpy().astype(np.int64) * 2 + sides
                halves, place = np.unique(half, return_inverse=True)
                total = np.zeros((len(halves), vectors.shape[1]))
                np.add.at(total, place, vectors)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((halves // 2).astype(np.int32)), pa.array((halves % 2).astype(np.int32)),
                        pa.array(list(total), pa.list_(pa.float64())),
                    ],
                    names=["cell", "side", "total"],
                )

    slim = rows.select("cell", "embedding", "a", "b", _chance(key))
    return slim.mapInArrow(run, "cell int, side int, total array<double>")


def _two_means(rows: DataFrame, key: str) -> DataFrame:
    """(cell, a, b): unit centres of two halves of each cell, after some rounds from two of its rows.

    Vectors are added up by place, in partial sums per task: no cell's rows meet in one task.
    """
    first = F.struct(F.xxhash64(key), "embedding")
    ends = rows.groupBy("cell").agg(F.min(first).alias("a"), F.max(first).alias("b"))
    centres = ends.select("cell", F.col("a.embedding").alias("a"), F.col("b.embedding").alias("b"))
    centres = stored(with_unit(with_unit(centres, "a"), "b"), "centres")
    for _ in range(ROUNDS):
        parts = _added(rows.join(centres, "cell"), key).select("cell", "side", F.posexplode("total").alias("i", "x"))
        sums = parts.groupBy("cell", "side", "i").agg(F.sum("x").alias("x"))
        lists = sums.groupBy("cell", "side").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("l"))
        means = lists.select("cell", "side", F.transform("l", lambda e: e["x"]).alias("v"))
        both = means.groupBy("cell").agg(
            F.max(F.when(F.col("side") == 0, F.col("v"))).alias("_a"), F.max(F.when(F.col("side") == 1, F.col("v"))).alias("_b")
        )
        # A side without rows keeps its centre.
        moved = centres.join(both, "cell", "left").select(
            "cell", F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")
        )
        centres = stored(with_unit(with_unit(moved, "a"), "b"), "centres")
    return centres


def search_cells(
    kept: KeptCells,
    queries: DataFrame,
    k: int = 3,
    query_key: str = "query_id",
    query_vector: str = "embedding",
    having: Mapping[str, Sequence] | None = None,
    only: DataFrame | None = None,
    counter: Accumulator | None = None,
) -> DataFrame:
    """The k most cosine-similar rows of each query, reading only packs with cells that can hold one.

    ``having`` names values that attributes must have (None for null): cells without any are not
    read. ``only`` has the keys that may be found, for other conditions. The answer is that of a
    search of all rows that qualify.
    """
    unknown = set(having or {}) - set(kept.attributes)
    if unknown:
        raise ValueError(f"the index does not keep the attributes {sorted(unknown)}")
    cells, where = kept.cells, None
    for attribute, values in (having or {}).items():
        cells = cells.where(_may_hold(attribute, values))
        test = _one_of(attribute, values)
        where = test if where is None else where & test
    rows = kept.rows if only is None else kept.rows.join(only.select(kept.key), kept.key, "left_semi")
    return best_matches_in_cells(
        rows, cells, queries, k, kept.key, "embedding", query_key, query_vector, where, counter
    )
