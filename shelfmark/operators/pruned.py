"""Exact top-k search that joins only those groups of queries and cells of a corpus that can matter.

Each corpus vector belongs to a cell with a pivot, and the cell knows its least similar member. Equal
queries are asked once; the others form groups of those nearest to the same pivot, and a group knows
its own least similar member. By the triangle inequality of angles no score between a group and a
cell exceeds

    cos(angle between their pivots - reach of the group - reach of the cell).

Every group first meets the cells around it that fill k; then only cells whose bound reaches the
worst k-th score of the group. Pivots, groups and pairs are all rows of DataFrames: nothing about
cells or queries is on the driver, whatever their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.pieces import with_pack
from ..sources.shared import stored
from .catalogue import KEY
from .similarity import QUERIES, ROWS, SCORES, best_of, cosines, matrix_of, query_vectors, ranked, unit, usable

SLACK = 1e-7
CELL_ROWS = 4096
# Queries of a bundle and corpus rows of a lot, between which pairs are dealt out.
BUNDLE = 4096
LOT = 32_768


def _packed(rows: DataFrame) -> DataFrame:
    """(ids, data): up to ROWS rows of (id, array of doubles) in a block."""
    kind = rows.schema[0].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                one = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(one, c) for c in part.columns], names=["ids", "data"]
                )

    return rows.mapInArrow(pack, f"ids array<{kind}>, data array<array<double>>")


def met(rows: DataFrame, cells: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(ids, matrix, cell ids, cell matrix)`` for each two blocks of rows and of cells.

    Both have (id, array of doubles). The join has no key: blocks of cells are there once, however
    many tasks or shuffle partitions there are. Few of them Spark broadcasts, else it pairs the
    partitions of both sides.
    """
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The first block of a task has its number added, or all first blocks would share a slot.
    turn = F.monotonically_increasing_id() + F.spark_partition_id()
    left = _packed(rows).withColumn("slot", F.pmod(turn, F.lit(slots)).cast("int")).repartition("slot")
    # One batch of cells from one task makes few blocks; their number is that of the cells by ROWS.
    right = stored(_packed(cells), "cell-blocks").select(F.col("ids").alias("cell_ids"), F.col("data").alias("cell_data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, cell_ids, cell_data in zip(*batch.columns):
                cell_matrix, cell_ids = matrix_of(cell_data.values), cell_ids.values
                ids, matrix = ids.values, matrix_of(data.values)
                step = max(1, SCORES // max(1, len(cell_matrix)))
                for start in range(0, len(matrix), step):
                    yield from work(ids.slice(start, step), matrix[start : start + step], cell_ids, cell_matrix)

    pairs = left.select("ids", "data").crossJoin(right)
    return pairs.mapInArrow(run, schema)


def nearest_cells(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """(id, cell, near) for (id, vector) and (cell, unit pivot): the most similar pivot, of equal ones the first."""
    name, kind = rows.columns[0], rows.schema[0].dataType.simpleString()

    def work(ids, vectors, cell_ids, pivots):
        near = unit(vectors) @ pivots.T
        best = near.argmax(axis=1)
        yield pa.RecordBatch.from_arrays(
            [ids, cell_ids.take(pa.array(best)), pa.array(near[np.arange(len(best)), best])], names=[name, "cell", "near"]
        )

    found = met(rows, cells.select("cell", "pivot"), work, f"`{name}` {kind}, cell int, near double")
    best = F.max(F.struct("near", (-F.col("cell")).alias("cell"))).alias("best")
    return found.groupBy(name).agg(best).select(name, (-F.col("best.cell")).alias("cell"), F.col("best.near").alias("near"))


def pivots_of(corpus: DataFrame, number: int, key: str = KEY, vector: str = "embedding") -> DataFrame:
    """(cell, pivot): unit vectors of ``number`` rows, the first in order of their hashed keys."""
    first = usable(corpus, key, vector).orderBy(F.xxhash64(key), key).limit(number)
    numbered = first.select(
        (F.row_number().over(Window.orderBy(F.xxhash64(key), key)) - 1).alias("cell"), F.col(vector).alias("pivot")
    )
    return with_unit(numbered, "pivot")


def with_unit(df: DataFrame, column: str) -> DataFrame:
    """A vector column as doubles of length 1, of length 0 where it has none."""
    x = F.col(column).cast("array<double>")
    length = F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, b: a + b * b))
    usable_length = F.when((length > 0) & (length < float("inf")), length)
    # In a list of one, the length is computed once for a row and not for each of its numbers.
    scaled = F.transform(F.array(usable_length), lambda n: F.transform(x, lambda e: F.coalesce(e / n, F.lit(0.0))))
    return df.withColumn(column, F.get(scaled, F.lit(0)))


def measured(rows: DataFrame, cells: DataFrame, key: str, vector: str, *more: Column) -> DataFrame:
    """(cell, pivot, rows, least_near, ...) of the cells that (key, vector, cell, ...) rows lie in."""
    names = [f.name for f in cells.select("cell", "pivot").schema]
    joined = rows.join(cells.select(*names), "cell")
    inner = F.aggregate(
        F.arrays_zip(F.col(vector).cast("array<double>").alias("a"), F.col("pivot").alias("b")), F.lit(0.0),
        lambda total, pair: total + pair["a"] * pair["b"],
    )
    length = F.sqrt(F.aggregate(F.col(vector).cast("array<double>"), F.lit(0.0), lambda a, b: a + b * b))
    near = F.when((length > 0) & (length < float("inf")) & inner.isNotNull(), inner / length).otherwise(0.0)
    known = joined.withColumn("_near", near).groupBy("cell").agg(
        F.first("pivot").alias("pivot"), F.count(F.lit(1)).alias("rows"), F.min("_near").alias("least_near"), *more
    )
    return known


def _reach(near: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(near, -1, 1))


def grouped(asked: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (group, home, least_near, queries) of (key, vector), and (key, group) of each query."""
    key = asked.columns[0]
    homes = stored(asked.join(nearest_cells(asked, cells), key), "homes")
    sizes = homes.groupBy("cell").agg(F.count(F.lit(1)).alias("_all"))
    number = F.greatest(F.lit(1), F.expr(f"(_all + {QUERIES - 1}) div {QUERIES}"))
    block = F.pmod(F.xxhash64(key), number)
    member = homes.join(sizes, "cell").select(key, "_vector", "near", "cell", F.concat_ws("-", "cell", block).alias("group"))
    groups = member.groupBy("group").agg(
        F.first("cell").alias("home"), F.min("near").alias("least_near"),
        F.collect_list(F.struct(key, "_vector")).alias("queries"),
    )
    return stored(groups, "query-groups"), member.select(key, "group")


def _around(groups: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """(group, cell): the cells nearest to the home of a group that hold k rows together."""

    def work(ids, homes, cell_ids, data):
        pivots, sizes = data[:, :-1], data[:, -1].astype(np.int64)
        angles = _reach(homes @ pivots.T)
        order = np.argsort(angles, axis=1, kind="stable")
        filled = np.cumsum(sizes[order], axis=1) - sizes[order] < k
        row, place = np.nonzero(filled)
        chosen = order[row, place]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row)), cell_ids.take(pa.array(chosen)), pa.array(angles[row, chosen]), pa.array(sizes[chosen])],
            names=["home", "cell", "angle", "rows"],
        )

    homes = groups.select("home").distinct().join(cells.select(F.col("cell").alias("home"), "pivot"), "home")
    sized = cells.select("cell", F.concat("pivot", F.array(F.col("rows").cast("double"))).alias("data"))
    found = met(homes, sized, work, "home int, cell int, angle double, rows long")
    order = Window.partitionBy("home").orderBy("angle", "cell")
    before = F.sum("rows").over(order) - F.col("rows")
    near = found.withColumn("before", before).where(F.col("before") < k).select("home", "cell")
    return groups.select("group", "home").join(near, "home").select("group", "cell")


def _within(groups: DataFrame, cells: DataFrame) -> DataFrame:
    """(group, cell) whose bound reaches the ``worst`` score of the group."""

    def work(ids, data, cell_ids, cell_data):
        homes, least, worst = data[:, :-2], data[:, -2], data[:, -1]
        pivots, cell_least = cell_data[:, :-1], cell_data[:, -1]
        apart = _reach(homes @ pivots.T) - _reach(least)[:, None] - _reach(cell_least)[None, :]
        row, column = np.nonzero(np.cos(np.maximum(0, apart - SLACK)) >= worst[:, None] - SLACK)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row)), cell_ids.take(pa.array(column))], names=["group", "cell"]
        )

    homes = groups.join(cells.select(F.col("cell").alias("home"), "pivot"), "home")
    left = homes.select("group", F.concat("pivot", F.array("least_near", "worst")))
    right = cells.select("cell", F.concat("pivot", F.array("least_near")))
    return met(left, right, work, "group string, cell int")


def _bundled(groups: DataFrame) -> tuple[DataFrame, int]:
    """(bundle, members) of about BUNDLE queries each, and how many bundles there are."""
    total = groups.agg(F.sum(F.size("queries"))).first()[0] or 0
    number = max(1, -(-total // BUNDLE))
    bundle = F.pmod(F.xxhash64("group"), F.lit(number)).alias("bundle")
    packed = groups.groupBy(bundle).agg(F.collect_list(F.struct("group", "queries")).alias("members"))
    return stored(packed, "query-bundles"), number


def _laid(rows: DataFrame, key: str, vector: str, lots: int) -> DataFrame:
    """(lot, cells, keys, vectors): up to ROWS rows of a lot, which has every so many-th cell, by cell."""
    kind = rows.schema[key].dataType.simpleString()
    lot = F.pmod("cell", F.lit(lots)).cast("int").alias("lot")
    known = rows.select(lot, "cell", key, vector).hint("rebalance", "lot").sortWithinPartitions("lot", "cell")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(given)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                for start in range(a, b, ROWS):
                    part = batch.slice(start, min(ROWS, b - start))
                    one = pa.array([0, part.num_rows], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(given[start : start + 1]), *(pa.ListArray.from_arrays(one, c) for c in part.columns[1:])],
                        names=["lot", "cells", "keys", "vectors"],
                    )

    return known.mapInArrow(pack, f"lot int, cells array<int>, keys array<{kind}>, vectors array<array<float>>")


def _met_scores(schema: T.StructType, k: int, counter: Accumulator | None):
    """The k best of each query among those rows of a block whose cells its group is to meet."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def found(keys: list, vectors: np.ndarray, names: list, asked: np.ndarray) -> pa.RecordBatch:
        out: list[list] = [[], [], []]
        step = max(1, SCORES // max(1, len(keys)))
        for start in range(0, len(names), step):
            for name, row in zip(names[start:], cosines(unit(asked[start : start + step]), vectors)):
                chosen = best_of(row, keys, k)
                out[0] += [name] * len(chosen)
                out[1] += [keys[i] for i in chosen]
                out[2] += [float(row[i]) for i in chosen]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=field.type) for c, field in zip(out, arrow)], schema=arrow
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells, keys, vectors, asked in zip(*batch.columns):
                own, keys, vectors = cells.values.to_numpy(), keys.as_py(), matrix_of(vectors.values)
                wanted, queries = asked.values.field("cells"), asked.values.field("queries")
                for i in range(len(wanted)):
                    at = np.flatnonzero(np.isin(own, wanted[i].values.to_numpy()))
                    if not len(at):
                        continue
                    members = queries[i].values
                    names = members.field(0).to_pylist()
                    if counter is not None:
                        counter.add(len(at) * len(names))
                    every = len(at) == len(own)
                    yield found(
                        keys if every else [keys[j] for j in at], vectors if every else vectors[at],
                        names, matrix_of(members.field(1), vectors.shape[1]),
                    )

    return run


def _searched(
    rows: DataFrame, pairs: DataFrame, bundles: DataFrame, number: int, total: int, key: str, vector: str,
    query_key: str, k: int, where: Column | None, counter: Accumulator | None,
) -> DataFrame:
    """The k best rows of each query in the cells its group is paired with; no other cell is read.

    Cells go together in lots of about LOT rows, groups in ``number`` bundles of about BUNDLE queries.
    A group's queries are sent once for each lot with a cell it meets, so what is shuffled grows with
    queries times lots, not with queries times cells. Where lots are fewer than shuffle partitions,
    their rows are sent to several parts of the bundles.
    """
    lots = max(1, -(-total // LOT))
    parts = min(number, -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // lots))
    part = F.pmod("bundle", F.lit(parts)).cast("int").alias("part")
    meets = pairs.groupBy("group", F.pmod("cell", F.lit(lots)).cast("int").alias("lot")).agg(
        F.collect_list("cell").alias("cells")
    )
    meets = meets.groupBy(F.pmod(F.xxhash64("group"), F.lit(number)).alias("bundle"), "lot").agg(
        F.map_from_entries(F.collect_list(F.struct("group", "cells"))).alias("meets")
    )
    members = F.filter("members", lambda m: F.map_contains_key("meets", m["group"]))
    asked = F.transform(members, lambda m: F.struct(F.col("meets")[m["group"]].alias("cells"), m["queries"].alias("queries")))
    blocks = meets.join(bundles, "bundle").select("lot", part, asked.alias("asked"))
    wanted = with_pack(pairs.where("cell >= 0").select("cell").distinct(), rows)
    held = rows.join(wanted, wanted.columns, "left_semi")
    laid = _laid(usable(held if where is None else held.where(where), key, vector, "cell"), key, vector, lots)
    copies = laid.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    schema = T.StructType([
        T.StructField(query_key, bundles.schema["members"].dataType.elementType["queries"].dataType.elementType[0].dataType),
        T.StructField(key, laid.schema["keys"].dataType.elementType), T.StructField("score", T.DoubleType()),
    ])
    # Spark takes the copies for no larger than one and would broadcast them; a merge needs no side in memory.
    both = blocks.join(copies.hint("merge"), ["lot", "part"]).select("cells", "keys", "vectors", "asked")
    return ranked(both.mapInArrow(_met_scores(schema, k, counter), schema), k)


def best_matches_in_cells(
    rows: DataFrame,
    cells: DataFrame,
    queries: DataFrame,
    k: int = 3,
    key: str = KEY,
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "embedding",
    where: Column | None = None,
    counter: Accumulator | None = None,
) -> DataFrame:
    """What ``best_matches`` finds, joining only groups of queries and cells that can hold a match.

    ``rows`` (key, vector, cell) are laid out by cell, so a cell that no group meets is not read;
    ``cells`` has (cell, unit pivot, rows, least_near). ``where`` limits the rows searched. Queries
    without a vector are left out; query keys must be distinct. ``counter`` adds up the scores
    computed (more if tasks are run again).
    """
    twice = F.raise_error(F.lit("query keys must be distinct"))
    one = F.when(F.count(F.lit(1)) > 1, twice).otherwise(F.min("_vector")).alias("_vector")
    asked = stored(query_vectors(queries, query_key, query_vector).groupBy(query_key).agg(one), "queries")
    # Equal vectors are asked once, under the smallest of their keys.
    first = stored(asked.groupBy("_vector").agg(F.min(query_key).alias(query_key)).select(query_key, "_vector"), "query-vectors")
    cells = stored(cells.select(F.col("cell").cast("int"), "pivot", "rows", "least_near"), "cells")
    groups, member = grouped(first, cells)
    around = stored(_around(groups, cells, k), "pairs")
    bundles, number = _bundled(groups)
    total = cells.agg(F.sum("rows")).first()[0] or 0

    def searched(pairs: DataFrame) -> DataFrame:
        return _searched(rows, pairs, bundles, number, total, key, vector, query_key, k, where, counter)

    found = stored(searched(around), "matches")
    last = found.where(F.col("rank") == k).select(query_key, F.col("score").alias("_last"))
    worst = member.join(last, query_key, "left").groupBy("group").agg(
        F.min(F.coalesce("_last", F.lit(float("-inf")))).alias("worst")
    )
    more = _within(groups.select("group", "home", "least_near").join(worst, "group"), cells)
    rest = stored(more.join(around, ["group", "cell"], "left_anti"), "pairs")
    best = ranked(found.unionByName(searched(rest)).drop("rank"), k)
    same = asked.join(first.select(F.col(query_key).alias("_first"), "_vector"), "_vector").select(query_key, "_first")
    return same.join(best.withColumnRenamed(query_key, "_first"), "_first").select(query_key, "rank", key, "score")


def best_matches_of_many(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 3,
    key: str = KEY,
    vector: str = "embedding",
    query_key: str = "query_id",
    query_vector: str = "embedding",
    cell_rows: int = CELL_ROWS,
    counter: Accumulator | None = None,
) -> DataFrame:
    """``best_matches`` for many queries over a corpus without a layout: it is laid out by cell first.

    Worth its while where there are many more queries than cells. The layout is written to the shared
    folder, once, and lives as long as what ``stored`` writes.
    """
    known = stored(usable(corpus, key, vector), "corpus")
    number = max(1, -(-known.count() // cell_rows))
    pivots = stored(pivots_of(known, number, key, vector), "pivots")
    near = nearest_cells(known.select(key, F.col(vector).cast("array<double>")), pivots)
    laid = known.join(near.select(key, "cell"), key)
    rows = stored(laid.hint("rebalance", "cell"), "corpus-cells", by="cell")
    cells = measured(rows, pivots, key, vector)
    return best_matches_in_cells(rows, cells, queries, k, key, vector, query_key, query_vector, counter=counter)
