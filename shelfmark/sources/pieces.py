"""Tables in pieces, of which a change writes only those it touches.

The rows lie in a table partitioned by the number of their piece, and a small table lists the pieces
that count, with what is known of each. A change never writes into a piece: it adds the rows of the
pieces it touches under numbers not used before and then publishes a new list, which is one switch
of a view. So bytes written follow the change, readers see either state whole, and what a failed
change leaves behind is in no list and goes with the next one. One writer at a time is assumed.

Many small pieces would be as many folders and files. A packed table is partitioned by packs instead,
each a range of PACKED piece numbers, and the number of a row's piece is a column; a change begins a
pack of its own. A pack goes when none of its pieces counts any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import _quoted, _versions, write_table

PIECE = "piece"
PACK = "piece_pack"
PACKED = 64
ROWS, LIST = "__rows", "__pieces"


def pieces(spark: SparkSession, name: str) -> DataFrame | None:
    """The list of pieces that count, None if there is no such table."""
    return spark.table(name + LIST) if spark.catalog.tableExists(name + LIST) else None


def rows_in(spark: SparkSession, name: str, wanted: DataFrame | None = None) -> DataFrame:
    """Rows of the pieces that count, or of the ``wanted`` ones; others are not read."""
    listed = wanted if wanted is not None else pieces(spark, name)
    # The comparison is what lets Spark prune partitions by the join at run time.
    listed = listed.where(F.col(PIECE) >= 0).select(PIECE)
    rows = spark.table(name + ROWS)
    listed = with_pack(listed, rows)
    return rows.join(listed, listed.columns, "left_semi").drop(PACK)


def with_pack(listed: DataFrame, rows: DataFrame) -> DataFrame:
    """A list whose first column is a number of pieces, with their packs if ``rows`` lie in packs."""
    return listed.withColumn(PACK, _pack(listed.columns[0])) if PACK in rows.columns else listed


def _pack(piece: str) -> Column:
    return F.expr(f"cast(`{piece}` div {PACKED} as int)")


def is_packed(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name + ROWS) and PACK in spark.table(name + ROWS).columns


def next_piece(spark: SparkSession, name: str) -> int:
    """A number above those of all pieces, whether listed, listed before or left by a failed change."""
    listed = pieces(spark, name)
    highest = listed.agg(F.max(PIECE)).first()[0] if listed is not None else None
    size = PACKED if is_packed(spark, name) else 1
    there = [n * size + size - 1 for n in _there(spark, name)]
    return -(-(1 + max([-1 if highest is None else highest, *there])) // size) * size


def _there(spark: SparkSession, name: str) -> set[int]:
    """Numbers of the pieces, or packs, that have rows: one for each, as the catalog itself holds."""
    if not spark.catalog.tableExists(name + ROWS):
        return set()
    return {int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {_quoted(name + ROWS)}").collect()}


def add_rows(df: DataFrame, name: str, path: str | None = None, packed: bool = False) -> None:
    """Add rows of new pieces; they count once a list with them is published.

    ``packed`` says how a new table is laid out; one that is there stays as it is. The rebalance hint
    brings the rows of a piece together, and lets adaptive execution split a piece that holds many of
    them over several tasks.
    """
    spark, by = df.sparkSession, PIECE
    if is_packed(spark, name) if spark.catalog.tableExists(name + ROWS) else packed:
        df, by = df.withColumn(PACK, _pack(PIECE)), PACK
    writer = df.hint("rebalance", by).write.mode("append").partitionBy(by)
    if path is not None:
        writer = writer.option("path", f"{path.rstrip('/')}/rows")
    writer.saveAsTable(name + ROWS)


def publish(listed: DataFrame, name: str, columns: list[str], path: str | None = None) -> DataFrame:
    """Make ``listed`` the list of pieces that count and ``name`` a view of their rows."""
    spark = listed.sparkSession
    write_table(listed, name + LIST, path=path and f"{path.rstrip('/')}/pieces")
    names = ", ".join(f"r.`{c}`" for c in columns)
    pack = f" AND r.{PACK} = cast(l.{PIECE} div {PACKED} as int)" if is_packed(spark, name) else ""
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(name)} AS SELECT {names} FROM {_quoted(name + ROWS)} AS r "
        f"LEFT SEMI JOIN {_quoted(name + LIST)} AS l ON r.{PIECE} = l.{PIECE} AND l.{PIECE} >= 0{pack}"
    )
    return spark.table(name)


def tidy(spark: SparkSession, name: str) -> None:
    """Drop the pieces that neither the present list nor the one before it names."""
    there, by = _there(spark, name), PACK if is_packed(spark, name) else PIECE
    for _, version in _versions(spark, name + LIST):
        number = _pack(PIECE) if by == PACK else F.col(PIECE)
        there -= {r[0] for r in spark.table(version).select(number).distinct().collect()}
    stale = sorted(there)
    for start in range(0, len(stale), 500):
        parts = ", ".join(f"PARTITION ({by}={n})" for n in stale[start : start + 500])
        spark.sql(f"ALTER TABLE {_quoted(name + ROWS)} DROP IF EXISTS {parts}")
