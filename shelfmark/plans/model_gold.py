"""Silver table to model-tagged gold table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import FLAG_KEYS
from ..operators.catalogue import KEY
from ..operators.model import Model, with_model_tags
from ..operators.tag_maps import (
    collect_values, first_rows, flag_rows, value_numbers, with_parsed_tags, with_value_flags,
)
from ..sources import pieces
from ..sources.shared import stored
from ..sources.tables import read_table, write_table

TAGS = "cleaned_tagged_description"
TEXT = "concatenated_text"
ANSWER = "tagged_description"
MOST_COLUMNS = 10_000


def answers_kept(
    spark: SparkSession,
    source: DataFrame,
    memory_table: str,
    make_model: Callable[[dict], Model],
    partitions: int,
    rounds: int = 1,
) -> DataFrame:
    """The source with the model's answers; a text that has one in ``memory_table`` is not asked again.

    Texts are told apart by their SHA-256. Each of ``rounds`` parts is kept once it is answered, so
    a failure costs the answers of one part. A round adds its own answers to the memory and writes
    nothing else; of the memory only the hashes are read to find what is new.
    """
    hashed = source.withColumn("text_hash", F.sha2(TEXT, 256))
    texts = hashed.where(F.col(TEXT).isNotNull()).groupBy("text_hash").agg(F.min(TEXT).alias(TEXT))
    part = F.pmod(F.xxhash64("text_hash"), F.lit(rounds))
    for number in range(rounds):
        asked = texts.where(part == number)
        if spark.catalog.tableExists(memory_table):
            asked = asked.join(read_table(spark, memory_table).select("text_hash"), "text_hash", "left_anti")
        got = stored(with_model_tags(asked, make_model, partitions=partitions).select("text_hash", ANSWER), "answers")
        _remember(spark, got, memory_table)
    return hashed.join(read_table(spark, memory_table), "text_hash", "left").drop("text_hash")


def _remember(spark: SparkSession, got: DataFrame, memory_table: str) -> None:
    """Add answers to the memory as a piece of their own."""
    pieces.tidy(spark, memory_table)
    listed = pieces.pieces(spark, memory_table)
    if listed is not None and got.isEmpty():
        return
    if listed is None and spark.catalog.tableExists(memory_table):
        # A memory from before it was kept in pieces becomes the first one.
        got = got.unionByName(stored(read_table(spark, memory_table), "answers"))
    number = pieces.next_piece(spark, memory_table)
    pieces.add_rows(got.withColumn(pieces.PIECE, F.lit(number)), memory_table)
    new = spark.range(1).select(F.lit(number).alias(pieces.PIECE))
    listed = new if listed is None else listed.select(pieces.PIECE).unionByName(new)
    pieces.publish(listed, memory_table, ["text_hash", ANSWER])


def compact_answers(spark: SparkSession, memory_table: str) -> DataFrame:
    """Write the memory as one piece. Worth its while after many rounds with few answers each."""
    pieces.tidy(spark, memory_table)
    number = pieces.next_piece(spark, memory_table)
    whole = read_table(spark, memory_table)
    pieces.add_rows(whole.withColumn(pieces.PIECE, F.lit(number)), memory_table)
    pieces.publish(spark.range(1).select(F.lit(number).alias(pieces.PIECE)), memory_table, ["text_hash", ANSWER])
    pieces.tidy(spark, memory_table)
    return read_table(spark, memory_table)


def tag_with_model(
    spark: SparkSession,
    silver_table: str,
    answer_table: str,
    gold_table: str,
    make_model: Callable[[dict], Model],
    keys: Sequence[str] = tuple(FLAG_KEYS),
    partitions: int | None = None,
    n: int | None = None,
    values: Sequence[str] | None = None,
    rounds: int = 1,
    most_columns: int = MOST_COLUMNS,
) -> DataFrame:
    """Ask the model, repair and parse its answers, add one flag per value.

    Writes the parsed answers (``answer_table``), what the model has said to each text
    (``<answer_table>_memory``, for later runs), every value found with a number that it keeps
    (``<gold_table>_values``), the set flags as rows of key and flag (``<gold_table>_flags``) and the
    flags as columns (``gold_table``, returned). ``values`` names the columns, none if it is empty;
    without it they are all values found, and more than ``most_columns`` of them are refused: for
    these there are the other two tables, which need nothing on the driver. ``n`` keeps the first
    products by key only. ``partitions`` calls run at a time, as many as the session's shuffle
    partitions if not given; in ``rounds`` parts, each kept once it is answered.
    """
    source = first_rows(read_table(spark, silver_table), n, [KEY])
    at_once = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    answers = answers_kept(spark, source, f"{answer_table}_memory", make_model, at_once, rounds)
    parsed = write_table(with_parsed_tags(answers), answer_table)
    before = read_table(spark, f"{gold_table}_values") if spark.catalog.tableExists(f"{gold_table}_values") else None
    write_table(value_numbers(parsed, TAGS, before), f"{gold_table}_values")
    write_table(flag_rows(parsed, TAGS, KEY, keys), f"{gold_table}_flags")
    chosen = collect_values(parsed, TAGS, most_columns) if values is None else values
    return write_table(with_value_flags(parsed, TAGS, chosen, keys), gold_table)
