"""JSON repair, parsing and membership tests on model output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG_MAP = "map<string,array<string>>"

# What is cut from model output, in order.
CUTS = [("```", ""), ("[{", "{"), ("}]", "}")]
# All Unicode whitespace and the four separator controls, at either end. The
# look-behind starts the second part at the head of a run of blanks only.
BLANK = r"[\s\x1c-\x1f]"
EDGE_SPACE = rf"(?U)\A{BLANK}+|(?<!{BLANK}){BLANK}+\z"

# A strict reader: no single quotes, no NaN.
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def unwrapped(text: Column) -> Column:
    """Text without code fences and without a list around one object."""
    for old, new in CUTS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, EDGE_SPACE, "")


def with_repaired_json(df: DataFrame, text: str, out: str) -> DataFrame:
    """Unwrapped, re-serialised JSON; text that is not one valid value is kept as it was.

    The text is read strictly as the first item of a list whose second item is
    the text's own hash. It is one valid value if exactly these two items come
    back: words after the value, several values, or brackets that close the
    list early give something else. Keys keep their order and repeats.
    """
    core, items, mark = F.col("_core"), F.col("_items"), F.md5("_core")
    listed = F.concat(F.lit("["), core, F.lit(',"'), mark, F.lit('"]'))
    read = df.withColumn("_core", unwrapped(F.col(text))).withColumn(
        "_items", F.from_json(listed, "array<string>", STRICT)
    )
    valid = (F.size(items) == 2) & (F.get(items, F.lit(1)) == mark)
    return read.withColumn(
        out,
        F.when(valid & core.rlike(r"^[\[{]"), F.get(items, F.lit(0)))
        .when(valid, core)
        .otherwise(F.col(text)),
    ).drop("_core", "_items")


def with_tag_map(df: DataFrame, text: str, out: str) -> DataFrame:
    """Parse to category -> values; of a repeated key the last entry counts."""
    parsed = F.col("_parsed")
    keys = F.map_keys(parsed)
    distinct = F.array_distinct(keys)
    entries = F.map_entries(parsed)
    last = F.transform(
        distinct,
        lambda key: F.element_at(F.filter(entries, lambda entry: entry["key"] == key), -1)["value"],
    )
    return (
        df.withColumn("_parsed", F.from_json(text, TAG_MAP))
        .withColumn(
            out,
            F.when(F.size(distinct) == F.size(keys), parsed).otherwise(
                F.map_from_arrays(distinct, last)
            ),
        )
        .drop("_parsed")
    )


def any_key_contains(tags: Column, keys: Sequence[str], values: Sequence[str]) -> Column:
    """Whether a value is in the list of a key, OR-ed, with SQL's unknown for a missing key."""
    tests = [F.array_contains(tags.getItem(key), value) for value in values for key in keys]
    answer = tests[0]
    for test in tests[1:]:
        answer = answer | test
    return answer
