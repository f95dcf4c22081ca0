"""Model requests and answers: prompts, repair, parsing, values and flags.

The answers of the checked queries are written by SQL from the gold tags, in
the shapes a model gives them: bare, fenced, in a list, with a repeated
category, without one, broken.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import rules
from shelfmark.functions.json_text import with_repaired_json
from shelfmark.functions.prompts import with_prompt
from shelfmark.operators import tag_maps as ops
from registered.stand_ins import rule_model
from shelfmark.operators.model import with_model_tags
from shelfmark.plans.regex_gold import regex_gold
from shelfmark.sources.shared import stored
from shelfmark.sources.tables import register_view

from .catalogue import SUBSTRING_SQL
from .inputs import silver_catalogue, table, with_steps

KEY = "site_product_identifier"
TAGS = "cleaned_tagged_description"

# One text per product, the same in both engines.
ANSWER = """
SELECT site_product_identifier,
  CASE WHEN category_name = 'PROMO' THEN '```' || body || '```'
       WHEN category_name = 'STANDARD' THEN ' [{' || substr(body, 2, length(body) - 2) || '}] '
       WHEN category_name = 'ECONOMY' AND theme_type = '' THEN body || ' I hope this helps'
       WHEN occasion_type = 'special' THEN '```json' || body || '```'
       WHEN headline_text IS NULL THEN NULL
       WHEN play_type = 'strategy' THEN 'unclear'
       ELSE body END AS tagged_description
FROM (
  SELECT *,
    '{' || CASE WHEN play_type = '' THEN '"Age Range":' || ages || ',' ELSE '' END
        || '"Occasion":' || occasions
        || ',"Theme":' || CASE WHEN theme_type = '' THEN '[]' ELSE '["' || theme_type || '"]' END
        || CASE WHEN product_type = 'comics' THEN ',"Theme":["Comics and books"]' ELSE '' END
        || '}' AS body
  FROM (
    SELECT *,
      CASE WHEN age_range = '' THEN '[]' WHEN theme_type = 'space' THEN '["Kids","kids"]'
           ELSE '["' || age_range || '"]' END AS ages,
      CASE WHEN occasion_type = '' THEN '["Everyday Play"]'
           ELSE '["' || occasion_type || '","Everyday Play"]' END AS occasions
    FROM {source}))
"""


def answers(spark: SparkSession, folder: str) -> DataFrame:
    gold = regex_gold(silver_catalogue(spark, folder))
    return spark.sql(ANSWER.replace("{source}", register_view(gold, f"gold_{uuid4().hex}")))


def parsed_answers(spark, folder):
    return ops.with_parsed_tags(answers(spark, folder))


def prompt_render(spark, folder):
    return with_prompt(table(spark, folder, "conversations"), "text").select(
        "conv_id", "turn", "system_prompt", "user_prompt"
    )


def model_tags(spark, folder):
    tagged = with_model_tags(silver_catalogue(spark, folder), rule_model, partitions=8)
    return tagged.select(KEY, "tagged_description")


def model_flags(spark, folder):
    """Model answers, stored once, to flags."""
    tagged = with_model_tags(silver_catalogue(spark, folder), rule_model, partitions=8)
    parsed = stored(ops.with_parsed_tags(tagged.select(KEY, "tagged_description")), "answers")
    return ops.with_value_flags(parsed, TAGS, ops.collect_values(parsed, TAGS)).drop(
        "tagged_description", TAGS
    )


def json_repair(spark, folder):
    return with_repaired_json(answers(spark, folder), "tagged_description", "repaired")


def json_map_entries(spark, folder):
    entries = ops.map_entries(parsed_answers(spark, folder), TAGS, [KEY])
    return ops.entry_values(entries, [KEY])


def json_distinct_values(spark, folder):
    return ops.distinct_values(parsed_answers(spark, folder), TAGS)


def json_flags(spark, folder):
    parsed = stored(parsed_answers(spark, folder), "answers")
    flagged = ops.with_value_flags(parsed, TAGS, ops.collect_values(parsed, TAGS))
    return flagged.drop("tagged_description", TAGS)


def json_flag_rows(spark, folder):
    return ops.flag_rows(parsed_answers(spark, folder), TAGS, KEY)


def json_flag_numbers(spark, folder):
    """The set values of each product by their numbers, read back as values."""
    parsed = stored(parsed_answers(spark, folder), "parsed")
    some = parsed.where(F.col(KEY) < "2")
    numbers = stored(ops.value_numbers(parsed, TAGS, ops.value_numbers(some, TAGS)), "values")
    rows = ops.with_flag_numbers(parsed, numbers, TAGS, KEY)
    named = rows.select(KEY, F.explode_outer("flag_numbers").alias("number")).join(numbers, "number", "left")
    return named.groupBy(KEY).agg(F.array_join(F.sort_array(F.collect_list("value")), ",").alias("flags"))


def limit_n(spark, folder):
    return ops.first_rows(answers(spark, folder), 20, [KEY])


def event_props(spark, folder):
    """JSON text of the events, fenced, repaired back to plain objects."""
    fenced = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("```\n"), "props", F.lit("\n```")).alias("fenced")
    )
    return with_repaired_json(fenced, "fenced", "repaired").drop("fenced")


QUERIES = {
    "prompt_render": prompt_render,
    "model_tags": model_tags,
    "model_flags": model_flags,
    "json_repair": json_repair,
    "json_map_entries": json_map_entries,
    "json_distinct_values": json_distinct_values,
    "json_flags": json_flags,
    "json_flag_rows": json_flag_rows,
    "json_flag_numbers": json_flag_numbers,
    "limit_n": limit_n,
    "event_props": event_props,
}

_steps = {
    "tagged": SUBSTRING_SQL,
    "answers": ANSWER.replace("{source}", "tagged"),
    "unwrapped": r"""
SELECT *, regexp_replace(replace(replace(replace(tagged_description, '```', ''), '[{', '{'), '}]', '}'),
                         '^\s+|\s+$', '', 'g') AS core FROM answers""",
    "repaired": """
SELECT site_product_identifier, tagged_description,
       CASE WHEN json_valid(core) THEN CAST(json(core) AS varchar) ELSE tagged_description END
         AS repaired FROM unwrapped""",
    # Only the text of one JSON object, perhaps with words after it, becomes a map.
    "object": r"""
SELECT site_product_identifier, CASE WHEN starts_with(repaired, '{')
         THEN regexp_extract(repaired, '^\{.*\}') END AS body FROM repaired""",
    "pairs": r"""
SELECT site_product_identifier, n, regexp_extract(pair, '^"([^"]*)"', 1) AS "Key",
       regexp_extract(pair, '\[(.*)\]', 1) AS items
FROM (SELECT site_product_identifier, unnest(list) AS pair, generate_subscripts(list, 1) AS n
      FROM (SELECT *, regexp_extract_all(body, '"[^"]*":\[[^\]]*\]') AS list FROM object))""",
    "last_pairs": """
SELECT site_product_identifier, "Key", arg_max(items, n) AS items FROM pairs
GROUP BY site_product_identifier, "Key" """,
    "entries": """
SELECT site_product_identifier, "Key",
       unnest(regexp_extract_all(items, '"([^"]*)"', 1)) AS "Value" FROM last_pairs""",
}


def _flag_sql(*values: str) -> str:
    """1 if either list has a value; 0 if both are there without it; else NULL."""
    wanted = ", ".join(f"'{value}'" for value in values)
    name = "flag_" + values[0].replace(" ", "_")
    return (
        f"CAST(CASE WHEN count(CASE WHEN \"Key\" IN ('Occasion', 'Age Range') AND \"Value\" IN "
        f"({wanted}) THEN 1 END) > 0 THEN 1 WHEN max(both_there) THEN 0 END AS INTEGER) AS {name}"
    )


_FLAGS = [
    ("Comics and books",), ("Everyday Play",), ("Kids", "kids"), ("christmas",),
    ("space",), ("special",),
]

def _hits_sql(category: str) -> str:
    """The allowed values whose first word is in the text, in order."""
    values = ", ".join(
        rf"CASE WHEN regexp_matches(t, '\b{value.split()[0].lower()}\b') THEN '{value}' END"
        for value in rules.MODEL_TAGS[category]
    )
    return f"list_filter([{values}], lambda x: x IS NOT NULL)"


_hits = ", ".join(f'{_hits_sql(c)} AS "{c}"' for c in rules.MODEL_TAGS)
_model_steps = {
    "hits": f"SELECT site_product_identifier, t, {_hits} FROM "
    "(SELECT *, lower(concatenated_text) AS t FROM silver)"
}
_members = ", ".join(
    f"""CASE WHEN len("{c}") > 0 THEN '"{c}": ["' || array_to_string("{c}", '", "') || '"]' END"""
    for c in sorted(rules.MODEL_TAGS)
)
# The values that occur in the derived catalogue.
_OCCURRING = [
    "Adults", "Advanced", "Books and Comics", "Building Sets", "Building and Construction",
    "Christmas Gift", "Kids", "Space", "Special Treat", "Star Wars", "Strategy and Puzzle-Solving",
]
_model_flags = ", ".join(
    f"""CAST(CASE WHEN t IS NULL THEN NULL
      WHEN list_contains("Occasion", '{v}') OR list_contains("Age Range", '{v}') THEN 1
      WHEN len("Occasion") > 0 AND len("Age Range") > 0 THEN 0 END AS INTEGER)
      AS "flag_{v.replace(' ', '_')}" """
    for v in _OCCURRING
)

ORACLES = {
    "model_tags": with_steps(
        "silver",
        f"SELECT {KEY}, CASE WHEN t IS NOT NULL THEN '```{{' || array_to_string(list_filter("
        f"[{_members}], lambda x: x IS NOT NULL), ', ') || '}}```' END AS tagged_description "
        "FROM hits",
        _model_steps,
    ),
    "model_flags": with_steps("silver", f"SELECT {KEY}, {_model_flags} FROM hits", _model_steps),
    "prompt_render": "SELECT conv_id, turn, replace('"
    + rules.MODEL_PROMPT.replace("'", "''")
    + f"', '{rules.DESCRIPTION_SLOT}', text) AS system_prompt, "
    f"'{rules.MODEL_QUESTION}' AS user_prompt FROM conversations",
    "json_repair": with_steps(
        "clean", f"SELECT {KEY}, tagged_description, repaired FROM repaired", _steps
    ),
    "json_map_entries": with_steps(
        "clean", f'SELECT {KEY}, "Key", "Value" FROM entries', _steps
    ),
    "json_distinct_values": with_steps("clean", 'SELECT DISTINCT "Value" FROM entries', _steps),
    "json_flag_rows": with_steps(
        "clean",
        f"SELECT DISTINCT {KEY}, 'flag_' || replace(\"Value\", ' ', '_') AS flag FROM entries "
        "WHERE \"Key\" IN ('Occasion', 'Age Range')",
        _steps,
    ),
    "json_flag_numbers": with_steps(
        "clean",
        f"SELECT answers.{KEY}, coalesce(string_agg(DISTINCT \"Value\", ',' ORDER BY \"Value\"), '') AS flags "
        f"FROM answers LEFT JOIN (SELECT * FROM entries WHERE \"Key\" IN ('Occasion', 'Age Range')) AS e "
        f"ON answers.{KEY} = e.{KEY} GROUP BY answers.{KEY}",
        _steps,
    ),
    "json_flags": with_steps(
        "clean",
        f"SELECT answers.{KEY}, {', '.join(_flag_sql(*values) for values in _FLAGS)} FROM answers "
        f"LEFT JOIN entries ON answers.{KEY} = entries.{KEY} "
        f"LEFT JOIN (SELECT {KEY}, count(*) = 2 AS both_there FROM last_pairs "
        f"WHERE \"Key\" IN ('Occasion', 'Age Range') GROUP BY {KEY}) AS present "
        f"ON answers.{KEY} = present.{KEY} GROUP BY answers.{KEY}",
        _steps,
    ),
    "limit_n": with_steps(
        "clean",
        f"SELECT {KEY}, tagged_description FROM answers ORDER BY {KEY} LIMIT 20",
        _steps,
    ),
    "event_props": "SELECT event_id, CAST(json(props) AS varchar) AS repaired FROM events",
}
