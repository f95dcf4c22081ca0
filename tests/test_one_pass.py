"""Tags found in one pass are those of one pattern per tag."""

import random

import pytest

from shelfmark.functions import rules, tags

SETS = {
    "overlap": {"a": ["display", "play"], "b": ["play", "playful", "lay"], "c": ["y", "ab"]},
    "order": {"a": ["ab", "abc", "a"], "b": ["abc", "ab"], "c": ["bc d", "b", "bc"]},
    "signs": {"a": ["a.b", "a"], "b": ["(x)", "x|y", "$"], "c": ["é", "éa", "a-b"]},
    "words": {"a": ["star wars", "star"], "b": ["wars", "star"], "c": ["war", "star-war", "car"]},
    "none": {"a": [], "b": ["x"]},
}


def texts(words, seed):
    rng = random.Random(seed)
    parts = [*words, *(w[: len(w) // 2] for w in words), " ", " ", "_", "-", "s", "é", ".", "\n"]
    some = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)]
    return [(None,), ("",), *((t,) for t in some)]


@pytest.mark.parametrize("bounded", [False, True])
@pytest.mark.parametrize("name", [*SETS, "BOUNDED_TAGS", "SUBSTRING_TAGS", "CASCADE_TAGS"])
def test_one_pass_changes_no_tag(spark, name, bounded):
    rule_set = SETS.get(name) or {t: [w.lower() for w in some] for t, some in getattr(rules, name).items()}
    words = sorted({w for some in rule_set.values() for w in some})
    frame = spark.createDataFrame(texts(words, 1), "t string")
    listed = {t: some for t, some in rule_set.items() if some}
    slow = tags.with_tags(frame, rules.tag_patterns(listed, bounded), "t").select("t", *listed).collect()
    fast = tags.with_rule_tags(frame, rule_set, "t", bounded)
    assert fast.columns == ["t", *rule_set]
    assert sorted(map(repr, fast.select("t", *listed).collect())) == sorted(map(repr, slow))
    for tag in set(rule_set) - set(listed):
        assert {r[0] for r in fast.select(tag).collect()} == {None, ""}


def test_one_scan_of_a_text(spark):
    frame = spark.createDataFrame([("kids",)], f"{tags.CLEAN} string")
    plan = tags.with_substring_tags(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1 and "regexp_extract(" not in plan
    assert rules.one_pass({"a": [""]}) is None and rules.one_pass({"a": ["é"]}, True) is None
