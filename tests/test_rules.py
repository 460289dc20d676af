import random

import pytest

from checks.inputs import AGENTS
from millrace.functions import agents as known
from millrace.operators import rules as table_rules
from millrace.operators.rules import RULE, families_by_rules, read_rules, rule_rows
from millrace.plans.city_profile import requests_by_family


def first_fit(text, rules):
    fits = [(position, family) for position, family, parts in rules if parts is not None and None not in parts and all(p in text for p in parts)]
    return min(fits)[1] if fits else "Other"


def named(spark, texts, rules):
    found = families_by_rules(spark.createDataFrame([(t,) for t in texts], "agent string"), spark.createDataFrame(rules, RULE), "agent")
    return {r.agent: r.family for r in found.collect()}


def test_rules_of_a_list_and_of_a_table_agree(spark):
    texts = spark.createDataFrame([(a,) for a in AGENTS] * 2, "agent string")
    for rules, function in ((known.BROWSER_RULES, known.browser), (known.OS_RULES, known.operating_system)):
        found = {r.agent: r.family for r in families_by_rules(texts, rule_rows(spark, rules), "agent").collect()}
        assert found == {r.agent: r.family for r in texts.select("agent", function("agent").alias("family")).collect()}


def test_first_fits_against_trying_every_rule(spark):
    generator = random.Random(2)
    piece = lambda n: "".join(generator.choice("abcé /") for _ in range(n))
    texts = sorted({piece(generator.randint(0, 30)) for _ in range(200)})
    rules = [(at // 2, f"f{at}", [piece(generator.randint(0, 5)) for _ in range(generator.randint(0, 3) if at > 150 else generator.randint(1, 3))]) for at in range(300)]
    rules += [(1, "null part", ["a", None]), (0, "no list", None)]
    assert named(spark, texts, rules) == {t: first_fit(t, rules) for t in texts}


def test_texts_without_a_rule_and_none(spark):
    rules = [(2, "all", []), (1, "x", ["xyz"])]
    assert named(spark, ["xyz", "", None], rules) == {"xyz": "x", "": "all", None: "Other"}
    assert named(spark, ["xyz", None], []) == {"xyz": "Other", None: "Other"}
    assert named(spark, [], rules) == {}


def test_the_plan_does_not_grow_with_the_rules(spark, plan):
    texts = spark.createDataFrame([(a,) for a in AGENTS], "agent string").repartition(4)
    few = [(at, f"f{at}", [f"word {at}"]) for at in range(10)]
    many = [(at, f"f{at}", [f"word {at}", "Mozilla"]) for at in range(10_000)] + [(10_000, "bot", ["bot"])]
    frames = [families_by_rules(texts, spark.createDataFrame(rules, RULE), "agent") for rules in (few, many)]
    shapes = [[line.split("(")[0].strip(" :+-*") for line in plan(frame).splitlines()] for frame in frames]
    assert len(shapes[0]) == len(shapes[1]) and not any(word in plan(frames[1]) for word in ("Python", "Cartesian", "NestedLoop"))
    assert {r.family for r in frames[1].collect()} == {"bot", "Other"}


def test_few_pairs_are_proposed(spark, monkeypatch):
    """A rule is filed under its rarest run, not under one that all texts have."""
    counts = spark.createDataFrame([("Moz", 1000), ("ill", 1000), ("zil", 1000), ("ozi", 1000), ("lla", 1000), ("abc", 2), ("bcd", 3)], "gram string, count long")
    rules = spark.createDataFrame([(1, "a", ["Mozilla", "abcd"]), (2, "b", ["ab"]), (3, "c", ["never"])], RULE)
    assert {r.position: r.gram for r in table_rules._filed(rules, counts).collect()} == {1: "abc", 2: ""}


@pytest.mark.parametrize("line", ["x\tf\tp", "1\tf", "1\tf\t", "", "\t\t"])
def test_lines_that_are_no_rules(spark, tmp_path, line):
    (tmp_path / "rules").write_text(f"{line}\n5\tBots\tbot\t/\n")
    assert [tuple(r) for r in read_rules(spark, str(tmp_path / "rules")).collect()] == [(5, "Bots", ["bot", "/"])]


def test_requests_are_counted_by_family(spark, tmp_path):
    (tmp_path / "rules").write_text("2\tBots\tbot\n1\tGoogle\tGoogle\tbot\n")
    lines = spark.createDataFrame([("Googlebot",), ("Googlebot",), ("abot",), ("x",), (None,)], "value string")
    found = requests_by_family(lines, read_rules(spark, str(tmp_path / "rules")))
    assert {r.family: r.requests for r in found.collect()} == {"Google": 2, "Bots": 1, "Other": 1}


def test_no_texts_are_broadcast_however_small_they_look(spark, plan):
    texts = spark.createDataFrame([(f"{'word ' * 40}{at}",) for at in range(50)], "agent string")
    frame = families_by_rules(texts, spark.createDataFrame([(1, "one", ["word 7"])], RULE), "agent")
    shown = plan(frame)
    assert "SortMergeJoin" in shown and "Broadcast" not in shown
    assert {r.agent for r in frame.collect() if r.family == "one"} == {f"{'word ' * 40}7"}


def test_only_the_first_of_rules_with_the_same_parts_meets_texts(spark):
    counts = spark.createDataFrame([("abc", 2), ("xyz", 9)], "gram string, count long")
    rules = [(at, f"f{at}", ["xyz", "abc"] if at % 2 else ["abc", "", "xyz", "abc"]) for at in range(1, 500)] + [(1, "e", ["abc", "xyz"])]
    found = table_rules._filed(spark.createDataFrame(rules, RULE), counts).collect()
    assert [(r.position, r.family, r.gram) for r in found] == [(1, "e", "abc")]
    assert named(spark, ["abcxyz", "abc"], rules) == {"abcxyz": "e", "abc": "Other"}
