"""Priority rules: the same result for any number of rules, expressions of any kind."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyfold.operators import entities as ent
from tallyfold.operators import skew
from tallyfold.schemas import ENTITIES, MERCHANT_MAP

RULES = [
    ("SHOP", "keyword", 1, None), ("shop 7", "keyword", 2, 5), ("[", "regex", 3, 1), (None, "keyword", 3, 1),
    ("^S.*9$", "regex", 2, None), ("A SHOP", None, 4, 3), ("BAR", None, 5, None), ("", "keyword", 6, 900),
    ("(?i)uber|lyft", "regex", 7, 2), ("(CAFE|BISTRO) [0-9]+", "regex", 1, 4), ("^(MART|STORE)$", "regex", 2, 4),
    ("CO\\.UK", "regex", 3, 3), ("AMZN? ?MK+TP", "regex", 4, 3), ("\\QA.B\\E", "regex", 5, 3), ("x{2}y", "regex", 6, 3),
    ("(a(b(c|d)e)f|gh) i", "regex", 7, 3), ("é+t[aé]", "regex", 1, 3), ("(?=Z)ZED", "regex", 2, 3), ("SAME", "keyword", 9, 7),
    ("SAME", "keyword", 8, 7), ("[a-c&&[b]]q", "regex", 5, 3), ("\\d{3}-\\d{4}", "regex", 6, 3), ("p|", "regex", 7, 899),
]
TEXTS = [
    "SHOP 7", "A SHOP 8", "SHOP 9", "BAR", "", "x", "uBeR eats", "LYFT", "CAFE 12", "BISTRO x", "MART", "STORE", "STORES",
    "www.site.co.uk", "WWW.SITE.CO.UK", "AMZ MKTP", "AMZN MKKTP", "AMMKTP", "A.B", "AxB", "xxy", "xy", "gh i", "abcef i", "ababcdef i",
    "été", "étaé", "ZED", "SAME", "bq", "aq", "call 555-1234 now", "p", "nothing here",
]


def plain(rules, texts):
    def fires(pattern, kind, text):
        if kind == "regex":
            if pattern == "\\QA.B\\E":
                return "A.B" in text
            if pattern == "[a-c&&[b]]q":
                return "bq" in text
            try:
                return re.search(pattern, text) is not None
            except re.error:
                return False
        return pattern in text

    found = {}
    for text in texts:
        hits = [(p if p is not None else 2**31 - 1, -len(pattern), pattern, e) for pattern, kind, e, p in rules if pattern is not None and fires(pattern, kind, text)]
        if hits:
            found[text] = min(hits)[3]
    return found


def matched(spark, rules, texts, inline):
    frame = spark.createDataFrame(rules, MERCHANT_MAP)
    entities = spark.createDataFrame([(k, f"e{k}", "c") for k in range(1, 10)], ENTITIES)
    rows = ent.match_entities(spark.createDataFrame([(t,) for t in texts], "raw_description string"), frame, entities, inline_rules=inline).collect()
    assert len({r.raw_description for r in rows}) == len(rows)
    return {r.raw_description: r.entity_id for r in rows}


@pytest.mark.parametrize("inline", [0, 1, 300])
def test_any_number_of_rules_gives_the_same(spark, inline):
    wanted = plain(RULES, TEXTS)
    assert matched(spark, RULES, [*TEXTS, *TEXTS], inline) == wanted
    without = [r for r in RULES if r[0] not in ("", "p|")]
    assert matched(spark, without, TEXTS, inline) == plain(without, TEXTS) != wanted


@pytest.mark.parametrize("inline", [0, 300])
def test_random_expressions(spark, inline):
    """Expressions put together at random: the index may not lose a match."""
    rng = random.Random(3)
    parts = ["A", "b", "AB", "a+", "b?", "A*", ".", "[AB]", "[^a]", "(A|b)", "(ab)?", "(a|)", "\\.", "\\d", "B{2}", "a{0,1}", "^", "$", "AbA", "(A(b|B)a)", "|"]
    rules = [("".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))), "regex", 1 + k % 9, k) for k in range(150)]
    rules = [r for r in rules if not re.search(r"[\^$][*+?{]|\*\+|\+\+|\?\+", r[0])]
    texts = ["".join(rng.choice("AaBb.1") for _ in range(rng.randrange(8))) for _ in range(200)]
    texts = sorted(set(texts))
    for start in (0, 40, 80):
        some = rules[start : start + 40]
        assert matched(spark, some, texts, inline) == plain(some, texts)


def test_required_texts(spark):
    cases = {
        "AMAZON": ["amazon"], "^UBER +EATS$": ["uber "], "(A|B)CD": ["cd"], "NETFLIX|HULU": ["netflix", "hulu"], "(?i)Shop": ["shop"],
        "^(MART|STORE)$": ["mart", "store"], "AB?C": ["a"], "[abc]+": None, "a|[b]": None, "(?=x)y": None, "\\Qa\\E": None, "": None,
    }
    rows = spark.createDataFrame([(p,) for p in cases], "p string").select("p", ent.required_texts(F.col("p")).alias("r")).collect()
    found = {r.p: r.r for r in rows}
    assert {p: r and sorted(r) for p, r in found.items() if p != "AB?C"} == {p: r and sorted(r) for p, r in cases.items() if p != "AB?C"}
    assert found["AB?C"] in (["a"], ["c"])


def test_the_index_scans_texts_once(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "texts")
    spark.createDataFrame([(t,) for t in TEXTS], "raw_description string").write.parquet(path)
    rules = spark.createDataFrame(RULES, MERCHANT_MAP)
    entities = spark.createDataFrame([(1, "e", "c")], ENTITIES)
    found = ent.match_entities(spark.read.parquet(path), rules, entities, inline_rules=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Cartesian" not in plan and "Union" not in plan


def test_only_heavy_keys_are_salted(spark):
    """One key has half of the rows; the lookup rows of the others are sent once."""
    facts = spark.range(8000).select("id", F.when(F.col("id") % 2 == 0, "HOT").otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("key"))
    dim = spark.createDataFrame([("HOT", 0), *[(f"k{n}", n) for n in range(1, 1000, 2)], (None, 1)], "key string, v int")
    heavy = skew.heavy_keys(facts, ["key"], 8).collect()
    assert [r._k0 for r in heavy] == ["HOT"] and heavy[0]._pieces == 16
    on = lambda a, b: a("key") == b("key")
    shuffled, sent = (skew.dimension_join(facts, dim, on, "id", "left", small=s).select("id", "facts.key", "v") for s in (False, True))
    assert shuffled.exceptAll(sent).isEmpty() and sent.exceptAll(shuffled).isEmpty() and shuffled.count() == 8000
    joined = skew.dimension_join(facts, dim, on, "id", "inner", small=False)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "sequence(0, (coalesce(_pieces" in plan.replace("#", "").replace(" ", " ") or "_pieces" in plan
    copies = skew.dimension_join(dim.alias("d").select("key", F.col("v").alias("id")), dim, on, "id", "inner", small=False)
    assert copies.count() == 501


def test_conditions_that_are_no_equality_need_keys(spark):
    facts = spark.createDataFrame([("A", 1)], "x string, id int")
    with pytest.raises(ValueError, match="keys"):
        skew.dimension_join(facts, facts, lambda a, b: F.lower(a("x")) == b("x"), "id", small=False)
