"""Priority rules that map descriptions to entities."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.operators.skew import dimension_join

INLINE_RULES = 300
PIECE = 6  # letters of the pieces that rules are looked up by, at most

# What parts the plain text of a regular expression: classes, escapes, groups without groups in
# them (taken away from the inside, to a depth), a letter or gap that may be missing or repeated
# so many times, and the other signs.
_GAP = "\x00"
_CLASS = r"\[\^?(?:\\.|[^\]\\\[])+\]"
_ESCAPE = r"\\."
_GROUP = r"\([^()]*\)"
_DEPTH = 4
_OPTIONAL = r"[^|()](?:[?*]|\{[^}]*\})[?+]?"
_OTHER = r"[.^$+?]"
# Not looked into: flags and look-arounds, quotes, code points, properties, long references, nested or odd classes.
_UNCLEAR = r"\(\?|\\[QExuUpPcNkRX0]|\\[0-9][0-9]|\[\^?\]|\[(?:\\.|[^\]\\])*\[|&&|\x00"


def _fires(description: Column, pattern: str, match_type: str) -> Column:
    if match_type == "regex":
        return description.rlike(pattern)
    return description.contains(pattern)


def _inline_best(description: Column, rules: list) -> Column:
    """CASE over ordered rules that gives the position of the first one that fires."""
    branches = F
    for position, rule in rules:
        branches = branches.when(_fires(description, rule.pattern, rule.match_type), position)
    return branches.otherwise(None)


LAST = 2**31 - 1  # where rules without a priority stand: behind all others


def _ordered(rows: list) -> list:
    def place(rule):
        return rule.priority, -len(rule.pattern), rule.pattern, rule.entity_id is not None, rule.entity_id or 0

    return sorted(rows, key=place)


def _compiles(pattern: str) -> Column:
    """Whether a regular expression can be compiled, found out where the rule lies."""
    return F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.col(pattern)).isNotNull()


def _usable(merchant_map: DataFrame) -> DataFrame:
    """Rules that can fire, with their place in the order made explicit. A rule without a type is a keyword."""
    rules = merchant_map.where(F.col("pattern").isNotNull()).withColumns(
        {"match_type": F.coalesce("match_type", F.lit("keyword")), "priority": F.coalesce("priority", F.lit(LAST))}
    )
    return rules.where((F.col("match_type") != "regex") | _compiles("pattern"))


def invalid_rules(spark: SparkSession, merchant_map: DataFrame) -> DataFrame:
    """Rules whose regular expression cannot be compiled; they are left out of the matching."""
    rules = merchant_map.where((F.col("match_type") == "regex") & F.col("pattern").isNotNull())
    return rules.where(~_compiles("pattern"))


def match_entities(
    descriptions: DataFrame, merchant_map: DataFrame, entities: DataFrame, inline_rules: int = INLINE_RULES
) -> DataFrame:
    """Best entity per distinct description; descriptions without a match are left out.

    Rules are tried by priority (none comes last), then the longer pattern, then its text; rules
    without a pattern or with an invalid one are not tried, rules without a type are keywords. A
    rule table of ordinary size becomes one CASE expression, evaluated where the descriptions
    lie. A larger one stays distributed: rules are indexed by a piece of text that a match must
    hold, found by an equality join, and evaluated on the descriptions that hold it.
    """
    texts = descriptions.select("raw_description").where(F.col("raw_description").isNotNull()).distinct()
    rules = _usable(merchant_map)
    head = rules.limit(inline_rules + 1).collect()
    matched = _match_inline(texts, _ordered(head)) if len(head) <= inline_rules else _match_indexed(texts, rules)
    joined = dimension_join(
        matched, entities, lambda fact, dim: fact("entity_id") == dim("entity_id"), "raw_description", "inner"
    )
    return joined.select("facts.raw_description", "facts.entity_id", "dim.clean_name", "dim.primary_category")


def _match_inline(texts: DataFrame, rules: list) -> DataFrame:
    numbered = list(enumerate(rules))
    if not numbered:
        return texts.select("raw_description", F.lit(None).cast("int").alias("entity_id")).limit(0)
    ids = F.array(*[F.lit(rule.entity_id) for rule in rules])
    best = texts.withColumn("_best", _inline_best(F.col("raw_description"), numbered))
    return best.where(F.col("_best").isNotNull()).select(
        "raw_description", F.element_at(ids, F.col("_best") + 1).alias("entity_id")
    )


def _lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else, so that a part's lower case is part of the whole's."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def required_texts(pattern: Column) -> Column:
    """Texts of which every match of a regular expression holds at least one, in lower case.

    What is not plain text (classes, escapes, groups, optional letters, anchors) parts it; of
    what is left the longest run of each alternative counts. NULL where there is none, or where
    the expression has something that is not looked into.
    """
    gap = F.lit(_GAP)
    plain = F.regexp_replace(F.regexp_replace(pattern, r"^\(\?i\)", ""), r"\(\?:", "(")
    opened = F.regexp_replace(plain, r"^\^?\(([^()\[\]\\]*)\)\$?$", "$1")
    rest = opened
    for part in (_CLASS, _ESCAPE, *[_GROUP] * _DEPTH, _OPTIONAL, _OTHER):
        rest = F.regexp_replace(rest, F.lit(part), gap)
    alternatives = F.transform(
        F.split(rest, r"\|"),
        lambda one: F.array_max(
            F.transform(F.split(one, _GAP), lambda run: F.struct(F.length(run).alias("n"), run.alias("run")))
        )["run"],
    )
    unclear = plain.rlike(_UNCLEAR) | rest.rlike(r"[()\[]") | F.exists(alternatives, lambda run: run == "")
    return F.when(~unclear, F.transform(alternatives, _lowered))


def _indexed(rules: DataFrame) -> DataFrame:
    """Rules by the pieces of text to look them up by; the empty piece is in every text.

    Of the pieces of a required text the one that the fewest rules have is taken.
    """
    is_regex = F.col("match_type") == "regex"
    none = F.array(F.lit(""))
    required = F.when(is_regex, F.coalesce(required_texts(F.col("pattern")), none)).otherwise(F.array(_lowered(F.col("pattern"))))
    each = rules.select("pattern", "match_type", "priority", "entity_id", F.explode(required).alias("required"))
    size = F.least(F.length("required"), F.lit(PIECE))
    places = F.sequence(F.lit(1), F.length("required") - size + 1)
    pieces = each.select("*", F.explode(places).alias("at")).withColumn("piece", F.substr("required", F.col("at"), size))
    held = pieces.groupBy("piece").agg(F.count("*").alias("rules"))
    names = [*each.columns]
    found = pieces.join(held, "piece").groupBy(*names).agg(F.min_by("piece", F.struct("rules", "at")).alias("piece"))
    return found.drop("required").distinct()


def _match_indexed(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule is looked up by its piece and tried on the texts that hold it."""
    index = _indexed(rules)
    # Lengths of pieces: PIECE of them at most, and none.
    lengths = sorted(row.n for row in index.select(F.length("piece").alias("n")).distinct().collect())
    whole = _lowered(F.col("raw_description"))

    def cut(n: int) -> Column:
        if n == 0:
            return F.array(F.lit(""))
        places = F.sequence(F.lit(1), F.greatest(F.length(whole) - n + 1, F.lit(1)))
        return F.transform(places, lambda at: F.substr(whole, at, F.lit(n)))

    pieces = F.array_distinct(F.concat(*map(cut, lengths)))
    facts = texts.select("raw_description", F.explode(pieces).alias("piece"))

    def condition(text, rule):
        regex = rule("match_type") == "regex"
        held = text("raw_description").contains(rule("pattern"))
        fires = F.when(regex, F.rlike(text("raw_description"), rule("pattern"))).otherwise(held)
        return (text("piece") == rule("piece")) & fires

    hits = dimension_join(facts, index, condition, "raw_description", "inner", keys={"piece": "piece"})
    order = F.struct("priority", -F.length("pattern"), "pattern", "entity_id")
    return hits.groupBy("facts.raw_description").agg(F.min_by("entity_id", order).alias("entity_id"))


def orphan_rules(merchant_map: DataFrame, entities: DataFrame) -> DataFrame:
    """Rules that point at an entity that does not exist."""
    return merchant_map.join(entities.select("entity_id"), "entity_id", "left_anti").select(*merchant_map.columns)
