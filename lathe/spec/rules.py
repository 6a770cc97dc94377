"""Grammars supplied as a rule table (field, prio, pattern, grp).

The compiled grammars in ``packs`` use literal patterns. Here patterns are
data: rows meet the rules in one projection per text, so no pairs are
shuffled; the rules travel as one small array taken from the table.
"""

from pyspark.sql import DataFrame, functions as F

MAX_RULES = 2000


def extract_with_rules(df: DataFrame, ids, text_col: str, rules: DataFrame, fields) -> DataFrame:
    """Per field the first rule (by priority) that matches.

    A rule table is configuration: more than MAX_RULES rows are refused
    instead of being sent to every task.
    """
    ids = [ids] if isinstance(ids, str) else list(ids)
    packed = rules.agg(
        F.when(F.count(F.lit(1)) > MAX_RULES, F.raise_error(F.lit("rule table too large"))).otherwise(
            F.array_sort(F.collect_list(F.struct("field", "prio", "pattern", "grp")))
        ).alias("rules")
    )
    work = df.withColumn("__rules", packed.scalar())
    found = work.withColumn(
        "__hits",
        F.filter(
            F.transform("__rules", lambda r: F.struct(r["field"].alias("field"), F.call_function("regexp_extract", F.col(text_col), r["pattern"], r["grp"]).alias("value"))),
            lambda h: h["value"] != "",
        ),
    )

    def first(field):
        return F.get(F.filter("__hits", lambda h: h["field"] == field), F.lit(0))["value"]

    return found.select(*ids, *[first(f).alias(f) for f in fields])
