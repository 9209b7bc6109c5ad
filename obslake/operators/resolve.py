"""Company resolution: written names -> canonical names.

Ranked stages: alias, exact, case-insensitive, compact (letters and digits only), fuzzy. The first
four are one equi-join on (stage, key) where the lowest stage wins; only distinct names that all
of them leave open go on to the fuzzy join. Work is done per distinct name, not per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.text import compact, strip
from obslake.operators.fuzzy import best_fuzzy_match
from obslake.operators.lookup import lookup_join
from obslake.rules import DEFAULT_RULES, Rules
from obslake.session import materialise

# up to so many canonical names Spark may broadcast their keys; it knows the files they come from, not the keys
BROADCAST_NAMES = 100_000
STAGES = ("alias", "exact", "case_insensitive", "compact", "fuzzy")
ALIAS, EXACT, CASELESS, COMPACT, FUZZY = range(5)


def _keys(name):
    return F.array(
        F.struct(F.lit(EXACT).alias("stage"), name.alias("key")),
        F.struct(F.lit(CASELESS).alias("stage"), F.lower(name).alias("key")),
        F.struct(F.lit(COMPACT).alias("stage"), compact(name).alias("key")),
    )


def _alias_key(name):
    return F.struct(F.lit(ALIAS).alias("stage"), name.alias("key"))


def canonical_keys(canonicals: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """(stage, key, canonical): every key that leads to a canonical name.

    An alias counts only when its target is a canonical name. When two canonical names share a
    folded key, the one that sorts first owns it.
    """
    name = F.col("canonical")
    keys = _keys(name)
    if rules.company_aliases:
        aliases = F.array(*[
            F.struct(F.lit(alias).alias("alias"), F.lit(target).alias("target"))
            for alias, target in rules.company_aliases.items()
        ])
        own = F.filter(aliases, lambda a: a["target"] == name)
        keys = F.concat(F.transform(own, lambda a: _alias_key(a["alias"])), keys)
    return (
        canonicals.select("canonical", F.inline(keys))
        .groupBy("stage", "key").agg(F.min("canonical").alias("canonical"))
    )


def resolve_names(
    names: DataFrame, canonicals: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Resolve a column ``name`` against a column ``canonical``: (name, canonical, stage).

    Only resolved names are returned. The stages before the fuzzy one are run at once and kept as
    a table, since both the answer and the fuzzy stage read them; so are the canonical names.
    """
    canonicals = materialise(
        canonicals.select("canonical").where(F.col("canonical").isNotNull()).distinct(),
        "canonical-names")
    keys = canonical_keys(canonicals, rules)
    if canonicals.count() > BROADCAST_NAMES:
        keys = keys.hint("merge")
    name = F.col("name")
    blocked = name.isin(*rules.unresolvable_companies)
    distinct = names.select(strip(name).alias("name")).where(name != "").distinct()
    asked = distinct.select("name", F.inline(
        F.when(blocked, F.array(_alias_key(name))).otherwise(
            F.concat(F.array(_alias_key(name)), _keys(name)))))
    answered = lookup_join(asked, keys, ["stage", "key"])
    hit = F.when(F.col("canonical").isNotNull(), F.struct("stage", "canonical"))
    staged = materialise(
        answered.groupBy("name").agg(F.min(hit).alias("hit"))
        .select("name", "hit.canonical", "hit.stage"),
        "staged-names",
    )
    open_names = staged.where(F.col("canonical").isNull() & ~blocked).select("name")
    fuzzy = best_fuzzy_match(open_names, canonicals, rules.fuzzy_threshold)
    return staged.where(F.col("canonical").isNotNull()).unionByName(
        fuzzy.select("name", "canonical", F.lit(FUZZY).alias("stage")))


def with_company(
    articles: DataFrame, companies: DataFrame, column: str = "company_name",
    rules: Rules = DEFAULT_RULES, out: str = "company_name_resolved",
    stage_out: str | None = None,
) -> DataFrame:
    """Add the canonical name of each row's company, NULL where it cannot be resolved."""
    raw = F.coalesce(strip(F.col(column)), F.lit(""))
    mapping = materialise(
        resolve_names(articles.select(raw.alias("name")),
                      companies.select(F.col("company_name").alias("canonical")), rules),
        "resolved-names",
    )
    columns = [F.col("name").alias("_r_name"), F.col("canonical").alias(out)]
    if stage_out:
        labels = F.array(*[F.lit(s) for s in STAGES])
        columns.append(F.get(labels, F.col("stage")).alias(stage_out))
    return lookup_join(
        articles.withColumn("_r_name", raw), mapping.select(*columns), "_r_name").drop("_r_name")
