"""Mixing sources to target shares of tokens.

Each mix is a tree: domain, language, source. A source has a leaf in each (domain, language) that it has documents of. Weights
start at the root: a domain's weight is that of its languages, theirs that of their leaves, and a leaf's is the target share of
its source by the leaf's part of the source's tokens; so weights can be handed down level by level. A leaf gives at most
max_repeats times its tokens. What it can't give is taken over by its siblings (same domain and language), then within the domain,
then by the whole mix, always in proportion to weights. Of each leaf whole epochs are taken, then a prefix of one more epoch, in an
order of documents that the seed and the epoch give.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUDGETS = "mix_id long, source_code string, domain string, language string, target_share double, max_repeats long, tokens long, source_tokens long, total_tokens long, weight double, target_tokens double, reachable boolean, granted_tokens double, reached_share double"


def _fill(leaves: pd.DataFrame, at, spare: float) -> float:
    """Gives `spare` tokens to the leaves `at` in proportion to their weights, up to their capacities; returns the rest."""
    while spare > 1e-6:
        group = leaves.loc[at]
        room = group[group.capacity - group.granted > 1e-9]
        weight = room.weight.sum()
        if room.empty or weight <= 0:
            break
        add = (spare * room.weight / weight).clip(upper=room.capacity - room.granted)
        leaves.loc[room.index, "granted"] += add
        spare -= add.sum()
        if add.sum() <= 1e-9:
            break
    return max(0.0, spare)


def _budget(mix: pd.DataFrame) -> pd.DataFrame:
    leaves = mix.sort_values(["domain", "language", "source_code"]).reset_index(drop=True)
    total = int(leaves.tokens.sum())
    part = (leaves.tokens / leaves.source_tokens.where(leaves.source_tokens > 0)).fillna(1.0)
    own = leaves.target_share * part
    domains, siblings = leaves.groupby("domain", dropna=False).groups, leaves.groupby(["domain", "language"], dropna=False).groups
    # down the tree: what a node gets is parted among its children by their weights
    leaves["weight"], leaves["target_tokens"] = own, 0.0
    for domain, at in domains.items():
        of_domain = own.sum() and total * own.sum() * own[at].sum() / own.sum()
        for (name, _), below in siblings.items():
            if name == domain and own[at].sum() > 0:
                of_language = of_domain * own[below].sum() / own[at].sum()
                leaves.loc[below, "target_tokens"] = of_language * own[below] / own[below].sum() if own[below].sum() > 0 else 0.0
    leaves["capacity"] = leaves.max_repeats * leaves.tokens.astype(float)
    leaves["granted"] = leaves[["capacity", "target_tokens"]].min(axis=1)
    leaves["reachable"] = leaves.max_repeats * leaves.source_tokens.astype(float) >= leaves.target_share * total
    short = leaves.target_tokens - leaves.granted
    left: dict = {}
    for (domain, _), at in siblings.items():
        left[domain] = left.get(domain, 0.0) + _fill(leaves, at, short[at].sum())
    rest = sum(_fill(leaves, at, left.get(domain, 0.0)) for domain, at in domains.items())
    _fill(leaves, leaves.index, rest)
    given = leaves.granted.sum()
    leaves["total_tokens"] = total
    leaves["granted_tokens"] = leaves.granted
    leaves["reached_share"] = leaves.granted / given if given else 0.0
    return leaves[[c.split()[0] for c in BUDGETS.split(", ")]]


def source_profile(tokens: DataFrame) -> DataFrame:
    """Of rows (source, language, domain, n_tokens): the leaves (source, domain, language, tokens, source_tokens)."""
    at = [F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("language", F.lit("")).alias("language")]
    leaves = tokens.groupBy("source", *at).agg(F.sum("n_tokens").alias("tokens"))
    return leaves.withColumn("source_tokens", F.sum("tokens").over(Window.partitionBy("source")))


def mix_budgets(targets: DataFrame, profile: DataFrame) -> DataFrame:
    """One row for each leaf (mix_id, source_code, domain, language) of targets: its budget, whether the target of its source is
    reachable, and its reached share.

    A source without documents has one leaf without tokens. Rows without mix, source or share are left out; a null max_repeats is 1,
    a negative one 0; of a source listed twice in a mix the greatest share and repeats hold. A mix has a row for each source,
    domain and language at most, so one task can hold it.
    """
    clean = targets.where("mix_id is not null and source_code is not null and target_share is not null")
    repeats = F.greatest(F.coalesce(F.col("max_repeats").cast("long"), F.lit(1)), F.lit(0))
    clean = clean.groupBy("mix_id", "source_code").agg(F.max("target_share").alias("target_share"), F.max(repeats).alias("max_repeats"))
    known = clean.join(profile.withColumnRenamed("source", "source_code"), "source_code", "left").fillna({"tokens": 0, "source_tokens": 0, "domain": "", "language": ""})
    return known.groupBy("mix_id").applyInPandas(_budget, BUDGETS)


def mix_selection(budgets: DataFrame, tokens: DataFrame, seed: int = 0, range_tokens: int = 4_000_000) -> DataFrame:
    """Rows (mix_id, source_code, doc_id, n_tokens, copies): whole epochs for all documents of a leaf, one copy more for a prefix.

    tokens: doc_id, source, domain, language, n_tokens. The prefix is the longest, in the seeded order of the leaf's last epoch, that
    fits what is left of its budget. Running sums are taken in two steps (over hash ranges of about range_tokens each, then inside
    each), so neither a leaf nor a range has to grow with the corpus in one task. Documents without tokens are taken in no prefix.
    """
    at = ["mix_id", "source_code", "domain", "language"]
    plan = budgets.where("tokens > 0 and granted_tokens > 0").select(*at, "tokens", "granted_tokens")
    plan = plan.withColumn("epochs", F.floor(F.col("granted_tokens") / F.col("tokens") + 1e-9).cast("long"))
    plan = plan.withColumn("rest", F.col("granted_tokens") - F.col("epochs") * F.col("tokens")).withColumn("ranges", F.ceil(F.col("tokens") / range_tokens))
    placed = tokens.where("n_tokens > 0").select("doc_id", F.col("source").alias("source_code"), F.coalesce("domain", F.lit("")).alias("domain"), F.coalesce("language", F.lit("")).alias("language"), "n_tokens")
    drawn = placed.join(plan, ["source_code", "domain", "language"])
    draw = F.xxhash64(F.lit(seed), "mix_id", "epochs", "doc_id")
    drawn = drawn.withColumn("draw", draw).withColumn("bucket", F.floor((F.col("draw") / F.lit(2.0**64) + 0.5) * F.col("ranges")))
    ranges = drawn.groupBy(*at, "bucket").agg(F.sum("n_tokens").alias("sum"))
    ahead = F.coalesce(F.sum("sum").over(Window.partitionBy(*at).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.sum("n_tokens").over(Window.partitionBy(*at, "bucket").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    summed = drawn.withColumn("upto", inside).join(ranges.withColumn("ahead", ahead).drop("sum"), [*at, "bucket"])
    copies = F.col("epochs") + (F.col("ahead") + F.col("upto") <= F.col("rest") + 1e-6).cast("long")
    return summed.select(*at, "doc_id", "n_tokens", copies.alias("copies")).where("copies > 0")
