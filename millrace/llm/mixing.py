"""Mixing sources to target weights in DataFrame operations: budgets go down a tree, documents are taken in a seeded order."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.llm.words import saved

#: Hex digits of the order that cut a leaf into slices whose tokens are summed first; only one slice of a leaf is then sorted.
SLICE_DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """levels: name and expression from the root down. weights: whole numbers by level and value, else 1.

    The budget is `parts` of `of` of all tokens; a leaf gives at most `epochs` times its tokens.
    """

    levels: tuple[tuple[str, str], ...] = (("domain", "domain"), ("lang", "lang"), ("source", "source"))
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    parts: int = 9
    of: int = 10
    epochs: int = 3
    seed: int = 17

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.levels]


def _weight(level: str, how: Mix) -> Column:
    known = how.weights.get(level, {})
    pairs = [F.lit(x) for name, weight in known.items() for x in (name, int(weight))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(level)), F.lit(1)) if pairs else F.lit(1)


def _filled(children: DataFrame, parents: list[str], level: str, how: Mix) -> DataFrame:
    """`budget` of each child: by weight, where a child that has less gives the rest to its siblings.

    In the order of capacity per weight the children that get all they have come first; the others share what is left.
    """
    whole = "decimal(38,0)"
    rows = children.withColumn("weight", _weight(level, how).cast(whole)).withColumn("room", F.col("capacity").cast(whole))
    order = Window.partitionBy(*parents).orderBy(F.col("capacity").cast("double") / F.nullif(F.col("weight").cast("double"), F.lit(0.0)), level)
    group = Window.partitionBy(*parents)
    rows = rows.withColumn("before", F.coalesce(F.sum("room").over(order.rowsBetween(Window.unboundedPreceding, -1)).cast(whole), F.lit(0).cast(whole)))
    rows = rows.withColumn("after", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(whole))
    left = F.col("of_parent").cast(whole) - F.col("before")
    rows = rows.withColumn("full", (F.col("weight") > 0) & (F.col("room") * F.col("after") <= F.col("weight") * left))
    rows = rows.withColumn("taken", F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(group).cast(whole))
    rows = rows.withColumn("shares", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(group).cast(whole))
    share = F.expr("((cast(of_parent as decimal(38,0)) - taken) * weight) div nullif(shares, 0)")
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(F.coalesce(share, F.lit(0).cast("long")))
    return rows.withColumn("budget", F.least(budget, F.col("capacity"))).drop("weight", "room", "before", "after", "full", "taken", "shares", "of_parent")


def leaf_budgets(leaves: DataFrame, how: Mix) -> DataFrame:
    """`leaves` (levels, tokens) with `budget`, the tokens to take of each.

    A node can give what its leaves can give, so a parent's budget never exceeds what its children have: a shortage is made up by
    siblings, and only what all of them lack reaches the siblings of the parent.
    """
    names = how.names
    sized = leaves.withColumn("capacity", F.col("tokens") * how.epochs)
    total = leaves.agg(F.sum("tokens").cast("decimal(38,0)").alias("all_tokens"))
    goal = F.expr(f"(coalesce(all_tokens, 0) * {how.parts}) div {how.of}")
    upper = total.select(F.least(goal, (F.coalesce("all_tokens", F.lit(0)) * how.epochs).cast("long")).alias("budget"))
    for depth in range(1, len(names) + 1):
        parents = names[: depth - 1]
        children = sized.groupBy(*names[:depth]).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        above = upper.select(*parents, F.col("budget").alias("of_parent"))
        children = children.join(above, parents) if parents else children.join(F.broadcast(above))  # one row
        upper = _filled(children, parents, names[depth - 1], how)
    return upper.select(*names, "tokens", "budget")


def _order(epoch: Column, id_column: str, how: Mix) -> Column:
    return F.md5(F.concat(F.lit(f"{how.seed}/"), epoch.cast("string"), F.lit("/"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))).alias("place")


def mixed_sources(docs: DataFrame, how: Mix, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, levels, n_tokens, copies) of the documents to take; `row` has all columns of `docs`.

    Tokens are runs without white space. Each leaf takes all documents as often as its budget holds all of them, then the documents
    of one more epoch, in the order of a hash of seed, epoch and id, as long as their tokens fit. The place up to which
    they fit is found by the token sums of slices of the order, and by sorting the one slice where the budget ends; a leaf's documents are
    never sorted together.

    Null and empty texts have 0 tokens and cost nothing. A null level is the value 'unknown'. Rows of one id share a place, and
    are taken together or not. A leaf without tokens gives nothing; an empty table gives an empty result.
    """
    names = how.names
    level_columns = [F.coalesce(F.expr(expression).cast("string"), F.lit("unknown")).alias(name) for name, expression in how.levels]
    tokens = F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens")
    narrow = saved(docs.select(*level_columns, F.col(id_column).alias("doc_key"), tokens), "tokens")
    leaves = saved(narrow.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = leaf_budgets(leaves, how).where("tokens > 0").select(
        *names, F.expr("budget div tokens").alias("full_epochs"), F.expr("budget % tokens").alias("rest")
    )
    plan = saved(plan, "plan")

    placed = narrow.join(plan.where("rest > 0"), names).withColumn("place", _order(F.col("full_epochs"), "doc_key", how))
    sliced = placed.withColumn("slice", F.substring("place", 1, SLICE_DIGITS))
    slices = sliced.groupBy(*names, "slice", "rest").agg(F.sum("n_tokens").alias("tokens"))
    ends = F.sum("tokens").over(Window.partitionBy(*names).orderBy("slice"))
    slices = slices.withColumn("end", ends).withColumn("begin", F.col("end") - F.col("tokens"))
    whole = slices.where("end <= rest").groupBy(*names).agg(F.max(F.concat("slice", F.lit("g"))).alias("last"))
    cut = slices.where("begin <= rest and end > rest").groupBy(*names).agg(F.min(F.struct("slice", "begin")).alias("cut"))
    inside = sliced.join(cut, names).where("slice = cut.slice")
    upto = F.col("cut.begin") + F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("place"))
    last_inside = inside.withColumn("upto", upto).where("upto <= rest").groupBy(*names).agg(F.max("place").alias("last"))
    limits = whole.unionByName(last_inside).groupBy(*names).agg(F.max("last").alias("last_place"))
    plan = saved(plan.join(limits, names, "left"), "plan")

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *level_columns, tokens)
    one_more = F.coalesce(_order(F.col("full_epochs"), f"row.{id_column}", how) <= F.col("last_place"), F.lit(False))
    return (
        rows.join(plan, names)
        .withColumn("copies", F.col("full_epochs") + one_more.cast("long"))
        .where("copies > 0")
        .select("row", *names, "n_tokens", "copies")
    )
