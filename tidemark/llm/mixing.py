"""Mixing sources to target weights by hierarchical budgeting, in built-in functions only.

A budget of tokens flows down a tree of groups (say domain, language, source). At each node
it is dealt to the children by weight; what a child cannot use, because all its documents
over all epochs hold fewer tokens, goes to its siblings by weight, and only what no sibling
can use is left to the node's own siblings. A leaf then takes whole epochs of its documents
and, of the last one, the prefix of a seeded order that fits.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import spread_rank, store

WORD = r"[^\x20\x09-\x0D]+"


def _weight(level: int, column: str, weights: dict[tuple[int, str], int]) -> Column:
    own = {name: weight for (at, name), weight in weights.items() if at == level}
    known = F.create_map(*[F.lit(x) for x in chain(*own.items())])[F.col(column)] if own else F.lit(None).cast("int")
    return F.coalesce(known, F.lit(1)).cast("decimal(9,0)")


def deal(children: DataFrame, parent: list[str], ties: str) -> DataFrame:
    """Add ``dealt`` to children with ``weight``, ``room`` and their parent's ``budget``.

    Children are taken in the order of room per weight: one whose room is no more than its
    share of what is left gets all of it, and those after the last such child share the
    rest, rounded down. A weight of 0 gets nothing.
    """
    order = Window.partitionBy(*parent).orderBy(F.expr("if(weight = 0, double('infinity'), cast(room as double) / cast(weight as double))"), ties)
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    zero = F.lit(0).cast("decimal(28,0)")
    out = children.withColumn("left", F.col("budget").cast("decimal(28,0)") - F.coalesce(F.sum("room").over(before), zero))
    out = out.withColumn("rest", F.sum("weight").over(after))
    out = out.withColumn("full", F.expr("weight > 0 and cast(room as decimal(19,0)) * cast(rest as decimal(19,0)) <= cast(weight as decimal(9,0)) * left"))
    sums = {
        "used": F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(whole), zero),
        "shared": F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole),
    }
    out = out.withColumns(sums)
    part = F.expr("if(full, cast(room as bigint), if(weight = 0, 0L, cast(floor(cast(weight as decimal(9,0)) * cast(budget - used as decimal(19,0)) div shared) as bigint)))")
    return out.withColumn("dealt", part).drop("left", "rest", "full", "used", "shared")


def mix(
    docs: DataFrame,
    levels: dict[str, Column],
    weights: dict[tuple[int, str], int],
    share: tuple[int, int] = (1, 1),
    epochs: int = 2,
    seed: str = "mix",
    tokens: Column | None = None,
    key: Column | None = None,
) -> DataFrame:
    """``doc_id``, the ``levels``, ``n_tokens``, ``leaf_budget`` and ``copies`` (0 or more) for every row of ``docs``.

    ``levels`` names the tree's levels from the top; ``weights`` gives whole weights for
    ``(level, value)``, 1 where none is given; ``share`` is the budget as a fraction of all
    tokens; no document is taken more than ``epochs`` times; ``tokens`` counts a row's
    tokens, white-space words by default. Null level values are a group named by the empty
    string. Null and empty texts hold no tokens; they are taken where the running total
    fits, so in a leaf without tokens always once. Rows that repeat an id and a text
    follow each other. Other columns are ignored. An empty table gives an empty result.
    With ``key``, a long that tells rows of one id apart, there is a last column ``key``.
    """
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)) if tokens is None else tokens
    names = list(levels)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.coalesce(value.cast("string"), F.lit("")).alias(name) for name, value in levels.items()],
        tokens.cast("long").alias("n_tokens"),
        F.xxhash64("text").alias("tie"),
        *([] if key is None else [key.cast("long").alias("key")]),
    )
    rows = store(rows, "mix-rows")
    leaves = store(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budgets = None
    for level, name in enumerate(names):
        path = names[: level + 1]
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * epochs).cast("decimal(18,0)").alias("room"))
        nodes = nodes.withColumn("weight", _weight(level, name, weights))
        if budgets is None:
            nodes = nodes.withColumn("budget", F.lit(total * share[0] // share[1]).cast("decimal(18,0)"))
        else:
            nodes = nodes.join(budgets, names[:level])
        budgets = deal(nodes, names[:level], name).select(*path, F.col("dealt").cast("decimal(18,0)").alias("budget"))
    plan = leaves.join(budgets, names).select(
        *[F.col(name).alias(f"_{name}") for name in names],
        F.col("budget").cast("long").alias("leaf_budget"),
        F.expr("if(tokens = 0, 0L, cast(budget as bigint) div tokens)").alias("whole"),
        F.expr("if(tokens = 0, 0L, cast(budget as bigint) % tokens)").alias("over"),
    )
    # Stored, so that its size is known before the join: dealing rows by leaf would put a hot leaf into one task.
    plan = store(plan, "mix-plan")
    on = [rows[name] == plan[f"_{name}"] for name in names]
    condition = on[0]
    for one in on[1:]:
        condition = condition & one
    drawn = rows.join(plan, condition).drop(*[f"_{name}" for name in names])
    digest = F.md5(F.concat_ws("/", F.lit(seed), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    # The order is 60 bits, moved up so that its first 14 tell the slices.
    drawn = drawn.withColumn("place", F.shiftleft(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), 4))
    drawn = spread_rank(drawn, names, F.col("place"), [F.col("doc_id"), F.col("tie")], "earlier", F.col("n_tokens"), bits=14)
    last = (F.col("whole") < epochs) & (F.col("earlier") + F.col("n_tokens") <= F.col("over"))
    return drawn.select("doc_id", *names, "n_tokens", "leaf_budget", (F.col("whole") + last.cast("long")).alias("copies"), *([] if key is None else ["key"]))
