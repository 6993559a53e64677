"""Mixing sources to target weights by iterative proportional fitting.

Token counts are summed into cells of source, language and topic. A cell is drawn
with the product of one factor per source, language and topic, and with one at
most. Raking sets the factors of one key after the other, so that the tokens drawn
of each of its values meet their target. Cells that are taken whole keep what they
have, and the others are raked again, so the marginals still hold after capping. A
document is drawn with its cell's probability by a hash of its id, so the draw is the
same in every run.

Only DataFrame functions are used. Cells are summed with partial aggregation, so a
source with a third of all rows is no hot spot. A step groups the cells by one key and
stores them scaled; its plan is small and the same in every round.

Defined results: null keys form the group named by an empty text. Null texts
have no tokens; a cell without tokens has probability 1, as it costs nothing. A
null id draws as the text ``null``. A target for a value that does not occur is
spread over those that do, and so is what a target asks beyond the tokens of its
value. Rows that repeat are drawn alike. An empty table gives an empty result.
Extra columns, whatever their names, stay within ``document``.
"""

from pyspark.sql import functions as F

KEYS = ("source", "lang", "topic")
TEMPERATURE = 0.5
BUDGET = 0.5
ROUNDS = 8
# From here on a cell is taken whole. Chances that come to one by rounding errors count as one.
WHOLE = 1 - 1e-9
# A step changes a factor by this much at most, which keeps targets that cannot all be met from
# driving the factors apart.
MOST_CHANGE = 2.0
SEED = "mix-1"
MOST_BROADCAST_CELLS = 100_000


def words_in(text):
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t-\r]+")).cast("bigint")


def form_of(text):
    """A topic by the form of a text: table, marked, shouted, long or short prose."""
    return (
        F.when(text.isNull(), "none")
        .when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("***")) | F.contains(text, F.lit("###")), "marked")
        .when(F.contains(text, F.lit("!! ")), "shouted")
        .when(F.length(text) >= 4000, "long")
        .otherwise("short")
    )


def tempered(cells, key, temperature=TEMPERATURE):
    """``key, target``: weights in proportion to a power of the tokens of each value."""
    tokens = F.sum("base").cast("double")
    return cells.groupBy(key).agg(F.pow(tokens, F.lit(temperature)).alias("target"))


def goals_of(cells, key, target, budget_tokens, stored):
    """``key, goal``: the tokens that are to be drawn of each value.

    Goals are in proportion to the targets. Values whose tokens do not suffice are
    taken whole and the others share the rest; their set only grows, so the loop ends.
    """
    there = cells.groupBy(key).agg(F.sum("base").cast("double").alias("all")).where("all > 0")
    asked = stored(there.join(target.where("target > 0"), key), "targets")
    scale, taken = 0.0, -1
    full = F.lit(False)
    while True:
        now = asked.agg(
            F.count(F.when(full, 1)).alias("taken"),
            F.coalesce(F.sum(F.when(full, F.col("all"))), F.lit(0.0)).alias("tokens"),
            F.sum(F.when(~full, F.col("target"))).alias("target"),
        ).first()
        if now["taken"] == taken or not now["target"]:
            break
        taken = now["taken"]
        scale = max(0.0, budget_tokens - now["tokens"]) / now["target"]
        full = F.lit(scale) * F.col("target") >= F.col("all")
    goal = F.least(F.col("all"), F.lit(scale) * F.col("target"))
    return stored(asked.select(key, goal.alias("goal")), "goals")


def step(cells, key):
    """Cells whose ``chance`` is scaled so that the values of one key meet their goals.

    What the whole cells of a value hold is taken as given and the others are scaled to
    the rest; where whole cells alone hold more than the goal, all are scaled.
    """
    whole, base = F.col("chance") >= WHOLE, F.col("base").cast("double")
    goal = F.col("goal")
    sums = cells.groupBy(key).agg(
        F.max(f"goal_{key}").alias("goal"),
        F.sum(F.when(whole, base).otherwise(0.0)).alias("whole"),
        F.sum(F.when(whole, 0.0).otherwise(base * F.col("chance"))).alias("part"),
    )
    rest = goal - F.col("whole")
    change = (
        F.when((rest > 0) & (F.col("part") > 0), rest / F.col("part"))
        .when(F.col("whole") + F.col("part") > goal, goal / (F.col("whole") + F.col("part")))
        .otherwise(1.0)
    )
    bounded = F.least(F.greatest(change, F.lit(1 / MOST_CHANGE)), F.lit(MOST_CHANGE))
    # A value without tokens, or that no target names, is not to be drawn: its chance fades.
    factors = sums.select(key, F.when(goal.isNull(), 1 / MOST_CHANGE).otherwise(bounded).alias("factor"))
    scaled = cells.join(factors, key).withColumn("chance", F.col("chance") * F.col("factor"))
    return scaled.select(*cells.columns)


def rake(cells, goals, budget, stored, rounds=ROUNDS):
    """Cells with ``probability`` such that the tokens drawn by each key meet its goals.

    ``goals`` maps a key to a table of the key and its ``goal`` in tokens. A cell carries
    its three goals and its chance, the product of all factors so far.
    """
    raked = cells.withColumn("chance", F.lit(float(budget)))
    for key in KEYS:
        raked = raked.join(goals[key].withColumnRenamed("goal", f"goal_{key}"), key, "left")
    raked = stored(raked, "raked")
    for _ in range(rounds):
        for key in KEYS:
            raked = stored(step(raked, key), "raked")
    chance = F.when(F.col("base") == 0, 1.0).otherwise(F.least(F.lit(1.0), F.col("chance")))
    return raked.select(*KEYS, "base", F.round(chance, 6).alias("probability"))


def draw(ids, seed=SEED):
    """A number in [0, 1) by a hash of the id."""
    text = F.concat(F.coalesce(ids.cast("string"), F.lit("null")), F.lit(f"/{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def keyed(docs, topic):
    """Each row as ``document``, with its three keys as ``k_source, k_lang, k_topic`` and ``k_tokens``."""
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    every = [docs["`" + c.replace("`", "``") + "`"] for c in docs.columns]
    return docs.select(
        F.struct(*every).alias("document"),
        name(docs["source"]).alias("k_source"),
        name(docs["lang"]).alias("k_lang"),
        name(topic).alias("k_topic"),
        words_in(docs["text"]).alias("k_tokens"),
    )


def mix(
    docs, stored, topic=None, targets=None, budget=BUDGET, seed=SEED, temperature=TEMPERATURE,
    most_broadcast=MOST_BROADCAST_CELLS,
):
    """All rows as ``document``, with ``k_`` keys, ``probability`` and ``kept``.

    ``budget`` is the share of all tokens that the drawn documents should have.
    Without ``targets`` (key to a table of the key and ``target`` weights) shares
    follow tempered token counts. ``topic`` is a column of ``docs``; by default the
    form of the text stands for it. Cells beyond ``most_broadcast`` meet the documents
    in a plain join, whose hot cells adaptive execution splits.
    """
    marked = keyed(docs, form_of(docs["text"]) if topic is None else topic)
    cells = (
        marked.groupBy(*[F.col(f"k_{k}").alias(k) for k in KEYS])
        .agg(F.sum("k_tokens").alias("base"))
        .select(*KEYS, "base")
    )
    cells = stored(cells, "cells")
    size = cells.agg(F.count("*").alias("n"), F.sum("base").alias("tokens")).first()
    goals = {}
    for key in KEYS:
        target = (targets or {}).get(key)
        target = tempered(cells, key, temperature) if target is None else target
        goals[key] = goals_of(cells, key, target, budget * (size["tokens"] or 0), stored)
    chosen = rake(cells, goals, budget, stored).select(
        *[F.col(k).alias(f"k_{k}") for k in KEYS], "probability"
    )
    if size["n"] <= most_broadcast:
        chosen = F.broadcast(chosen)
    return marked.join(chosen, [f"k_{k}" for k in KEYS]).withColumn(
        "kept", draw(F.col("document.doc_id"), seed) < F.col("probability")
    )


def drawn(docs, stored, **options):
    """The rows of ``docs`` that are drawn, as they are."""
    return mix(docs, stored, **options).where("kept").select("document.*")
