"""Near duplicates by bottom-k sketches: one hash function, inverted lists, exact checks.

Every set of word shingles keeps its ``k`` smallest hashes. Inverted lists of
the retained values propose pairs, the union of two sketches estimates their
similarity, and the full sets decide. Linked documents form classes.

Defined results: a null or empty text has an empty set and is linked with
nothing. Rows that repeat one doc_id count as one document with several texts.
A row without doc_id links with nothing, has no component and is kept. Columns
other than the id and the text are ignored.
"""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from barograph.llm.common import over_batches, stored, word_ids, words_of

SKETCH = 64


def shingles(text, size, cache):
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    ids = np.array(word_ids(words_of(text), cache), dtype=np.uint64)
    if not len(ids):
        return ids.view(np.int64)
    width = min(size, len(ids))
    value = np.zeros(len(ids) - width + 1, dtype=np.uint64)
    for at in range(width):
        value = value * np.uint64(0x9E3779B97F4A7C15) + ids[at : at + len(value)]
        value ^= value >> np.uint64(31)
        value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(29)
    return np.unique(value.view(np.int64))


def least_shared(k, percent):
    """Values two sketches of size k share at the threshold, less six deviations."""
    share = percent / 100
    return max(1, math.floor(k * share - 6 * math.sqrt(k * share * (1 - share))))


def sketched(docs, size, k=SKETCH, id_col="doc_id", text_col="text"):
    """``id, n, sig, sketch`` of every row; equal sets have equal signatures."""

    def make():
        cache = {}

        def step(rows):
            sets = [shingles(text or "", size, cache) for text in rows["text"]]
            return {
                "id": rows["id"],
                "n": [len(s) for s in sets],
                "sig": [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets],
                "sketch": [s[:k] for s in sets],
            }

        return step

    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return over_batches(plain, "id bigint, n bigint, sig binary, sketch array<bigint>", make)


def alike(percent):
    """Whether the sizes of two sets allow the similarity at all."""
    return F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")


def estimated(pairs, sketches, percent, k):
    """Keep pairs whose union sketch does not rule the similarity out.

    Two complete sketches decide exactly. Otherwise the k smallest values of
    the union are a random sample of it; the bound lies six deviations below
    what a pair at the threshold shares.
    """
    side = lambda x: sketches.select(
        F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")
    )
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    common = F.array_intersect("s_a", "s_b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, k)
    complete = F.greatest("n_a", "n_b") <= k
    exact = F.lit(100) * F.size(common) >= F.lit(percent) * (
        F.col("n_a") + F.col("n_b") - F.size(common)
    )
    seen = F.size(F.array_intersect(common, union)) >= least_shared(k, percent)
    return both.where(F.when(complete, exact).otherwise(seen)).select("a", "b")


def measured(pairs, texts, size):
    """``a, b, n_a, n_b, both``: sizes and overlap of the full shingle sets of pairs."""

    def make():
        cache = {}

        def step(rows):
            out, last, mine = [], None, None
            for a, b, x, y in zip(rows["a"], rows["b"], rows["text_a"], rows["text_b"]):
                if (a, x) != last:
                    last, mine = (a, x), shingles(x, size, cache)
                other = shingles(y, size, cache)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                out.append((a, b, len(mine), len(other), both))
            names = ("a", "b", "n_a", "n_b", "both")
            return {name: [row[i] for row in out] for i, name in enumerate(names)}

        return step

    side = lambda x: texts.select(F.col("id").alias(x), F.col("text").alias(f"text_{x}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    schema = "a bigint, b bigint, n_a bigint, n_b bigint, both bigint"
    found = over_batches(joined, schema, make, ["a", "b", "text_a", "text_b"])
    return found.groupBy("a", "b").agg(
        *[F.max_by(c, "both").alias(c) for c in ("n_a", "n_b")], F.max("both").alias("both")
    )


def links(pairs, percent):
    """Measured pairs that reach the similarity."""
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return pairs.where(F.lit(100) * F.col("both") >= F.lit(percent) * union).select("a", "b")


def components(edges, label="components"):
    """``node, component`` of every node of undirected edges ``a, b``.

    Each round takes the smallest label of the neighbours and then the label of
    that label, which halves long chains; the loop ends when no label changes.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    both = stored(both.where("a <> b").distinct(), label)
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("a"), F.min("b")).alias("component")
        ),
        label,
    )
    while True:
        at = labels.select(F.col("node").alias("b"), F.col("component").alias("theirs"))
        least = both.join(at, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("near"))
        best = labels.join(least, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        onward = labels.select(
            F.col("node").alias("component"), F.col("component").alias("further")
        )
        following = stored(
            best.join(onward, "component").select(
                "node", "old", F.least("component", "further").alias("component")
            ),
            label,
        )
        labels = following.select("node", "component")
        if following.where("component <> old").isEmpty():
            return labels


def private_counts(docs, size):
    """``rep, private``: how many shingles of each text occur in no other of these texts."""

    def make():
        cache = {}

        def step(rows):
            sets = [shingles(text, size, cache) for text in rows["text"]]
            return {
                "rep": np.repeat(np.array(rows["id"], dtype=np.int64), [len(s) for s in sets]),
                "value": np.concatenate(sets),
            }

        return step

    spread = over_batches(docs.select("id", "text"), "rep bigint, value bigint", make)
    return (
        spread.groupBy("value")
        .agg(F.count("*").alias("df"), F.min("rep").alias("rep"))
        .where("df = 1")
        .groupBy("rep")
        .agg(F.count("*").alias("private"))
    )


def mixed_lists(lists):
    """Rows of lists that hold several classes."""
    several = (
        lists.groupBy("value")
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high")
        .select("value")
    )
    return lists.join(several, "value", "left_semi")


def side(lists, name, *more):
    """Rows of lists as one side of a pair."""
    plain = {"rep": name, "n": f"n_{name}", "usable": f"u_{name}", "class": f"c_{name}"}
    named = [F.col(old).alias(new) for old, new in plain.items()]
    return lists.select("value", *named, *[F.col(m).alias(f"{m}_{name}") for m in more])


def could_link(met, percent, most, further=None):
    """Distinct ``a < b`` of pairs whose sizes, and ``most`` shared shingles, allow the similarity."""
    enough = F.lit(100 + percent) * most >= F.lit(percent) * (F.col("n_a") + F.col("n_b"))
    allowed = alike(percent) & enough
    met = met.where(allowed if further is None else allowed & further)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def relabelled(lists, edges, classes):
    """Lists with the classes that further edges have joined."""
    of = lambda x: classes.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    between = (
        edges.join(of("a"), "a", "left")
        .join(of("b"), "b", "left")
        .select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    )
    joined = components(between).withColumnRenamed("node", "class")
    return (
        lists.join(joined, "class", "left")
        .withColumn("class", F.coalesce("component", "class"))
        .drop("component")
    )


def near_duplicates(
    docs, size=5, percent=80, k=SKETCH, id_col="doc_id", text_col="text"
):
    """``id, n_shingles, component``: one row per input row.

    Copies of one shingle set are represented by their smallest id. Of the
    retained values of a set only the rarest go into the inverted lists: two
    similar sets share so many that one of these must be among them. A list is
    not compared pair by pair. It first meets its most typical member, which
    joins a family of near copies; where several classes are left, shingles that
    occur in one text alone bound what the text can share, and the list meets
    the most central member by that bound. Only what is still outside the main
    class of a list, and can reach the similarity, meets the other members.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    hashed = stored(sketched(texts, size, k, "id"), "sketches")
    copies = stored(
        hashed.where("id IS NOT NULL AND n > 0")
        .groupBy("sig", "n")
        .agg(F.min("id").alias("rep"), F.first("sketch").alias("sketch")),
        "copies",
    )
    shared_least = least_shared(k, percent)
    postings = copies.select("rep", "n", F.explode("sketch").alias("value"))
    frequent = postings.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    need = F.greatest(
        F.lit(1), F.floor(F.least(F.col("n"), F.lit(k)) * F.lit(shared_least) / F.lit(k))
    ).cast("int")
    lists = stored(
        postings.join(frequent, "value")
        .groupBy("rep", "n")
        .agg(
            F.sum("df").alias("typical"),
            F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"),
        )
        .where(F.size("shared") >= need)
        .select(
            "rep", "n", "typical",
            F.explode(F.expr("slice(shared, 1, size(shared) - need + 1)".replace(
                "need", f"cast(greatest(1, floor(least(n, {k}) * {shared_least} / {k})) as int)"
            ))).alias("entry"),
        )
        .select("rep", "n", "typical", "entry.value"),
        "lists",
    )
    heads = stored(
        lists.groupBy("value")
        .agg(
            F.max(F.struct("typical", F.negative("rep").alias("minus"), "n")).alias("head"),
            F.count("*").alias("members"),
        )
        .where("members > 1")
        .select(
            "value", F.negative("head.minus").alias("head"), F.col("head.n").alias("head_n")
        ),
        "heads",
    )
    first = (
        lists.join(heads, "value")
        .where("rep <> head")
        .select(
            F.least("rep", "head").alias("a"),
            F.greatest("rep", "head").alias("b"),
            F.col("n").alias("n_a"),
            F.col("head_n").alias("n_b"),
        )
        .where(alike(percent))
        .select("a", "b")
        .distinct()
    )
    first = stored(first, "first-pairs")
    sketches = copies.select("rep", "n", "sketch")
    wanted = lambda pairs: texts.join(
        pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi"
    )

    def confirmed(pairs, label):
        near = stored(estimated(pairs, sketches, percent, k), f"{label}-near")
        return stored(measured(near, wanted(near), size), f"{label}-measured")

    overlaps = confirmed(first, "first")
    edges = links(overlaps, percent)
    classes = components(edges)
    placed = stored(
        lists.join(heads.select("value", "head"), "value")
        .join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .select("value", "rep", "n", F.coalesce("component", "rep").alias("class")),
        "placed",
    )
    mixed = stored(mixed_lists(placed), "mixed")
    # No other text of these lists has the private shingles of a text, so they
    # bound what it can share, and the text with the fewest is the most central.
    private = private_counts(
        texts.join(mixed.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), size
    )
    opened = (
        mixed.join(private, "rep", "left")
        .withColumn("usable", F.col("n") - F.coalesce("private", F.lit(0)))
        .where(F.lit(100) * F.col("usable") >= F.lit(percent) * F.col("n"))
        .select("value", "rep", "n", "usable", "class")
    )
    keys = opened.groupBy("rep").agg(F.array_sort(F.collect_set("value")).alias("keys"))
    opened = stored(opened.join(keys, "rep"), "open-lists")
    centres = stored(
        opened.groupBy("value")
        .agg(
            F.max(
                F.struct(
                    (F.col("usable") / F.col("n")).alias("share"), "n",
                    F.negative("rep").alias("minus"), "usable",
                )
            ).alias("centre")
        )
        .select(
            "value", F.negative("centre.minus").alias("b"), F.col("centre.n").alias("n_b"),
            F.col("centre.usable").alias("u_b"),
        ),
        "centres",
    )
    around = side(opened, "a").join(centres, "value").where("a <> b")
    second = stored(
        could_link(around, percent, F.least("u_a", "u_b")).join(first, ["a", "b"], "left_anti"),
        "second-pairs",
    )
    found = confirmed(second, "second")
    more = links(found, percent)
    overlaps = overlaps.union(found).select("a", "b", "both")
    centred = (
        relabelled(opened, more, classes)
        .join(centres.select("value", F.col("b").alias("centre")), "value")
        .withColumns({"a": F.least("rep", "centre"), "b": F.greatest("rep", "centre")})
        .join(overlaps, ["a", "b"], "left")
        .withColumn("inside", F.when(F.col("rep") == F.col("centre"), F.col("n")).otherwise(F.col("both")))
        .drop("a", "b", "both")
    )
    opened = stored(mixed_lists(centred), "last-lists")
    mains = opened.groupBy("value").agg(
        F.max(F.struct((F.col("usable") / F.col("n")).alias("share"), "n", "class")).alias("top")
    )
    minor = opened.join(mains.select("value", F.col("top.class").alias("main")), "value").where(
        F.col("class") != F.col("main")
    )
    met = (
        side(minor, "a", "keys", "inside")
        .join(side(opened, "b", "keys", "inside"), "value")
        .where("c_a <> c_b")
    )
    # What two texts share lies inside of the centre of their list or outside of it.
    bound = F.least("inside_a", "inside_b") + F.least(
        F.col("u_a") - F.col("inside_a"), F.col("u_b") - F.col("inside_b")
    )
    known = F.col("inside_a").isNotNull() & F.col("inside_b").isNotNull()
    most = F.when(known, F.least(bound, "u_a", "u_b")).otherwise(F.least("u_a", "u_b"))
    # Two texts meet in the first list they share, and only there.
    meet = F.array_min(F.array_intersect("keys_a", "keys_b")) == F.col("value")
    third = stored(
        could_link(met, percent, most, meet)
        .join(first, ["a", "b"], "left_anti")
        .join(second, ["a", "b"], "left_anti"),
        "third-pairs",
    )
    last = links(confirmed(third, "third"), percent)
    linked = stored(
        components(edges.union(more).union(last)).withColumnRenamed("node", "rep"), "classes"
    )
    of_copies = copies.join(linked, "rep", "left").select(
        "sig", F.coalesce("component", "rep").alias("component")
    )
    return (
        hashed.drop("sketch")
        .join(of_copies, "sig", "left")
        .select(
            "id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"),
        )
    )
