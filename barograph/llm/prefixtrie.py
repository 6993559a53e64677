"""The trie of conversation prefixes, in balanced parentheses per shard.

A node is a distinct sequence of first turns; its members are the conversations
that begin with it. Conversations are cut into layers of ``LAYER`` turns, so that
no row grows with a conversation. A prefix is known by the exclusive or of 128-bit
hashes of its turns, each with its place. Equal paths of one layer are counted
before anything else, so a group of copies is one row.

Paths are sorted over the cluster, and every ``SHARD`` neighbours are written as
balanced parentheses: a node opens, its subtree follows, it closes. Blocks of
``BLOCK`` parentheses know the least and greatest excess of opened over closed
ones, and a tree over the blocks finds the parenthesis that closes a node, which
delimits its subtree. The rank of pairs "()" counts the leaves between, cumulative
sums over the nodes give members and savings.

A node whose subtree goes on in the next shard lies on a spine that both shards
hold. Sums over shards merge in one grouping; what the spine itself was counted
twice for is taken from the last path of a shard and the first path of the next.
Subtrees of deeper layers are added to the nodes above by sums over their members.

Defined results: turns count by number, those without number first; equal numbers
by role, then text (by their first 64 characters, then by hash). Rows that repeat
are turns of their own. A null role or text is empty. Rows without conv_id take no
part. A conversation without turns is a member of the root alone. An empty table
gives no rows, not even a root. Extra columns are left out, whatever their names.
Turns and conversations may be of any length.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

LAYER = 64
SHARD = 16_384
BLOCK = 256
CHUNK = 8_192
WORD = "[^\\x20\\x09-\\x0D]+"
NODE = ["depth", "ka", "kb"]


class Parentheses:
    """Balanced parentheses with blocks of least and greatest excess."""

    def __init__(self, bits):
        self.bits = np.asarray(bits, dtype=np.int8)
        size = len(self.bits)
        self.excess = np.cumsum(2 * self.bits.astype(np.int64) - 1)
        blocks = max(1, -(-size // BLOCK))
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[:size] = self.excess
        self.blocks = padded.reshape(blocks, BLOCK)
        self.least = [self.blocks.min(axis=1)]
        while len(self.least[-1]) > 1:
            level = self.least[-1]
            if len(level) % 2:
                level = np.append(level, np.iinfo(np.int64).max)
            self.least.append(level.reshape(-1, 2).min(axis=1))
        self.greatest = np.where(self.blocks == padded.max(), -1, self.blocks).max(axis=1)
        self.opened = np.concatenate([[0], np.cumsum(self.bits)])
        pairs = np.zeros(size, dtype=np.int64)
        pairs[:-1] = (self.bits[:-1] == 1) & (self.bits[1:] == 0)
        self.pairs = pairs

    def find_close(self, places):
        """Where the nodes that open at ``places`` close: the next lesser excess."""
        places = np.asarray(places, dtype=np.int64)
        out = np.empty(len(places), dtype=np.int64)
        for start in range(0, len(places), 65_536):
            out[start : start + 65_536] = self._find_close(places[start : start + 65_536])
        return out

    def _find_close(self, places):
        wanted, block = self.excess[places], places // BLOCK
        at, found = self._within(block, wanted, places % BLOCK)
        far = np.flatnonzero(~found)
        if len(far):
            next_block = self._next_block(block[far], wanted[far])
            at[far] = self._within(next_block, wanted[far], np.full(len(far), -1))[0]
        return at

    def _within(self, block, wanted, after):
        """First place of a block, beyond ``after``, with less excess; is there one?"""
        less = self.blocks[block] < wanted[:, None]
        less &= np.arange(BLOCK) > after[:, None]
        return block * BLOCK + less.argmax(axis=1), less.any(axis=1)

    def _next_block(self, block, wanted):
        """The next block after ``block`` whose least excess is below ``wanted``."""
        node, level = block.copy(), np.zeros(len(block), dtype=np.int64)
        climbing = np.ones(len(block), dtype=bool)
        for height, least in enumerate(self.least):
            right = np.minimum(node + 1, len(least) - 1)
            here = climbing & (node % 2 == 0) & (right > node) & (least[right] < wanted)
            node = np.where(here, right, np.where(climbing, node // 2, node))
            level = np.where(here, height, level)
            climbing &= ~here
        for height in range(len(self.least) - 1, 0, -1):
            least = self.least[height - 1]
            down = level == height
            left = np.minimum(2 * node, len(least) - 1)
            node = np.where(down, 2 * node + (least[left] >= wanted), node)
            level = np.where(down, height - 1, level)
        return node


class Paths:
    """Distinct sorted paths of one or more layers, as padded arrays."""

    NAMES = ["layer", "pa", "pb", "n", "member", "goes_on"]

    def __init__(self, columns, lengths, ha, hb, words):
        self.columns, self.lengths = columns, lengths
        size, place = len(lengths), np.arange(LAYER)
        self.here = place < lengths[:, None]
        self.ha, self.hb, self.words = (np.zeros((size, LAYER), dtype=np.int64) for _ in range(3))
        self.ha[self.here], self.hb[self.here], self.words[self.here] = ha, hb, words

    @classmethod
    def read(cls, batch):
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in cls.NAMES}
        path = batch.column("path")
        lengths = np.diff(path.offsets.to_numpy())
        turns = path.flatten()
        return cls(columns, lengths, *(turns.field(n).to_numpy() for n in ("ha", "hb", "w")))

    def take(self, start, stop):
        part = object.__new__(Paths)
        part.columns = {n: c[start:stop] for n, c in self.columns.items()}
        for name in ("lengths", "here", "ha", "hb", "words"):
            setattr(part, name, getattr(self, name)[start:stop])
        return part

    @staticmethod
    def joined(parts):
        whole = object.__new__(Paths)
        whole.columns = {n: np.concatenate([p.columns[n] for p in parts]) for n in Paths.NAMES}
        for name in ("lengths", "here", "ha", "hb", "words"):
            setattr(whole, name, np.concatenate([getattr(p, name) for p in parts]))
        return whole

    def __len__(self):
        return len(self.lengths)

    def shared(self):
        """Per path the nodes it shares with the one before, its root included; 0 for the first."""
        out = np.zeros(len(self), dtype=np.int64)
        if len(self) > 1:
            same = (self.ha[1:] == self.ha[:-1]) & (self.hb[1:] == self.hb[:-1])
            same &= self.here[1:] & self.here[:-1]
            same = np.concatenate([same, np.zeros((len(same), 1), dtype=bool)], axis=1)
            rooted = np.ones(len(same), dtype=bool)
            for name in ("layer", "pa", "pb"):
                rooted &= self.columns[name][1:] == self.columns[name][:-1]
            out[1:] = np.where(rooted, 1 + same.argmin(axis=1), 0)
        return out

    def keys(self, side):
        """The key of every prefix of every path, the root's first."""
        root = self.columns["pa" if side == 0 else "pb"][:, None]
        turns = self.ha if side == 0 else self.hb
        return np.bitwise_xor.accumulate(np.concatenate([root, turns], axis=1), axis=1)


def shard_nodes(paths):
    """One row per node of a shard: its key and the sums over its part of the subtree."""
    shared, nodes = paths.shared(), paths.lengths + 1
    opens = nodes - shared
    closes = np.concatenate([[0], nodes[:-1] - shared[1:]])
    steps = np.stack([closes, opens], axis=1).ravel()
    bits = np.repeat(np.tile([0, 1], len(paths)), steps)
    bits = np.concatenate([bits, np.zeros(nodes[-1], dtype=bits.dtype)])
    tree = Parentheses(bits)
    row = np.repeat(np.arange(len(paths)), opens)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(opens) - opens, opens) + shared[row]
    places = np.flatnonzero(tree.bits)
    ends = tree.find_close(places)
    first, stop = np.arange(len(row)), tree.opened[ends]
    ending = depth == paths.lengths[row]

    def between(values):
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[stop] - sums[first]

    members = between(np.where(ending, paths.columns["n"][row], 0))
    # The pair of a path that goes on in the next layer is no leaf.
    leaf = tree.pairs[places] * ~(ending & paths.columns["goes_on"][row].astype(bool))
    words = np.where(depth > 0, paths.words[row, np.maximum(depth - 1, 0)], 0)
    layer = paths.columns["layer"][row]
    ka, kb = paths.keys(0), paths.keys(1)
    up = np.maximum(depth - 1, 0)
    return {
        "depth": layer * LAYER + depth,
        "ka": ka[row, depth],
        "kb": kb[row, depth],
        "top": (depth == 0) & (layer > 0),
        "qa": ka[row, up],
        "qb": kb[row, up],
        "n": members,
        "member": least_between(
            np.where(ending, paths.columns["member"][row], np.iinfo(np.int64).max), first, stop
        ),
        "leaves": between(leaf),
        "saved": between(members * words) - between(words),
    }


def least_between(values, first, stop):
    """The least of ``values[first:stop]`` for many ranges, by minima over powers of two."""
    levels, width = [values], 1
    while 2 * width <= len(values):
        levels.append(np.minimum(levels[-1][:-width], levels[-1][width:]))
        width *= 2
    size = np.frexp((stop - first).astype(np.float64))[1] - 1
    out = np.empty(len(first), dtype=np.int64)
    for level, least in enumerate(levels):
        mine = size == level
        out[mine] = np.minimum(least[first[mine]], least[stop[mine] - (1 << level)])
    return out


def spine(before, after):
    """What two neighbouring shards both counted, taken back: the nodes their edge paths share."""
    pair = Paths.joined([before, after])
    shared = int(pair.shared()[1])
    ka, kb = pair.keys(0)[1, :shared], pair.keys(1)[1, :shared]
    words = np.concatenate([[0], pair.words[1, : max(0, shared - 1)]])[:shared]
    layer = int(pair.columns["layer"][1])
    ended = int(pair.lengths[0]) == shared - 1 and not bool(pair.columns["goes_on"][0])
    depth = np.arange(shared)
    return {
        "depth": layer * LAYER + depth,
        "ka": ka,
        "kb": kb,
        "top": (depth == 0) & (layer > 0),
        "leaves": np.full(shared, -1 if ended else 0),
        "saved": np.cumsum(words[::-1])[::-1],
    }


PARTS = pa.schema(
    [
        ("part", pa.int64()), ("edge", pa.int64()), ("depth", pa.int64()), ("ka", pa.int64()),
        ("kb", pa.int64()), ("top", pa.bool_()), ("qa", pa.int64()), ("qb", pa.int64()),
        ("n", pa.int64()), ("member", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
        ("layer", pa.int64()), ("pa", pa.int64()), ("pb", pa.int64()), ("goes_on", pa.bool_()),
        ("ha", pa.list_(pa.int64())), ("hb", pa.list_(pa.int64())), ("w", pa.list_(pa.int64())),
    ]
)
KINDS = {pa.int64(): "bigint", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<bigint>"}
PARTS_DDL = ", ".join(f"{f.name} {KINDS[f.type]}" for f in PARTS)


def part_batch(columns, size):
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[f.name], type=f.type) if f.name in columns else pa.nulls(size, f.type)
            for f in PARTS
        ],
        schema=PARTS,
    )


def edge_batch(paths, at, part, edge):
    """The first (edge 1) or last (edge 2) path of a part, as one row."""
    row = paths.take(at, at + 1)
    size = int(row.lengths[0])
    columns = {n: row.columns[n] for n in ("layer", "pa", "pb", "goes_on")}
    columns |= {"part": [part], "edge": [edge]}
    columns |= {n: [v[0, :size]] for n, v in (("ha", row.ha), ("hb", row.hb), ("w", row.words))}
    return part_batch(columns, 1)


def encode_shards(batches):
    """Nodes of the shards of one part, with the part's first and last path."""
    part, waiting, before = TaskContext.get().partitionId(), None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        read = Paths.read(batch)
        if before is None and waiting is None:
            yield edge_batch(read, 0, part, 1)
        waiting = read if waiting is None else Paths.joined([waiting, read])
        while len(waiting) > SHARD:
            yield from encode_shard(waiting.take(0, SHARD), before, part)
            before, waiting = waiting.take(SHARD - 1, SHARD), waiting.take(SHARD, len(waiting))
    if waiting is not None:
        yield from encode_shard(waiting, before, part)
        yield edge_batch(waiting, len(waiting) - 1, part, 2)


def encode_shard(paths, before, part):
    for columns in (shard_nodes(paths), before and spine(before, paths.take(0, 1))):
        if columns and len(columns["depth"]):
            size = len(columns["depth"])
            yield part_batch(columns | {"part": np.full(size, part), "edge": np.zeros(size)}, size)


def merge_spines(batches):
    """Spines of rows that hold the last path of a part beside the first one of the next."""
    for batch in batches:
        for row in batch.to_pylist():
            pair = [
                Paths(
                    {n: np.array([row[f"{side}_{n}"]]) for n in ("layer", "pa", "pb", "goes_on")}
                    | {"n": np.zeros(1), "member": np.zeros(1)},
                    np.array([len(row[f"{side}_ha"])]),
                    *(np.array(row[f"{side}_{n}"], dtype=np.int64) for n in ("ha", "hb", "w")),
                )
                for side in ("last", "first")
            ]
            columns = spine(*pair)
            if len(columns["depth"]):
                yield part_batch(columns, len(columns["depth"]))


def number_turns(batches):
    """Number the turns of each conversation within a sorted part; mark the part's last row."""
    part, last_id, count, held = TaskContext.get().partitionId(), None, 0, None

    def marked(batch, last):
        flags = np.zeros(batch.num_rows, dtype=bool)
        flags[-1] = last
        return batch.append_column(pa.field("last", pa.bool_()), pa.array(flags))

    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        ids = batch.column("conv_id").to_numpy()
        fresh = np.concatenate([[ids[0] != last_id or last_id is None], ids[1:] != ids[:-1]])
        start = np.maximum.accumulate(np.where(fresh, np.arange(size), -1))
        place = np.where(start < 0, count + np.arange(size), np.arange(size) - start) + 1
        last_id, count = ids[-1], int(place[-1])
        if held is not None:
            yield marked(held, False)
        held = pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("conv_id", "a", "b", "w")),
             pa.array(place, type=pa.int64()), pa.array(np.full(size, part, dtype=np.int64))],
            names=["conv_id", "a", "b", "w", "place", "part"],
        )
    if held is not None:
        yield marked(held, True)


def ordered_turns(conversations, store):
    """``conv_id, pos, a, b, w``: place from 1, 128-bit hash and words of every turn.

    Turns are sorted over the cluster and numbered part by part, so that a
    conversation may be spread over many tasks. The counts of the parts before,
    one row a part, are broadcast.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.left(role, F.lit(64)).alias("role_start"),
        F.left(text, F.lit(64)).alias("text_start"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("w"),
    )
    order = [
        F.col("conv_id"), F.col("turn").asc_nulls_first(), "role_start", "text_start", "a", "b"
    ]
    schema = "conv_id bigint, a bigint, b bigint, w bigint, place bigint, part bigint, last boolean"
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = store(turns.select("conv_id", "a", "b", "w").mapInArrow(number_turns, schema), "turns")
    edges = numbered.where("last").select(
        "conv_id",
        F.lead("part").over(Window.orderBy("part")).alias("part"),
        F.sum("place").over(Window.partitionBy("conv_id").orderBy("part")).alias("earlier"),
    )
    placed = numbered.join(F.broadcast(edges), ["conv_id", "part"], "left")
    pos = F.col("place") + F.coalesce("earlier", F.lit(0))
    return placed.select("conv_id", pos.alias("pos"), "a", "b", "w")


def with_shared_openings(turns, store, group=20, longest=3):
    """Conversations rebuilt so that those of a group share openings, root rows included.

    Conversation c takes the first h turns of conversation ``c - c % group`` and
    goes on with its own turns after the h-th, where h is the remainder of the
    CRC-32 of its decimal id by ``longest + 1``. Every conversation also gets a
    row at place 0.
    """
    turns = store(turns, "ordered")
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    rest = F.pmod("conv_id", F.lit(group))
    turn = F.struct("pos", "a", "b", "w")
    heads = (
        turns.where((rest == 0) & (F.col("pos") <= longest))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(turn)).alias("opening"))
    )

    def opened(df):
        df = df.withColumns({"share": share, "base": F.col("conv_id") - rest})
        found = df.join(heads, "base", "left")
        taken = F.slice(F.coalesce("opening", F.expr("array()")), F.lit(1), F.col("share").cast("int"))
        return found.withColumn("opening", taken)

    zero = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in ("pos", "a", "b", "w")])
    convs = opened(turns.select("conv_id").distinct())
    begun = convs.select("conv_id", F.inline(F.concat(F.array(zero), "opening")))
    own = opened(turns).where(F.col("pos") > F.col("share"))
    moved = F.col("pos") - F.col("share") + F.size("opening")
    return begun.unionByName(own.select("conv_id", moved.alias("pos"), "a", "b", "w"))


def cut_layers(turns, store):
    """Conversations cut into layers: path, keys of its ends, and whether it is the last.

    ``turns`` holds places from 1 on without gaps, and a row at place 0 for every
    conversation.
    """
    real = F.col("pos") > 0
    layer = F.floor(F.greatest(F.col("pos") - 1, F.lit(0)) / LAYER).cast("bigint")
    turn = F.struct("pos", "ha", "hb", "w")
    hashed = turns.withColumns(
        {
            "ha": F.when(real, F.xxhash64("pos", "a", "b")),
            "hb": F.when(real, F.xxhash64(F.lit(3), "pos", "b", "a")),
            "layer": layer,
        }
    )
    cut = hashed.groupBy("conv_id", "layer").agg(
        F.sort_array(F.collect_list(F.when(real, turn))).alias("turns"),
        F.coalesce(F.bit_xor("ha"), F.lit(0)).alias("xa"),
        F.coalesce(F.bit_xor("hb"), F.lit(0)).alias("xb"),
    )
    path = F.transform("turns", lambda t: F.struct(t["ha"].alias("ha"), t["hb"].alias("hb"), t["w"].alias("w")))
    cut = store(cut.withColumn("path", path).drop("turns"), "layers")
    along = Window.partitionBy("conv_id").orderBy("layer")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    keys = cut.select(
        "conv_id",
        "layer",
        F.coalesce(F.bit_xor("xa").over(before), F.lit(0)).alias("pa"),
        F.coalesce(F.bit_xor("xb").over(before), F.lit(0)).alias("pb"),
        F.lead("layer").over(along).isNull().alias("last"),
    )
    whole = cut.join(keys, ["conv_id", "layer"])
    ends = {"ea": F.col("pa").bitwiseXOR(F.col("xa")), "eb": F.col("pb").bitwiseXOR(F.col("xb"))}
    return store(whole.withColumns(ends).drop("xa", "xb"), "cut")


def distinct_paths(cut):
    """Equal paths as one row: members, the smallest of them, and whether any goes on."""
    return cut.groupBy("layer", "pa", "pb", "path").agg(
        F.count("*").alias("n"),
        F.min("conv_id").alias("member"),
        F.bool_or(~F.col("last")).alias("goes_on"),
        F.max("ea").alias("ea"),
        F.max("eb").alias("eb"),
    )


def shard_parts(paths, store):
    """Nodes of all shards, and what neighbouring parts counted twice."""
    order = ["layer", "pa", "pb", "path"]
    sorted_paths = paths.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = store(
        sorted_paths.select(*Paths.NAMES, "path").mapInArrow(encode_shards, PARTS_DDL), "shards"
    )
    edges = parts.where("edge > 0")
    sides = {
        side: edges.where(F.col("edge") == number).select(
            F.col("part").alias(f"{side}_part"),
            *[F.col(n).alias(f"{side}_{n}") for n in ("layer", "pa", "pb", "goes_on", "ha", "hb", "w")],
        )
        for side, number in (("first", 1), ("last", 2))
    }
    following = sides["first"].select(
        F.col("first_part").alias("last_part"),
        F.lead("first_part").over(Window.orderBy("first_part")).alias("first_part"),
    )
    met = sides["last"].join(following, "last_part").join(sides["first"], "first_part")
    spines = met.mapInArrow(merge_spines, PARTS_DDL)
    sums = ["depth", "ka", "kb", "top", "qa", "qb", "n", "member", "leaves", "saved"]
    return parts.where("edge = 0").select(*sums).unionByName(spines.select(*sums))


def merged(parts):
    return parts.groupBy(*NODE, "top").agg(
        F.max("qa").alias("qa"), F.max("qb").alias("qb"), F.sum("n").alias("n"),
        F.min("member").alias("member"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
    )


def deeper_sums(cut, paths, nodes):
    """What the layers below add to the nodes of a layer, as further parts.

    The sums of a layer's subtrie go to its smallest member. Summed from the
    end of a conversation, and over all members, they give each place between two
    layers the sums of everything below it.
    """
    tops = nodes.where("top").select(
        F.floor(F.col("depth") / LAYER).alias("layer"),
        F.col("ka").alias("pa"), F.col("kb").alias("pb"), "member", "leaves", "saved",
    )
    deep = cut.where("layer > 0").select("conv_id", "layer", "pa", "pb")
    mine = F.col("conv_id") == F.col("member")
    back = Window.partitionBy("conv_id").orderBy(F.desc("layer"))
    below = (
        deep.join(tops, ["layer", "pa", "pb"])
        .withColumns({n: F.when(mine, F.col(n)).otherwise(0) for n in ("leaves", "saved")})
        .withColumns({n: F.sum(n).over(back) for n in ("leaves", "saved")})
        .groupBy("layer", F.col("pa").alias("ea"), F.col("pb").alias("eb"))
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        .withColumn("layer", F.col("layer") - 1)
    )
    key = {
        side: F.aggregate(
            F.expr(f"slice(path, 1, CAST(j AS INT)).{turn}"),
            F.col(root),
            lambda x, y: x.bitwiseXOR(y),
        )
        for side, root, turn in (("ka", "pa", "ha"), ("kb", "pb", "hb"))
    }
    empty = {n: F.lit(None).cast("bigint") for n in ("qa", "qb", "member")}
    above = paths.where("goes_on").join(below, ["layer", "ea", "eb"])
    above = above.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(LAYER)))).where("layer = 0 OR j > 0")
    columns = {"depth": F.col("layer") * LAYER + F.col("j"), **key, "top": F.lit(False), **empty}
    return above.withColumns(columns).withColumn("n", F.lit(0).cast("bigint")).select(
        *NODE, "top", "qa", "qb", "n", "member", "leaves", "saved"
    )


def chunk_ids(batches):
    """Ascending ids of each node as texts of ``CHUNK`` ids at most, with their first id."""
    key, ids = None, []

    def chunk():
        text = ",".join(map(str, ids))
        return pa.RecordBatch.from_pydict(
            {"ka": [key[0]], "kb": [key[1]], "first": [ids[0]], "ids": [text]}
        )

    for batch in batches:
        rows = zip(*(batch.column(n).to_pylist() for n in ("ka", "kb", "conv_id")))
        done = {"ka": [], "kb": [], "first": [], "ids": []}
        for ka, kb, conv_id in rows:
            if key is not None and ((ka, kb) != key or len(ids) == CHUNK):
                for name, value in zip(done, (*key, ids[0], ",".join(map(str, ids)))):
                    done[name].append(value)
                ids = []
            key = (ka, kb)
            ids.append(conv_id)
        if done["ka"]:
            yield pa.RecordBatch.from_pydict(done)
    if ids:
        yield chunk()


def digest_chunks(batches):
    """SHA-256 of each node's ids, from its chunks in ascending order; nothing is gathered."""
    key, digest = None, None
    for batch in batches:
        done = {"ka": [], "kb": [], "ends_sha256": []}
        for ka, kb, ids in zip(*(batch.column(n).to_pylist() for n in ("ka", "kb", "ids"))):
            if (ka, kb) == key:
                digest.update(b"," + ids.encode())
                continue
            if key is not None:
                for name, value in zip(done, (*key, digest.hexdigest())):
                    done[name].append(value)
            key, digest = (ka, kb), hashlib.sha256(ids.encode())
        if done["ka"]:
            yield pa.RecordBatch.from_pydict(done)
    if key is not None:
        yield pa.RecordBatch.from_pydict(
            {"ka": [key[0]], "kb": [key[1]], "ends_sha256": [digest.hexdigest()]}
        )


def end_digests(cut):
    """Digest of the ids of the conversations that end at a node.

    A digest is made from first to last, so the ids of one node pass one task,
    as texts of thousands of ids each.
    """
    ends = cut.where("last").select(F.col("ea").alias("ka"), F.col("eb").alias("kb"), "conv_id")
    order = ["ka", "kb", "conv_id"]
    chunks = (
        ends.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(chunk_ids, "ka bigint, kb bigint, first bigint, ids string")
    )
    return (
        chunks.repartition("ka", "kb")
        .sortWithinPartitions("ka", "kb", "first")
        .mapInArrow(digest_chunks, "ka bigint, kb bigint, ends_sha256 string")
    )


def prefix_trie(turns, store):
    """One row per node of the trie of all conversations.

    ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``. ``turns`` are
    as for ``cut_layers``.
    """
    cut = cut_layers(turns, store)
    paths = store(distinct_paths(cut), "paths")
    local = store(merged(shard_parts(paths, store)), "local-nodes")
    nodes = merged(
        local.where("NOT top").unionByName(deeper_sums(cut, paths, local))
    )
    nodes = store(nodes.drop("top"), "nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("qa").alias("ka"), F.col("qb").alias("kb"))
        .agg(F.count("*").alias("n_children"))
    )
    parents = nodes.select(
        F.col("ka").alias("qa"), F.col("kb").alias("qb"),
        F.col("depth").alias("above"), F.col("member").alias("parent_conv_id"),
    )
    with_above = nodes.withColumn("above", F.col("depth") - 1)
    whole = (
        with_above.join(parents, ["above", "qa", "qb"], "left")
        .join(children, NODE, "left")
        .join(end_digests(cut), ["ka", "kb"], "left")
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.select(
        F.col("member").alias("conv_id"),
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
