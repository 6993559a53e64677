"""Alignment of two tokenizers over the same bytes.

Both tokenizers read a space and the text. A token of the first (A, byte-level
pieces of ``tokenizers``) ends where its character offsets say, a token of the
second (B, pieces with byte fallback of ``sentencepiece``) where the span of its
proto says. These are coarse cuts: where one character is shared among several
tokens, such as a wide character in A or a run of byte pieces in B, the bytes
that the tokens decode to refine them. Places where tokens of both end cut the
text into groups, and every token of A is linked with every token of B in its
group. A pair of ids counts in how many documents it is linked.

A text is aligned unit by unit: a single space or line end between two marks
opens a unit, and neither tokenizer has a token across that place (the pieces of
B are checked for it; a vocabulary that has such pieces is aligned whole). Units
that were met lately are remembered, so a word is aligned once and not per text.

Counts are summed in Spark. Pairs with at least ``share`` of all counts, and so
``1 / share`` of them at most, are shared with every task; all other pairs meet
their counts in a join, in which none of them can be hot.

Defined results: a text that is null or empty, or whose tokens of A or B do not
decode to its bytes (B reads a U+2581 as a space), has no tokens, and its digest
of groups is ''. Every row is a document of its own, also where ids repeat or are
null. An empty table gives no rows. Extra columns are left out, whatever their
names. Texts are aligned whole.
"""

import functools
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from barograph.llm.common import over_batches, rows_of

SHARE = 2e-6
MARK = "▁"
B_BITS = 20
MAX_CACHED = 400_000
MAX_CACHED_LINKS = 8_000_000
LONGEST_CACHED = 64
UNITS = re.compile(r"(?<=\S)(?=[ \n]\S)")
PLAIN = re.compile(f"[ \n][^\\s{MARK}]+")
RUN = 4096


class Side:
    """Tokens of many units of one tokenizer, end to end: ids, their unit and their coarse ends.

    ``coarse`` is the byte where the library's offset ends a token, or -1 where
    the offset lies within a character that several tokens share; ``unit`` is the
    place of each token's unit.
    """

    def __init__(self, ids, unit, coarse, table, lengths):
        self.ids, self.unit = np.array(ids, dtype=np.int64), unit
        parts = [table[i] for i in ids]
        size = len(lengths)
        decoded = np.fromiter(map(len, parts), np.int64, len(parts))
        base = np.cumsum([0, *lengths])
        # Tokens of a unit go on where the units before it end, whatever those decode to.
        mine = np.bincount(unit, weights=decoded, minlength=size).astype(np.int64)
        shift = base[:-1] - (np.cumsum(mine) - mine)
        self.ends = np.cumsum(decoded) + shift[unit]
        agree = np.bincount(unit, weights=(coarse >= 0) & (coarse != self.ends), minlength=size)
        self.data, self.stops = b"".join(parts), np.cumsum(mine)
        self.fits = (mine == np.diff(base)) & (agree == 0)

    def decodes_to(self, parts):
        """Whether the tokens of each unit decode to its bytes."""
        if self.data == b"".join(parts):
            return self.fits
        stops = [0, *self.stops.tolist()]
        same = [self.data[a:b] == part for a, b, part in zip(stops, stops[1:], parts)]
        return self.fits & np.array(same, dtype=bool)

    def keep(self, whole):
        """Leave out the tokens of all other units."""
        kept = whole[self.unit]
        self.ids, self.ends, self.unit = self.ids[kept], self.ends[kept], self.unit[kept]


class Aligner:
    """Two tokenizers, read from their files."""

    def __init__(self, a_path, b_path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        codes = byte_characters()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, number in entries.items():
            self.a_bytes[number] = bytes(codes[c] for c in entry if c in codes)
        every = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in every]
        self.is_byte = np.array([self.b.is_byte(i) for i in every])
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if byte else p.replace(MARK, " ").encode()
            for p, byte in zip(pieces, self.is_byte)
        ]
        self.b_sizes = np.array([len(p) for p in self.b_bytes], dtype=np.int64)
        self.lone_mark = self.b.piece_to_id(MARK)
        inner = re.compile(f"[^{MARK}]{MARK}|\n")
        self.splits = not any(inner.search(p) for p, byte in zip(pieces, self.is_byte) if not byte)

    def runs(self, units):
        """Neighbouring units that are encoded as one text: a sign and what holds no blank.

        Such units may stand one behind the other as they do in a text; others, with
        blanks within or at their end, are encoded alone.
        """
        run, size = [], 0
        for unit in units:
            plain = self.splits and PLAIN.fullmatch(unit)
            if run and (not plain or size > RUN):
                yield run
                run, size = [], 0
            if plain:
                run.append(unit)
                size += len(unit)
            else:
                yield [unit]
        if run:
            yield run

    def a_side(self, runs, lengths):
        found = self.a.encode_batch(runs, add_special_tokens=False)
        ids = [e.ids for e in found]
        sizes = [len(i) for i in ids]
        # Offsets count characters; a character of U+0080, U+0800, U+10000 on has a byte more.
        points = np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.concatenate([[0], np.cumsum(widths)])
        first = np.repeat(np.cumsum([0, *map(len, runs)])[:-1], sizes)
        spans = [x for e in found for span in e.offsets for x in span]
        starts, ends = np.array(spans, dtype=np.int64).reshape(-1, 2).T + first
        shared = np.zeros(len(ends), dtype=bool)
        shared[:-1] = (starts[1:] < ends[:-1]) & (first[1:] == first[:-1])
        coarse = np.where(shared, -1, byte_at[ends])
        # A token belongs to the unit in which it starts.
        unit = np.searchsorted(np.cumsum(lengths), byte_at[starts], side="right")
        return Side([i for own in ids for i in own], unit, coarse, self.a_bytes, lengths)

    def b_side(self, runs, counts, lengths):
        """Tokens of B; the mark that B adds stands for the space in front of a run.

        Before a line end that mark is a token of its own, as no piece holds a
        line end, and is left out.
        """
        plain = [run[1:] if run[0] == " " else run for run in runs]
        protos = self.b.encode(plain, return_type="proto", num_threads=1)
        stops = np.cumsum(lengths)
        last = np.cumsum(counts) - 1
        base = np.concatenate([[0], stops[last]])
        ids, ends, sizes = [], [], []
        for run, proto, at in zip(runs, protos, base.tolist()):
            pieces, led = proto.pieces, run[0] == " "
            if not led and pieces and pieces[0].id == self.lone_mark:
                pieces = pieces[1:]
            ids += [p.id for p in pieces]
            ends += [p.end for p in pieces]
            sizes.append((len(pieces), at + led))
        number = np.array(ids, dtype=np.int64)
        run_of = np.repeat(np.arange(len(runs)), [n for n, _ in sizes])
        shift = np.array([at for _, at in sizes], dtype=np.int64)
        coarse = np.where(self.is_byte[number], -1, np.array(ends, dtype=np.int64) + shift[run_of])
        # A token belongs to the unit in which the bytes up to it end.
        decoded = np.cumsum(self.b_sizes[number])
        before = np.concatenate([[0], decoded])[np.cumsum([0, *(n for n, _ in sizes)])[:-1]]
        unit = np.searchsorted(stops, decoded - before[run_of] + base[:-1][run_of], side="left")
        unit = np.clip(unit, (last - np.array(counts) + 1)[run_of], last[run_of])
        return Side(ids, unit, coarse, self.b_bytes, lengths)

    def sides(self, units, together=True):
        """Tokens of A and of B, and for which units both decode to the unit's bytes.

        Units that go wrong among others are tried again alone.
        """
        parts = [unit.encode("utf-8", "replace") for unit in units]
        lengths = [len(p) for p in parts]
        groups = list(self.runs(units)) if together else [[unit] for unit in units]
        runs, counts = ["".join(g) for g in groups], [len(g) for g in groups]
        a, b = self.a_side(runs, lengths), self.b_side(runs, counts, lengths)
        whole = a.decodes_to(parts) & b.decodes_to(parts)
        if together and (np.repeat(counts, counts)[~whole] > 1).any():
            return self.sides(units, together=False)
        a.keep(whole)
        b.keep(whole)
        return a, b, whole, np.cumsum(lengths)


class Links:
    """Groups and links of units, by the number of a unit."""

    def __init__(self, aligner):
        self.aligner, self.number = aligner, {}
        self.sums = np.zeros((0, 4), dtype=np.int64)
        self.whole = np.zeros(0, dtype=bool)
        self.starts = np.zeros(1, dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)
        self.uses = np.zeros(0, dtype=np.int64)
        self.groups = []

    def full(self):
        return len(self.whole) > MAX_CACHED or len(self.pairs) > MAX_CACHED_LINKS

    def shrink(self):
        """Forget the units used least, and of those used alike the latest; a quarter stays."""
        names = list(self.number.items())
        places = np.fromiter((at for _, at in names), np.int64, len(names))
        order = np.argsort(-self.uses[places], kind="stable")[: MAX_CACHED // 4]
        kept = places[order]
        size = self.sums[kept, 3]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        self.pairs = self.pairs[np.repeat(self.starts[kept], size) + inside]
        if len(self.pairs) > MAX_CACHED_LINKS // 2:
            self.__init__(self.aligner)
            return
        self.number = {names[i][0]: at for at, i in enumerate(order.tolist())}
        self.starts = np.concatenate([[0], np.cumsum(size)])
        self.sums, self.whole = self.sums[kept], self.whole[kept]
        self.groups = [self.groups[at] for at in kept.tolist()]
        self.uses = np.zeros(len(kept), dtype=np.int64)

    def add(self, units):
        """Align new units, all in one go: the end of a unit is an end of both tokenizers."""
        a, b, whole, stops = self.aligner.sides(units)
        cuts = np.intersect1d(a.ends, b.ends)
        group_a, group_b = np.searchsorted(cuts, a.ends), np.searchsorted(cuts, b.ends)
        n_a, n_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
        first_b = np.cumsum(n_b) - n_b
        # Every token of A meets the tokens of B from the first of its group on.
        many = n_b[group_a]
        places = np.repeat(first_b[group_a] - (np.cumsum(many) - many), many)
        pairs = np.repeat(a.ids, many) << B_BITS | b.ids[places + np.arange(len(places))]
        group_unit = np.searchsorted(stops, cuts)
        counts = [
            np.bincount(of, weights=w, minlength=len(units)).astype(np.int64)
            for of, w in ((a.unit, None), (b.unit, None), (group_unit, None), (group_unit, n_a * n_b))
        ]
        self.groups += texts_of(a, b, group_a, group_b, len(units))
        self.number.update(zip(units, range(len(self.whole), len(self.whole) + len(units))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts[3])])
        self.sums = np.concatenate([self.sums, np.stack(counts, axis=1)])
        self.whole = np.concatenate([self.whole, whole])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.uses = np.concatenate([self.uses, np.zeros(len(units), dtype=np.int64)])

    def documents(self, texts):
        """Sums, digests, and offsets, pairs and occurrences of whole texts."""
        cut = UNITS.split if self.aligner.splits else lambda whole: [whole]
        units = [cut(" " + text) if text else [] for text in texts]
        new = list(dict.fromkeys(u for names in units for u in names if u not in self.number))
        if new:
            self.add(new)
        numbers = [[self.number[u] for u in names] for names in units]
        rows = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
        flat = np.array([k for n in numbers for k in n], dtype=np.int64)
        self.uses += np.bincount(flat, minlength=len(self.uses))
        spoilt = np.zeros(len(texts), dtype=bool)
        spoilt[rows[~self.whole[flat]]] = True
        keep = ~spoilt[rows]
        rows, flat = rows[keep], flat[keep]
        sums = np.zeros((len(texts), 4), dtype=np.int64)
        np.add.at(sums, rows, self.sums[flat])
        size = self.sums[flat, 3]
        place = np.repeat(self.starts[flat] - (np.cumsum(size) - size), size)
        row_of = np.repeat(rows, size)
        keys = row_of << (2 * B_BITS) | self.pairs[place + np.arange(len(place))]
        keys, times = np.unique(keys, return_counts=True)
        offsets = np.searchsorted(keys >> (2 * B_BITS), np.arange(len(texts) + 1))
        digests = [
            hashlib.sha256(";".join([self.groups[k] for k in n]).encode()).hexdigest()
            if n and not bad
            else ""
            for n, bad in zip(numbers, spoilt.tolist())
        ]
        for name in new:
            if len(name) > LONGEST_CACHED:
                self.number.pop(name)
        return sums, digests, offsets, keys & ((1 << 2 * B_BITS) - 1), times


def texts_of(a, b, group_a, group_b, size):
    """Per unit its groups as text: ids of A, a bar, ids of B, a semicolon between groups."""
    names = []
    for side, group, closing in ((a, group_a, "|"), (b, group_b, ";")):
        last = np.diff(group, append=-1) != 0
        names += [
            f"{i}{closing if end else ','}" for i, end in zip(side.ids.tolist(), last.tolist())
        ]
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    names = np.array(names, dtype=object)[order].tolist()
    counts = np.bincount(a.unit, minlength=size) + np.bincount(b.unit, minlength=size)
    stops = [0, *np.cumsum(counts).tolist()]
    return ["".join(names[x:y])[:-1] for x, y in zip(stops, stops[1:])]


def byte_characters():
    """The characters by which byte-level vocabularies write the 256 bytes, each with its byte.

    Bytes that print in Latin-1 stand for themselves; the others follow from U+0100 on.
    """
    printed = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}


@functools.cache
def read_aligner(a_path, b_path):
    return Aligner(a_path, b_path)


MET = {}


def known_links(a_path, b_path):
    """The units that this worker met lately, of this task or of one before."""
    links = MET.get((a_path, b_path))
    if links is None:
        links = MET[a_path, b_path] = Links(read_aligner(a_path, b_path))
    if links.full():
        links.shrink()
    return links


def align_texts(docs, a_path, b_path):
    """One row per document with its counts, digest, distinct pairs and their occurrences.

    ``uid`` numbers the rows. It changes from run to run, so store the result
    before it is used twice. A pair is ``a_id * 2**20 + b_id``.
    """

    def make():
        task, number = TaskContext.get().partitionId(), 0

        def step(rows):
            nonlocal number
            links = known_links(a_path, b_path)
            sums, digests, offsets, pairs, times = links.documents(rows["text"])
            first, number = number, number + len(digests)
            lists = [
                pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(values))
                for values in (pairs, times)
            ]
            return {
                "uid": [(task << 33) + k for k in range(first, number)],
                "doc_id": rows["doc_id"],
                "n_a": sums[:, 0],
                "n_b": sums[:, 1],
                "n_groups": sums[:, 2],
                "n_links": sums[:, 3],
                "groups_sha256": digests,
                "pairs": lists[0],
                "times": lists[1],
            }

        return step

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return over_batches(
        plain,
        "uid bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, pairs array<bigint>, times array<bigint>",
        make,
    )


def pair_counts(aligned, store):
    """``pair, n, top``: documents that hold a pair linked; is it its A id's highest count?"""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count("*").alias("n")
    )
    counts = store(counts, "pair-counts").withColumn("a", F.shiftright("pair", B_BITS))
    best = counts.groupBy("a").agg(F.max("n").alias("best"))
    marked = counts.join(best, "a").select("pair", "n", (F.col("n") == F.col("best")).alias("top"))
    return store(marked, "pair-marks")


def judge_links(aligned, marked, store, share=SHARE):
    """``aligned`` with ``n_best`` and ``count_sum`` in place of its pairs."""
    total = marked.agg(F.sum("n").alias("n")).first()["n"] or 0
    frequent = rows_of(marked.where(F.col("n") >= total * share).orderBy("pair")) if total else []
    known = (
        np.array([r["pair"] for r in frequent], dtype=np.int64),
        np.array([r["n"] for r in frequent], dtype=np.int64),
        np.array([r["top"] for r in frequent], dtype=bool),
    )
    shared = aligned.sparkSession.sparkContext.broadcast(known)
    kept = ["uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = ", ".join(f"{n} {t}" for n, t in aligned.dtypes if n in kept)
    schema += ", n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"

    def look_up(batches):
        keys, counts, tops = shared.value
        for batch in batches:
            offsets, pairs = flat(batch.column("pairs"))
            times = flat(batch.column("times"))[1]
            rows = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
            met = keys[at] == pairs if len(keys) else np.zeros(len(pairs), dtype=bool)
            sums = []
            for weight in (tops.astype(np.int64), counts):
                total = np.zeros(batch.num_rows, dtype=np.int64)
                np.add.at(total, rows[met], times[met] * weight[at[met]])
                sums.append(pa.array(total))
            rest = np.concatenate([[0], np.cumsum(np.bincount(rows[~met], minlength=batch.num_rows))])
            left = [
                pa.ListArray.from_arrays(pa.array(rest, type=pa.int32()), pa.array(values[~met]))
                for values in (pairs, times)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in kept] + sums + left,
                names=[*kept, "n_best", "count_sum", "pairs", "times"],
            )

    met = store(aligned.select(*kept, "pairs", "times").mapInArrow(look_up, schema), "links-met")
    rare = met.select("uid", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
    rare = (
        rare.join(marked, "pair")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("_best"),
            F.sum(F.col("times") * F.col("n")).alias("_sum"),
        )
    )
    joined = met.drop("pairs", "times").join(rare, "uid", "left")
    return joined.select(
        *[n for n in kept if n != "uid"],
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
    )


def flat(column):
    """Offsets from 0 on and values of a list column without nulls."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0] : offsets[-1]]
    return offsets - offsets[0], values


def align_tokenizers(docs, a_path, b_path, store, share=SHARE):
    """Counts of tokens, groups and links of every document, and how common its links are."""
    aligned = store(align_texts(docs, a_path, b_path), "aligned")
    return judge_links(aligned, pair_counts(aligned, store), store, share)
