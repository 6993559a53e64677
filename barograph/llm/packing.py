"""Best-fit packing of token ids into sequences, with a fixed number of open bins.

A document is its token ids and a closing id. One longer than a sequence is cut
into pieces of a full sequence; the last piece may be shorter. Pieces go, in
windows of ``WINDOW`` as they come and the longest of a window first, into the
open bin with the least free space that still holds them. A bitset has one bit for
each amount of free space that some open bin has, so that bin is found by a shift
and the lowest bit. Where a piece opens a bin beyond the fixed number, the fullest
open bin closes.

Every task packs the pieces of its own rows, so neither texts nor ids are shuffled,
and what a task keeps is its window and its open bins. A bin that still has more
than a sixteenth of its space free at the end of a task, of which best fit leaves few, gives its
pieces back; those of ``TASKS`` tasks meet in one and are packed again.

Ids come from the ``tokenizers`` library, word by word: a vocabulary that drops
white space has no token across a space or a line end, and words that the worker
met lately are remembered. Where a text holds the beginning of a special string,
or the vocabulary doesn't drop white space, the text is encoded whole.

Defined results: a null text counts as empty, and is one piece that holds the
closing id alone. Every row is a document of its own, also where ids repeat or are
null. An empty table gives no rows. Extra columns are left out, whatever their
names. Of bins with equal free space the one that came to it last is filled first.
Texts are encoded whole, however long.
"""

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from barograph.llm.common import slices

CAPACITY = 4096
CLOSING_ID = 1
OPEN_BINS = 1024
WINDOW = 1024
TASKS = 64
MAX_CACHED = 600_000
LONGEST_CACHED = 64

PIECE = [
    ("doc_id", pa.int64()), ("piece", pa.int64()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()),
]
PACKED = pa.schema([*PIECE, ("sequence_id", pa.int64()), ("offset", pa.int64())])
LEFT = pa.schema([*PACKED, ("task", pa.int64()), ("loose", pa.bool_())])


class Words:
    """Ids of texts, as bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, path):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.older = {"": b""}, {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [token.content[:2] for token in added]
        apart = self._encode(["a b", "a", "b", " a", "a\nb", "a \n b", "\n"])
        self.splits = (
            apart[0] == apart[1] + apart[2] == apart[4] == apart[5]
            and apart[1] == apart[3]
            and not apart[6]
            and not any(c in token.content for token in added for c in " \n")
        )

        # Where the vocabulary makes letters small, words that differ in case alone are one word. Up to
        # U+00FF every letter has one small form, whatever stands beside it.
        latin = [chr(c) for c in range(0x100) if chr(c).isalpha()]
        self.small = self._encode(latin) == self._encode([c.lower() for c in latin])

    def _cut(self, text):
        text = text.replace("\n", " ")
        if self.small:
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.split(" ")

    def _encode(self, texts):
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def ids(self, texts):
        known, cut, seen = self.known, {}, set()
        whole = [
            k for k, t in enumerate(texts) if not self.splits or any(s in t for s in self.special)
        ]
        for k in set(range(len(texts))).difference(whole):
            cut[k] = self._cut(texts[k])
            seen.update(cut[k])
        seen.difference_update(known)
        again = seen.intersection(self.older)
        known.update((word, self.older[word]) for word in again)
        new = list(seen.difference(again))
        known.update(zip(new, self._encode(new)))
        out = dict(zip(whole, self._encode([texts[k] for k in whole])))
        for k, words in cut.items():
            out[k] = b"".join(map(known.__getitem__, words))
        for word in new:
            if len(word) > LONGEST_CACHED:
                del known[word]
        if len(known) > MAX_CACHED // 2:
            # Words that go on occurring come back from the older half.
            self.older, self.known = known, {"": b""}
        return [out[k] for k in range(len(texts))]


@functools.cache
def known_words(path):
    """One per worker: words met by one task are known to the next."""
    return Words(path)


class Bins:
    """Open bins by their free space; a bin is ``[sequence_id, pieces]``."""

    def __init__(self, first_id, capacity=CAPACITY, open_bins=OPEN_BINS):
        self.next_id, self.capacity, self.most = first_id, capacity, open_bins
        self.bits, self.open, self.by_free = 0, 0, [[] for _ in range(capacity + 1)]

    def _take(self, free):
        same = self.by_free[free]
        found = same.pop()
        if not same:
            self.bits ^= 1 << free
        self.open -= 1
        return found

    def add(self, piece, length):
        """Place a piece; returns the bins that this closed, with their free space."""
        closed = []
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            if self.open == self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                closed.append((self._take(fullest), fullest))
            free, found = self.capacity, [self.next_id, []]
            self.next_id += 1
        found[1].append((piece, length))
        free -= length
        if free:
            self.by_free[free].append(found)
            self.bits |= 1 << free
            self.open += 1
        else:
            closed.append((found, 0))
        return closed

    def rest(self):
        """The bins still open, fullest first."""
        return [(found, free) for free, same in enumerate(self.by_free) for found in same]


def pieces_of(doc_ids, ids, closing=CLOSING_ID, capacity=CAPACITY):
    """Rows of ``PIECE``: each document's ids and the closing id, cut at full sequences."""
    end = closing.to_bytes(4, "little")
    for doc_id, data in zip(doc_ids, ids):
        data += end
        step = 4 * capacity
        for number, at in enumerate(range(0, len(data), step)):
            part = data[at : at + step]
            yield doc_id, number, number * capacity, len(part) // 4, zlib.crc32(part)


def packed_rows(batches, first_id, task=0, capacity=CAPACITY, open_bins=OPEN_BINS, loose=None):
    """Pack lists of piece rows in windows; yields lists of rows of ``LEFT``.

    Bins with more than ``loose`` free at the end are marked, if it is given.
    """
    bins, window = Bins(first_id, capacity, open_bins), []

    def rows(closed, marked=False):
        for (sequence, pieces), free in closed:
            offset, mark = 0, marked and free > loose
            for piece, length in pieces:
                yield (*piece, sequence, offset, task, mark)
                offset += length

    def place(window):
        for piece in sorted(window, key=lambda p: -p[3]):
            yield from rows(bins.add(piece, piece[3]))

    for batch in batches:
        out = []
        for piece in batch:
            window.append(piece)
            if len(window) == WINDOW:
                out += place(window)
                window = []
        yield out
    yield [*place(window), *rows(bins.rest(), loose is not None)]


def to_batch(rows, schema):
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=f.type) for values, f in zip(columns, schema)], schema=schema
    )


DDL = {pa.int64(): "bigint", pa.bool_(): "boolean"}


def ddl(schema):
    return ", ".join(f"{f.name} {DDL[f.type]}" for f in schema)


def pack_documents(docs, path, store, closing=CLOSING_ID, capacity=CAPACITY, open_bins=OPEN_BINS):
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Pieces of one sequence lie one behind the other from 0 on. ``path`` names the
    vocabulary file of the ``tokenizers`` library.
    """

    def pack(batches):
        words, task = known_words(path), TaskContext.get().partitionId()

        def pieces():
            for batch in batches:
                for part in slices(batch):
                    texts = [t or "" for t in part.column("text").to_pylist()]
                    doc_ids = part.column("doc_id").to_pylist()
                    yield pieces_of(doc_ids, words.ids(texts), closing, capacity)

        found = packed_rows(pieces(), task << 33, task, capacity, open_bins, capacity // 16)
        for rows in found:
            if rows:
                yield to_batch(rows, LEFT)

    def pack_again(batches):
        # Sequences of the second packing have ids below 0.
        first = -(1 << 62) + (TaskContext.get().partitionId() << 33)
        given = (
            zip(*(batch.column(name).to_pylist() for name, _ in PIECE)) for batch in batches
        )
        for rows in packed_rows(given, first, 0, capacity, open_bins):
            if rows:
                yield to_batch([row[: len(PACKED)] for row in rows], PACKED)

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    first = store(plain.mapInArrow(pack, ddl(LEFT)), "packed")
    names = [name for name, _ in PIECE]
    meet = F.floor(F.col("task") / TASKS)
    again = (
        first.where("loose")
        .select(*names, "task", "sequence_id", "offset", meet.alias("meet"))
        .repartition("meet")
        .sortWithinPartitions("meet", "task", "sequence_id", "offset")
        .select(*names)
        .mapInArrow(pack_again, ddl(PACKED))
    )
    return first.where("not loose").select(*PACKED.names).unionByName(again)
