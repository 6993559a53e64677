"""Unigram encoding by Viterbi over a double-array trie of pieces, and decoding.

A text gets a white-space mark in front and for every space. The best split
into pieces maximises the sum of log scores. A character that no piece covers
falls back to the byte pieces of its UTF-8 form. Decoding joins pieces and
bytes and turns marks into spaces.

The vocabulary file at hand ranks its pieces instead of giving probabilities,
so a piece gets the log frequency that Zipf's law gives its rank.

Pieces never go over from a word into the next mark, so a run of marks with the
characters after it is encoded on its own, and short ones are remembered.

Defined results: null and empty texts have no pieces and decode to an empty
text. A mark in a text cannot be told from a space and decodes to one. Texts
are encoded whole; equal scores prefer the longer last piece. Columns other than
doc_id, text, lang and source are left out.
"""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from barograph.llm.common import over_batches

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
LONGEST_CACHED = 64
MAX_CACHED = 500_000
UNKNOWN_COST = 10.0


class DoubleArray:
    """A trie in two arrays: the child of ``s`` by code ``c`` is ``base[s] + c`` if its check is ``s``."""

    def __init__(self, words):
        times = Counter(c for word in words for c in word)
        characters = sorted(times, key=lambda c: (-times[c], c))
        self.codes = {c: i + 1 for i, c in enumerate(characters)}
        # No state has a child by this code, which stands for all other characters.
        self.no_code = len(characters) + 1
        tree = {}
        for number, word in enumerate(words):
            node = tree
            for c in word:
                node = node.setdefault(self.codes[c], {})
            node[0] = number
        size = 2 * len(characters) + 64
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        waiting, free = [(0, tree)], 1
        while waiting:
            state, node = waiting.pop()
            self.value[state] = node.get(0, -1)
            codes = sorted(c for c in node if c)
            if not codes:
                continue
            start, taken = max(1, free - codes[0]), 0
            while True:
                self._grow(start + codes[-1] + 1)
                if all(self.check[start + c] < 0 for c in codes):
                    break
                taken += self.check[start + codes[0]] >= 0
                start += 1
            place = start + codes[0]
            if taken >= 0.9 * (place - free + 1):  # later searches skip what is nearly full
                free = place
            self.base[state] = start
            for c in codes:
                self.check[start + c] = state
            waiting += [(start + c, node[c]) for c in codes]
        # Whatever the state and the code, its child's place is within the arrays.
        self._grow(max(self.base) + self.no_code + 1)

    def _grow(self, size):
        more = size - len(self.check)
        if more > 0:
            more += len(self.check) // 2
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more


class Unigram:
    """``pieces``: (id, piece, log score); ``byte_ids``: the ids of the 256 byte pieces."""

    def __init__(self, pieces, byte_ids):
        self.ids = [p[0] for p in pieces]
        self.scores = [p[2] for p in pieces]
        self.trie = DoubleArray([p[1] for p in pieces])
        self.byte_ids = byte_ids
        self.texts = {p[0]: p[1] for p in pieces}
        self.bytes = {number: piece.encode() for number, piece in self.texts.items()}
        self.bytes |= {number: bytes([b]) for b, number in enumerate(byte_ids)}
        self.unknown = min(self.scores) - UNKNOWN_COST
        self.singles = {self.trie.codes[p[1]] for p in pieces if len(p[1]) == 1}
        self.longest = max(len(p[1]) for p in pieces)
        self.cache = {}
        inner = re.compile(f"[^{MARK}]{MARK}")
        self.splits = not any(inner.search(p[1]) for p in pieces)

    def best(self, chunk):
        """``(score, ids)`` of the best split of a chunk."""
        size = len(chunk)
        best, back = [-math.inf] * (size + 1), [None] * (size + 1)
        best[0] = 0.0
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        known, other = self.trie.codes.get, self.trie.no_code
        codes = [known(c, other) for c in chunk]
        scores, unknown = self.scores, self.unknown
        for at in range(size):
            here, state, end = best[at], 0, at
            for code in codes[at : at + self.longest]:
                following = base[state] + code
                if check[following] != state:
                    break
                state, number = following, value[following]
                end += 1
                if number >= 0:
                    score = here + scores[number]
                    if score > best[end]:
                        best[end], back[end] = score, (at, number)
            # A character that is a piece by itself never falls back to its bytes.
            if codes[at] not in self.singles and here + unknown > best[at + 1]:
                best[at + 1], back[at + 1] = here + unknown, (at, None)
        out, at = [], size
        while at:
            start, number = back[at]
            if number is None:
                encoded = chunk[start:at].encode("utf-8", "replace")
                out += [self.byte_ids[b] for b in reversed(encoded)]
            else:
                out.append(self.ids[number])
            at = start
        return best[size], out[::-1]

    def encode(self, text, cache):
        if not text:
            return []
        whole = MARK + text.replace(" ", MARK)
        if len(cache) > MAX_CACHED:
            cache.clear()
        out = []
        for chunk in CHUNK.findall(whole) if self.splits else [whole]:
            found = cache.get(chunk)
            if found is None:
                found = self.best(chunk)[1]
                if len(chunk) <= LONGEST_CACHED:
                    cache[chunk] = found
            out += found
        return out

    def decode(self, ids):
        out = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return out.replace(MARK, " ")[1:]


def read_unigram(path):
    """The vocabulary of a model file, with Zipf's log frequencies by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    byte_ids = [i for i in every if model.is_byte(i)]
    plain = [
        i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]
    ranked = sorted(plain, key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (rank + 2.7) for rank in range(len(ranked))))
    pieces = [
        (i, model.id_to_piece(i), -math.log(rank + 2.7) - total) for rank, i in enumerate(ranked)
    ]
    return Unigram(pieces, byte_ids)


def encode_texts(docs, path):
    """``doc_id, ids`` of every row; the vocabulary, some 32,000 pieces, is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(read_unigram(path))

    def make():
        # The model stays with a Python worker, and so do the chunks it has met.
        model, cache = shared.value, shared.value.cache

        def step(rows):
            ids = [np.array(model.encode(t, cache), dtype=np.int32) for t in rows["text"]]
            back = [model.decode(i.tolist()) for i in ids]
            told = [b == (t or "").replace(MARK, " ") for t, b in zip(rows["text"], back)]
            first, last = model.byte_ids[0], model.byte_ids[-1]
            return {
                "doc_id": rows["doc_id"],
                "lang": rows["lang"],
                "source": rows["source"],
                "n_tokens": [len(i) for i in ids],
                "n_byte_tokens": [int(((i >= first) & (i <= last)).sum()) for i in ids],
                "round_trip": told,
                "ids": ids,
            }

        return step

    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
    )
    return over_batches(
        plain,
        "doc_id bigint, lang string, source string, n_tokens bigint, n_byte_tokens bigint, "
        "round_trip boolean, ids array<int>",
        make,
    )


def decode_ids(encoded, path):
    """``doc_id, text`` from rows of ``doc_id, ids``; null ids decode to an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_unigram(path))

    def make():
        def step(rows):
            texts = [shared.value.decode(ids or []) for ids in rows["ids"]]
            return {"doc_id": rows["doc_id"], "text": texts}

        return step

    return over_batches(encoded.select("doc_id", "ids"), "doc_id bigint, text string", make)
