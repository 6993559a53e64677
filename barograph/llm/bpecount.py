"""Token counts by byte-pair merging over a heap and a linked list.

The vocabulary is the piece list of a model file with byte fallback. Symbols
start as characters; the adjacent pair whose joined piece ranks best is merged
again and again. The count is the number of symbols left, that is the first
symbols less the merges, where a symbol that is no piece counts its bytes. No
identifiers are made.

No piece of such a vocabulary goes over from a word into the next mark of white
space, so a text is counted chunk by chunk: a run of marks and the characters
after it. Where a vocabulary has such a piece, texts are counted whole.

Defined results: a null or empty text has 0 bytes and 0 tokens. Texts are
counted whole, however long; chunks beyond 64 characters are not cached.
Repeated rows get the same counts and other columns are ignored.
"""

import re
from heapq import heapify, heappop, heappush

from pyspark.sql import functions as F

from barograph.llm.common import over_batches

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
LONGEST_CACHED = 64
MAX_CACHED = 1_000_000
TOKEN_LIMIT = 4096


class Merges:
    """Ranks of pieces; a piece with a better score ranks lower."""

    def __init__(self, pieces):
        """``pieces``: (piece, score) of the ordinary pieces of a vocabulary."""
        order = sorted(range(len(pieces)), key=lambda i: (-pieces[i][1], i))
        self.ranks = {pieces[i][0]: rank for rank, i in enumerate(order)}
        self.characters = {piece for piece in self.ranks if len(piece) == 1}
        inner = re.compile(f"[^{MARK}]{MARK}")
        self.splits = not any(inner.search(piece) for piece, _ in pieces)

    def count(self, chunk):
        """Symbols left of a chunk, with the bytes of characters that are no piece.

        A symbol is the place where it starts; ``after`` and ``before`` link
        it to its neighbours, and ``after`` is 0 where a symbol was merged. The
        heap holds rank, start and end of a pair in one number; a pair is out
        of date unless two neighbours still fill just these places.
        """
        size, rank_of = len(chunk), self.ranks.get
        wide = size + 1
        after, before = list(range(1, size + 2)), list(range(-1, size))
        heap = []
        for at in range(size - 1):
            rank = rank_of(chunk[at : at + 2])
            if rank is not None:
                heap.append((rank * wide + at) * wide + at + 2)
        heapify(heap)
        merges = 0
        while heap:
            rest, end = divmod(heappop(heap), wide)
            at = rest % wide
            middle = after[at]
            if not 0 < middle < end or after[middle] != end:
                continue
            after[at], after[middle] = end, 0
            merges += 1
            if end < size:
                before[end] = at
                rank = rank_of(chunk[at : after[end]])
                if rank is not None:
                    heappush(heap, (rank * wide + at) * wide + after[end])
            start = before[at]
            if start >= 0:
                rank = rank_of(chunk[start:end])
                if rank is not None:
                    heappush(heap, (rank * wide + start) * wide + end)
        count = size - merges
        if not self.characters.issuperset(chunk):
            at = 0
            while at < size:
                if after[at] == at + 1 and chunk[at] not in self.characters:
                    count += len(chunk[at].encode("utf-8", "replace")) - 1
                at = after[at]
        return count


def marked(text):
    """A text as the vocabulary sees it: a mark in front and for every space."""
    return MARK + text.replace(" ", MARK) if text else ""


def read_pieces(path):
    """(piece, score) of the ordinary pieces of a vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
    ]


def count_tokens(docs, path, limit=TOKEN_LIMIT):
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row.

    ``path`` names the vocabulary file; its pieces, some 32,000, are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_pieces(path))

    def make():
        merges, cache = Merges(shared.value), {}

        def tokens(text):
            whole = marked(text)
            chunks = CHUNK.findall(whole) if merges.splits else [whole] if whole else []
            if len(cache) > MAX_CACHED:
                cache.clear()
            total = 0
            for chunk in chunks:
                found = cache.get(chunk)
                if found is None:
                    found = merges.count(chunk)
                    if len(chunk) <= LONGEST_CACHED:
                        cache[chunk] = found
                total += found
            return total

        def step(rows):
            counts = [tokens(t or "") for t in rows["text"]]
            return {
                "doc_id": rows["doc_id"],
                "n_bytes": [len((t or "").encode("utf-8", "replace")) for t in rows["text"]],
                "n_tokens": counts,
                "over_limit": [n > limit for n in counts],
            }

        return step

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return over_batches(
        plain, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean", make
    )
