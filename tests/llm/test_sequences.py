"""Packing, the conversation trie and aligned tokenizers against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barograph.llm import alignment, packing, prefixtrie, registry
from barograph.llm.common import stored

SF_DIR = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SIGNS = [
    " ", "  ", "\n", "\n\n", "\t", "a", "b", "word", "don't", "'s", "é", "漢", "🙂", "́", "　", "\r",
    "▁", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "<|startoftext|>", "12", "345", ".", ",",
    "--", "\x00", "\x1c", "\x85", "ﬁ", "Σ", "ΑΣ", "İ",
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()


@pytest.fixture(scope="module")
def strange():
    pick = random.Random(5)
    return ["".join(pick.choice(SIGNS) for _ in range(pick.randrange(14))) for _ in range(3000)]


@pytest.fixture
def store(spark, tmp_path):
    """Tables are written and read again, as in a job."""
    numbers = iter(range(10**6))

    def keep(df, label):
        path = f"{tmp_path}/{label}-{next(numbers)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    return keep


# --- packing ---------------------------------------------------------------


def test_ids_by_words_are_the_librarys(documents, strange):
    words, library = packing.Words(WORDS), Tokenizer.from_file(WORDS)
    assert words.splits
    texts = [r["text"] or "" for r in documents] + strange
    for text, data in zip(texts, words.ids(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(data, dtype="<u4").tolist() == ids, text[:80]


def test_texts_are_encoded_whole_where_words_are_not_enough():
    words = packing.Words(BYTES)
    assert not words.splits
    ids = Tokenizer.from_file(BYTES).encode("a b  c", add_special_tokens=False).ids
    assert np.frombuffer(words.ids(["a b  c"])[0], dtype="<u4").tolist() == ids


def check_packing(rows, docs, capacity):
    library = Tokenizer.from_file(WORDS)
    pieces, sequences = Counter(), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[tuple(r[n] for n, _ in packing.PIECE)] += 1
    expected = Counter()
    for doc_id, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], dtype="<u4")
            expected[doc_id, number, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert pieces == expected
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), sum(n * r[3] for r, n in expected.items()) / capacity


def test_packing(spark, documents, store):
    docs = spark.createDataFrame(documents).repartition(5)
    rows = packing.pack_documents(docs, WORDS, store).collect()
    used, least = check_packing(rows, [(r["doc_id"], r["text"]) for r in documents], 4096)
    assert used <= 1.05 * least + 1


def test_packing_odd_rows_and_few_bins(spark, odd, store):
    rows = packing.pack_documents(odd, WORDS, store, capacity=64, open_bins=2).collect()
    assert rows[0].asDict().keys() == set(packing.PACKED.names)
    check_packing(rows, [(r["doc_id"], r["text"]) for r in odd.collect()], 64)
    none = packing.pack_documents(odd.limit(0), WORDS, store)
    assert none.collect() == []
    assert dict(none.dtypes)["ids_crc32"] == "bigint"


def test_best_fit_rule():
    bins = packing.Bins(0, capacity=10, open_bins=2)
    closed = [x for n, length in enumerate([6, 7, 3, 4, 9, 8]) for x in bins.add(n, length)]
    # 3 goes to the fuller of 6 and 7 and fills it, 4 fills the other; 9 and 8 stay open.
    assert [([n for n, _ in b[1]], free) for b, free in closed] == [([1, 2], 0), ([0, 3], 0)]
    assert [free for _, free in bins.add(6, 5)] == [1]  # a third bin: the fullest, 9, closes
    assert sorted(free for _, free in bins.rest()) == [2, 5]


def test_loose_bins_are_packed_again(spark, store):
    rows = [(i, "a " * 40) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(16)
    packed = packing.pack_documents(docs, WORDS, store)
    assert packed.select("sequence_id").distinct().count() == 1


# --- conversation trie -----------------------------------------------------


def rebuilt(rows):
    """Conversations of the contract, from ``(conv_id, turn, role, text)``."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def plain_trie(conversations):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(prefix[:-1] for prefix in members if prefix)
    leaves, saved = Counter(), Counter()
    for prefix, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", prefix[-1][1])) if prefix else 0
        for depth in range(len(prefix) + 1):
            saved[prefix[:depth]] += (len(own) - 1) * words
            leaves[prefix[:depth]] += not children[prefix]
    return {
        (
            min(own), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(own),
            children[prefix], leaves[prefix], saved[prefix],
            hashlib.sha256(",".join(map(str, sorted(ends[prefix]))).encode()).hexdigest(),
        )
        for prefix, own in members.items()
    }


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
TURNS = "conv_id bigint, turn bigint, role string, text string"


def trie(df, store):
    turns = prefixtrie.with_shared_openings(prefixtrie.ordered_turns(df, store), store)
    return prefixtrie.prefix_trie(turns, store)


def check_trie(spark, rows, store):
    found = trie(spark.createDataFrame(rows, TURNS), store)
    assert found.columns == TRIE
    found = [tuple(r) for r in found.collect()]
    assert len(found) == len(set(found))
    assert set(found) == plain_trie(rebuilt(rows))


def test_trie_of_the_tables(spark, store):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check_trie(spark, rows, store)


def test_trie_of_long_and_repeated_conversations(spark, store):
    """Layers, copies, conversations that are openings of others, ties, nulls."""
    pick = random.Random(9)
    stem = [f"turn {i} {'w ' * (i % 3)}" for i in range(300)]
    rows = []
    for c in range(130):
        length = pick.choice([0, 1, 2, 5, 63, 64, 65, 66, 128, 130, 200, 300])
        texts = stem[:length] if c % 3 else stem[: length // 2] + [f"own {pick.randrange(4)} {i}" for i in range(length - length // 2)]
        # A conversation without own turns past its opening: one turn only.
        for turn, text in enumerate(texts or ["alone"]):
            rows.append((c, turn, "user" if turn % 2 else "assistant", text))
    rows += [(7, 3, "user", "a tie"), (7, 3, "user", "a tie"), (7, 3, None, "b"), (9, None, "user", "first")]
    rows += [(9, None, None, None), (None, 1, "user", "nobody's"), (10**15, 0, "user", ""), (10**15, 1, "user", " ")]
    check_trie(spark, rows, store)


def test_trie_of_nothing(spark, store):
    assert trie(spark.createDataFrame([], TURNS), store).collect() == []
    nobody = spark.createDataFrame([(None, 1, "user", "x")], TURNS)
    assert trie(nobody, store).collect() == []


def test_trie_ignores_extra_columns(spark, store):
    rows = [(c, t, "user", f"{c % 2} {t}") for c in range(4) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS).withColumns({n: F.lit("x") for n in ("pos", "a", "layer", "path", "member")})
    assert {tuple(r) for r in trie(df, store).collect()} == plain_trie(rebuilt(rows))


@pytest.mark.parametrize("seed", range(3))
def test_find_close_over_blocks(seed):
    """Random and very deep nests, wider than one block."""
    pick, bits, depth = random.Random(seed), [], 0
    for _ in range(6000):
        up = depth == 0 or pick.random() < (0.5, 0.55, 0.9)[seed]
        bits.append(int(up))
        depth += 1 if up else -1
    bits += [0] * depth
    stack, closes = [], {}
    for at, bit in enumerate(bits):
        if bit:
            stack.append(at)
        else:
            closes[stack.pop()] = at
    tree = prefixtrie.Parentheses(bits)
    places = np.flatnonzero(tree.bits)
    assert tree.find_close(places).tolist() == [closes[p] for p in places.tolist()]


@pytest.mark.parametrize("cut", [1, 2, 3, 7])
def test_shards_merge_along_their_spines(cut):
    """However sorted paths are cut into shards, sums and spines give the whole tree's."""
    pick = random.Random(cut)
    paths = sorted({tuple(pick.randrange(3) for _ in range(pick.randrange(6))) for _ in range(60)})
    columns = {
        "layer": np.zeros(len(paths), dtype=np.int64), "pa": np.zeros(len(paths), dtype=np.int64),
        "pb": np.zeros(len(paths), dtype=np.int64), "n": np.arange(1, len(paths) + 1),
        "member": np.arange(len(paths)), "goes_on": np.zeros(len(paths), dtype=bool),
    }
    hashes = [hash((i, x)) | 1 for p in paths for i, x in enumerate(p)]
    flat = np.array(hashes, dtype=np.int64), np.array(hashes, dtype=np.int64) * 3, np.array([x + 1 for p in paths for x in p])
    whole = prefixtrie.Paths(columns, np.array([len(p) for p in paths]), *flat)

    def sums(parts):
        out = defaultdict(lambda: np.zeros(3, dtype=np.int64))
        for part in parts:
            for k in range(len(part["depth"])):
                n = part["n"][k] if "n" in part else 0
                out[part["depth"][k], part["ka"][k], part["kb"][k]] += [n, part["leaves"][k], part["saved"][k]]
        return {key: value.tolist() for key, value in out.items()}

    shards = [whole.take(i, min(i + cut, len(whole))) for i in range(0, len(whole), cut)]
    parts = [prefixtrie.shard_nodes(s) for s in shards]
    for before, after in zip(shards, shards[1:]):
        parts.append(prefixtrie.spine(before.take(len(before) - 1, len(before)), after.take(0, 1)))
    assert sums(parts) == sums([prefixtrie.shard_nodes(whole)])


# --- aligned tokenizers ----------------------------------------------------


def plain_alignment(texts):
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    reads = alignment.read_aligner(BYTES, PIECES)
    out, held, best = [], Counter(), Counter()
    for text in texts:
        whole = " " + (text or "")
        a_ids = a.encode(whole, add_special_tokens=False).ids if text else []
        b_ids = b.encode(text) if text else []
        a_parts, b_parts = [reads.a_bytes[i] for i in a_ids], [reads.b_bytes[i] for i in b_ids]
        if not text or not b"".join(a_parts) == b"".join(b_parts) == whole.encode():
            a_ids, b_ids, a_parts, b_parts = [], [], [], []
        a_ends, b_ends = np.cumsum([0, *map(len, a_parts)])[1:], np.cumsum([0, *map(len, b_parts)])[1:]
        groups, links, x, y = [], Counter(), 0, 0
        for end in sorted(set(a_ends.tolist()) & set(b_ends.tolist())):
            to_x, to_y = int(np.searchsorted(a_ends, end)) + 1, int(np.searchsorted(b_ends, end)) + 1
            groups.append((a_ids[x:to_x], b_ids[y:to_y]))
            links.update((i, j) for i in a_ids[x:to_x] for j in b_ids[y:to_y])
            x, y = to_x, to_y
        held.update(links.keys())
        told = ";".join(",".join(map(str, i)) + "|" + ",".join(map(str, j)) for i, j in groups)
        digest = hashlib.sha256(told.encode()).hexdigest() if groups else ""
        out.append((len(a_ids), len(b_ids), len(groups), links, digest))
    for (i, _), n in held.items():
        best[i] = max(best[i], n)
    return [
        (
            n_a, n_b, n_groups, sum(links.values()), digest,
            sum(k for pair, k in links.items() if held[pair] == best[pair[0]]),
            sum(k * held[pair] for pair, k in links.items()),
        )
        for n_a, n_b, n_groups, links, digest in out
    ]


ALIGNED = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.mark.parametrize("share", [alignment.SHARE, 0.01, 2.0])
def test_alignment(spark, documents, strange, store, share):
    """With all pairs shared, with some, and with none."""
    texts = [r["text"] for r in documents][:80] + strange[:400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    rows = alignment.align_tokenizers(docs, BYTES, PIECES, store, share).orderBy("doc_id").collect()
    assert [tuple(r[n] for n in ALIGNED) for r in rows] == plain_alignment(texts)


def test_units_are_forgotten_and_met_again(monkeypatch, strange):
    """With room for few units and links, results are those of whole texts all the same."""
    monkeypatch.setattr(alignment, "MAX_CACHED", 300)
    links = alignment.Links(alignment.read_aligner(BYTES, PIECES))
    names = ["n_a", "n_b", "n_groups", "n_links"]
    for most in (10**6, 200):
        monkeypatch.setattr(alignment, "MAX_CACHED_LINKS", most)
        for at in range(0, 1500, 100):
            texts = strange[at : at + 100]
            sums, digests, *_ = links.documents(texts)
            plain = plain_alignment(texts)
            assert [(*s, d) for s, d in zip(sums.tolist(), digests)] == [(*p[:4], p[4]) for p in plain], names
            if links.full():
                links.shrink()
    assert len(links.whole) <= 300


def test_alignment_odd_rows(spark, odd, store):
    found = alignment.align_tokenizers(odd, BYTES, PIECES, store)
    texts = [r["text"] for r in odd.collect()]
    expected = Counter(plain_alignment(texts))
    assert Counter(tuple(r[n] for n in ALIGNED) for r in found.collect()) == expected
    assert alignment.align_tokenizers(odd.limit(0), BYTES, PIECES, store).collect() == []


def test_queries_return_the_contract(spark):
    columns = {
        "op11_packing": packing.PACKED.names,
        "op12_prefix_trie": TRIE,
        "op13_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"],
    }
    for name, expected in columns.items():
        found = registry.QUERIES[name](spark, SF_DIR)
        assert found.columns == expected
        assert {t for n, t in found.dtypes if not n.endswith("sha256")} == {"bigint"}
        assert stored(found, name).count() > 0
