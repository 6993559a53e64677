"""Operators across rows: near duplicates, nearest vectors, mixing and the pipeline."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barograph.llm import bottomk, mixing, permindex, quality

SF_DIR = "/root/testdata/sf0.001"


def components(texts, size, percent):
    """Smallest id reachable, by comparing all pairs of shingle sets."""
    sets = {}
    for i, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
        width = min(size, len(words))
        sets[i] = {tuple(words[j : j + width]) for j in range(len(words) - width + 1)} if words else set()
    label = {i: i for i in sets}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    pick = random.Random(size)
    base = [[pick.choice("abcdefghij") + str(pick.randrange(40)) for _ in range(120)] for _ in range(4)]
    texts = [(i, t) for i, t in enumerate([None, "", "One", "one", "a b", "a  B"])]
    for words in base:
        for _ in range(22):
            copy = list(words)
            for _ in range(pick.randrange(8)):
                copy[pick.randrange(len(copy))] = f"x{pick.randrange(10**6)}"
            texts.append((len(texts), " ".join(copy)))
    docs = spark.createDataFrame(texts + [texts[9]], "doc_id bigint, text string")
    rows = bottomk.near_duplicates(docs, size, percent).collect()
    assert len(rows) == len(texts) + 1
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in rows} == components(texts, size, percent)


def test_odd_documents(spark, odd):
    rows = bottomk.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert all(r["component"] == r["id"] for r in rows if r["id"] in (0, 1, 2, 3, None))
    assert bottomk.near_duplicates(odd.limit(0)).count() == 0


def test_nearest_vectors(spark, keep):
    numbers = np.random.default_rng(2)
    points = numbers.normal(size=(900, 12)) * numbers.uniform(0.5, 2, size=(900, 1))
    points[300:600] = points[7]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(1000, None), (1020, [0.0] * 12), (1040, [float("nan")] * 12), (1060, [None] * 12), (None, rows[3][1]), (1080, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = permindex.nearest(vectors, keep, F.col("id") % 20 == 0, vector_block=400, query_block=20).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    hits = 0
    for query in range(0, 900, 20):
        scores = points @ points[query]
        order = [i for i in sorted(range(900), key=lambda i: (-round(scores[i], 9), i)) if i != query][:20]
        assert [s for _, s in by_query[query]] == sorted((s for _, s in by_query[query]), reverse=True)
        assert all(s == pytest.approx(scores[i]) for i, s in by_query[query])
        hits += len({i for i, _ in by_query[query]} & set(order))
    assert set(by_query) == set(range(0, 900, 20)) and hits >= 0.9 * 20 * 45
    assert permindex.nearest(vectors.limit(0), keep, F.col("id") % 20 == 0).count() == 0


def test_nearest_vectors_by_footrule(spark, keep):
    numbers = np.random.default_rng(4)
    centres = numbers.normal(size=(30, 16))
    points = centres[numbers.integers(0, 30, 900)] + 0.3 * numbers.normal(size=(900, 16))
    vectors = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>")
    hits = {}
    for walked in (64, 0):
        found = permindex.nearest(vectors, keep, F.col("id") % 20 == 0, least=100, walked=walked, vector_col="embedding").collect()
        hits[walked] = 0
        for query in range(0, 900, 20):
            scores = points @ points[query]
            order = [i for i in sorted(range(900), key=lambda i: (-scores[i], i)) if i != query][:20]
            hits[walked] += len({r["vec_id"] for r in found if r["query_id"] == query} & set(order))
    # Without a step of the orders all entries are equally far, and every one is ranked again.
    assert hits[0] == 20 * 45 and 0.8 * 20 * 45 <= hits[64] < 20 * 45


def test_equal_vectors_score_alike_in_every_block(spark, keep):
    """Copies spread over blocks of different size rank by id, with one and the same score."""
    numbers = np.random.default_rng(8)
    points = numbers.normal(size=(1000, 37)) * numbers.uniform(0.1, 9, size=(1000, 1))
    points[100:900:2] = points[5] * 3
    vectors = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id bigint, embedding array<double>")
    asked = F.col("id").isin(5, 6, 7, 8, 9)
    found = permindex.nearest(vectors, keep, asked, vector_block=90, query_block=2).collect()
    rows = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        rows.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert [i for i, _ in rows[5]] == list(range(100, 140, 2))
    for query, near in rows.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(s == math.fsum(points[i] * points[query]) for i, s in near)
        copies = [(i, s) for i, s in near if 100 <= i < 900 and i % 2 == 0]
        assert len({s for _, s in copies}) <= 1 and [i for i, _ in copies] == list(range(100, 100 + 2 * len(copies), 2))


def test_recall_on_the_tables(spark, keep):
    """On 500 vectors the footrule picks the candidates, and nine of ten neighbours are among them."""
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = permindex.nearest(vectors, keep, F.col("id") % 20 == 0).collect()
    rows = {r["vec_id"]: np.array(next(v for v in r if isinstance(v, list)), dtype=float) for r in vectors.collect() if any(isinstance(v, list) for v in r)}
    ids = sorted(i for i, v in rows.items() if np.isfinite(v).all() and v.any())
    assert max(permindex.LEAST_CANDIDATES, permindex.SHARE * len(ids)) < len(ids) / 3
    matrix, hits = np.stack([rows[i] for i in ids]), 0
    queries = [i for i in ids if i % 20 == 0]
    for query in queries:
        scores = matrix @ rows[query]
        best = [i for i, _ in sorted(zip(ids, scores), key=lambda x: (-x[1], x[0])) if i != query][:20]
        hits += len({r["vec_id"] for r in found if r["query_id"] == query} & set(best))
    assert hits >= 0.9 * 20 * len(queries)


def test_mixing_meets_its_targets(spark, odd, keep):
    pick = random.Random(1)
    rows = [(i, pick.choice("aaab"), pick.choice(["en", "de"]), "w " * pick.randrange(1, 60)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    goal = spark.createDataFrame([("a", 0.6), ("b", 0.3), ("absent", 0.1)], "source string, target double")
    mixed = mixing.mix(docs, mixing_store, targets={"source": goal}, budget=0.3).cache()
    sums = {r["k_source"]: r["w"] for r in mixed.groupBy("k_source").agg(F.sum(F.col("k_tokens") * F.col("probability")).alias("w")).collect()}
    total = sum(len(r[3].split()) for r in rows)
    assert sum(sums.values()) == pytest.approx(0.3 * total, rel=1e-3)
    assert sums["a"] / sum(sums.values()) == pytest.approx(2 / 3, rel=1e-3)
    drawn = mixed.where("kept").agg(F.sum("k_tokens")).first()[0]
    assert drawn == pytest.approx(0.3 * total, rel=0.12)
    assert mixing.mix(odd, mixing_store).count() == odd.count()
    assert mixing.mix(odd.limit(0), mixing_store).count() == 0


@pytest.fixture(scope="module")
def mixture():
    pick = random.Random(6)
    rows = []
    for i in range(4000):
        source = pick.choices(["a", "b", "c", None], [60, 25, 10, 5])[0]
        text = "w " * pick.randrange(1, 90) + ("*** x" if pick.random() < 0.15 else "")
        rows.append((i, source, pick.choices(["en", "de"], [4, 1])[0], text))
    return rows


def test_marginals_hold_after_capping(spark, mixture):
    """With many cells taken whole, every key's tokens still meet their goals."""
    docs = spark.createDataFrame(mixture, "doc_id bigint, source string, lang string, text string")
    mixed = mixing.mix(docs, mixing_store, budget=0.6).cache()
    total = sum(len(r[3].split()) for r in mixture)
    whole = mixed.where("probability = 1").select("k_source", "k_lang", "k_topic").distinct().count()
    assert whole >= 2
    for key, of in (("k_source", lambda r: r[1] or ""), ("k_lang", lambda r: r[2]), ("k_topic", lambda r: "marked" if "***" in r[3] else "short")):
        there = {}
        for r in mixture:
            there[of(r)] = there.get(of(r), 0) + len(r[3].split())
        goals, full = {}, set()
        while True:
            rest = {v: n ** 0.5 for v, n in there.items() if v not in full}
            scale = (0.6 * total - sum(there[v] for v in full)) / sum(rest.values())
            goals = {v: n if v in full else scale * rest[v] for v, n in there.items()}
            more = {v for v in rest if goals[v] >= there[v]}
            if not more:
                break
            full |= more
        got = mixed.groupBy(key).agg(F.sum(F.col("k_tokens") * F.col("probability")).alias("w")).collect()
        assert {r[key]: r["w"] / total for r in got} == pytest.approx({v: g / total for v, g in goals.items()}, abs=0.002)


def test_targets_that_cannot_be_met(spark):
    """Keys that contradict each other give probabilities all the same, and near the budget."""
    rows = [(i, "a" if i < 10 else "b", "en" if i < 10 else "de", "w " * 10) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    goals = {
        "source": spark.createDataFrame([("a", 0.9), ("b", 0.1)], "source string, target double"),
        "lang": spark.createDataFrame([("en", 0.1), ("de", 0.9)], "lang string, target double"),
    }
    found = mixing.mix(docs, mixing_store, targets=goals, budget=0.5).select("probability").distinct().collect()
    assert all(0 <= r["probability"] <= 1 for r in found)


def test_mixing_by_a_plain_join_and_a_topic_of_ones_own(spark, mixture):
    """Cells too many for a broadcast give the same draw; a topic is any column."""
    docs = spark.createDataFrame(mixture, "doc_id bigint, source string, lang string, text string")
    names = ["document.doc_id", "k_source", "k_topic", "probability", "kept"]
    topic = F.when(docs["doc_id"] % 3 == 0, "third")
    one, two = (
        {tuple(r) for r in mixing.mix(docs, mixing_store, topic=topic, most_broadcast=n).select(*names).collect()} for n in (10**5, 0)
    )
    assert one == two and {r[2] for r in one} == {"third", ""} and "" in {r[1] for r in one}


CLASHING = ["probability", "kept", "k_source", "document", "n", "component", "base", "factor", "chance", "id", "rep", "n_rows", "_text", "doc.x"]


@pytest.fixture
def clashing(spark, odd):
    """The odd documents, two more that repeat, and columns named like those the stages use."""
    long = "Some quite long text that repeats itself nowhere at all and so has words enough. " * 3
    more = spark.createDataFrame(
        [(50, long, "en", "s"), (50, long, "en", "s"), (50, long, "en", "s"), (51, long, "en", "s"), (None, long, "en", "s"), (None, long, "en", "s"),
         (52, "My mail is a.b@example.com and " + long, "en", "t"), (53, None, None, None)], "doc_id bigint, text string, lang string, source string"
    )
    docs = odd.select("doc_id", "text", "lang", "source").unionByName(more)
    return docs.withColumns({n: F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for n in CLASHING})


def by_id(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)


def test_stages_against_plain_versions(spark, clashing):
    """Every stage keeps the rows, texts and extra columns that a plain version keeps."""
    import corpus_pipeline

    stages = dict(corpus_pipeline.STAGES)
    before = clashing.collect()
    extra = {r["doc_id"]: tuple(r[n] for n in CLASHING) for r in before}

    def run(name, docs):
        found = mixing_store(stages[name](spark, docs, SF_DIR), "stage")
        assert found.columns == docs.columns and found.dtypes == docs.dtypes
        rows = found.collect()
        assert all(tuple(r[n] for n in CLASHING) == extra[r["doc_id"]] for r in rows)
        assert stages[name](spark, docs.limit(0), SF_DIR).count() == 0
        return rows

    model = quality.learn_quality(spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    judge = quality.judge_of(model, quality.THRESHOLD)
    assert by_id(run("quality rules", clashing)) == by_id(r for r in before if judge(r["text"] or "")[3])

    # Of copies the smallest id stays, and one row of those that repeat an id and a text.
    sets = components([(r["doc_id"], r["text"]) for r in before if r["doc_id"] is not None], 5, 80)
    expected = {(r["doc_id"], r["text"]) for r in before if r["doc_id"] is None or sets[r["doc_id"]][1] == r["doc_id"]}
    assert by_id(run("near duplicates", clashing)) == sorted(expected, key=repr)

    masked = run("personal data", clashing)
    mails = {i: t for i, t in by_id(masked) if t and "example.com" in t}
    assert not mails and len(masked) == len(before)
    plain = [(r["doc_id"], r["text"]) for r in before if r["doc_id"] != 52]
    assert [x for x in by_id(masked) if x[0] != 52] == sorted(plain, key=repr)

    chosen = mixing.mix(clashing, mixing_store, budget=corpus_pipeline.MIX_BUDGET, temperature=corpus_pipeline.MIX_TEMPERATURE)
    drawn = [r["document"] for r in chosen.collect() if zlib_draw(r["document"]["doc_id"]) < r["probability"]]
    assert by_id(run("mixing to target weights", clashing)) == by_id(drawn)
    encoded = stages["piece encoding"](spark, clashing, SF_DIR).collect()
    assert len(encoded) == len(before) and all(r["round_trip"] for r in encoded)


def zlib_draw(doc_id):
    digest = hashlib.md5(f"{'null' if doc_id is None else doc_id}/{mixing.SEED}".encode()).hexdigest()
    return int(digest[:8], 16) / 2**32


def mixing_store(df, label):
    from barograph.llm.common import stored

    return stored(df, label)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows, at = docs.count(), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = mixing_store(stage(spark, at, SF_DIR), "test")
        assert at.columns == docs.columns and at.dtypes == docs.dtypes, name
        assert 0 < at.count() <= rows, name
        rows = at.count()
    last = corpus_pipeline.STAGES[-1][1](spark, at, SF_DIR)
    assert last.count() == rows and last.where("round_trip").count() == rows


def test_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
