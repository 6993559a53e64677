"""Toxicity by maximum-scoring segments of token log-odds.

Words get the log-odds of the toxic against the other training texts, counted
by texts, under a Dirichlet prior in proportion to the whole vocabulary and
shrunk by one standard error; words that do not tell the classes apart get a
small negative score. A linear scan finds every maximal-scoring segment of a
text. A segment's score becomes a number of expected chance segments by
extreme-value statistics of the scores; significant segments add up, and a
logistic curve fitted on the training texts turns the sum into a probability.

Counts cover all training texts. The model holds every word whose score the
standard error leaves above ``LEAST_SCORE``, however rare it is: 16 bytes a
word, as sorted 64-bit hashes and their scores.

Defined results: null and empty texts have no segment and get the probability
of a text without evidence. Null labels teach nothing; without both classes
every score is 0. Of several labels of one document the largest counts.
Repeated rows get the same result; other columns are ignored.
"""

import math
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from barograph.llm.common import over_batches, rows_of
from barograph.llm.quality import calibrated

LEAST_SCORE = 0.05
MAX_CACHED = 200_000
PRIOR = 0.1
DRIFT = 0.25
SIGNIFICANT = 1.0
CUTOFF = 0.3
STRIPPED = b".,;:!?\"'()[]{}|#*$%&<>-"


def tokens_of(text):
    """Lower-case words without the punctuation around them."""
    return [w.strip(STRIPPED) for w in text.lower().encode("utf-8", "replace").split()]


def presence_counts(training):
    """``token, y, n``: in how many texts of each class a token occurs."""

    def make():
        def step(rows):
            counts = Counter()
            for y, text in zip(rows["y"], rows["text"]):
                counts.update((token, y) for token in set(tokens_of(text)))
            keys = list(counts)
            return {
                "token": [k[0] for k in keys],
                "y": [k[1] for k in keys],
                "n": [counts[k] for k in keys],
            }

        return step

    counted = over_batches(
        training.select("y", "text"), "token binary, y int, n bigint", make
    )
    one = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))
    return counted.where(F.length("token") > 0).groupBy("token").agg(
        one(1).alias("toxic"), one(0).alias("other")
    )


class Scores:
    """Scores of words, found by the sorted 64-bit hashes of the words."""

    def __init__(self, hashes, scores):
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.scores = hashes[order], scores[order]
        self.cache = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def of(self, tokens):
        """``{token: score}`` of those that have one."""
        if len(self.cache) > MAX_CACHED:
            self.cache.clear()
        new = [t for t in set(tokens) if t not in self.cache]
        if new and len(self.hashes):
            asked = np.array([hashed(t) for t in new], dtype=np.int64)
            at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
            hit = self.hashes[at] == asked
            found = zip(new, hit.tolist(), self.scores[at].tolist())
            self.cache.update((t, score if known else None) for t, known, score in found)
        return self.cache


def hashed(token):
    """The signed 64-bit hash of a word, as Spark keeps it."""
    value = xxhash.xxh3_64_intdigest(token)
    return value - 2**64 if value >= 2**63 else value


def token_scores(counts, prior=PRIOR):
    """The scores, and the chance of each score in texts that are not toxic."""
    totals = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).first()
    if not totals["toxic"] or not totals["other"]:
        return None
    n1, n0 = float(totals["toxic"]), float(totals["other"])
    strength = prior * n1
    a = (F.col("toxic") + F.col("other")) * F.lit(strength / (n1 + n0))
    odds = lambda c, n: F.log((c + a) / (F.lit(n + strength) - c - a))
    delta = odds(F.col("toxic"), n1) - odds(F.col("other"), n0)
    error = F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("other") + a))
    scored = (
        counts.withColumn("score", F.signum(delta) * F.greatest(F.abs(delta) - error, F.lit(0.0)))
        .withColumn("chance", (F.col("other") + a) / F.lit(n0 + strength))
        .where(F.abs("score") > LEAST_SCORE)
    )

    def make():
        return lambda rows: rows | {"hash": [hashed(t) for t in rows["token"]]}

    schema = "hash bigint, score double, chance double"
    found = over_batches(scored, schema, make, ["token", "score", "chance"]).toArrow()
    hashes, score, chance = (found.column(n).to_numpy() for n in ("hash", "score", "chance"))
    return Scores(hashes, score), (score, chance)


def decay(chances, drift=DRIFT):
    """The positive root of E[exp(x * score)] = 1, which scales scores to chance."""
    scores, weights = chances
    scores = np.append(scores, 0.0) - drift
    weights = np.append(weights, max(1e-9, 1 - weights.sum()))
    low, high = 1e-6, 1e-6
    excess = lambda x: float((weights * np.exp(np.clip(x * scores, -700, 60))).sum()) - 1
    while excess(high) <= 0 and high < 50:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return low


def segments(scores):
    """``(start, end, score)`` of all maximal-scoring segments, in one pass.

    Candidates are kept with the running sums before and after them. A new one
    is joined with earlier candidates while that raises its score.
    """
    total, held = 0.0, []
    for at, score in scores:
        before = total
        total += score
        if score <= 0:
            continue
        start, low, high = at, before, total
        while True:
            back = len(held) - 1
            while back >= 0 and held[back][2] >= low:
                back = held[back][4]
            if back < 0 or held[back][3] >= high:
                held.append((start, at + 1, low, high, back))
                break
            start, low = held[back][0], held[back][2]
            del held[back:]
    return [(start, end, high - low) for start, end, low, high, _ in held]


class Detector:
    """Scores, scale and calibration; ``evidence`` of a text, and its probability."""

    def __init__(self, scores, scale, curve=(0.0, 0.0)):
        self.scores, self.scale, self.curve = scores, scale, curve

    def passages(self, text):
        """``(start, end, weight)`` of significant passages, in words of the text."""
        tokens = tokens_of(text)
        known = self.scores.of(tokens)
        # A word said over and over is one sign, not many independent ones: it is one place.
        starts = [i for i, token in enumerate(tokens) if i == 0 or token != tokens[i - 1]]
        ends = [*starts, len(tokens)]
        steps, last = [], -1
        for at, start in enumerate(starts):
            score = known.get(tokens[start])
            if score is not None:
                # The words between two scored ones only drift down: one step for all.
                if at - last > 1:
                    steps.append((at - 1, -DRIFT * (at - last - 1)))
                steps.append((at, score - DRIFT))
                last = at
        log_size = math.log(max(1, len(starts)))
        found = [(starts[s], ends[e], self.scale * w - log_size) for s, e, w in segments(steps)]
        return [(s, e, w) for s, e, w in found if w > SIGNIFICANT], len(tokens)

    def evidence(self, text):
        return sum(weight for _, _, weight in self.passages(text)[0])

    def probability(self, evidence):
        slope, shift = self.curve
        z = slope * math.log1p(evidence) + shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def learn_toxicity(training, stored=lambda df, label: df):
    """A detector from rows of ``y, text``; None unless both classes occur."""
    counted = stored(presence_counts(training), "toxic-words")
    learned = token_scores(counted)
    if learned is None:
        return None
    scores, chances = learned
    detector = Detector(scores, decay(chances))
    shared = training.sparkSession.sparkContext.broadcast(detector)

    def make():
        def step(rows):
            # One value in steps of 0.05, so that few groups are left to fit the curve on.
            told = [round(20 * math.log1p(shared.value.evidence(t))) for t in rows["text"]]
            return {"x": told, "y": rows["y"]}

        return step

    told = over_batches(training.select("text", "y"), "x bigint, y int", make)
    points = rows_of(told.groupBy("x", "y").agg(F.count("*").alias("n")).orderBy("x", "y"))
    x = np.array([p["x"] / 20 for p in points])
    y = np.array([float(p["y"]) for p in points])
    n = np.array([float(p["n"]) for p in points])
    detector.curve = calibrated(x, y, n)
    return detector


def score_toxicity(docs, detector, cutoff=CUTOFF):
    """``doc_id, score, predicted, n_passages, worst_start, worst_end`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(detector)

    def make():
        learned = shared.value

        def step(rows):
            told = [learned.passages(t or "")[0] if learned else [] for t in rows["text"]]
            worst = [max(p, key=lambda x: (x[2], -x[0]), default=(None, None, 0.0)) for p in told]
            score = [
                learned.probability(sum(x[2] for x in p)) if learned else 0.0 for p in told
            ]
            return {
                "doc_id": rows["doc_id"],
                "score": score,
                "predicted": [int(s >= cutoff) for s in score],
                "n_passages": [len(p) for p in told],
                "worst_start": [w[0] for w in worst],
                "worst_end": [w[1] for w in worst],
            }

        return step

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return over_batches(
        plain,
        "doc_id bigint, score double, predicted int, n_passages bigint, worst_start bigint, "
        "worst_end bigint",
        make,
    )
