"""Quality rules: fixed text counts, and a hashed n-gram classifier behind them.

The classifier is a logistic regression on hashed words and character trigrams.
It is fitted on a bounded sample of labelled rows (``max_rows``), calibrated on
a part of the sample that the fit has not seen, and applied in Arrow batches
against a fixed threshold.

Defined results: a null text counts as empty; an empty text has no words and
fails the base rules. Labels that are null are not learned from. Without any
label of either class the classifier accepts everything that the base rules
accept. Repeated rows get the same result; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barograph.llm.common import map_rows, over_batches, slices, word_ids

BUCKETS = 4096
MAX_ROWS = 4000
THRESHOLD = 0.5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
NO_SPACES = str.maketrans("", "", SPACES)


def split_words(text):
    """Words as bytes, case kept."""
    return text.encode("utf-8", "replace").split()


def repeated_words(words):
    """Words that lie in a three-word window found at least twice."""
    if len(words) < 4:
        return 0
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    base = len(numbers)
    pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1].astype(np.int64) * base + ids[2:]
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = times[place] > 1
    inside = np.zeros(len(words), dtype=bool)
    for at in range(3):
        inside[at : at + len(again)] |= again
    return int(inside.sum())


def repeated_lines(text):
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def text_counts(text):
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text."""
    words = split_words(text)
    return (
        len(words),
        len(text.translate(NO_SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeated_lines(text),
        repeated_words(words),
    )


def base_fails(n_words, n_repeat_words):
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEATED_PERCENT * n_words


def hashed_features(text, cache, buckets=BUCKETS):
    """Damped counts of hashed words and character trigrams, each part of length one."""
    words = np.array(word_ids(split_words(text), cache), dtype=np.uint64)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
    grams = np.zeros(0, dtype=np.uint64)
    if len(points) >= 3:
        grams = points[:-2] * np.uint64(1_000_003) + points[1:-1]
        grams = (grams * np.uint64(1_000_003) + points[2:]) * np.uint64(0x9E3779B97F4A7C15)
        grams >>= np.uint64(40)
    parts = []
    for values in (words, grams):
        counts = np.bincount(
            (values % np.uint64(buckets // 2)).astype(np.int64), minlength=buckets // 2
        )
        part = np.log1p(counts.astype(np.float32))
        parts.append(part / max(1e-9, float(np.linalg.norm(part))))
    return np.concatenate(parts)


def fitted(features, labels, rounds=300, rate=2.0, decay=1e-4):
    """Weights and bias of a logistic regression by accelerated gradient descent."""
    size, wide = features.shape
    weights, bias = np.zeros(wide, np.float32), 0.0
    ahead, ahead_bias = weights.copy(), bias
    share = max(1, labels.sum()) / size
    each = np.where(labels > 0, 0.5 / share, 0.5 / max(1e-9, 1 - share)).astype(np.float32)
    each /= each.sum()
    for at in range(rounds):
        error = (1 / (1 + np.exp(-(features @ ahead + ahead_bias))) - labels) * each
        step = ahead - rate * (features.T @ error + decay * ahead)
        step_bias = ahead_bias - rate * float(error.sum())
        push = at / (at + 3)
        ahead, ahead_bias = step + push * (step - weights), step_bias + push * (step_bias - bias)
        weights, bias = step, step_bias
    return weights, bias


def calibrated(scores, labels, weights=None):
    """Slope and shift that turn scores into probabilities, by Newton's method."""
    a, b = 1.0, 0.0
    weights = np.ones(len(scores)) if weights is None else weights
    loss = lambda a, b: float(
        (weights * (np.logaddexp(0, a * scores + b) - labels * (a * scores + b))).sum()
        + 0.005 * (a - 1) ** 2
    )
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * scores + b, -30, 30)))
        gap, w = weights * (p - labels), weights * (p * (1 - p) + 1e-6)
        slope = np.array([(gap * scores).sum() + 1e-2 * (a - 1), gap.sum()])
        curve = np.array(
            [[(w * scores**2).sum() + 1e-2, (w * scores).sum()], [(w * scores).sum(), w.sum()]]
        )
        change, at = np.linalg.solve(curve, slope), loss(a, b)
        while loss(a - change[0], b - change[1]) > at and abs(change).max() > 1e-9:
            change /= 2
        a, b = a - change[0], b - change[1]
        if abs(change).max() < 1e-8:
            break
    return float(a), float(b)


def learn_quality(docs, labels, max_rows=MAX_ROWS, buckets=BUCKETS):
    """The classifier, from at most ``max_rows`` labelled texts picked by a hash of the id."""
    picked = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    texts = docs.where("text IS NOT NULL").select("doc_id", "text")
    # Of several texts of one id the smallest is learned from.
    chosen = (
        texts.join(F.broadcast(picked), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.max("quality").alias("quality"))
    )

    def make():
        cache = {}

        def step(rows):
            made = [hashed_features(t, cache, buckets) for t in rows["text"]]
            held = [np.flatnonzero(f) for f in made]
            return {
                "id": rows["doc_id"],
                "quality": rows["quality"],
                "places": [h.astype(np.uint16).tobytes() for h in held],
                "values": [f[h].astype(np.float16).tobytes() for f, h in zip(made, held)],
            }

        return step

    made = over_batches(chosen, "id bigint, quality int, places binary, values binary", make)
    # Rows come one by one and hold what is not zero, so the driver's memory is that of the matrix.
    rows = sorted(map(tuple, made.toLocalIterator()))
    marks = np.array([float(quality > 0) for _, quality, _, _ in rows], dtype=np.float32)
    if not len(rows) or marks.min() == marks.max():
        return None
    unseen = np.arange(len(rows)) % 5 == 0
    if len(set(marks[~unseen])) < 2:
        unseen[:] = False
    # The texts of the fit come first, so both parts are views of one matrix.
    order = np.argsort(unseen, kind="stable")
    features = np.zeros((len(rows), buckets), dtype=np.float32)
    for place, at in enumerate(order):
        held = np.frombuffer(rows[at][2], np.uint16)
        features[place, held] = np.frombuffer(rows[at][3], np.float16)
    del rows
    marks, seen = marks[order], int((~unseen).sum())
    weights, bias = fitted(features[:seen], marks[:seen])
    held = slice(seen, None) if seen < len(marks) else slice(None)
    a, b = calibrated((features[held] @ weights + bias).astype(float), marks[held].astype(float))
    return {"weights": weights, "bias": bias, "a": a, "b": b, "buckets": buckets}


def judge_of(model, threshold):
    """A function from a text to its counts, base failure, probability and verdict."""
    cache = {}

    def probability(text):
        if model is None:
            return 1.0
        score = hashed_features(text, cache, model["buckets"]) @ model["weights"]
        z = model["a"] * float(score + model["bias"]) + model["b"]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def judge(text):
        counts = text_counts(text)
        failed, chance = base_fails(counts[0], counts[4]), probability(text)
        return counts, failed, chance, not failed and chance >= threshold

    return judge


def quality_rules(docs, model, threshold=THRESHOLD):
    """``doc_id``, the counts, ``base_failed``, ``probability`` and ``kept`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        judge = judge_of(shared.value, threshold)

        def step(rows):
            told = [judge(t or "") for t in rows["text"]]
            return {
                "doc_id": rows["doc_id"],
                **{name: [t[0][i] for t in told] for i, name in enumerate(COUNTS)},
                "base_failed": [t[1] for t in told],
                "probability": [t[2] for t in told],
                "kept": [t[3] for t in told],
            }

        return step

    return over_batches(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"),
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, probability double, kept boolean",
        make,
    )


def kept_rows(docs, model, threshold=THRESHOLD):
    """The rows of ``docs``, with all of their columns, whose text is accepted.

    Rows keep their order within a batch and any column type Arrow can carry.
    """
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def keep(batches):
        judge = judge_of(shared.value, threshold)
        for batch in batches:
            for rows in slices(batch):
                texts = rows.column(place).to_pylist()
                yield rows.filter(pa.array([judge(t or "")[3] for t in texts], pa.bool_()))

    return map_rows(docs, keep)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
