"""Language identification by words first, then by ever shorter character n-grams.

Known words score by their log frequency in each language. An unseen word is
scored by its character n-grams of the longest order that has a known one;
every step to a shorter order costs a fixed penalty.

Words and n-grams are counted over all training rows and all of them count.
Those with at least ``least_share`` of all occurrences of their kind are shared
with every task, ``1 / least_share`` per order at most; the others stay a table,
which the remaining words of the documents, and the n-grams of unseen ones, are
joined with. The share decides where a token is looked up, never its score.
Scores are summed as whole multiples of 2^-32, so their order does not matter.

Defined results: a null text, or one without a letter, is ``und`` with score 0.
Rows whose language is null teach nothing; without any training row every text
is ``und``. Ties go to the language that sorts first. Long texts are read
whole; repeated rows get the same result and other columns are ignored.
"""

import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from barograph.llm import common
from barograph.llm.common import over_batches, rows_of

# Word characters are letters, digits and other numbers, such as a square or a half; the last two are no letters.
OTHER_NUMBERS = {c for c in map(chr, range(0x110000)) if c.isnumeric() and not (c.isalpha() or c.isdecimal())}
# Without those numbers, as a class that lists a thousand of them is tried item by item at every place.
LETTERS = re.compile(r"[^\W\d_]+")
ORDERS = (4, 3, 2, 1)
LEAST_SHARE = 2e-6
BACKOFF = 0.7
UNKNOWN = "und"
SCALE = 2.0**32


def letter_words(text):
    """Runs of letters, in lower case."""
    text = text.lower()
    if not text.isascii():
        for number in OTHER_NUMBERS.intersection(text):
            text = text.replace(number, " ")
    return LETTERS.findall(text)


def grams_of(word, order):
    """Character n-grams; from two characters on the edges of the word are marked."""
    marked = f"<{word}>" if order > 1 else word
    return [marked[i : i + order] for i in range(len(marked) - order + 1)]


def word_counts(training):
    """``lang, token, n`` over all rows of ``lang, text``: counted in batches, then summed."""

    def make():
        def step(rows):
            counts = {}
            for lang, text in zip(rows["lang"], rows["text"]):
                counts.setdefault(lang, Counter()).update(letter_words(text))
            flat = [(lang, word, n) for lang, c in counts.items() for word, n in c.items()]
            return {
                "lang": [x[0] for x in flat],
                "token": [x[1] for x in flat],
                "n": [x[2] for x in flat],
            }

        return step

    rows = training.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = over_batches(rows, "lang string, token string, n bigint", make)
    return counted.groupBy("lang", "token").agg(F.sum("n").alias("n"))


def gram_counts(words):
    """``lang, size, token, n``: n-grams of every word, weighted by its count."""

    def make():
        def step(rows):
            counts = {}
            for lang, word, n in zip(rows["lang"], rows["token"], rows["n"]):
                for order in ORDERS:
                    held = counts.get((lang, order))
                    if held is None:
                        held = counts[lang, order] = {}
                    for gram in grams_of(word, order):
                        held[gram] = held.get(gram, 0) + n
            flat = [(*key, gram, n) for key, held in counts.items() for gram, n in held.items()]
            names = ("lang", "size", "token", "n")
            return {name: [row[i] for row in flat] for i, name in enumerate(names)}

        return step

    counted = over_batches(words, "lang string, size int, token string, n bigint", make)
    return counted.groupBy("lang", "size", "token").agg(F.sum("n").alias("n"))


def by_token(counts):
    """``size, token, n, by``: every token with its occurrences, in all and by language."""
    pairs = F.collect_list(F.struct(F.col("lang").alias("key"), F.col("n").alias("value")))
    return counts.groupBy("size", "token").agg(F.sum("n").alias("n"), pairs.alias("by"))


class Backoff:
    """Log frequencies by language: of words (order 0), and of n-grams by their order.

    Each order has a table from token to row and a matrix of rows; the last row
    of a matrix is for tokens that were never counted. ``rest`` is the table of
    the counted tokens that are not in here; it stays with the driver.
    """

    def __init__(self, languages, totals, entries, distinct, rest=None):
        self.languages, self.rest = languages, rest
        self.places = {lang: i for i, lang in enumerate(languages)}
        self.rows = {size: {} for size in (0, *ORDERS)}
        for size, token, _ in entries:
            self.rows[size][token] = len(self.rows[size])
        self.below, self.matrix = {}, {}
        for size, rows in self.rows.items():
            total = np.array([totals.get((lang, size), 0) for lang in languages], dtype=float)
            self.below[size] = np.log(total + 0.5 * (distinct.get(size, 0) + 1))
            self.matrix[size] = np.full((len(rows) + 1, len(languages)), 0.5)
        for size, token, by in entries:
            for lang, n in by:
                self.matrix[size][self.rows[size][token], self.places[lang]] += n
        for size, matrix in self.matrix.items():
            self.matrix[size] = np.log(matrix) - self.below[size]

    def __getstate__(self):
        return self.__dict__ | {"rest": None}

    def row(self, size, by):
        """Scores of a token from its counts by language."""
        counts = np.full(len(self.languages), 0.5)
        for entry in by:
            counts[self.places[entry["key"]]] += entry["value"]
        return np.log(counts) - self.below[size]

    def missing(self, word):
        """``(order, n-gram)`` that an unseen word may need and that are not in here."""
        for order in ORDERS:
            rows, grams = self.rows[order], set(grams_of(word, order))
            absent = [gram for gram in grams if gram not in rows]
            yield from ((order, gram) for gram in absent)
            if len(absent) < len(grams):
                break

    def scores(self, words, more=None):
        """A row of scores by language for each word; ``more`` has rows by order and token."""
        more = more or {}
        out = np.zeros((len(words), len(self.languages)))
        known = np.array([self.rows[0].get(w, -1) for w in words], dtype=np.int64)
        out[known >= 0] = self.matrix[0][known[known >= 0]]
        for i in np.flatnonzero(known < 0):
            if (0, words[i]) in more:
                out[i], known[i] = more[0, words[i]], 0
        left = np.flatnonzero(known < 0)
        for step, order in enumerate(ORDERS, 1):
            rows, matrix = self.rows[order], self.matrix[order]
            grams = [grams_of(words[i], order) for i in left]
            sizes = np.array([len(g) for g in grams], dtype=np.int64)
            flat = [g for found in grams for g in found]
            places = np.array([rows.get(g, -1) for g in flat], dtype=np.int64)
            values, seen = matrix[places], places >= 0
            for i in np.flatnonzero(~seen) if more else ():
                if (order, flat[i]) in more:
                    values[i], seen[i] = more[order, flat[i]], True
            some = sizes > 0
            hit = np.zeros(len(left), dtype=bool)
            if some.any():
                starts = (np.cumsum(sizes) - sizes)[some]
                hit[some] = np.add.reduceat(seen, starts, dtype=np.int64) > 0
                means = np.add.reduceat(values, starts) / sizes[some][:, None]
                out[left[hit]] = means[hit[some]] + step * np.log(BACKOFF)
            left = left[~hit]
            if not len(left):
                break
        return out

    def word(self, word):
        """Scores of one word by language."""
        return self.scores([word])[0]


def learn_languages(training, least_share=LEAST_SHARE, stored=lambda df, label: df):
    """The model, from rows of ``lang, text``; None without any."""
    words = stored(word_counts(training), "lang-words")
    grams = gram_counts(words)
    counts = words.select("lang", F.lit(0).alias("size"), "token", "n").unionByName(grams)
    tokens = stored(by_token(counts), "lang-tokens")
    each = tokens.select("size", F.explode("by").alias("e")).groupBy("size", "e.key")
    totals = {(r["key"], r["size"]): r["n"] for r in rows_of(each.agg(F.sum("e.value").alias("n")))}
    if not totals:
        return None
    sizes = tokens.groupBy("size").agg(F.sum("n").alias("all"), F.count("*").alias("distinct"))
    sizes = rows_of(sizes)
    least = F.element_at(
        F.create_map(*[F.lit(x) for r in sizes for x in (r["size"], r["all"] * least_share)]),
        F.col("size"),
    )
    entries = [
        (r["size"], r["token"], [(e["key"], e["value"]) for e in r["by"]])
        for r in rows_of(tokens.where(F.col("n") >= least).select("size", "token", "by"))
    ]
    return Backoff(
        sorted({lang for lang, _ in totals}),
        totals,
        entries,
        {r["size"]: r["distinct"] for r in sizes},
        tokens.where(F.col("n") < least).select("size", "token", "by"),
    )


def fixed(rows):
    return np.rint(rows * SCALE).astype(np.int64)


def document_parts(docs, shared):
    """``key, doc_id, token, n, row``: for every document the sum of its shared words, and
    every other word with its count."""

    def make():
        learned = shared.value
        known, matrix = learned.rows[0], fixed(learned.matrix[0])

        def step(rows):
            out = {"key": [], "doc_id": [], "token": [], "n": [], "row": []}

            def add(*values):
                for held, value in zip(out.values(), values):
                    held.append(value)

            for key, doc_id, text in zip(rows["key"], rows["doc_id"], rows["text"]):
                words = letter_words(text) if text else []
                places = [known.get(w, -1) for w in words]
                held = [p for p in places if p >= 0]
                add(key, doc_id, None, 1, matrix[held].sum(axis=0) if words else None)
                if len(held) < len(words):
                    rest = Counter(w for w, p in zip(words, places) if p < 0)
                    for word, n in rest.items():
                        add(key, None, word, n, None)
            return out

        return step

    plain = docs.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
    )
    schema = "key bigint, doc_id bigint, token string, n bigint, row array<bigint>"
    return over_batches(plain, schema, make)


def word_rows(words, rest, shared, stored):
    """``token, row``: scores of words that are not shared, from the table of the other tokens."""

    def make_grams():
        learned = shared.value

        def step(rows):
            flat = [(w, *need) for w in rows["token"] for need in learned.missing(w)]
            names = ("token", "size", "gram")
            return {name: [row[i] for row in flat] for i, name in enumerate(names)}

        return step

    def make_rows():
        learned = shared.value

        def step(rows):
            more = {}
            for word, by, grams in zip(rows["token"], rows["by"], rows["grams"]):
                if by is not None:
                    more[0, word] = learned.row(0, by)
                for g in grams or ():
                    if (g["size"], g["gram"]) not in more:
                        more[g["size"], g["gram"]] = learned.row(g["size"], g["by"])
            return {"token": rows["token"], "row": list(fixed(learned.scores(rows["token"], more)))}

        return step

    counted = rest.where("size = 0").select("token", "by")
    first = stored(words.join(counted.hint("merge"), "token", "left"), "lang-rare")
    unseen = first.where("by IS NULL").select("token")
    grams = over_batches(unseen, "token string, size int, gram string", make_grams)
    others = rest.where("size > 0").withColumnRenamed("token", "gram")
    found = grams.join(others.hint("merge"), ["size", "gram"]).groupBy("token")
    found = found.agg(F.collect_list(F.struct("size", "gram", "by")).alias("grams"))
    ready = first.join(found.hint("merge"), "token", "left")
    return over_batches(ready.select("token", "by", "grams"), "token string, row array<bigint>", make_rows)


def identify_languages(docs, model, stored=common.stored):
    """``doc_id, lang_pred, score`` of every row; the score is the posterior of the choice."""
    if model is None:
        return docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
        )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    parts = stored(document_parts(docs, shared), "lang-parts")
    rare = parts.where("token IS NOT NULL").select("key", "token", "n")
    scored = word_rows(rare.select("token").distinct(), model.rest, shared, stored)
    joined = rare.join(scored.hint("merge"), "token").select(
        "key", F.lit(None).cast("bigint").alias("doc_id"), "n", "row"
    )
    every = parts.where("token IS NULL").select("key", "doc_id", "n", "row").unionByName(joined)
    sums = [F.sum(F.col("n") * F.col("row")[i]) for i in range(len(model.languages))]
    told = every.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.array(*sums).alias("total"))
    told = told.withColumn("best", F.array_max("total"))
    at = F.array_position("total", F.col("best")).cast("int")
    chances = F.transform("total", lambda x: F.exp((x - F.col("best")) / F.lit(SCALE)))
    score = 1 / F.aggregate(chances, F.lit(0.0), lambda held, x: held + x)
    languages = F.array(*[F.lit(lang) for lang in model.languages])
    return told.select(
        "doc_id",
        F.when(F.col("best").isNull(), UNKNOWN).otherwise(F.element_at(languages, at)).alias("lang_pred"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )
