"""Operators on single texts against plain versions, a library, round trips and edge cases."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from barograph.llm import bpecount, langid, pii, quality, siteprior, toxicity, unigram

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF_DIR = "/root/testdata/sf0.001"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@pytest.fixture(scope="module")
def texts(spark):
    found = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    pick, signs = random.Random(3), "0123456789.... -+@@abc()\n#日é▁ th"
    return found + ["".join(pick.choice(signs) for _ in range(pick.randrange(90))) for _ in range(3000)]


def test_token_counts_are_the_librarys(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    merges = bpecount.Merges(bpecount.read_pieces(PATH))
    assert merges.splits
    for text in texts[:1200] + ["", " ", "  a  b ", "<s>hi</s> <0x0A>", "\x00a", "aaaa" * 90, "日本😀z"]:
        counted = sum(map(merges.count, bpecount.CHUNK.findall(bpecount.marked(text))))
        assert counted == len(library.encode(text)), text[:80]
        assert merges.count(bpecount.marked(text)) == counted


def test_unigram_is_best_and_decodes(texts):
    model, cache = unigram.read_unigram(PATH), {}
    score = dict(zip(model.ids, model.scores))
    known = {piece: score[i] for i, piece in model.texts.items()}

    def best(chunk):
        if not chunk:
            return 0.0
        ends = [known[chunk[:n]] + best(chunk[n:]) for n in range(1, len(chunk) + 1) if chunk[:n] in known]
        alone = [] if chunk[:1] in known else [model.unknown + best(chunk[1:])]
        return max(ends + alone)

    for chunk in ["▁the", "▁ouring", "▁▁▁ab", "日本", "éa1😀z", "▁token.", "\x00"]:
        assert model.best(chunk)[0] == pytest.approx(best(chunk))
    for text in texts[:600]:
        assert model.decode(model.encode(text, cache)) == text.replace("▁", " ")


def test_unigram_steps_stay_within_its_arrays(texts):
    """Any state followed by any code has a place, and unknown characters have a code without children."""
    model = unigram.read_unigram(PATH)
    base, check, other = model.trie.base, model.trie.check, model.trie.no_code
    assert other not in model.trie.codes.values() and max(base) + other < len(check)
    assert all(check[place + other] != state for state, place in enumerate(base))
    # Chunks that a worker has met stay with its model, whichever task met them.
    assert model.cache == {} and model.encode(texts[0], model.cache) and model.cache


def test_letters_are_found_by_plain_classes():
    """Numbers of all kinds part words, and the pattern lists none of them, which would be tried at every character."""
    plain = lambda text: "".join(c if c.isalpha() and not c.isnumeric() or c in "一二" else " " for c in text).split()
    for text in ["x²y ½ Ⅻa", "naïve_çà 3été", "a٣b", "plain words 12", ""]:
        assert langid.letter_words(text) == plain(text.lower())
    assert len(langid.LETTERS.pattern) < 20


def test_personal_data_follows_the_rules(texts):
    def plain(text):
        for kind, rule in RULES.items():
            for match in re.finditer(rule, text):
                digits = re.sub("[^0-9]", "", match[0])
                if (
                    kind == "email"
                    or (kind == "ip" and all(int(p) < 256 for p in match[0].split(".")))
                    or (kind == "card" and 13 <= len(digits) <= 19 and pii.luhn(digits))
                    or (kind == "phone" and 9 <= len(digits) <= 15)
                ):
                    yield pii.KINDS.index(kind), match.start(), match.end()

    for text in texts:
        assert [s for s in pii.spans_of(text) if s[0] < 4] == list(plain(text)), text[:80]
    hidden = pii.masked('a.b@c.de, token = "abcdef123456" IBAN GB82 WEST 1234 5698 7654 32, http://u:p@h.io/x')
    assert hidden == '[EMAIL], token = "[SECRET]" IBAN [ACCOUNT], [LOGIN]/x'


def test_quality_counts(texts):
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = list(zip(words, words[1:], words[2:]))
        times, inside = Counter(windows), set()
        for at, window in enumerate(windows):
            inside |= {at, at + 1, at + 2} if times[window] > 1 else set()
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        assert quality.text_counts(text) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside),
        )


def test_segments_by_brute_force():
    pick = random.Random(5)
    for _ in range(300):
        scores = [pick.choice([-3, -2, -1, -1, 1, 2, 4]) for _ in range(pick.randrange(12))]

        def split(low, high):
            sums = [(sum(scores[i:j]), i - j, i, j) for i in range(low, high) for j in range(i + 1, high + 1)]
            top = max(sums, default=(0, 0, 0, 0), key=lambda s: (s[0], s[1], -s[2]))
            if top[0] <= 0:
                return []
            return [*split(low, top[2]), (top[2], top[3], top[0]), *split(top[3], high)]

        found = toxicity.segments(list(enumerate(scores)))
        assert sum(s for _, _, s in found) == sum(s for _, _, s in split(0, len(scores))), scores
        assert all(sum(scores[i:j]) == s for i, j, s in found)


def test_language_backoff(spark, odd, keep):
    rows = [("en", "the cat sat on the mat"), ("de", "der hund saß auf der matte"), (None, "le chat"), ("en", None)]
    model = langid.learn_languages(spark.createDataFrame(rows, "lang string, text string"), 0.0, keep)
    assert model.languages == ["de", "en"]
    assert np.argmax(model.word("the")) == 1 and np.argmax(model.word("saßen")) == 0
    assert np.allclose(model.word("日"), 0)
    found = {r["doc_id"]: r for r in langid.identify_languages(odd, model).collect()}
    assert [found[i]["lang_pred"] for i in (0, 1, 2, 3)] == ["und"] * 4 and found[0]["score"] == 0
    assert langid.identify_languages(odd, model).count() == odd.count()
    none = langid.learn_languages(spark.createDataFrame([], "lang string, text string"), 0.0, keep)
    assert {r["lang_pred"] for r in langid.identify_languages(odd, none).collect()} == {"und"}


def test_languages_do_not_depend_on_what_is_shared(spark, keep):
    english = [("en", f"the cat sat on the mat with house{chr(97 + i % 26)}") for i in range(400)]
    rows = english + [("ga", "madra beag cúramach"), ("de", "grüße vom schloss")]
    docs = [(0, "madra beag"), (1, "cúramachta"), (2, "schlossgrüße"), (3, "the house"), (4, "12"), (5, "madra the beag madra")]
    training = spark.createDataFrame(rows, "lang string, text string")
    docs = spark.createDataFrame([*docs, docs[0]], "doc_id bigint, text string")
    found = {}
    for share in (0.0, 0.01, 2.0):
        model = langid.learn_languages(training, share, keep)
        found[share] = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify_languages(docs, model).collect())
    assert [lang for _, lang, _ in found[0.0]] == ["ga", "ga", "ga", "de", "en", "und", "ga"]
    for share in (0.01, 2.0):
        assert [f[:2] for f in found[share]] == [f[:2] for f in found[0.0]]
        assert np.allclose([f[2] for f in found[share]], [f[2] for f in found[0.0]], atol=1e-6)


def test_rare_toxic_words_count(spark):
    counts = [(b"slur", 40, 0), (b"mild", 2, 48), (b"once", 1, 0)]
    counts += [(b"w%d" % i, 40_000, 960_000) for i in range(40)]
    counts = spark.createDataFrame(counts, "token binary, toxic bigint, other bigint")
    scores, chances = toxicity.token_scores(counts)
    known = scores.of([b"slur", b"mild", b"once", b"absent"])
    assert known[b"slur"] > 1 and known[b"once"] is None and known[b"mild"] is None and known[b"absent"] is None
    passages, _ = toxicity.Detector(scores, toxicity.decay(chances)).passages("you slur and slur you slur")
    assert passages


def test_repeating_an_insult_takes_nothing_from_it():
    scores = toxicity.Scores(np.array([toxicity.hashed(b"slur")]), np.array([4.0]))
    detector = toxicity.Detector(scores, 1.0)
    once, n = detector.passages("oh you slur")
    often, long = detector.passages("oh you" + " slur" * 500 + " you")
    assert n == 3 and long == 503 and [(s, e) for s, e, _ in once + often] == [(2, 3), (2, 502)]
    assert detector.passages("slur " * 500)[0][0][2] == detector.passages("slur")[0][0][2] > 1
    assert often[0][2] == pytest.approx(once[0][2] - np.log(4 / 3))


def test_odd_rows(spark, odd, marks, keep):
    empty = odd.limit(0)
    for docs in (odd, empty):
        n = docs.count()
        assert pii.find_pii(docs).count() == n
        masked = pii.mask_texts(docs)
        assert masked.columns == docs.columns and masked.where("text IS NULL").count() == docs.where("text IS NULL").count()
        assert bpecount.count_tokens(docs, PATH).count() == n
        encoded = unigram.encode_texts(docs, PATH)
        assert encoded.where("round_trip").count() == n
        assert unigram.decode_ids(encoded, PATH).count() == n
        model = quality.learn_quality(docs, marks)
        judged = quality.quality_rules(docs, model).collect()
        assert len(judged) == n and not any(r["kept"] for r in judged)
        training = docs.join(marks, "doc_id").select(F.col("toxic").alias("y"), "text").where("y IS NOT NULL AND text IS NOT NULL")
        detector = toxicity.learn_toxicity(training, keep)
        assert toxicity.score_toxicity(docs, detector).where("score BETWEEN 0 AND 1").count() == n
        sites = siteprior.judge_quality(docs, marks, F.col("source"), F.col("lang"), keep)
        assert sites.where("probability BETWEEN 0 AND 1").count() == n


def test_site_prior_shrinks(spark, keep):
    rows = [(i, "plain words " * 20, "good" if i < 200 else "bad") for i in range(400)]
    rows.append((400, "plain words " * 20, "new"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(400)], "doc_id bigint, quality int")
    found = siteprior.judge_quality(docs, labels, F.col("source"), F.lit("p"), keep)
    prior = {r["host"]: r["p"] for r in found.groupBy("host").agg(F.avg("site_prior").alias("p")).collect()}
    assert prior["good"] > 0.95 and prior["bad"] < 0.05 and 0.3 < prior["new"] < 0.7


def test_numbers_are_no_letters(spark):
    """Squares, halves and Roman numerals are numbers; a text of nothing else is undetermined."""
    assert langid.letter_words("\u00b2 \u00bd 12 \u2167 _ a\u00b2b \u00c9t\u00e9 \u4e94") == ["a", "b", "\u00e9t\u00e9", "\u4e94"]
    rows = [(1, "en", "the cat and the dog"), (2, "de", "der Hund und die Katze")]
    training = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    model = langid.learn_languages(training.select("lang", "text"))
    odd = spark.createDataFrame([(3, "\u00b2"), (4, "\u00bd 12"), (5, "\u2167"), (6, "the dog")], "doc_id bigint, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identify_languages(odd, model).collect()}
    assert found[3] == found[4] == found[5] == ("und", 0.0) and found[6][0] == "en"
