"""The registered queries of the operators on texts, and their SQL where there is one."""

import public_tokenizers
from pyspark.sql import functions as F

from barograph.llm import alignment, bottomk, bpecount, langid, mixing, packing, permindex, pii
from barograph.llm import prefixtrie, quality, siteprior, toxicity, unigram
from barograph.llm.common import remainder, stored, table

VOCABULARY = "piece_bpe_32k.model"
WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def op1_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rest = remainder(F.col("doc_id"), 5)
    model = langid.learn_languages(docs.where(rest != 0).select("lang", "text"), stored=stored)
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return langid.identify_languages(docs, model).withColumn("held_out", held_out)


def op2_site_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", docs["source"], docs["lang"])
    return siteprior.judge_quality(
        docs, table(spark, sf_dir, "labels"), docs["source"], path, stored
    )


def op3_permutation_search(spark, sf_dir):
    return permindex.nearest(
        table(spark, sf_dir, "embeddings"), stored, F.col("id") % 20 == 0
    )


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    marks = (
        table(spark, sf_dir, "labels")
        .where("toxic IS NOT NULL")
        .where(remainder(F.col("doc_id"), 4) != 2)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("y"))
    )
    # The same join at every size, of texts that can be learned from alone.
    texts = docs.where("text IS NOT NULL").where(remainder(F.col("doc_id"), 4) != 2)
    training = texts.select("doc_id", "text").join(marks.hint("merge"), "doc_id")
    training = stored(training.select("y", "text"), "toxic-training")
    detector = toxicity.learn_toxicity(training, stored)
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return toxicity.score_toxicity(docs, detector).withColumn("held_out", held_out)


def op5_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return bpecount.count_tokens(docs, public_tokenizers.path(VOCABULARY))


def op6_pii(spark, sf_dir):
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.learn_quality(docs, table(spark, sf_dir, "labels"))
    return quality.quality_rules(docs, model)


def op8_near_duplicates(spark, sf_dir):
    found = bottomk.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    mixed = mixing.mix(docs, stored)
    return mixed.select(
        F.col("document.doc_id").cast("bigint").alias("doc_id"),
        F.col("k_source").alias("source"),
        F.col("k_lang").alias("lang"),
        F.col("k_topic").alias("topic"),
        F.col("k_tokens").alias("tokens"),
        "probability",
        "kept",
    )


def op10_unigram(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return unigram.encode_texts(docs, public_tokenizers.path(VOCABULARY))


def op11_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path(WORD_VOCABULARY), stored)


def op12_prefix_trie(spark, sf_dir):
    turns = prefixtrie.ordered_turns(table(spark, sf_dir, "conversations"), stored)
    return prefixtrie.prefix_trie(prefixtrie.with_shared_openings(turns, stored), stored)


def op13_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    a_path = public_tokenizers.path(BYTE_VOCABULARY)
    return alignment.align_tokenizers(docs, a_path, public_tokenizers.path(VOCABULARY), stored)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_site_quality, op3_permutation_search, op4_toxicity, op5_token_counts,
        op6_pii, op7_quality_rules, op8_near_duplicates, op9_mixing, op10_unigram, op11_packing,
        op12_prefix_trie, op13_alignment,
    )
}


NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ')
        ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS s
    FROM words, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS t(i)
    WHERE len(w) > 0
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT p.a, p.b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
    ) p JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
    WHERE 100 * p.both >= 85 * (m.n + n.n - p.both)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM sizes
    UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b
), least AS (SELECT a, min(b) AS component FROM reached GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id,
    d.doc_id = coalesce(l.component, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN least l ON l.a = d.doc_id
"""


def mixing_sql(rounds=mixing.ROUNDS):
    """Goals from sorted sums, then raking with two common tables per step."""
    goals, steps, last = [], [], "first"
    for key in mixing.KEYS:
        # Values in the order in which they would be taken whole; the scale that takes no further one holds.
        goals.append(
            f"asked_{key} AS MATERIALIZED (SELECT {key}, sum(base)::DOUBLE AS whole, "
            f"pow(sum(base)::DOUBLE, {mixing.TEMPERATURE}) AS target FROM cells GROUP BY 1 HAVING sum(base) > 0), "
            f"scaled_{key} AS (SELECT target / whole AS ratio, ({mixing.BUDGET} * (SELECT sum(base) FROM cells) - "
            "coalesce(sum(whole) OVER (ORDER BY target / whole DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) "
            "/ sum(target) OVER (ORDER BY target / whole DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS scale "
            f"FROM asked_{key}), "
            f"goals_{key} AS MATERIALIZED (SELECT {key}, least(whole, target * (SELECT max(scale) FROM scaled_{key} "
            f"WHERE scale * ratio < 1)) AS goal_{key} FROM asked_{key})"
        )
    first = "first AS MATERIALIZED (SELECT *, {}::DOUBLE AS chance FROM cells {})".format(
        mixing.BUDGET, " ".join(f"LEFT JOIN goals_{key} USING ({key})" for key in mixing.KEYS)
    )
    for number in range(rounds):
        for key in mixing.KEYS:
            name = f"r{number}_{key}"
            steps.append(
                f"f{name} AS MATERIALIZED (SELECT {key}, CASE WHEN goal IS NULL THEN {1 / mixing.MOST_CHANGE} ELSE "
                "least(greatest(CASE WHEN goal > w AND p > 0 THEN (goal - w) / p WHEN w + p > goal THEN goal / (w + p) "
                f"ELSE 1 END, {1 / mixing.MOST_CHANGE}), {mixing.MOST_CHANGE}) END AS factor FROM (SELECT {key}, "
                f"max(goal_{key}) AS goal, sum(CASE WHEN chance >= {mixing.WHOLE!r}::DOUBLE THEN base::DOUBLE ELSE 0 END) AS w, "
                f"sum(CASE WHEN chance >= {mixing.WHOLE!r}::DOUBLE THEN 0 ELSE base * chance END) AS p FROM {last} GROUP BY 1)), "
                f"{name} AS MATERIALIZED (SELECT c.* REPLACE (c.chance * f.factor AS chance) FROM {last} c JOIN f{name} f USING ({key}))"
            )
            last = name
    return rf"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS tokens,
        CASE WHEN text IS NULL THEN 'none' WHEN contains(text, ' | ') THEN 'table'
            WHEN contains(text, '***') OR contains(text, '###') THEN 'marked'
            WHEN contains(text, '!! ') THEN 'shouted'
            WHEN length(text) >= 4000 THEN 'long' ELSE 'short' END AS topic
    FROM documents
), cells AS MATERIALIZED (
    SELECT source, lang, topic, sum(tokens)::BIGINT AS base FROM docs GROUP BY ALL
), {", ".join(goals)}, {first}, {", ".join(steps)}, chances AS (
    SELECT source, lang, topic,
        CASE WHEN base = 0 THEN 1.0 ELSE round(least(1.0, chance), 6) END AS probability
    FROM {last}
)
SELECT doc_id, source, lang, topic, tokens, probability::DOUBLE AS probability,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '/{mixing.SEED}'), 1, 8))::BIGINT
        / 4294967296.0 < probability AS kept
FROM docs JOIN chances USING (source, lang, topic)
"""


ORACLES = {"op8_near_duplicates": NEAR_DUPLICATES_SQL, "op9_mixing": mixing_sql()}
