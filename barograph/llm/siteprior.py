"""Quality of documents by hierarchical empirical Bayes.

Three levels are combined: the evidence of the document itself, the posterior
of its path within a host, and the posterior of the host. A host with few
documents is shrunk toward the global rate and a path toward its host; how much
is estimated from the spread of the rates, not set by hand.

The evidence of a document is a sum of log-likelihood ratios of binned text
measures, smoothed toward the global rate. A document counts for its site by
its label where it has one, else by the probability its own evidence gives. Its
own contribution is taken out of the site's sums before they judge it.

Everything is DataFrame work; the sums per host and path are grouped with
partial aggregation, so a host with a third of all documents is no hot spot.

Defined results: a null text counts as empty. Null hosts and paths are sites of
their own, named by an empty text. Null labels are no labels. Without labels
the prior is one half. Of several labels of one document the largest counts.
Rows repeated under one id keep their rows, each counted. Clashing column names
do not matter: only the named columns are read.
"""

from functools import reduce

from pyspark.sql import functions as F

SMOOTHING = 5.0
KEPT_FROM = 0.5
FEATURES = ("symbols", "capitals", "distinct", "width", "marks", "size")


def measures(text):
    """Binned measures of a text, as small numbers."""
    text = F.coalesce(text, F.lit(""))
    size = F.greatest(F.length(text), F.lit(1))
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([^ \t-\r]+)"))
    n_words = F.greatest(F.size(words), F.lit(1))
    share = lambda n, of, steps: F.least(F.floor(n * steps / of), F.lit(steps - 1))
    without = lambda signs: size - F.length(F.translate(text, signs, ""))
    return {
        "symbols": share(without("#*$%&|<>"), size, 40),
        "capitals": share(F.length(F.regexp_replace(text, r"[^\p{Lu}]", "")), size, 20),
        "distinct": share(F.size(F.array_distinct(words)), n_words, 10),
        "width": F.least(F.floor(size / n_words), F.lit(15)),
        "marks": share(without("!?"), size, 40),
        "size": F.least(F.floor(F.log2(n_words)), F.lit(14)),
    }


def bin_ratios(labelled, rate):
    """``feature, bin, ratio``: smoothed log-likelihood ratio of each bin of each measure."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES])
    counts = (
        labelled.select("quality", F.explode(pairs).alias("p"))
        .groupBy("p.feature", "p.bin")
        .agg(F.count("*").alias("n"), F.sum("quality").alias("good"))
    )
    mean = (F.col("good") + F.lit(SMOOTHING * rate)) / (F.col("n") + SMOOTHING)
    logit = lambda p: F.log(p / (1 - p))
    return counts.select("feature", "bin", (logit(mean) - logit(F.lit(rate))).alias("ratio"))


def concentration(rates, rate):
    """Pseudo-count of a beta prior by moments, from ``n`` and ``m`` (mean) of groups."""
    found = rates.where("n > 1").agg(
        F.count("*").alias("groups"),
        F.avg(F.pow(F.col("m") - F.lit(rate), 2)).alias("spread"),
        F.avg(1 / F.col("n")).alias("noise"),
    ).first()
    chance = rate * (1 - rate)
    if not found["groups"] or chance <= 0:
        return 10.0
    between = max((found["spread"] or 0.0) - chance * found["noise"], chance * 1e-3)
    return min(1000.0, max(1.0, chance / between - 1))


def judge_quality(docs, labels, host, path, stored=lambda df, label: df, kept_from=KEPT_FROM):
    """``doc_id, host, path, evidence, site_prior, probability, kept`` of every row."""
    marks = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("quality").cast("double").alias("quality"))
    )
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(host.cast("string"), F.lit("")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("")).alias("path"),
        *[value.cast("int").alias(name) for name, value in measures(docs["text"]).items()],
    )
    rows = stored(plain.join(marks, "doc_id", "left"), "site-documents")
    labelled = rows.where("quality IS NOT NULL")
    seen = labelled.agg(F.count("*").alias("n"), F.sum("quality").alias("good")).first()
    rate = ((seen["good"] or 0.0) + 1) / (seen["n"] + 2)
    # Some dozens of bins: the measures bound them.
    ratios = bin_ratios(labelled, rate).collect()
    table = {f: {r["bin"]: r["ratio"] for r in ratios if r["feature"] == f} for f in FEATURES}
    looked = [
        F.coalesce(
            F.element_at(F.create_map(*[F.lit(x) for pair in bins.items() for x in pair]), F.col(f)),
            F.lit(0.0),
        )
        for f, bins in table.items()
        if bins
    ]
    evidence = reduce(lambda x, y: x + y, looked, F.lit(0.0))
    prior = F.lit(rate / (1 - rate))
    odds = lambda e, o: o * F.exp(e) / (1 + o * F.exp(e))
    told = rows.select("doc_id", "host", "path", "quality", evidence.alias("evidence")).withColumn(
        "counts_as", F.coalesce("quality", odds(F.col("evidence"), prior))
    )
    told = stored(told, "site-evidence")
    paths = told.groupBy("host", "path").agg(
        F.count("*").alias("n_path"), F.sum("counts_as").alias("good_path")
    )
    hosts = paths.groupBy("host").agg(
        F.sum("n_path").alias("n_host"), F.sum("good_path").alias("good_host")
    )
    sites = stored(paths.join(hosts, "host"), "sites")
    overall = sites.agg(F.sum("n_path").alias("n"), F.sum("good_path").alias("good")).first()
    base = ((overall["good"] or 0.0) + 1) / ((overall["n"] or 0) + 2)
    by_host = sites.select("host", F.col("n_host").alias("n"), (F.col("good_host") / F.col("n_host")).alias("m"))
    strength_host = concentration(by_host.distinct(), base)
    by_path = sites.select(F.col("n_path").alias("n"), (F.col("good_path") / F.col("n_path")).alias("m"))
    strength_path = concentration(by_path, base)
    own = lambda good, n: (F.col(good) - F.col("counts_as"), F.col(n) - 1)
    (good_host, n_host), (good_path, n_path) = own("good_host", "n_host"), own("good_path", "n_path")
    host_mean = (good_host + F.lit(strength_host * base)) / (n_host + strength_host)
    site = (good_path + F.lit(strength_path) * host_mean) / (n_path + F.lit(strength_path))
    site = F.least(F.greatest(site, F.lit(1e-6)), F.lit(1 - 1e-6))
    judged = told.join(sites, ["host", "path"]).withColumn("site_prior", site)
    probability = odds(F.col("evidence"), F.col("site_prior") / (1 - F.col("site_prior")))
    return judged.withColumn("probability", probability).select(
        "doc_id", "host", "path", "evidence", "site_prior", "probability",
        (F.col("probability") >= kept_from).alias("kept"),
    )
