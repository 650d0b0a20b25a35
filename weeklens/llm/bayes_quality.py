"""Quality classifier with hierarchical empirical Bayes over sites.

Document level. A sparse logistic regression on the presence of words and symbol
runs (a bounded vocabulary) and on how much a text repeats itself gives each
document log odds of being good: of quality 1 and not toxic. It is fitted on at most ``train_rows`` labelled documents, drawn
by a hash of their id; everything else covers all documents.

Site level. Hosts have paths. A path's rate of good documents is shrunk towards
its host's rate, a host's towards the global one, each by a prior strength that
is estimated from the spread of the observed rates (method of moments): sites
with few documents fall back on the level above, large ones speak for
themselves. Rates are sums of document probabilities by grouped aggregation,
with the document itself left out. The posterior log odds are the document's
plus those of its path against the global rate.

Texts are read once for scoring; only numbers and keys are staged and joined. A
host with a third of all documents is folded on the map side.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import column, settled, stage, with_row_id, without_rows

TRAIN_ROWS = 20_000
VOCABULARY = 1 << 15
MIN_DOCS = 3
EDGE = 1e-6
# Words, and runs of symbols: "word", "|", "%%%".
TOKEN = r"\p{L}+|[^\p{L}\p{N}\s]+"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _with_variety(df: DataFrame) -> DataFrame:
    """Add a token for the share of distinct tokens among all, by length class (a tenth and a power of two)."""
    n = F.size("tokens")
    share = F.floor(F.size(F.array_distinct("tokens")) * 10 / F.greatest(n, F.lit(1)))
    mark = F.concat_ws("_", F.lit("\u0001variety"), share, F.floor(F.log2(n + 1)))
    return df.withColumn("tokens", F.concat("tokens", F.array(mark)))


def _logit(p: Column) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - EDGE)), F.lit(EDGE))
    return F.log(q / (1 - q))


def training_rows(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(tokens, label) of at most ``train_rows`` labelled documents. Labels with a null are left out; of
    repeated ones a document's worst counts."""
    known = (labels.select(column(labels, "doc_id", "long").alias("doc_id"), column(labels, "quality", "int").alias("q"),
                           column(labels, "toxic", "int").alias("t")).dropna()
             .groupBy("doc_id").agg(((F.min("q") >= 1) & (F.max("t") < 1)).cast("double").alias("label")))
    # bounded by the parameter, so every task can hold it
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"),
                        F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    return _with_variety(texts.join(F.broadcast(some), "doc_id").select(_tokens(F.col("text")).alias("tokens"), "label"))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS):
    """(vectorizer, model), or None if the labelled rows are not of both classes."""
    rows = stage(training_rows(docs, labels, train_rows), "labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    n = rows.count()
    least = float(min(MIN_DOCS, max(1, n // 10)))
    words = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=VOCABULARY, minDF=least, binary=True).fit(rows)
    # a word must speak for about two documents to get a weight
    model = LogisticRegression(featuresCol="features", labelCol="label", regParam=1.5 / n, elasticNetParam=1.0,
                               maxIter=100, standardization=False).fit(words.transform(rows))
    return words, model


def document_odds(docs: DataFrame, fitted, host: str, path: str) -> DataFrame:
    """_rid, doc_id, host, path (keys; "-" for null) and odds (log odds of being good) per row."""
    def key(name):
        c = column(docs, name, "string")
        return F.when(c.isNull(), "-").otherwise(F.concat(F.lit("+"), c))

    rows = with_row_id(docs).select("_rid", column(docs, "doc_id", "long").alias("doc_id"), key(host).alias("host"),
                                    key(path).alias("path"), _tokens(F.coalesce(column(docs, "text", "string"), F.lit(""))).alias("tokens"))
    keep = ["_rid", "doc_id", "host", "path"]
    if fitted is None:
        return rows.select(*keep, F.lit(0.0).alias("odds"))
    words, model = fitted
    scored = model.transform(words.transform(_with_variety(rows)))
    return scored.select(*keep, vector_to_array("rawPrediction")[1].alias("odds"))


def _strength(sites: DataFrame, mean: float) -> float:
    """Prior strength (pseudo-documents) of a level from the spread of its sites' rates around their parent."""
    r = sites.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
                  F.sum(F.col("n") * (F.col("s") / F.col("n") - F.col("parent")) ** 2).alias("spread")).first()
    v = mean * (1 - mean)
    if not r.n or v <= 0 or r.n <= r.k:
        return 1e6
    noise = v * r.k / r.n  # what the rates would spread by chance
    rho = (r.spread / r.n - noise) / max(EDGE, v - noise)
    return min(1e6, max(1.0, (1 - rho) / rho)) if rho > 0 else 1e6


def posteriors(odds: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add the host's, the path's and the document's posterior to staged ``document_odds``."""
    p = 1 / (1 + F.exp(-F.col("odds")))
    paths = stage(odds.withColumn("p", p).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")),
                  "path-rates")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    whole = hosts.agg(F.sum("hn").alias("n"), F.sum("hs").alias("s")).first()
    mean = (whole.s / whole.n) if whole.n else 0.5
    host_strength = _strength(hosts.select(F.col("hn").alias("n"), F.col("hs").alias("s"), F.lit(mean).alias("parent")), mean)
    sites = paths.join(hosts, "host")
    rate = (F.col("hs") + host_strength * mean) / (F.col("hn") + host_strength)
    path_strength = _strength(sites.withColumn("parent", rate), mean)
    # written, so that the join knows the size of the sites or else can split the documents of a large one
    rows = odds.withColumn("p", p).join(stage(sites, "sites"), ["host", "path"])
    host = (F.col("hs") - F.col("p") + host_strength * mean) / (F.col("hn") - 1 + host_strength)
    path = (F.col("s") - F.col("p") + path_strength * F.col("host_posterior")) / (F.col("n") - 1 + path_strength)
    rows = rows.withColumn("host_posterior", host).withColumn("path_posterior", path)
    total = F.col("odds") + _logit(F.col("path_posterior")) - _logit(F.lit(mean))
    return (rows.withColumn("p_document", F.col("p")).withColumn("p_good", 1 / (1 + F.exp(-total)))
            .withColumn("kept", F.col("p_good") >= threshold)
            .select("_rid", "doc_id", "p_document", "host_posterior", "path_posterior", "p_good", "kept"))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang",
             train_rows: int = TRAIN_ROWS, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: _rid, doc_id, p_document, host_posterior, path_posterior, p_good, kept.

    Null hosts and paths are sites of their own; missing columns are one such site. Null texts are empty
    and judged by the model's base rate and their site. Null or repeated doc_ids are ordinary rows. Without
    labelled documents of both classes nothing is known and every document is kept at even odds. An empty
    table gives an empty result.
    """
    odds = stage(document_odds(docs, fit(docs, labels, train_rows), host, path), "document-odds")
    return posteriors(odds, threshold)


def drop_rejected(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rejected rows; columns as given."""
    docs = settled(docs)
    gone = classify(docs, labels, **settings).filter(~F.col("kept")).select("_rid")
    return without_rows(docs, gone)
