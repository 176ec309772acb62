"""URL filters: rules first, then gradient-boosted trees on lexical features.

A URL's features are its length, depth, digit ratio, entropy, number of parameters, the
shape of its host, and statistics of its suffix among all labelled URLs. The trees are
trained from labelled URLs: a sample of each label that is bounded by a parameter, so
training costs the same on any corpus. All URLs are judged.
"""

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadglass.llm.common import written

# ---- Fixed values: the published rules, and seed words of the weak labels ---------
RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]
SEED_WORDS = ["casino", "pills", "bets", "viagra", "porn", "xxx", "lottery", "escort"]
# -----------------------------------------------------------------------------------

# Labelled URLs of each label that training sees, and the trees.
MAX_LABELLED = 10_000
TREES = 12
DEPTH = 3
SEED = 7
# A suffix is trusted as if it had so many URLs of the mean label besides its own.
PRIOR_URLS = 20
BLOCKED_FROM = 0.5

FEATURES = [
    "length", "depth", "digit_ratio", "entropy", "parameters", "labels", "hyphens",
    "longest_label", "secure", "suffix_rate", "suffix_share",
]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """From there up to ``?``, ``#`` or the end."""
    return F.coalesce(
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit("")
    )


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does. A rule fits its
    host and all subdomains, if the path starts with the rule's."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def seed_label(host: Column) -> Column:
    """Weak label: 1 if a label of the host holds a seed word, else 0."""
    return F.rlike(host, F.lit("|".join(SEED_WORDS))).cast("int")


def _suffix(host: Column) -> Column:
    """The registered part of a host: its last two labels."""
    return F.substring_index(host, ".", -2)


def lexical(urls: DataFrame) -> DataFrame:
    """The rows of ``urls``, which have ``url``, ``host`` and ``path``, with the features
    that need nothing but the URL."""
    url = F.coalesce("url", F.lit(""))
    size = F.greatest(F.length(url), F.lit(1))
    chars = F.filter(F.array_distinct(F.split(url, "")), lambda c: c != "")
    # Of each character that occurs, its share; n * log2(n) summed over them.
    entropy = F.aggregate(
        chars,
        F.lit(0.0),
        lambda total, c: total
        - (F.length(url) - F.length(F.replace(url, c))) / size
        * F.log2((F.length(url) - F.length(F.replace(url, c))) / size),
    )
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    return urls.withColumns(
        {
            "length": F.length(url).cast("double"),
            "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
            "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / size,
            "entropy": entropy,
            "parameters": F.when(query == "", 0.0).otherwise(
                F.regexp_count(query, F.lit("&")) + 1.0
            ),
            "labels": F.size(labels).cast("double"),
            "hyphens": F.regexp_count("host", F.lit("-")).cast("double"),
            "longest_label": F.array_max(F.transform(labels, F.length)).cast("double"),
            "secure": F.startswith(url, F.lit("https:")).cast("double"),
            "suffix": _suffix(F.col("host")),
        }
    )


def distinct_labels(labelled: DataFrame) -> DataFrame:
    """Each labelled URL once (url, label)."""
    rows = labelled.where("url IS NOT NULL AND label IN (0, 1)").groupBy("url").agg(
        F.max("label").alias("label")
    )
    return written(rows, "url-labels")


def labelled_sample(rows: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """About ``bound`` of the distinct rows (url, label) of each label, by the hash of the
    URL: a whole label if it has no more."""
    counts = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    share = F.lit(0.0)
    for label in (0, 1):
        rate = min(1.0, bound / counts.get(label, 1))
        share = F.when(F.col("label") == label, rate).otherwise(share)
    draw = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(draw < share)


def suffix_statistics(rows: DataFrame) -> tuple[DataFrame, float]:
    """(suffix, suffix_rate, suffix_share) over all ``rows`` (url, label), and the mean label."""
    counts = written(
        rows.groupBy(_suffix(host_of(F.col("url"))).alias("suffix")).agg(
            F.count("*").alias("n"), F.sum("label").alias("bad")
        ),
        "url-suffixes",
    )
    n, bad = counts.agg(F.sum("n"), F.sum("bad")).first()
    mean = bad / n if n else 0.0
    rate = (F.col("bad") + PRIOR_URLS * mean) / (F.col("n") + PRIOR_URLS)
    share = F.col("n") / float(max(n or 0, 1))
    return counts.select("suffix", rate.alias("suffix_rate"), share.alias("suffix_share")), mean


@dataclass
class UrlModel:
    """What training leaves: trees, or the one label that there was."""

    suffixes: DataFrame
    mean: float
    trees: object | None

    def features(self, urls: DataFrame) -> DataFrame:
        # There may be as many suffixes as URLs; adaptive execution splits hot ones.
        joined = lexical(urls).join(self.suffixes, "suffix", "left")
        return joined.withColumns(
            {
                "suffix_rate": F.coalesce("suffix_rate", F.lit(self.mean)),
                "suffix_share": F.coalesce("suffix_share", F.lit(0.0)),
            }
        )

    def blocked(self, urls: DataFrame) -> DataFrame:
        """The rows with ``score``, how likely they are to be blocked."""
        if self.trees is None:
            return urls.withColumn("score", F.lit(self.mean))
        rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
            self.features(urls)
        )
        scored = self.trees.transform(rows)
        return scored.withColumn("score", vector_to_array("probability")[1]).select(
            *urls.columns, "score"
        )


def train(labelled: DataFrame, bound: int = MAX_LABELLED) -> UrlModel:
    """Trees from rows (url, label); label 1 is to be blocked.

    A URL with several labels counts as blocked. Rows without URL, or with another label
    than 0 or 1, are left out.
    With one label only every URL gets it; without labelled rows none is blocked.
    """
    labels = distinct_labels(labelled)
    suffixes, mean = suffix_statistics(labels)
    model = UrlModel(suffixes, mean, None)
    if not 0 < mean < 1:
        return model
    sample = written(
        labelled_sample(labels, bound).withColumns(
            {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
        ),
        "url-sample",
    )
    # Both labels weigh the same in all.
    drawn = sample.agg(F.avg("label")).first()[0]
    weight = F.when(F.col("label") == 1, 0.5 / drawn).otherwise(0.5 / (1 - drawn))
    rows = model.features(sample)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        rows.withColumn("weight", weight)
    )
    trees = GBTClassifier(
        labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, seed=SEED
    )
    model.trees = trees.fit(rows.select("features", "label", "weight").coalesce(4))
    return model


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, ``rule`` (null if none
    fits), ``score`` and ``verdict``: the rule's, else block or allow by the trees.

    ``labelled`` (url, label) trains the trees; unless given, hosts with a seed word are
    the bad examples and all other hosts the good ones. Null URLs and such without
    ``://`` have empty host and path and are judged like any other, and so are very long ones.
    Repeated rows have equal results. Only page_id and url are read, so other columns may have
    any name, those of features too. No rows give no rows.
    """
    urls = pages.select("page_id", "url").withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    if labelled is None:
        labelled = urls.select("url", seed_label(F.col("host")).alias("label"))
    rule, decided = matched_rule(F.col("host"), F.col("path"), rules)
    by_trees = F.when(F.col("score") >= BLOCKED_FROM, "block").otherwise("allow")
    return train(labelled).blocked(urls).select(
        "page_id", "host", "path", rule.alias("rule"), "score",
        F.coalesce(decided, by_trees).alias("verdict"),
    )
