"""URL filter: rules by host and path, and logistic regression on hashed character n-grams where no rule fits.

A rule names a host, with all its subdomains, and the beginning of a path. Rules meet URLs by joins: each host that
occurs is split into its suffixes once, these are joined to the rules, and the rules of a host go to its URLs. The model
learns from a small table of labelled URLs: fixed examples, and URLs that a rule decides. Its features are MLlib's, so
scoring stays in the JVM.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmill.sources.workspace import stage

SIZES = (3, 4)  # characters of an n-gram
FEATURES = 2**16
LABELLED_URLS = 20_000  # URLs decided by rules that the model learns from, at most, chosen by a hash
THRESHOLD = 0.5

# Rules as (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

# Labelled examples, independent of the rules.
BLOCKED_EXAMPLES = [
    "http://casino-win.net/play", "http://www.online-casino.biz/slots", "http://free-bets.net/odds", "http://bets24.info/live",
    "http://poker-bonus.net/join", "http://win-cash.biz/free", "http://cheap-pills.net/buy", "http://free-pills.info/order",
    "http://xxx-videos.net/watch", "http://hot-dating.biz/chat", "http://sex-cams.net/live", "http://loan-cash.info/now",
    "http://casino.bonus-win.com/", "http://m.lottery-win.net/claim", "http://free-download-crack.net/keygen", "http://replica-watches.biz/sale",
]
ALLOWED_EXAMPLES = [
    "http://www.university.edu/research", "http://library.city.gov/catalogue", "http://docs.python-guide.net/tutorial", "http://news.daily.net/world",
    "http://blog.garden.net/tomatoes", "http://www.museum.net/history", "http://wiki.science.net/physics", "http://recipes.kitchen.net/soup",
    "http://www.travel-notes.net/italy", "http://school.town.net/library", "http://weather.region.net/today", "http://www.orchestra.net/concerts",
    "http://forum.cycling.net/thread", "http://www.hospital.net/visitors", "http://maps.country.net/roads", "http://archive.letters.net/1912",
]


# --- Parts of a URL -----------------------------------------------------------------------------------

_AFTER = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    """What comes after the first ``://`` up to ``/``, ``?`` or ``#``, with A-Z in lower case; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _AFTER, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str) -> Column:
    """What comes after the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, _AFTER, 2), F.lit(""))


def with_parts(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"))
    return rows.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))


# --- Rules --------------------------------------------------------------------------------------------


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def rules_by_host(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """site, rules: for each host of ``urls`` that a rule's host is a suffix of, those rules, the longest first.

    A rule without host or path, or without a verdict, is no rule. Of equally long ones that with the longer host comes
    first; of equal ones, block.
    """
    known = rules.filter("host IS NOT NULL AND host != '' AND path IS NOT NULL AND verdict IS NOT NULL").distinct()
    known = known.select(
        F.translate("host", _UPPER, _LOWER).alias("suffix"),
        F.struct(
            (-F.length(F.concat("host", "path"))).alias("order"), (-F.length("host")).alias("host_order"),
            F.when(F.col("verdict") == "block", 0).otherwise(1).alias("kind"), "path",
            F.concat(F.translate("host", _UPPER, _LOWER), "path").alias("rule"), "verdict",
        ).alias("rule"),
    )
    hosts = urls.filter("host != ''").select(F.col("host").alias("site")).distinct()
    labels = F.split("site", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    pairs = hosts.withColumn("suffix", F.explode(suffixes)).join(known, "suffix")
    return pairs.groupBy("site").agg(F.sort_array(F.collect_set("rule")).alias("rules"))


def decided(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (host, path and other columns) with rule and decision of the longest rule that fits, else NULL."""
    by_host = stage(rules_by_host(urls, rules), "rules-by-host")
    joined = urls.join(by_host, F.col("host") == F.col("site"), "left")
    fitting = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    joined = joined.withColumn("best", fitting).drop("site", "rules")
    return joined.withColumns({"rule": F.col("best.rule"), "decision": F.col("best.verdict")}).drop("best")


# --- Model --------------------------------------------------------------------------------------------


def with_grams(urls: DataFrame) -> DataFrame:
    """The character n-grams of host and path, told apart by a mark. ``|`` stands at a host's ends."""

    def grams(mark: str, text: Column) -> list[Column]:
        letters = F.split(text, "")
        gram, out = F.transform(letters, lambda x: F.concat(F.lit(mark), x)), []
        for size in range(2, max(SIZES) + 1):
            following = F.slice(letters, size, F.size(letters))
            gram = F.zip_with(gram, following, lambda x, y: F.concat(x, y))  # NULL where the text has ended
            out += [F.array_compact(gram)] if size in SIZES else []
        return out

    host = F.when(F.col("host") == "", F.lit("")).otherwise(F.concat(F.lit("|"), "host", F.lit("|")))
    return urls.withColumn("grams", F.concat(*grams("h", host), *grams("p", F.col("path"))))


def examples(spark: SparkSession) -> DataFrame:
    """host, path, blocked of the fixed examples."""
    rows = [(url, 1.0) for url in BLOCKED_EXAMPLES] + [(url, 0.0) for url in ALLOWED_EXAMPLES]
    table = spark.createDataFrame(rows, "url string, blocked double")
    return table.select(host_of("url").alias("host"), path_of("url").alias("path"), "blocked")


def labelled_by_rules(urls: DataFrame, at_most: int = LABELLED_URLS) -> DataFrame:
    """host, path, blocked of at most so many different URLs that a rule has decided, those of the least hash."""
    rows = urls.filter("decision IS NOT NULL").select("host", "path", (F.col("decision") == "block").cast("double").alias("blocked"))
    return rows.distinct().orderBy(F.xxhash64("host", "path"), "host", "path").limit(at_most)


def fit(labelled: DataFrame) -> PipelineModel | str:
    """A model of host, path, blocked; both labels have the same weight in all. With one label only, its verdict.

    Without any label the verdict is allow. The table is small, and learnt in one partition, so that the model does
    not depend on how it was partitioned.
    """
    rows = stage(labelled.orderBy("host", "path", "blocked").coalesce(1), "labelled-urls")
    counts = {r["blocked"]: r["count"] for r in rows.groupBy("blocked").count().collect()}
    if len(counts) < 2:
        return "block" if counts.get(1.0) else "allow"
    weight = F.when(F.col("blocked") == 1, sum(counts.values()) / 2 / counts[1.0]).otherwise(sum(counts.values()) / 2 / counts[0.0])
    pipeline = Pipeline(
        stages=[
            HashingTF(inputCol="grams", outputCol="counts", numFeatures=FEATURES, binary=True),
            Normalizer(inputCol="counts", outputCol="features"),
            LogisticRegression(labelCol="blocked", weightCol="weight", regParam=1e-4, maxIter=100, standardization=False),
        ]
    )
    return pipeline.fit(with_grams(rows).withColumn("weight", weight))


def judged(urls: DataFrame, model: PipelineModel | str) -> DataFrame:
    """``urls`` with ``blocked``, the model's chance that a URL is to be blocked."""
    if isinstance(model, str):
        return urls.withColumn("blocked", F.lit(1.0 if model == "block" else 0.0))
    scored = model.transform(with_grams(urls)).withColumn("blocked", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(*urls.columns, "blocked")


# --- Verdicts -----------------------------------------------------------------------------------------


def filter_urls(pages: DataFrame, rules: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, blocked (the model's chance) of every page.

    The verdict is that of the longest rule whose host is the URL's or a domain above it and whose path the URL's begins
    with; without such a rule it is the model's, which learns from ``labelled`` (url, blocked as 0 or 1) and, by default,
    from the fixed examples and URLs that rules decide.

    NULL urls and those without ``://`` have an empty host and path, to which no rule fits; NULL and repeated page_ids
    are rows of their own; very long URLs are judged whole; other columns are ignored; an empty table gives no rows.
    """
    spark = pages.sparkSession
    urls = stage(decided(with_parts(pages), rules), "urls")
    if labelled is None:
        table = examples(spark).unionByName(labelled_by_rules(urls))
    else:
        table = labelled.select(host_of("url").alias("host"), path_of("url").alias("path"), F.col("blocked").cast("double"))
        table = table.filter("blocked IN (0, 1)")
    scored = judged(urls, fit(table))
    own = F.when(F.col("blocked") >= THRESHOLD, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decision", own).alias("verdict"), "blocked")


def filter_pages(pages: DataFrame) -> DataFrame:
    """The verdicts under the fixed rules."""
    return filter_urls(pages, rule_table(pages.sparkSession))
