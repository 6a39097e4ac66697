"""URL filter: host and path rules, and a logistic regression on hashed character n-grams for the rest.

A URL's host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end (A-Z lower-cased); its path follows up to ``?``, ``#``
or the end. A rule (verdict, host, path) fits its host and all subdomains when the URL's path starts with the rule's; the longest fitting
rule decides. All other URLs are judged by a model: character n-grams of the host (between marks for its begin and end) and of the
path are hashed into ``2**FEATURE_BITS`` counts, and an L2-regularised logistic regression, fitted on a small labelled URL table
(``LABELLED`` or the caller's), blocks from ``threshold`` on.

DataFrame functions and Spark ML only. Defined results: a null URL, or one without ``://``, has empty host and path and is judged by the model (no n-grams of a
host: its intercept); repeated rows are judged each; an empty table gives an empty result; long URLs are read whole. Extra columns are left behind.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carepulse.llm.common import literal_table
from carepulse.llm.spans import let

FEATURE_BITS = 15
SIZES = (3, 4, 5)
L2, MAX_STEPS = 0.002, 40

#: The small labelled table (fixed values): hosts to block and to allow, each under the same prefixes and paths, so that only the
#: host's own words, and the paths that belong to one side, tell them apart.
BLOCKED_HOSTS = (
    "casino-bonus.example.org", "best-casino.example.net", "online-casino-win.example.com", "win-casino.example.org", "poker-bets.example.org", "free-bets-now.example.com",
    "sports-bets.example.com", "lucky-slots.example.net", "cheap-pills-shop.example.com", "pills-online.example.net", "discount-pharmacy.example.org", "cheap-meds.example.com",
    "diet-pills.example.net", "spam-farmer.example.com", "link-farm.example.com", "seo-spam.example.net", "spam-links.example.org", "click-farm.example.com", "adult-xx.example.com",
    "xxx-adult.example.net", "adult-dating.example.org", "hot-adult-videos.example.com", "ads-tracker.example.com", "track-ads.example.org", "ad-tracker.example.net", "popunder-ads.example.com",
    "free-money-win.example.org", "win-prizes.example.net", "crack-keygen.example.com", "payday-loans-fast.example.org", "replica-watches-cheap.example.net", "free-pills.example.org",
)
ALLOWED_HOSTS = (
    "library.example.org", "news.example.net", "gardening.example.com", "university.example.org", "weather.example.net", "museum.example.org", "cooking.example.com", "history.example.net",
    "software-docs.example.org", "travel.example.com", "science.example.org", "music.example.net", "theatre.example.org", "parliament.example.org", "school.example.net", "photography.example.com",
    "thonan.example.org", "therein.example.net", "onthe.example.org", "estion.example.net", "ratheing.example.org", "andthe.example.net", "wiki.example.org", "gazette.example.net",
    "health-service.example.org", "open-data.example.net", "city-council.example.org", "archive.example.net", "dictionary.example.org", "farm-museum.example.org", "ththed.example.com", "sports-club.example.org",
)
PREFIXES = ("", "www.", "blog.", "m.")
PATHS = ("/en/12", "/de/671/", "/fr/825.html", "/es/9", "/en/148.html", "/", "/index.html", "/en/453/")
BLOCKED_PATHS = ("/buy-cheap-pills", "/casino/win", "/adult/video", "/free-bets/join")
ALLOWED_PATHS = ("/catalogue/books", "/research/papers", "/recipes/soup", "/news/story")


def _labelled() -> list[tuple[str, int]]:
    rows = []
    for block, hosts, own in ((1, BLOCKED_HOSTS, BLOCKED_PATHS), (0, ALLOWED_HOSTS, ALLOWED_PATHS)):
        for k, h in enumerate(hosts):
            rows += [(f"http://{PREFIXES[(k + j) % 4]}{h}{PATHS[(k + 3 * j) % 8]}", block) for j in range(4)]
            rows.append((f"https://{h}{own[k % 4]}", block))
    return rows


LABELLED = _labelled()


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _grams(text: Column, tag: str) -> Column:
    def of(marked: Column, n: int) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(marked) - n), lambda i: F.concat(F.lit(tag), *[F.get(marked, i + k) for k in range(n)]))
        return F.when(F.size(marked) >= n, every).otherwise(F.array().cast("array<string>"))

    return let(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda marked: F.concat(*[of(marked, n) for n in SIZES]))


def grams(host_: Column, path_: Column) -> Column:
    """Tagged character n-grams of host and path (none of an empty part)."""
    none = F.array().cast("array<string>")
    return F.concat(F.when(host_ != "", _grams(host_, "h")).otherwise(none), F.when(path_ != "", _grams(path_, "p")).otherwise(none))


def fit(labelled: DataFrame) -> PipelineModel:
    """The model of a labelled table (url, block 0/1)."""
    rows = labelled.select(grams(host(F.col("url")), path(F.col("url"))).alias("grams"), F.col("block").cast("double").alias("label")).coalesce(1)  # a small table
    stages = [HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << FEATURE_BITS, binary=True),
              LogisticRegression(regParam=L2, maxIter=MAX_STEPS, standardization=False)]
    return Pipeline(stages=stages).fit(rows)


def labelled_urls(spark: SparkSession) -> DataFrame:
    return literal_table(spark, LABELLED, ["url", "block"])


def fitting_rule(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct<rule, verdict> of the longest fitting rule, else null. ``rules`` is a short policy list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith("." + h)) & path_.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], model: PipelineModel, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule (null: none), verdict (allow or block), block_probability."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("grams", grams(F.col("host"), F.col("path")))
    scored = model.transform(rows).withColumn("block_probability", F.element_at(vector_to_array("probability"), 2))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("block_probability") >= threshold, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "block_probability")
