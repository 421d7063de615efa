"""URL filter: listed rules first, then a logistic regression on hashed character n-grams.

Host and path are read from the url by SQL functions.  A rule names a host and the start of a path
and fits the host and all its subdomains; of the rules that fit, the longest wins.  Urls without a
rule are judged by a classifier that is trained here from a small labelled table of urls: n-grams of
``^host$`` and of the path are hashed into a fixed number of buckets.  All of it runs in Spark's own
expressions and feature transformers.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOST_GRAMS, PATH_GRAMS = (3, 4), (3,)
BUCKETS = 1 << 16
BLOCK_FROM = 0.5

#: fixed values of the query: rule and verdict
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

#: the labelled table that the query trains on; another one can be given
BLOCKED = (
    "http://www.casino-win.example.net/play", "https://online-casino.test/bonus", "http://poker-bets.test/en/1",
    "http://best-casino-games.test/slots", "https://bet-win-big.test/", "http://lucky-jackpot.test/spin",
    "http://www.cheap-pills.example.net/buy", "https://pills-discount.test/order", "http://viagra-cheap.test/en/20",
    "http://pharmacy-pills.test/no-prescription", "https://cheap-meds.test/pills/12", "http://diet-pills-now.test/",
    "http://ads-track.example.net/click", "https://track-clicks.test/redirect?u=1", "http://ads.banner-track.test/pixel",
    "https://adserver-clicks.test/banner/1", "http://popup-ads.test/landing", "https://tracking-ads.test/en/4",
    "http://xxx-videos.test/watch", "https://adult-cams.test/live", "http://free-porn-tube.test/1",
    "http://fast-payday-loans.test/apply", "https://win-free-prize.test/claim", "http://crypto-double.test/invest",
    "http://cheap-replica-watches.test/shop", "https://seo-backlinks-buy.test/", "http://work-from-home-rich.test/join",
    "http://spam-links.test/farm", "http://link-farm-spam.test/1", "https://free-bets-today.test/odds", "http://adult-x-films.test/en/3",
    "http://free-download-crack.test/keygen", "https://hot-singles-date.test/chat", "http://click-here-win.test/prize",
    "http://m.adult-films.example.net/en/5", "http://www.casino-games.example.com/de/7", "https://blog.free-pills.example.net/en/2",
    "https://m.track-ads.example.com/en/4", "https://www.spam-links.example.net/fr/6", "https://m.bets-today.example.com/es/9",
)
ALLOWED = (
    "https://www.example.net/en/1", "https://blog.gardening.test/en/201.html", "https://m.weather.test/de/7",
    "http://news.city-times.test/en/politics", "https://www.university.test/research/paper.html", "https://docs.python.test/3/library",
    "https://recipes.kitchen.test/es/120", "http://www.history-museum.test/fr/tour", "https://blog.thering.example.net/en/44",
    "https://m.thther.example.net/de/5.html", "https://www.ththan.example.com/en/88/", "http://blog.erthin.example.net/fr/9#top",
    "https://en.encyclopedia.test/wiki/Lion", "https://library.town.test/catalogue?page=2", "https://www.science-journal.test/article/31",
    "https://forum.cycling.test/t/992", "https://m.onthed.example.net/es/338?page=2&ref=x", "http://www.tionst.example.net/en/12",
    "https://www.train-times.test/en/timetable", "https://blog.photography.test/de/55", "https://school.maths.test/lesson/4",
    "https://www.hospital.test/departments", "http://m.inther.example.com/en/7", "https://government.test/forms/a1",
    "https://blog.ndther.example.net/en/217", "https://code.open-tools.test/project/readme", "https://www.theatre.test/programme",
    "https://www.atesre.example.net/en/571?utm_source=feed", "http://www.esthon.example.com/es/3/", "https://music.lessons.test/piano/2",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host with A-Z in lower case, both empty for null and for a url without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # a longer rule overrides
        own, slash, start = name.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def grams(text: Column, n: int, mark: str) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - (n - 1))
    found = F.transform(starts, lambda i: F.concat(F.lit(f"{mark}{n}:"), F.substring(text, i, F.lit(n))))
    return F.when(F.length(text) >= n, found).otherwise(F.array().cast("array<string>"))


def featured(urls: DataFrame) -> DataFrame:
    """Rows with host and path get ``features``: hashed n-grams that occur."""
    host = F.concat(F.lit("^"), F.col("host"), F.lit("$"))
    own = [grams(host, n, "h") for n in HOST_GRAMS] + [grams(F.col("path"), n, "p") for n in PATH_GRAMS]
    hashed = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features")
    return hashed.transform(urls.withColumn("grams", F.concat(*own))).drop("grams")


def with_parts(urls: DataFrame) -> DataFrame:
    host, path = parts(F.col("url"))
    return urls.withColumns({"host": host, "path": path})


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table (url, label): 1 to block."""
    return spark.createDataFrame([(u, 1.0) for u in BLOCKED] + [(u, 0.0) for u in ALLOWED], "url string, label double").coalesce(1)


def trained(labelled: DataFrame) -> LogisticRegressionModel:
    """The classifier; rows without a label don't teach."""
    rows = featured(with_parts(labelled.where("label is not null"))).select("features", "label").cache()
    model = LogisticRegression(regParam=0.01, maxIter=50, standardization=False).fit(rows)
    rows.unpersist()
    return model


def judged(pages: DataFrame, labelled: DataFrame, rules=RULES) -> DataFrame:
    """One row (page_id, host, path, rule, verdict, score) per page.

    ``score`` is the classifier's probability that the url is to be blocked; the rule's verdict
    comes first.  A null url and one without ``://`` have an empty host and path and are judged by
    the classifier on these.  Repeated pages give repeated rows; other columns are ignored.
    """
    model = trained(labelled)
    rows = model.transform(featured(with_parts(pages.select(F.col("page_id").cast("bigint"), "url"))))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    score = F.element_at(vector_to_array("probability"), 2)
    own = F.when(score >= BLOCK_FROM, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), score.alias("score"))
