"""URL filters: host and path rules first, then a logistic regression on hashed character n-grams."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (host, path prefix, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

GRAMS, BUCKETS = (3, 4, 5), 1 << 14

#: A small labelled table, written for this module: URLs to block and to allow.
BLOCKED = (
    "http://cheap-pills.example.com/buy/now", "https://cheap-watches.example.net/en/12", "http://www.cheap-tickets.test/sale",
    "https://casino-royal.example.org/play", "http://www.casino-online.example.com/en/7", "https://best-casino.test/bonus",
    "http://spam-offers.example.com/click", "https://spam-mail.example.net/de/3", "http://m.spam-links.test/a?ref=x",
    "https://adult-x.example.net/en/4", "http://m.adult-x.example.com/fr/9", "https://adult-chat.test/live",
    "http://free-porn.test/videos", "https://xxx-cams.example.org/1", "http://hot-xxx.example.com/x.html",
    "https://poker-win.test/jackpot", "http://slots-bonus.example.net/en/88", "https://betting-tips.test/odds",
    "http://viagra-store.example.com/order", "https://pills-online.test/cheap", "http://replica-bags.example.org/shop",
    "https://loan-fast.test/apply", "http://payday-loans.example.com/en/2", "https://crypto-doubler.test/invest",
    "http://win-prize.example.net/claim", "https://free-iphone.test/winner", "http://download-crack.example.com/keygen",
    "https://warez-mirror.test/full", "http://torrent-hub.example.org/get", "https://click-farm.test/go?aff=1",
    "http://cheap-flights-deal.test/x", "https://www.cheap-hosting.example.com/en/51", "http://casino-thon.example.org/en/3",
    "https://www.spam-tion.example.org/en/6?utm_source=feed", "http://adult-x.example.org/en/2.html", "https://cheap-ering.example.com/fr/7",
    "http://bet-casino.example.net/slots", "https://adult-dating.example.com/join", "http://spam.example.org/en/1",
    "https://casino.example.com/", "http://cheap.example.com/en/", "https://adult.example.com/en/5#top",
    "http://free-bets.example.com/en/14", "https://m.free-bets.example.org/de/2", "http://ads-track.example.com/en/5", "https://m.ads-track.example.net/fr/41",
    "https://cheap-nd.example.com/en/12", "http://www.cheap-thti.example.com/en/34", "https://m.cheap-ouer.example.org/es/8.html",
    "http://casino-er.example.org/en/27", "https://m.casino-anst.example.com/de/6/", "http://blog.casino-lyen.example.com/en/93#top",
    "https://spam-re.example.org/en/41", "http://blog.spam-onth.example.com/fr/6", "https://m.spam-hein.example.com/en/17/",
    "https://m.adult-x.example.org/en/61", "http://blog.adult-x.example.com/de/8.html", "https://www.adult-x.example.com/es/3?page=2&ref=x",
)
ALLOWED = (
    "https://www.library.example.org/books/12", "http://news.example.com/en/2024/01/story.html", "https://blog.garden.example.com/en/77",
    "http://university.test/courses/math", "https://docs.project.test/guide/start", "http://m.weather.example.com/en/today",
    "https://museum.example.org/fr/visit", "http://city-council.test/minutes", "https://www.hospital.example.com/contact",
    "http://recipes.example.net/en/soup", "https://history.test/archive/1901", "http://blog.thenand.example.com/en/34",
    "https://tionsh.example.net/en/2", "http://www.theron.example.com/fr/30?page=2&ref=x", "https://m.ththha.example.org/en/38.html",
    "http://ththon.example.com/de/19.html", "https://blog.tionble.example.com/fr/12", "http://m.tiontion.example.com/en/24#top",
    "https://www.anthere.example.org/en/5/", "http://erand.example.com/es/6", "https://blog.ofthe.example.net/en/71?utm_source=feed",
    "http://ingver.example.com/de/8", "https://chande.example.org/fr/9/", "http://www.lationde.example.com/es/13.html",
    "https://school.test/lessons/2", "http://radio.example.com/en/live", "https://maps.test/city/centre",
    "http://science.example.org/en/paper/5", "https://cooking.test/bread", "http://music.example.com/en/album/3",
    "https://travel-notes.example.org/en/rome", "http://chess-club.test/games", "https://bird-watch.example.com/en/list",
    "http://www.astronomy.test/stars", "https://m.railway.example.net/en/times", "http://blog.poetry.example.org/en/44",
    "https://law-review.test/issues/9", "http://software.example.com/en/manual.html", "https://health.test/advice/sleep",
    "http://theatre.example.org/es/season", "https://farming.example.com/en/wheat", "http://www.bridges.test/design",
    "https://heand.example.com/en/", "http://thnthe.example.org/en/1", "https://example.com/en/3", "http://example.org/",
    "http://www.thering.example.org/en/12/", "https://erer.example.com/en/63", "http://m.stthin.example.com/en/4?page=2&ref=x",
    "https://blog.onhean.example.org/en/95.html", "http://ndat.example.com/fr/2/", "https://www.ouha.example.com/en/31#top",
    "http://shthor.example.org/de/7", "https://m.eratin.example.org/es/18", "http://blog.leand.example.com/de/44.html",
    "https://www.inwhes.example.com/en/6?utm_source=feed", "http://tithan.example.org/en/29", "https://haerly.example.com/es/72/",
    "http://m.reonst.example.com/fr/15#top", "https://nteare.example.org/en/84.html", "http://blog.ererth.example.org/en/3/",
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The part after the first `://` up to `/`, `?`, `#` (A-Z lower-cased), and from there up to `?`, `#`."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, with their ends marked and told apart by a letter.

    Runs of digits in the path count as one zero: page numbers tell nothing.
    """

    def of(text: Column, mark: str) -> list[Column]:
        closed = F.concat(F.lit("^"), text, F.lit("$"))
        return [
            F.when(
                F.length(closed) >= n,
                F.transform(F.sequence(F.lit(1), F.length(closed) - n + 1), lambda i, n=n: F.concat(F.lit(mark), F.substring(closed, i, F.lit(n)))),
            ).otherwise(F.array().cast("array<string>"))
            for n in GRAMS
        ]

    return F.concat(*of(host, "h"), *of(F.regexp_replace(path, "[0-9]+", "0"), "p"))


def with_features(frame: DataFrame) -> DataFrame:
    hashed = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="llm_grams", outputCol="llm_features")
    return hashed.transform(frame.withColumn("llm_grams", grams(F.col("host"), F.col("path"))))


def train(spark: SparkSession, blocked=BLOCKED, allowed=ALLOWED) -> LogisticRegressionModel:
    """A model of P(block) from the labelled table; its size is fixed."""
    rows = [(u, 1.0) for u in blocked] + [(u, 0.0) for u in allowed]
    labelled = spark.createDataFrame(rows, "url string, label double").coalesce(1)
    host, path = host_and_path(F.col("url"))
    known = with_features(labelled.select(host.alias("host"), path.alias("path"), "label"))
    return LogisticRegression(featuresCol="llm_features", labelCol="label", regParam=0.003, maxIter=60).fit(known)


def rule_and_verdict(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    ordered = sorted(rules, key=lambda r: len(r[0] + r[1]), reverse=True)
    fits = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in ordered
    ]
    return F.coalesce(*fits)


def url_filter(pages: DataFrame, *, key: str = "page_id", url: str = "url", rules=RULES, model: LogisticRegressionModel | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict for every row.

    The longest rule whose host is the URL's host or a parent of it and whose path begins
    the URL's path decides; without one the model does, blocking from a probability of one
    half on. A null URL or one without `://` has an empty host and path, fits no rule and is
    left to the model. Each row is judged by itself, so repeated rows agree and no rows give
    none. Other columns are not read.
    """
    spark = pages.sparkSession
    model = model or train(spark)
    host, path = host_and_path(pages[f"`{url}`"])
    split = pages.select(pages[f"`{key}`"].alias("page_id"), host.alias("host"), path.alias("path"))
    judged = model.transform(with_features(split)).withColumn("llm_rule", rule_and_verdict(F.col("host"), F.col("path"), rules))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("llm_rule.rule").alias("rule"),
        F.coalesce("llm_rule.verdict", F.when(F.col("prediction") == 1.0, "block").otherwise("allow")).alias("verdict"),
    )
