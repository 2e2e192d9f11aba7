"""URL filter: host rules, then logistic regression, with DataFrame operations only.

The model sees hashed character n-grams of host and path and is trained on a
small labelled URL table by Spark's own (JVM) logistic regression.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revline.session import scratch_path

#: A rule's verdict and the rule (host/path).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)

#: The small labelled URL table, 1 is block.
BLOCKED_SEEDS = (
    "http://www.casino-royal.example/slots/win-now",
    "https://online-casino-bonus.example/en/12",
    "http://m.casino-slots.example.com/fr/3.html",
    "http://win-jackpot.example.com/en/88/",
    "https://big-win-lottery.example.org/es/7",
    "https://free-bets-today.example/offer",
    "http://sports-bets.example.com/en/5#top",
    "https://best-bets.example.net/de/19?page=2&ref=x",
    "http://cheap-pills-shop.example/buy",
    "https://www.pills-online.example.com/en/41",
    "http://diet-pills.example.org/fr/64/",
    "http://cheap-meds.example.net/es/9.html",
    "https://cheap-watches.example.com/de/4",
    "http://spam-mailer.example.com/en/2",
    "https://link-farm.example.org/en/31",
    "http://blog.content-farm.example.net/fr/8?utm_source=feed",
    "http://spam-links.example.com/es/77",
    "https://adult-videos.example/x/18",
    "http://m.adult-chat.example.com/en/6",
    "https://adult-x-cams.example.org/de/3",
    "http://xxx-adult.example.net/en/55.html",
    "http://ads-server.example.com/click/1",
    "https://track-ads.example.com/en/14",
    "http://ads-click-track.example.net/fr/29",
    "https://pixel-track.example.org/es/2?ref=x",
    "http://free-money-now.example.com/en/1",
    "https://free-gifts.example.net/de/72",
    "http://win-free-phone.example.org/en/90/",
)
ALLOWED_SEEDS = (
    "https://www.weather.example/today",
    "https://blog.gardening.example.com/en/12",
    "http://m.thenews.example.com/fr/3.html",
    "http://library.example.com/en/88/",
    "https://museum.example.org/es/7",
    "https://www.cityhall.example/services",
    "http://football.example.com/en/5#top",
    "https://recipes.example.net/de/19?page=2&ref=x",
    "http://pharmacy.example/opening-hours",
    "https://www.thirteenth.example.com/en/41",
    "http://station.example.org/fr/64/",
    "http://nation.example.net/es/9.html",
    "https://watching.example.com/de/4",
    "http://mailing.example.com/en/2",
    "https://farmers.example.org/en/31",
    "http://blog.education.example.net/fr/8?utm_source=feed",
    "http://translation.example.com/es/77",
    "https://television.example/programme/18",
    "http://m.thinking.example.com/en/6",
    "https://cameras.example.org/de/3",
    "http://there.example.net/en/55.html",
    "http://service.example.com/about/1",
    "https://railway.example.com/en/14",
    "http://clicking.example.net/fr/29",
    "https://photos.example.org/es/2?ref=x",
    "http://economics.example.com/en/1",
    "https://freedom.example.net/de/72",
    "http://winter.example.org/en/90/",
    "http://blog.other.example.com/en/101",
    "https://www.tension.example.org/fr/230/",
    "https://this.example.com/de/7.html",
    "http://m.therein.example.net/es/415?page=2&ref=x",
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to / ? # or the end, then up to ? # or the end.

    A-Z of the host are lower-cased. Null, or no ``://``: both empty.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")),
            F.coalesce(path, F.lit("")))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; else nulls.

    A rule fits its host and all subdomains where the path starts with the
    rule's path. Of two equally long ones, the first in ``rules``.
    """
    rule = verdict = F.lit(None).cast("string")
    for says, text in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _gram(mark: str, value: Column, n: int):
    return lambda at: F.concat(F.lit(mark), F.substring(value, at, F.lit(n)))


def grams(host: Column, path: Column, sizes=(3, 4)) -> Column:
    """Character n-grams of host and path, each marked with where it comes from."""
    parts = []
    for mark, value in (("h", F.concat(F.lit("^"), host, F.lit("$"))),
                        ("p", F.concat(F.lit("^"), path, F.lit("$")))):
        for n in sizes:
            starts = F.sequence(F.lit(1), F.greatest(F.length(value) - n + 1, F.lit(1)))
            parts.append(F.transform(starts, _gram(mark, value, n)))
    return F.concat(*parts)


class UrlModel:
    """Hashed n-grams and a fitted logistic regression."""

    def __init__(self, model: LogisticRegressionModel, features: int, sizes: tuple[int, ...]):
        self.model, self.features, self.sizes = model, features, sizes

    def hasher(self) -> HashingTF:
        return HashingTF(numFeatures=self.features, binary=True, inputCol="_grams",
                         outputCol="_features")

    def score(self, df: DataFrame, host: str, path: str, out: str) -> DataFrame:
        """``df`` with the probability of block as column ``out``."""
        marked = df.withColumn("_grams", grams(F.col(host), F.col(path), self.sizes))
        found = self.model.transform(self.hasher().transform(marked))
        return found.select(*df.columns,
                            vector_to_array("_probability").getItem(1).alias(out))


def seed_table(spark: SparkSession) -> DataFrame:
    rows = [(u, 1.0) for u in BLOCKED_SEEDS] + [(u, 0.0) for u in ALLOWED_SEEDS]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def train(labelled: DataFrame, features: int = 1 << 14, sizes: tuple[int, ...] = (3, 4),
          regularisation: float = 0.01, iterations: int = 50) -> UrlModel:
    """Fit on a labelled URL table (url string, label 1.0 block or 0.0 allow).

    Rows without a label are left out.
    """
    host, path = split_url(F.col("url"))
    rows = (labelled.where("label IS NOT NULL")
            .select(F.col("label").cast("double").alias("label"),
                    grams(host, path, sizes).alias("_grams")))
    model = UrlModel(None, features, sizes)
    fitted = LogisticRegression(
        featuresCol="_features", labelCol="label", maxIter=iterations, regParam=regularisation,
        standardization=False, probabilityCol="_probability", rawPredictionCol="_raw",
        predictionCol="_prediction").fit(model.hasher().transform(rows))
    # a fitted model drags its training summary, and with it the session, into
    # every task; a stored one is only its coefficients
    path = scratch_path(labelled.sparkSession, "url-model")
    fitted.write().save(path)
    model.model = LogisticRegressionModel.load(path)
    return model


def judge_urls(pages: DataFrame, model: UrlModel, rules=RULES, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict (allow or block) and score of every row.

    The verdict is the longest fitting rule's, else block where the model's
    score (probability of block, 0 to 1) is at least 0.5.

    Defined cases: a null url or one without ``://`` has empty host and path, no
    rule, and the model's verdict on empty strings. Rows that repeat are judged
    each. Other columns are ignored; no rows give no rows.
    """
    host, path = split_url(F.col(url_col))
    split = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    scored = model.score(split, "host", "path", "score")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    return scored.select(
        F.col("_id").alias(id_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
        .alias("verdict"), "score")
