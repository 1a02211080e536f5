"""URL filter: host and path rules, and for the rest a logistic regression on hashed
character n-grams of host and path. Built-in DataFrame and ML operations only."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.quality import let

#: (host, path prefix, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
BUCKETS, SIZES = 1024, (3, 4)
MAX_RULES, MAX_LABELLED = 1000, 100_000
#: Labelled addresses the model is trained on (fixed values; 1: block).
LABELLED = (
    ("https://casino-bonus.example.net/win/jackpot", 1), ("http://free-slots.example.net/bonus/spin", 1),
    ("https://bet-poker.example.com/casino/vip", 1), ("http://win-prize.example.org/free/gift-card", 1),
    ("http://hot-singles.example.net/adult/chat", 1), ("https://xxx-cams.example.com/adult/live", 1),
    ("https://adult-video.example.net/xxx/hot", 1), ("http://crack-keygen.example.net/warez/download", 1),
    ("http://free-download.example.com/crack/serial", 1), ("https://warez.example.org/torrent/keygen", 1),
    ("http://cheap-pills.example.com/buy/viagra", 1), ("https://pharma-pills.example.net/cheap/order", 1),
    ("http://payday-loan.example.net/cash/fast", 1), ("https://fast-cash.example.com/loan/apply-now", 1),
    ("http://get-rich.example.net/crypto/double", 1), ("https://crypto-giveaway.example.com/free/bonus", 1),
    ("https://news.example.net/en/12", 0), ("https://blog.example.org/de/348", 0), ("http://m.example.com/fr/77/", 0),
    ("https://www.example.net/es/9021?page=2", 0), ("https://docs.example.org/guide/install", 0),
    ("https://wiki.example.org/article/history", 0), ("http://library.example.net/books/catalogue", 0),
    ("https://www.example.com/about", 0), ("https://shop.example.com/products/chair", 0),
    ("https://university.example.org/research/papers", 0), ("http://city.example.net/services/parks", 0),
    ("https://m.weather.example.com/forecast/today", 0), ("https://museum.example.org/exhibitions/2020", 0),
    ("http://recipes.example.net/bread/sourdough", 0), ("https://travel.example.com/en/4510#top", 0),
    ("https://forum.example.net/topic/garden", 0),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a url; both empty without ``://`` and for null."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; a rule fits its
    host and all subdomains where the path starts with the rule's."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"the table is compiled into the plan: {MAX_RULES} rules at most")
    found = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))
        found = F.when(fits, hit) if found is None else found.when(fits, hit)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _buckets(host: Column, path: Column) -> Column:
    """Bucket of every n-gram of ``^host$`` and ``^path$``, marked by part."""
    def grams(tag: str, text: Column, n: int) -> Column:
        def bucket(s: Column, i: Column) -> Column:
            return F.pmod(F.xxhash64(F.concat(F.lit(tag), s.substr(i, F.lit(n)))), F.lit(BUCKETS)).cast("int")

        line = F.concat(F.lit("^"), text, F.lit("$"))
        return let(line, lambda s: F.when(F.char_length(s) < n, F.array().cast("array<int>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.char_length(s) - (n - 1)), lambda i: bucket(s, i))))

    parts = [grams(tag, text, n) for tag, text in (("h", host), ("p", path)) for n in SIZES]
    return F.concat(*parts)


def labelled_table(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(v).alias("label")) for u, v in LABELLED])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def train(labelled: DataFrame, reg: float = 0.01) -> tuple[list[float], float]:
    """Weights and intercept from a (url, label) table of at most ``MAX_LABELLED`` rows.
    Rows with a null label are left out; without both labels every url scores 0.5."""
    rows = labelled.filter("label is not null").select(F.col("label").cast("double").alias("label"), *[
        c.alias(n) for c, n in zip(host_and_path(F.col("url")), ("host", "path"))])
    seen = rows.agg(F.count("*").alias("n"), F.countDistinct("label").alias("k")).first()
    if seen["n"] > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled addresses")
    if seen["k"] < 2:
        return [0.0] * BUCKETS, 0.0
    idx = rows.select("label", _buckets(F.col("host"), F.col("path")).alias("idx"))
    # a fixed-width row per address; the table is small and this is its only use
    dense = idx.select("label", F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda d: (
        F.size(F.filter("idx", lambda x: x == d)) / F.greatest(F.lit(1), F.size("idx"))).cast("double")).alias("x"))
    vectors = dense.select("label", array_to_vector("x").alias("features"))
    model = LogisticRegression(maxIter=100, regParam=reg / BUCKETS, standardization=False).fit(vectors)
    return [float(w) for w in model.coefficients.toArray()], float(model.intercept)


def block_probability(host: Column, path: Column, weights: list[float], intercept: float) -> Column:
    table = F.array(*[F.lit(w) for w in weights])
    total = let(_buckets(host, path), lambda idx: F.aggregate(
        idx, F.lit(0.0), lambda acc, x: acc + F.get(table, x)) / F.greatest(F.lit(1), F.size(idx)))
    return 1 / (1 + F.exp(-(total + F.lit(intercept))))


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score: one row per row of ``pages``.

    The longest fitting rule decides; else the model blocks where its probability
    is at least ``threshold``. A null url or one without ``://`` has empty host and
    path and goes to the model. Repeated rows each keep a row; other columns are
    ignored.
    """
    weights, intercept = train(labelled if labelled is not None else labelled_table(pages.sparkSession))
    host, path = host_and_path(F.col("url"))
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    scored = cut.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("r"),
                        block_probability(F.col("host"), F.col("path"), weights, intercept).alias("block_score"))
    own = F.when(F.col("block_score") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("r.rule").alias("rule"),
                         F.coalesce("r.verdict", own).alias("verdict"), "block_score")
