"""URL filter: explicit rules, and logistic regression on hashed character n-grams for the rest.

Only DataFrame operations run, in training as in scoring. The host and the path
give n-grams of three to five characters (the host with a sign at both ends),
each hashed into one of ``BUCKETS`` weights. The regression is fitted to a small
table of labelled URLs; its weights become an array literal, so scoring is a map
without a shuffle.

A null URL, or one without ``://``, has an empty host and path; no rule fits it
and the model's intercept decides (the table calls it ordinary). Repeated rows are judged alike, an empty
table gives no rows, and a URL of any length is judged as a whole. New columns take the
place of columns of their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.llm.common import table

BUCKETS = 2048
SIZES = (3, 4, 5)
BLOCK_FROM = 0.5
#: The feature that all rows share; the n-grams of a row have length one together.
INTERCEPT = 0.3

#: (host and path prefix, verdict)
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))

# A small labelled table: URLs of unwanted and of ordinary sites, by host and path.
BLOCKED = """
http://casino-royal-bonus.example.com/slots/free-spins
https://bestcasino.example.net/jackpot?ref=9
http://poker-online.example.org/texas/bonus
https://sportbet365.example.com/odds/live
http://bet-win-now.example.net/betting/tips
https://lotto-winner.example.com/claim/prize
http://cheap-pills.example.org/viagra/buy
https://online-pharmacy.example.net/cialis/discount
http://diet-pills.example.com/lose-weight-fast
https://porn-videos.example.net/xxx/teen
http://free-xxx.example.com/sex/cams
https://adult-dating.example.org/hookup/tonight
http://hotsex.example.net/porn/watch
https://sexcams.example.com/adult/live
http://escort-service.example.org/girls
http://torrent-downloads.example.net/movies/cracked
https://warez.example.com/crack/keygen
http://keygen-serials.example.org/download/full-version
https://free-movies-hd.example.net/watch/online/stream-free
http://adserver.example.com/click?banner=12
https://ads.tracker.example.net/track/pixel.gif
http://click.track.example.org/redirect/affiliate
https://banner-ads.example.com/adclick/popunder
http://popads.example.net/serve/ad
https://secure-login-verify.example.com/account/update/password
http://paypal-verify.example.net/signin/confirm
https://bank-login.example.org/verify/account
http://free-iphone.example.com/win/prize/claim-now
https://make-money-fast.example.net/work-from-home
http://get-rich-crypto.example.com/bitcoin/double
https://payday-loans.example.org/cash/instant
http://cheap-replica-watches.example.net/buy/rolex
https://seo-backlinks.example.com/buy/links
http://spam-mailer.example.org/bulk/email
https://malware-host.example.net/exe/setup.exe
https://www.casino-king.example.org/en/812
http://blog.free-bets-now.example.com/fr/77?page=2
https://m.cheap-pills-shop.example.net/de/3055
http://adult-videos.example.org/es/19
https://ads-network.example.com/en/4410
http://www.spam-links.example.net/en/231
https://link-farm.example.org/fr/5
http://m.win-casino.example.net/de/64
https://adult-chat.example.com/en/2208
http://track-ads.example.org/es/731
https://www.pills-cheap.example.com/fr/90
http://blog.bets-free.example.net/en/1503
https://spam-farm.example.net/de/12
http://m.adult-zone.example.org/en/6
""".split()
ALLOWED = """
https://www.ththere.example.com/en/120
http://blog.tionand.example.org/fr/55?page=2
https://m.thenre.example.net/de/871#top
http://inthe.example.com/es/12
https://thther.example.org/en/685
http://erstan.example.net/fr/402
https://www.hetion.example.org/de/9
http://m.reand.example.com/fr/3117
https://blog.anst.example.net/en/64?ref=x
http://tionble.example.org/de/2051
https://docs.example.com/guide/install
https://docs.example.org/manual/reference/strings
http://news.example.net/world/2021/05/storm
https://news.example.com/science/telescope
http://wiki.example.org/history/rome
https://wiki.example.net/mathematics/algebra
http://library.example.org/books/chapter/4
https://university.example.net/courses/biology
http://school.example.com/lessons/geography
https://museum.example.org/collection/paintings
http://weather.example.net/forecast/week
https://recipes.example.com/soup/tomato
http://gardening.example.org/roses/pruning
https://travel.example.net/city/lisbon
http://health.example.org/nutrition/vitamins
https://research.example.com/papers/physics
http://forum.example.net/thread/8841
https://blog.example.org/2020/notes
http://shop.example.com/furniture/chairs
https://support.example.net/help/printer
http://city.example.org/council/minutes
https://sports.example.com/football/results
http://music.example.net/concerts/schedule
https://code.example.org/project/readme
http://mail.example.com/about
http://www.thtion.example.com/en/4071
https://m.anthe.example.com/en/318/
http://blog.ererth.example.com/de/77.html
https://ththes.example.net/en/5250.html
http://www.ouring.example.net/fr/61/
https://m.tionth.example.org/en/2993?utm_source=feed
http://blog.thhaed.example.org/es/408.html
https://inreth.example.org/fr/19#top
http://www.ststhe.example.com/es/704/
https://blog.thenti.example.com/fr/1138?utm_source=feed
http://m.wherth.example.net/es/36.html
https://www.atheon.example.net/de/870/
http://thandth.example.com/de/5502
https://m.lything.example.org/de/243?page=2
http://blog.leauth.example.net/fr/90
https://www.heitung.example.org/en/6
http://kirsten-photo.example.de/holiday/alps
https://openletters.example.fr/essais/2
http://nordsee.example.de/karte/hafen
https://biblioteca.example.es/libros/poesia
http://a.b.example.com/x
https://c.example.net/
http://example.org
https://home.example.edu/staff/list
""".split() + ["", "", ""]  # a page without a URL is no reason to block it

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def buckets(host: Column, path: Column, sizes: Sequence[int] = SIZES, count: int = BUCKETS) -> Column:
    """The buckets of all n-grams, repeats included."""

    def grams(text: Column, n: int, sign: str) -> Column:
        def of(chars: Column) -> Column:  # a variable, so that the text is split once
            starts = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda i: F.pmod(F.crc32(F.concat(F.lit(sign), *(F.get(chars, i + j) for j in range(n))).cast("binary")), F.lit(count)).cast("int"))

        return F.flatten(F.transform(F.array(F.split(text, "")), of))

    ends = F.when(host == "", host).otherwise(F.concat(F.lit("^"), host, F.lit("$")))
    return F.concat(*(grams(ends, n, "h") for n in sizes), *(grams(path, n, "p") for n in sizes))


def train(
    spark: SparkSession, blocked: Sequence[str] = BLOCKED, allowed: Sequence[str] = ALLOWED, count: int = BUCKETS, rounds: int = 400, rate: float = 0.08, decay: float = 0.002
) -> tuple[float, list[float]]:
    """Intercept and weights of a logistic regression (1: block) on a small labelled URL table.

    Gradient descent over the whole table, as one query: the weights are sums of
    the rows' features, so each round needs the inner products of the rows only,
    and updates one number for each row. The table is the caller's and small (the
    products are its size squared).
    """
    rows = spark.createDataFrame([(i, u, float(i < len(blocked))) for i, u in enumerate([*blocked, *allowed])], "i int, url string, y double")
    b = rows.select("i", "y", buckets(host_of(F.col("url")), path_of(F.col("url")), count=count).alias("b"))
    # bucket -1 is the intercept's; the n-grams
    x = (
        b.select("i", "y", F.explode("b").alias("k"), F.sqrt(F.size("b").cast("double")).alias("norm"))
        .groupBy("i", "y", "k", "norm")
        .agg(F.count("*").alias("c"))
        .select("i", "y", "k", (F.col("c") / F.col("norm")).alias("v"))
        .unionByName(b.select("i", "y", F.lit(-1).alias("k"), F.lit(INTERCEPT).alias("v")))
    )
    products = x.alias("p").join(x.alias("q"), F.col("p.k") == F.col("q.k")).groupBy(F.col("p.i").alias("i"), F.col("p.y").alias("y"), F.col("q.i").alias("j")).agg(F.sum(F.col("p.v") * F.col("q.v")).alias("s"))
    by_row = products.groupBy("i", "y").agg(F.array_sort(F.collect_list(F.struct("j", "s")))["s"].alias("s"))
    whole = by_row.agg(F.array_sort(F.collect_list(F.struct("i", "y", "s"))).alias("rows"))

    def step(alpha: Column, _: Column) -> Column:
        def update(row: Column, i: Column) -> Column:
            margin = F.aggregate(F.zip_with(row["s"], alpha, lambda s, a: s * a), F.lit(0.0), lambda acc, v: acc + v)
            return F.get(alpha, i) * (1 - rate * decay) + rate * (row["y"] - 1 / (1 + F.exp(-margin)))

        return F.transform("rows", update)

    alpha = whole.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.transform("rows", lambda r: F.lit(0.0)), step).alias("alpha"))
    alpha = alpha.select(F.posexplode("alpha").alias("i", "alpha"))
    weights = {r.k: r.w for r in x.join(alpha, "i").groupBy("k").agg(F.sum(F.col("v") * F.col("alpha")).alias("w")).collect()}  # count + 1 rows at most
    return weights[-1] * INTERCEPT, [weights.get(k, 0.0) for k in range(count)]


def score(host: Column, path: Column, intercept: float, weights: list[float]) -> Column:
    """The probability of ``block``."""
    b = buckets(host, path, count=len(weights))
    table_ = F.array(*map(F.lit, weights))
    total = F.aggregate(b, F.lit(0.0), lambda acc, x: acc + F.get(table_, x))
    return 1 / (1 + F.exp(-(F.lit(intercept) + total / F.sqrt(F.greatest(F.size(b), F.lit(1)).cast("double")))))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def judge_urls(pages: DataFrame, model: tuple[float, list[float]], url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``."""
    parts = pages.withColumn("host", host_of(F.col(f"`{url}`"))).withColumn("path", path_of(F.col(f"`{url}`")))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    scored = parts.withColumns({"rule": rule, "score": score(F.col("host"), F.col("path"), *model)})
    return scored.withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, train(spark)).select("page_id", "host", "path", "rule", "verdict", "score")
