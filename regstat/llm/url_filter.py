"""URL filter: ratio of two smoothed variable-order Markov models of characters (built-in functions only).

Host and path rules decide the urls they fit (the longest rule wins).  The
urls that rules allow and block train one character model each, from scheme
to fragment with the host in lower case; all counts
are tables that Spark groups and joins, nothing of them goes to the driver.
A character's probability is Witten-Bell smoothed: the counts after its
longest context, backed off to ever shorter ones and at last to a uniform
alphabet.  A url's score is the mean over its characters of
``log P_accepted - log P_rejected``.  The threshold is calibrated on labelled
urls that the counts leave out: the score that best parts the two classes.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule and is scored as it stands (null as the empty string); repeated rows each get the
verdict of their url; without urls of both classes the score is 0 and the
verdict of unruled urls is ``allow``; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regstat.llm.common import held_out, staged

#: (host, path, verdict) of the published rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
ORDER = 3            # longest context, in characters
ALPHABET = 256       # size of the uniform last resort
BINS = 100           # calibration bins per unit of score
SALTS = 16
START, END = "\u0002", "\u0003"


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tail = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(raw, upper, lower), F.lit("")), F.coalesce(tail, F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def sequence(url: Column) -> Column:
    """What the models read: the whole url, scheme, query and fragment included, its host in lower case; null is empty."""
    host, _ = host_path(url)
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3 + F.length(host), F.length(url))
    return F.coalesce(F.when(at > 0, F.concat(F.substring(url, F.lit(1), at + 2), host, rest)).otherwise(url), F.lit(""))


def _grams(seq: Column) -> Column:
    """Each character with its ORDER predecessors, the end mark included; takes time in proportion to the length."""
    chars = F.split(F.concat(F.lit(START * ORDER), seq, F.lit(END)), "")
    shifted = [F.slice(chars, F.lit(k + 1), F.length(seq) + 1) for k in range(ORDER + 1)]
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), shifted)


def gram_scores(grams: DataFrame) -> DataFrame:
    """gram -> log P_accepted - log P_rejected, from the counts ``a`` and ``b`` of each gram.

    A class without counts has the uniform model.
    """
    def context(k: int) -> Column:
        return F.substring("gram", 1, k)

    counts = {ORDER: grams}
    for k in range(ORDER - 1, -1, -1):
        counts[k] = (counts[k + 1].groupBy(F.substring("gram", 2, k + 1).alias("gram")).agg(F.sum("a").alias("a"), F.sum("b").alias("b")))

    below = None
    for k in range(ORDER + 1):
        totals = (counts[k].groupBy(context(k).alias("ctx"))
                  .agg(F.sum("a").alias("na"), F.sum("b").alias("nb"),
                       F.sum(F.when(F.col("a") > 0, 1).otherwise(0)).alias("da"), F.sum(F.when(F.col("b") > 0, 1).otherwise(0)).alias("db")))
        level = counts[k].withColumn("ctx", context(k)).join(totals, "ctx")
        if below is None:
            level = level.withColumn("qa", F.lit(1.0 / ALPHABET)).withColumn("qb", F.lit(1.0 / ALPHABET))
        else:
            level = level.withColumn("tail", F.substring("gram", 2, k)).join(below.withColumnRenamed("gram", "tail"), "tail")

        def smoothed(c: str) -> Column:
            n, d = F.col(f"n{c}"), F.col(f"d{c}")
            return F.when(n > 0, (F.col(c) + d * F.col(f"q{c}")) / (n + d)).otherwise(F.col(f"q{c}"))
        below = level.select("gram", smoothed("a").alias("qa"), smoothed("b").alias("qb"))
    return below.select("gram", (F.log("qa") - F.log("qb")).alias("ratio"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score of every page."""
    host, path = host_path(F.col("url").cast("string"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), sequence(F.col("url").cast("string")).alias("seq"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", name.alias("rule"), verdict.alias("ruled")).withColumn("key", F.md5(F.col("seq").cast("binary")))

    # one row per different url; its class, and whether its counts are left out for the calibration
    urls = staged(rows.groupBy("key").agg(F.first("seq").alias("seq"), F.first("ruled").alias("ruled"), F.count(F.lit(1)).alias("n"))
                  .withColumn("left_out", held_out(F.col("key"))), "urls")
    fit = ~F.col("left_out")
    weight = lambda v: F.when((F.col("ruled") == v) & fit, F.col("n")).otherwise(0)
    chars = urls.select("key", weight("allow").alias("a"), weight("block").alias("b"), F.explode(_grams(F.col("seq"))).alias("gram"))
    ratios = gram_scores(staged(chars.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b")), "url-grams"))      # counted once for all orders
    # a frequent gram is in almost every url: spread it over salted copies of its one model row (merged: their size is estimated without the copies)
    salted = ratios.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    scores = (chars.select("key", "gram", F.pmod(F.crc32(F.col("key").cast("binary")), F.lit(SALTS)).cast("int").alias("salt"))
              .join(salted, ["gram", "salt"]).groupBy("key").agg(F.avg("ratio").alias("score")))
    scored = staged(urls.select("key", "ruled", "left_out", "n").join(scores, "key").withColumn("score", F.round("score", 9)), "url-scores")

    threshold = calibrated(scored.filter("left_out and ruled is not null"))
    return (rows.join(scored.select("key", "score"), "key").crossJoin(F.broadcast(threshold))      # one row
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")).alias("verdict"), "score"))


def calibrated(labelled: DataFrame) -> DataFrame:
    """One row: the score from which urls are allowed, where the summed error rates of both classes are least.

    Scores are counted in bins, at most a few thousand rows whatever the
    input; of equally good cuts the middle one is taken.  0 if a class is missing.
    """
    bins = (labelled.groupBy(F.floor(F.greatest(F.least("score", F.lit(20.0)), F.lit(-20.0)) * BINS).alias("bin"))
            .agg(F.sum(F.when(F.col("ruled") == "allow", F.col("n")).otherwise(0)).alias("a"),
                 F.sum(F.when(F.col("ruled") == "block", F.col("n")).otherwise(0)).alias("b")))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cuts = (bins.withColumn("ca", F.coalesce(F.sum("a").over(below), F.lit(0))).withColumn("cb", F.coalesce(F.sum("b").over(below), F.lit(0)))
            .withColumn("ta", F.sum("a").over(whole)).withColumn("tb", F.sum("b").over(whole))
            .filter("ta > 0 and tb > 0")
            .withColumn("lost", F.round(F.col("ca") / F.col("ta") - F.col("cb") / F.col("tb"), 9))
            .withColumn("gap", F.lag("bin").over(Window.orderBy("bin"))))
    best = cuts.groupBy().agg(F.min(F.struct("lost", "bin", "gap")).alias("x"))
    # the cut lies between two filled bins: take the middle of the empty stretch
    return best.select(F.coalesce((F.col("x.bin") + F.coalesce(F.col("x.gap") + 1, F.col("x.bin"))) / 2 / BINS, F.lit(0.0)).alias("threshold"))
