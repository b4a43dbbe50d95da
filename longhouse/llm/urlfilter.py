"""URL verdicts from rules and, where no rule fits, from two character language models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from longhouse.llm.common import lookup
from longhouse.session import stage

#: Characters of context the models look back at most.
ORDER = 3
#: Symbols after folding: a-z, 0 for any digit, three marks, * for all others, and ^ and $ for the ends.
SYMBOLS = 33
#: The fold of the labelled URLs that sets the threshold; the models learn from the others.
FOLDS, HELD = 5, 0
#: Scores are cut to this range and width to find the threshold, a bounded table.
REACH, WIDTH = 10.0, 0.01

PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(url: str = "url") -> tuple[F.Column, F.Column]:
    """Host in lower case (A-Z only) and path; both empty for a null or a URL without ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(text, PATTERN, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, PATTERN, 2)


def longest_rule(rules: list[tuple[str, str]], host: F.Column, path: F.Column) -> F.Column:
    """The longest rule that fits, as struct(rule, verdict), else null.

    A rule is a host and a path, as ``example.com/en/``. It fits its host and all subdomains if the
    path starts with its own. Rules of equal length go by host length, then by name.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0]), -len(r[0].partition("/")[0]), r[0]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in reversed(ordered):
        at, slash, rest = rule.partition("/")
        own = at.lower()
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def folded(url: str = "url") -> F.Column:
    """The URL after its scheme, in ``SYMBOLS`` symbols, between ^ marks and a $.

    Digits fold into one symbol, letters outside a-z and other marks into another; so there are at
    most ``SYMBOLS`` ** (``ORDER`` + 1) grams however many URLs there are.
    """
    text = F.lower(F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://", ""))
    text = F.regexp_replace(F.regexp_replace(text, "[0-9]", "0"), r"(?s)[^a-z0./-]", "*")
    return F.concat(F.lit("^" * ORDER), text, F.lit("$"))


def positions(urls: DataFrame) -> DataFrame:
    """A row for each symbol to predict, with the gram that ends in it."""
    spots = F.explode(F.sequence(F.lit(1), F.length("__folded") - ORDER))
    at = urls.withColumn("__at", spots)
    return at.withColumn("__gram", F.substring("__folded", F.col("__at"), F.lit(ORDER + 1))).drop("__folded", "__at")


def class_models(labelled: DataFrame) -> list[DataFrame]:
    """Counts of both classes by order: a row for each gram of k context symbols and one more.

    Columns: gram and its counts in accepted and rejected URLs (a, r). ``labelled`` has __folded,
    __accepted and __weight.
    """
    full = (
        positions(labelled)
        .groupBy("__gram")
        .agg(
            F.sum(F.when(F.col("__accepted"), F.col("__weight")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("__accepted"), 0).otherwise(F.col("__weight"))).alias("r"),
        )
    )
    # written once: all orders are sums over it, and it is far smaller than the pages
    full = stage(full, "url-grams")
    tables = []
    for k in range(ORDER + 1):
        grams = full.groupBy(F.substring("__gram", ORDER + 1 - k, k + 1).alias("gram")).agg(
            F.sum("a").alias("a"), F.sum("r").alias("r")
        )
        tables.append(grams)
    return tables


def mixing_rates(tables: list[DataFrame]) -> list[tuple[DataFrame, DataFrame]]:
    """For each order: gram -> c/(n+t) by class, and context -> t/(n+t) by class (Witten-Bell)."""
    out = []
    for k, grams in enumerate(tables):
        context = F.substring("gram", 1, k) if k else F.lit("")
        grams = grams.withColumn("context", context)
        contexts = grams.groupBy("context").agg(
            F.sum("a").alias("an"),
            F.sum("r").alias("rn"),
            F.sum((F.col("a") > 0).cast("long")).alias("at"),
            F.sum((F.col("r") > 0).cast("long")).alias("rt"),
        )
        own = grams.join(F.broadcast(contexts), "context").select(
            "gram",
            F.when(F.col("an") > 0, F.col("a") / (F.col("an") + F.col("at"))).otherwise(0.0).alias(f"a{k}"),
            F.when(F.col("rn") > 0, F.col("r") / (F.col("rn") + F.col("rt"))).otherwise(0.0).alias(f"r{k}"),
        )
        rest = contexts.select(
            "context",
            F.when(F.col("an") > 0, F.col("at") / (F.col("an") + F.col("at"))).otherwise(1.0).alias(f"ab{k}"),
            F.when(F.col("rn") > 0, F.col("rt") / (F.col("rn") + F.col("rt"))).otherwise(1.0).alias(f"rb{k}"),
        )
        out.append((own, rest))
    return out


def ratio_scores(urls: DataFrame, models: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Log-likelihood difference per symbol, accepted over rejected, of each row of ``urls``.

    ``urls`` has __folded and the columns that name a row, which must be unique. The probability of
    a symbol mixes all orders: the longest context as far as it was seen, the rest by shorter ones,
    in the end 1/``SYMBOLS``. All model tables are broadcast; the fold bounds them.
    """
    rows = positions(urls)
    keys = [c for c in rows.columns if c != "__gram"]
    pa = pr = F.lit(1.0 / SYMBOLS)
    # rows of a distinct gram share their probabilities, a table bounded like the models
    grams = rows.select("__gram").distinct()
    for k, (own, rest) in enumerate(models):
        gram = F.substring("__gram", ORDER + 1 - k, k + 1)
        context = F.substring("__gram", ORDER + 1 - k, k) if k else F.lit("")
        grams = grams.join(F.broadcast(own), gram == F.col("gram"), "left").drop("gram")
        grams = grams.join(F.broadcast(rest), context == F.col("context"), "left").drop("context")
        pa = F.coalesce(f"a{k}", F.lit(0.0)) + F.coalesce(f"ab{k}", F.lit(1.0)) * pa
        pr = F.coalesce(f"r{k}", F.lit(0.0)) + F.coalesce(f"rb{k}", F.lit(1.0)) * pr
    ratios = grams.select("__gram", (F.ln(pa) - F.ln(pr)).alias("__ratio"))
    # the sum of rounded integers does not depend on the order of the rows
    micro = F.round(F.col("__ratio") * 1e6).cast("long")
    return (
        rows.join(F.broadcast(ratios), "__gram")
        .groupBy(*keys)
        .agg((F.sum(micro) / F.count(F.lit(1)) / 1e6).alias("score"))
    )


def threshold(scored: DataFrame) -> DataFrame:
    """The score from which on to accept, as one row (threshold): the least balanced error.

    ``scored`` has score, __accepted and __weight. Scores are counted in bins of ``WIDTH`` within
    ``REACH``. Without rows of both classes the threshold is 0.
    """
    bin_ = F.round(F.greatest(F.least(F.col("score"), F.lit(REACH)), F.lit(-REACH)) / WIDTH).cast("int")
    bins = scored.groupBy(bin_.alias("bin")).agg(
        F.sum(F.when(F.col("__accepted"), F.col("__weight")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("__accepted"), 0).otherwise(F.col("__weight"))).alias("r"),
    )
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wrong = bins.select(
        "bin",
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("a"),
        (F.sum("r").over(everything) - F.coalesce(F.sum("r").over(below), F.lit(0))).alias("r"),
        F.sum("a").over(everything).alias("an"),
        F.sum("r").over(everything).alias("rn"),
    ).where("an > 0 AND rn > 0")
    error = F.col("a") / F.col("an") + F.col("r") / F.col("rn")
    # of equal errors the bin nearest 0
    best = wrong.agg(F.min_by("bin", F.struct(error, F.abs("bin"), F.col("bin"))).alias("bin"))
    return best.select(F.coalesce((F.col("bin") - 0.5) * WIDTH, F.lit(0.0)).alias("threshold"))


def judge(pages: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """``pages`` with host, path, rule, score, threshold and verdict (``allow`` or ``block``).

    URLs that a rule decides are the labels: variable-order Markov models of the accepted and the
    rejected ones learn from ``FOLDS`` - 1 folds of them (by crc32 of the URL) and the remaining fold sets the
    threshold. Every other URL is accepted if its length-normalised log-likelihood difference
    reaches the threshold. URLs are counted by their number of rows and scored once each.

    A null URL and one without ``://`` have an empty host and path and are judged by the models as
    the text they are (null as empty). With no accepted or no rejected label the score is compared
    to 0; with no labels at all every score is 0 and the verdict is allow. Repeated rows are judged
    alike; no rows give no rows. Input columns named as the results are replaced.
    """
    own = ("host", "path", "rule", "verdict", "score", "threshold")
    columns = [c for c in pages.columns if c.lower() not in own]
    host, path = url_parts()
    rows = pages.select(*columns).withColumn("host", host).withColumn("path", path)
    rows = rows.withColumn("__rule", longest_rule(rules, F.col("host"), F.col("path")))
    rows = rows.withColumn("__url", F.coalesce("url", F.lit("")))
    urls = rows.groupBy("__url").agg(
        F.count(F.lit(1)).alias("__weight"), F.first("__rule.verdict").alias("__verdict")
    )
    urls = urls.withColumn("__folded", folded("__url"))
    labelled = urls.where(F.col("__verdict").isNotNull()).withColumn("__accepted", F.col("__verdict") == "allow")
    fold = F.crc32(F.col("__url").cast("binary")) % FOLDS
    models = mixing_rates(class_models(labelled.where(fold != HELD)))
    held = ratio_scores(
        labelled.where(fold == HELD).select("__url", "__folded", "__accepted", "__weight"), models
    )
    limit = threshold(held)
    open_urls = urls.where(F.col("__verdict").isNull()).select("__url", "__folded")
    scores = ratio_scores(open_urls, models)
    # a key only for rows that no rule decided
    rows = rows.withColumn("__open", F.when(F.col("__rule").isNull(), F.col("__url")))
    scored = lookup(rows, scores.withColumnRenamed("__url", "__open"), "__open", F.xxhash64("__url", "page_id"))
    scored = scored.withColumn("threshold", F.when(F.col("__rule").isNull(), limit.scalar()))
    method = F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")
    return scored.select(
        *columns, "host", "path", F.col("__rule.rule").alias("rule"), "score", "threshold",
        F.coalesce(F.col("__rule.verdict"), method).alias("verdict"),
    )
