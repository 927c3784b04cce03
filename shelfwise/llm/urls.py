"""URL filter: host and path rules, and a character language-model ratio where no rule fits.

URLs that a rule decides train two variable-order Markov models of characters, one of accepted and one
of rejected URLs, over the whole URL with its query string. Contexts of up to four characters are
interpolated (Witten-Bell): each order is mixed with the next shorter one by how many different
characters followed the context. The difference of the log-likelihoods per character is calibrated with
the scores of decided URLs that the models have not seen. All work is DataFrame operations; model
tables have a row per distinct run of characters.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.scratch import stored

ORDER = 4
#: (verdict, host, path): rules of the filter.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
ALPHABET = 256  # characters that an unseen one is taken from
FOLDS = 4  # one decided URL of so many is kept for the calibration


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for URLs without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def whole_url(url: Column) -> Column:
    """What the models read: all of the URL, the host in lower case; empty for null."""
    at = F.locate("://", url)
    host = host_and_path(url)[0]
    tail = F.substring(url, at + 3 + F.length(host), F.length(url))
    return F.coalesce(F.when(at > 0, F.concat(F.substring(url, F.lit(1), at + 2), host, tail)).otherwise(url), F.lit(""))


def held_out(text: Column) -> Column:
    """URLs that the models are not fitted on."""
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)) == 0


def windows_of(text: Column, order: int) -> Column:
    """Each character and the end with the ``order`` characters before, in time linear in the text. The characters
    are bound as a variable, so that the text is split once and not for each window."""
    chars = F.split(F.concat(F.lit("\x02" * order), text, F.lit("\x03")), "")

    def cut(c: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(c) - order - 1), lambda i: F.concat(*(F.get(c, i + k) for k in range(order + 1))))

    return F.get(F.transform(F.array(chars), cut), F.lit(0))


def _fits(host: str, path: str) -> Column:
    return ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)


def _decided(rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        rule = F.when(_fits(host, path), F.lit(host + path)).otherwise(rule)
        verdict = F.when(_fits(host, path), F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _model(windows: DataFrame, order: int) -> DataFrame:
    """Log-probability ratio of the last character of each window (``order + 1`` characters).

    ``windows``: window, allow, block (how often accepted and rejected URLs hold it).
    """
    kinds = ("allow", "block")
    shorter = None
    for k in range(order + 1):
        gram = F.expr(f"right(window, {k + 1})")
        grams = windows.groupBy(gram.alias("gram")).agg(*(F.sum(c).alias(c) for c in kinds))
        context = F.expr(f"left(gram, {k})")
        contexts = grams.groupBy(context.alias("context")).agg(
            *(F.sum(c).alias(f"{c}_all") for c in kinds), *(F.count_if(F.col(c) > 0).alias(f"{c}_kinds") for c in kinds)
        )
        rows = grams.withColumn("context", context).join(contexts, "context")
        if shorter is None:
            rows = rows.select("*", *(F.lit(1 / ALPHABET).alias(f"{c}_less") for c in kinds))
        else:
            less = shorter.select(F.col("gram").alias("suffix"), *(F.col(f"{c}_p").alias(f"{c}_less") for c in kinds))
            rows = rows.withColumn("suffix", F.expr(f"right(gram, {k})")).join(less, "suffix")
        p = [
            F.when(F.col(f"{c}_all") == 0, F.col(f"{c}_less"))
            .otherwise((F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_less")) / (F.col(f"{c}_all") + F.col(f"{c}_kinds")))
            .alias(f"{c}_p")
            for c in kinds
        ]
        shorter = rows.select("gram", *p)
    return shorter.select(F.col("gram").alias("window"), (F.ln("allow_p") - F.ln("block_p")).alias("ratio"))


def judge_urls(
    pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, order: int = ORDER,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, score (calibrated log-odds of acceptance) for every row.

    Null URLs and those without ``://`` have an empty host and path; null is judged as an empty string.
    Rows without an id, or that repeat one, come back like others. Where the rules decide no URL, or only
    accepted or only rejected ones, the score is 0 and means acceptance.
    """
    url = F.col(url_col).cast("string")
    host, path = host_and_path(url)
    rule, verdict = _decided(rules)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), whole_url(url).alias("text"))
    # Windows carry a short key, not the URL.
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key")
    rows = rows.select("page_id", "host", "path", key, "text", rule.alias("rule"), verdict.alias("ruled"))
    texts = rows.groupBy("key").agg(
        F.first("text").alias("text"), F.count_if(F.col("ruled") == "allow").alias("allow"), F.count_if(F.col("ruled") == "block").alias("block")
    )
    # A few bytes of URLs make many windows: a shuffle of its own, whose tasks are not merged for being small.
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = texts.repartition(tasks, "text").select("key", "text", "allow", "block", held_out(F.col("text")).alias("held"))
    cut = texts.select("key", "allow", "block", "held", F.explode(windows_of(F.col("text"), order)).alias("window"))
    seen = [F.sum(F.when(~F.col("held"), F.col(c)).otherwise(0)).alias(c) for c in ("allow", "block")]
    windows = stored(cut.groupBy("window").agg(*seen), "windows")
    ratios = stored(_model(windows, order), "ratios")
    scored = stored(
        cut.join(ratios, "window").groupBy("key").agg(
            F.avg("ratio").alias("raw"), *(F.first(c).alias(c) for c in ("allow", "block", "held"))
        ),
        "url-scores",
    )
    slope, shift = _calibration(scored)
    # A plain line: the log-odds between two normal distributions with a common variance.
    score = F.lit(slope) * F.col("raw") + F.lit(shift)
    judged = rows.join(scored.select("key", score.alias("score")), "key", "left")
    own = F.when(F.coalesce("score", F.lit(0.0)) >= 0, "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score")


def _calibration(scored: DataFrame) -> tuple[float, float]:
    """From the sums of one row: of decided URLs that were held out, or of all where those lack a kind."""
    sums = [
        F.sum(F.when(chosen, F.col(c) * F.col("raw") ** p)).alias(f"{name}{c}{p}")
        for name, chosen in (("held_", F.col("held")), ("", F.lit(True))) for c in ("allow", "block") for p in (0, 1, 2)
    ]
    n = scored.agg(*sums).first().asDict()
    if n["held_allow0"] and n["held_block0"]:
        n = {k.removeprefix("held_"): v for k, v in n.items() if k.startswith("held_")}
    if not n["allow0"] or not n["block0"]:
        return 0.0, 0.0
    means = {c: n[f"{c}1"] / n[f"{c}0"] for c in ("allow", "block")}
    spread = sum(n[f"{c}2"] - n[f"{c}0"] * means[c] ** 2 for c in means) / (n["allow0"] + n["block0"])
    slope = (means["allow"] - means["block"]) / max(spread, 1e-9)
    middle = (means["allow"] + means["block"]) / 2
    return (slope, -slope * middle) if math.isfinite(slope) else (0.0, 0.0)
