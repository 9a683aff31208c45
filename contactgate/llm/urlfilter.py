"""URL filter: host and path rules, and gradient-boosted trees for all other URLs.

Rules decide the URLs they fit (the longest rule wins).  Those URLs are the
labelled ones: boosted regression trees (``pyspark.ml``) are trained on their
lexical features and judge the rest.  Features are the lengths of URL, host and
path, depth, digit ratios, character entropy of host and path, parameter counts,
label and hyphen counts, and statistics of the host's suffix: its share of
all URLs, the mean length and depth of its URLs.

Only DataFrame functions and the JVM's tree learner run here.  The trees are
fitted on a bounded sample, about ``max_training_rows`` labelled URLs chosen by
their hash; suffix statistics cover every URL.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, materialized

#: (verdict, rule): host (with its subdomains), then the start of the path
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
MAX_TRAINING_ROWS = 20_000
TREES, DEPTH = 10, 4
TRAINING_PARTITIONS = 4
SUFFIX_BROADCAST_ROWS = 10_000      # rows of a host label and three numbers
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, F.lit("://"))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, start = rule.partition("/")
        fits = ((host_col == name) | F.endswith(host_col, F.lit("." + name))) & F.startswith(path_col, F.lit("/" + start))
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text).cast("double")
    chars = F.array_distinct(F.split(text, ""))
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0),
                                     lambda acc, c: acc - share(c) * F.log2(share(c)))).otherwise(0.0)


def lexical(urls: DataFrame) -> tuple[DataFrame, list[str]]:
    """``urls`` (columns url, host, path) with lexical feature columns; their names."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    length = lambda c: F.length(c).cast("double")
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    made = {
        "url_length": length(url), "host_length": length(F.col("host")), "path_length": length(F.col("path")),
        "depth": _count(F.col("path"), "/"), "labels": _count(F.col("host"), ".") + 1,
        "hyphens": _count(F.col("host"), "-"), "dots_in_path": _count(F.col("path"), "."),
        "digit_ratio": share(_count(url, "0123456789"), length(url)),
        "host_digit_ratio": share(_count(F.col("host"), "0123456789"), length(F.col("host"))),
        "host_entropy": _entropy(F.col("host")), "path_entropy": _entropy(F.col("path")),
        "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
        "query_length": length(query), "fragment": F.contains(url, F.lit("#")).cast("double"),
        "secure": F.startswith(F.lower(url), F.lit("https:")).cast("double"),
    }
    return urls.withColumns(made), list(made)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          max_training_rows: int = MAX_TRAINING_ROWS, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, block_score``.

    ``rule`` is null where the trees decided; ``block_score`` is 1 or 0 for rules and
    the trees' probability of ``block`` otherwise (block from 0.5).  A null url or one
    without ``://`` has an empty host and path and is judged by the trees; if the
    labelled URLs are all of one verdict, the rest gets that verdict, if there are none,
    ``allow``.  Repeated rows stay repeated; other columns are not read; an empty
    table gives no rows."""
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    urls = urls.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    urls = urls.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    rows, names = lexical(urls.withColumn("suffix", F.substring_index("host", ".", -1)))
    rows = materialized(rows)
    whole = rows.count()
    suffixes = rows.groupBy("suffix").agg(
        (F.count(F.lit(1)) / F.lit(float(max(1, whole)))).alias("suffix_share"), F.avg("url_length").alias("suffix_length"),
        F.avg("depth").alias("suffix_depth"))
    suffixes = materialized(suffixes)
    extra = ["suffix_share", "suffix_length", "suffix_depth"]
    # few distinct suffixes in practice, but no bound: broadcast only if counted to be few
    few = suffixes.limit(SUFFIX_BROADCAST_ROWS + 1).count() <= SUFFIX_BROADCAST_ROWS
    rows = rows.join(F.broadcast(suffixes) if few else suffixes, "suffix")
    ready = VectorAssembler(inputCols=names + extra, outputCol="features").transform(rows)
    labelled = (ready.where("found IS NOT NULL")
                .select("features", (F.col("found.verdict") == "block").cast("double").alias("label"), "url", "page_id"))
    sample = materialized(bounded_sample(labelled, max_training_rows, "url", "page_id")
                          .select("features", "label").coalesce(TRAINING_PARTITIONS))
    known = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(known) == 2:
        learner = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, seed=7)
        scored = learner.fit(sample).transform(ready).withColumn("p", vector_to_array("probability")[1])
    else:
        scored = ready.withColumn("p", F.lit(1.0 if known == {1.0} else 0.0))
    blocked = F.when(F.col("found").isNull(), F.col("p")).otherwise((F.col("found.verdict") == "block").cast("double"))
    return scored.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("p") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        blocked.alias("block_score"))
