"""URL filter: rules, then gradient-boosted trees on lexical features, in DataFrame and SQL functions only.

Rules decide where they fit; the urls they decide are the labelled ones, and a bounded sample of these (SAMPLE urls, those with the
smallest hashes) trains the trees that decide the rest.  Features: lengths of url, host and path, depth, host labels, digits
by length, entropy of the characters, number of parameters, hyphens, fragment, and statistics of the host's suffix: how
often the sample's urls with that suffix are blocked, drawn to the whole sample's share, and how many there are.

Cases: null urls and urls without ``://`` have an empty host and path, fit no rule and are decided by the trees like any other;
without labelled urls of both kinds the rest gets the one label there is, or allow; ties between rules of one length go
to block; repeated rows are decided each; an empty table gives an empty result; extra columns are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graphs import cut, smallest_hashes
from .words import ascii_lower

#: Production rules: (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
SAMPLE = 20_000
FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_share", "entropy", "parameters", "hyphens", "fragment", "suffix_share", "suffix_count")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does.  The rules are a list in the plan, not a table."""
    order = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block", r[1]))

    def fits(rule: str) -> Column:
        own, slash, rest = rule.partition("/")
        return ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))

    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in reversed(order):
        text, verdict = F.when(fits(rule), F.lit(rule)).otherwise(text), F.when(fits(rule), F.lit(kind)).otherwise(verdict)
    return text, verdict


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    count = lambda text, c: (F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))).cast("double")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n
    kinds = F.array_distinct(F.split(url, ""))
    entropy = F.aggregate(F.filter(kinds, lambda c: c != ""), F.lit(0.0), lambda sum_, c: sum_ - share(c) * F.log2(share(c)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": F.size(F.filter(F.split(path, "/"), lambda s: s != "")).cast("double"),
        "labels": count(host, ".") + 1,
        "digit_share": F.length(F.regexp_replace(url, "[^0-9]", "")) / n,
        "entropy": entropy,
        "parameters": F.when(query == "", F.lit(0.0)).otherwise(count(query, "&") + 1),
        "hyphens": count(url, "-") + count(url, "_"),
        "fragment": F.contains(url, F.lit("#")).cast("double"),
    }


def judge_urls(pages: DataFrame, rules=RULES, sample: int = SAMPLE, trees: int = 10, depth: int = 4, seed: int = 11) -> DataFrame:
    """``pages`` with host, path, rule, verdict and block_score; input columns of these names are replaced."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "block_score")]
    host, path = url_parts(F.col("url"))
    d = pages.select(*kept).withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    d = d.withColumns({"rule": rule, "_uf_rule": verdict})
    known = d.where(F.col("_uf_rule").isNotNull()).select("url", "host", "path", (F.col("_uf_rule") == "block").cast("double").alias("label"))
    known = cut(smallest_hashes(known, ["url"], ["url"], sample))
    total, blocked = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < blocked < total:
        only = "block" if total and blocked else "allow"
        d = d.withColumn("block_score", F.lit(1.0 if only == "block" else 0.0))
        return d.select(*kept, "host", "path", "rule", F.coalesce("_uf_rule", F.lit(only)).alias("verdict"), "block_score")
    suffix = F.element_at(F.split("host", r"\."), -1)
    share = (F.sum("label") + 10 * blocked / total) / (F.count(F.lit(1)) + 10)
    by_suffix = known.groupBy(suffix.alias("_uf_suffix")).agg(share.alias("suffix_share"), F.log1p(F.count(F.lit(1))).alias("suffix_count"))

    def featured(df: DataFrame) -> DataFrame:
        df = df.withColumn("_uf_suffix", suffix).join(F.broadcast(by_suffix), "_uf_suffix", "left")  # `sample` rows at most
        new = {k: v for k, v in lexical(F.col("url"), F.col("host"), F.col("path")).items()}
        new |= {"suffix_share": F.coalesce("suffix_share", F.lit(blocked / total)), "suffix_count": F.coalesce("suffix_count", F.lit(0.0))}
        return df.withColumn("_uf", F.struct(*[c.alias(n) for n, c in new.items()])).drop("suffix_share", "suffix_count", "_uf_suffix")

    names = [f"_uf_{n}" for n in FEATURES]
    wide = lambda df: VectorAssembler(inputCols=names, outputCol="_uf_x").transform(featured(df).withColumns({n: F.col(f"_uf.{n[4:]}") for n in names}))
    learner = GBTClassifier(featuresCol="_uf_x", labelCol="label", maxIter=trees, maxDepth=depth, seed=seed)
    model = learner.fit(wide(known).select("_uf_x", "label").coalesce(1))
    weights = model.treeWeights
    margin = reduce(lambda a, b: a + b, [F.lit(w) * _tree(t) for w, t in zip(weights, model.trees, strict=True)])
    scored = featured(d).withColumn("block_score", 1 / (1 + F.exp(-2 * margin)))
    return scored.select(*kept, "host", "path", "rule", F.coalesce("_uf_rule", F.when(F.col("block_score") > 0.5, "block").otherwise("allow")).alias("verdict"), "block_score")


def _tree(tree) -> Column:
    """A trained tree as a CASE expression over the features, so that scoring stays in generated code."""

    def at(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.prediction()))
        split = node.split()
        return F.when(F.col(f"_uf.{FEATURES[split.featureIndex()]}") <= F.lit(float(split.threshold())), at(node.leftChild())).otherwise(at(node.rightChild()))

    return at(tree._call_java("rootNode"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")
