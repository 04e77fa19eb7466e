"""URL verdicts: longest matching rule, else gradient-boosted trees over lexical features.

Trees grow level by level: one aggregation gives the gradient sums of all (node, feature, bin) cells, the driver picks the
splits from these few rows, and the trees become one conditional expression. Only column functions run on the executors.

Labelled URLs come as a table; at most ``sample`` of them train. The query uses the URLs that the rules decide.

Defined cases: a null url, or one without ``://``, has an empty host and path and meets no rule; user info and port count
as parts of the host, as written; equal long rules: the first given; without labels of both classes the trees allow all.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicweave.llm.common import bounded_sample, characters_in
from topicweave.session import materialize


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith(F.col("host"), F.lit("." + self.host))
        return host & F.startswith(F.col("path"), F.lit(self.path))


#: Fixed values of the contract.
RULES = (
    UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/"),
)

FEATURES = (
    "url_length", "host_length", "host_labels", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "suffix_urls", "suffix_share",
)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_parts(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` beside the other columns."""
    url = F.coalesce(F.col("url"), F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", _lower(host)).withColumn("path", path)


def longest_rule(rules: Sequence[UrlRule] = RULES) -> Column:
    """The rule that fits, as ``struct(rule, verdict)``; the longest one where several do."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.name)):
        out = F.when(r.fits(), F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def with_features(parts: DataFrame) -> DataFrame:
    """Lexical features of ``url``, ``host`` and ``path``; suffix statistics count all URLs of the last two host labels."""
    url = F.coalesce(F.col("url"), F.lit(""))
    chars = F.array_remove(F.split("host", ""), "")
    counts = F.transform(F.array_distinct(chars), lambda c: F.length("host") - F.length(F.replace(F.col("host"), c)))
    entropy = F.aggregate(counts, F.lit(0.0), lambda s, n: s - n / F.length("host") * F.log2(n / F.length("host")))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return parts.select(
        "*", F.substring_index("host", ".", -2).alias("suffix"),
        F.length(url).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.size(F.array_remove(F.split("host", "\\."), "")).cast("double").alias("host_labels"),
        F.size(F.array_remove(F.split("path", "/"), "")).cast("double").alias("depth"),
        F.coalesce(F.try_divide(characters_in(url, "0123456789").cast("double"), F.length(url)), F.lit(0.0)).alias("digit_ratio"),
        F.coalesce(entropy, F.lit(0.0)).alias("entropy"),
        F.size(F.array_remove(F.split(query, "&"), "")).cast("double").alias("parameters"),
        characters_in(F.col("host"), "-_").cast("double").alias("hyphens"),
    )


def suffix_statistics(rows: DataFrame) -> DataFrame:
    """``suffix, suffix_urls, suffix_share``: the logarithm of a suffix's URLs, and its share of distinct hosts."""
    hosts = rows.groupBy("suffix", "host").agg(F.count("*").alias("n"))
    return hosts.groupBy("suffix").agg(
        F.log1p(F.sum("n")).alias("suffix_urls"), (F.count("*") / F.sum("n")).alias("suffix_share"))


@dataclass(frozen=True)
class Boosting:
    trees: int = 10
    depth: int = 3
    rate: float = 0.3
    bins: int = 12
    ridge: float = 1.0
    sample: int = 20_000


@dataclass
class Split:
    feature: str = ""
    threshold: float = 0.0
    below: "Split | None" = None
    above: "Split | None" = None
    value: float = 0.0

    def column(self) -> Column:
        if self.below is None:
            return F.lit(self.value)
        return F.when(F.col(self.feature) <= self.threshold, self.below.column()).otherwise(self.above.column())


@dataclass
class UrlTrees:
    base: float = 0.0
    trees: list[Split] = field(default_factory=list)

    def margin(self) -> Column:
        return reduce(lambda a, b: a + b, [t.column() for t in self.trees], F.lit(self.base))


def boost(rows: DataFrame, features: Sequence[str], label: str, how: Boosting = Boosting()) -> UrlTrees:
    """Trees whose margin is above 0 where ``label`` is likelier true than false; without labels of both classes there is nothing to
    tell apart and the margin is below 0. ``rows`` is read once for each level."""
    marks = F.array(*[F.lit(i / how.bins) for i in range(how.bins + 1)])
    stats = rows.agg(
        F.count_if(label).alias("p"), F.count("*").alias("n"), *[F.percentile_approx(f, marks, 10_000).alias(f) for f in features]).collect()[0]
    model = UrlTrees()
    if not 0 < stats["p"] < stats["n"]:
        model.base = -1.0
        return model
    model.base = math.log(stats["p"] / (stats["n"] - stats["p"]))
    cuts = {f: [(a + b) / 2 for a, b in zip(v, v[1:])] for f in features if len(v := sorted(set(stats[f]))) > 1}
    if not cuts:
        return model
    bin_of = [
        F.struct(F.lit(f).alias("f"), reduce(lambda a, b: a + b, [(F.col(f) > c).cast("int") for c in cut]).alias("b")) for f, cut in cuts.items()
    ]
    for _ in range(how.trees):
        tree = Split()
        p = 1 / (1 + F.exp(-model.margin()))
        graded = rows.select(*features, (p - F.col(label).cast("double")).alias("_g"), (p * (1 - p)).alias("_h"))
        open_, place = {0: tree}, F.lit(0)
        for _ in range(how.depth):
            cells = graded.select(place.alias("node"), F.explode(F.array(*bin_of)).alias("cell"), "_g", "_h")
            sums: dict = {}
            for r in cells.where("node >= 0").groupBy("node", "cell").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h")).collect():
                sums.setdefault(r["node"], {}).setdefault(r["cell"]["f"], {})[r["cell"]["b"]] = (r["g"], r["h"])
            following, chosen = {}, F.lit(-1)
            for node, split in open_.items():
                best = _best_split(sums.get(node, {}), cuts, how)
                if best is None:
                    continue
                split.feature, split.threshold, low, high = best
                split.below, split.above = Split(value=low), Split(value=high)
                following |= {2 * node + 1: split.below, 2 * node + 2: split.above}
                chosen = F.when(place == node, F.when(F.col(split.feature) <= split.threshold, 2 * node + 1).otherwise(2 * node + 2)).otherwise(chosen)
            if not following:
                break
            open_, place = following, chosen
        model.trees.append(tree)
    return model


def _best_split(cells: dict, cuts: dict, how: Boosting) -> tuple[str, float, float, float] | None:
    """Feature, threshold and the values of both sides."""
    best, top = None, 1e-6
    for f, cut in cuts.items():
        bins = cells.get(f, {})
        g_all, h_all = sum(x for x, _ in bins.values()), sum(x for _, x in bins.values())
        g = h = 0.0
        for b, c in enumerate(cut):
            g, h = g + bins.get(b, (0, 0))[0], h + bins.get(b, (0, 0))[1]
            if min(h, h_all - h) < 1:
                continue
            g_rest, h_rest = g_all - g, h_all - h + how.ridge
            gain = g * g / (h + how.ridge) + g_rest * g_rest / h_rest - g_all**2 / (h_all + how.ridge)
            if gain > top * (1 + 1e-9):
                best, top = (f, c, -how.rate * g / (h + how.ridge), -how.rate * g_rest / h_rest), gain
    return best


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: Sequence[UrlRule] = RULES, how: Boosting = Boosting()) -> DataFrame:
    """``page_id, host, path, rule, verdict, block_margin`` for every row of ``pages (page_id, url)``.

    ``labelled (url, blocked)`` trains the trees; by default the URLs that a rule decides.
    """
    parts = with_features(with_parts(pages.select("page_id", "url"))).withColumn("_rule", longest_rule(rules))
    parts = materialize(parts, "urls")
    suffixes = materialize(suffix_statistics(parts), "suffixes")
    rows = parts.join(suffixes, "suffix")
    if labelled is None:
        known = rows.where("_rule is not null").withColumn("blocked", F.col("_rule.verdict") == "block")
    else:
        known = with_features(with_parts(labelled.select("url", "blocked"))).join(suffixes, "suffix", "left").fillna(0.0, ["suffix_urls", "suffix_share"])
    known = bounded_sample(known.where("blocked is not null").select("url", "blocked", *FEATURES), "url", how.sample)
    margin = boost(materialize(known.coalesce(4), "labelled-urls"), FEATURES, "blocked", how).margin()
    learned = F.when(F.col("_margin") > 0, "block").otherwise("allow")
    return rows.withColumn("_margin", margin).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), learned).alias("verdict"),
        F.col("_margin").alias("block_margin"))
