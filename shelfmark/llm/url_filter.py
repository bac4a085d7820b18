"""URL filters: rules first, then boosted trees on lexical features (operator 1).

A rule names a host with all its subdomains and the beginning of a path; of the
rules that fit, the longest decides. Urls that no rule fits are judged by
gradient-boosted trees on lexical features: lengths, depth, digit share,
character entropy, counts of parameters and marks, and the share of blocked urls
under the same host suffixes and first path segment. The shares come from all
different urls whose verdict the rules give and are pulled towards the overall
share where few urls stand behind them; the trees learn from at most ``SAMPLE``
of these urls.

All expressions run in the JVM. The tables of suffix shares grow with the input:
they are written and joined, without a hint, so that adaptive execution can split
a suffix with very many urls.

Edge cases: a null url or one without ``://`` has an empty host and path, fits
no rule and is judged by its features; without labelled urls of both kinds the
trees are constant and what no rule blocks is allowed. Rows are judged one by
one; a null page_id is passed on, extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .order_minhash import let
from .trees import BoostedTrees, fit_trees

# The rules of the query, verdict then host and path.
RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]

#: Bound on the labelled urls that are learnt from.
SAMPLE = 20_000
ROUNDS, DEPTH, SMOOTH = 15, 4, 20.0
BLOCK_FROM = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_rule(pages: DataFrame, rules: list[str]) -> DataFrame:
    """page_id, url, host, path, rule and its verdict (null where none fits).

    Rules are tried from the longest to the shortest, so a list is meant to have
    hundreds of them, not millions.
    """
    pages = pages.select("page_id", "url")
    host, path = host_and_path(F.col("url"))
    rows = pages.withColumn("host", host).withColumn("path", path)
    chosen = None
    for text in sorted(rules, key=lambda r: -len(r.split(" ", 1)[1])):
        verdict, pattern = text.split(" ", 1)
        rule_host, slash, rest = pattern.partition("/")
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(slash + rest)
        found = F.struct(F.lit(pattern).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, found) if chosen is None else chosen.when(fits, found)
    if chosen is None:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "ruled": F.lit(None).cast("string")})
    return rows.withColumn("chosen", chosen).select(
        "page_id", "url", "host", "path", F.col("chosen.rule").alias("rule"), F.col("chosen.verdict").alias("ruled")
    )


#: What is counted by value: last label, last two labels, first path segment.
STATISTICS = {
    "suffix1": "regexp_extract(host, '[^.]*$', 0)",
    "suffix2": "regexp_extract(host, '[^.]*[.]?[^.]*$', 0)",
    "segment": "regexp_extract(path, '^/([^/]*)', 1)",
}


def entropy(text: Column) -> Column:
    """Bits per character."""

    def of(chars: Column) -> Column:
        def part(total: Column, c: Column) -> Column:
            share = F.size(F.filter(chars, lambda x: x == c)) / F.size(chars)
            return total - share * F.log2(share)

        return F.aggregate(F.array_distinct(chars), F.lit(0.0), part)

    return F.coalesce(let(F.split(text, ""), of), F.lit(0.0))


def lexical(rows: DataFrame) -> DataFrame:
    """Rows with ``f_`` columns, all double and none null."""
    url = F.coalesce(F.col("url"), F.lit(""))

    def count(of: Column, pattern: str) -> Column:
        return F.length(of) - F.length(F.regexp_replace(of, pattern, ""))

    size = F.greatest(F.length(url), F.lit(1))
    features = {
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "labels": count(F.col("host"), r"\."), "depth": count(F.col("path"), "/"),
        "digits": count(url, "[0-9]") / size, "host_digits": count(F.col("host"), "[0-9]"),
        "longest_number": F.coalesce(F.array_max(F.transform(F.regexp_extract_all(url, F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)),
        "letters": count(url, r"\p{L}") / size, "hyphens": count(F.col("host"), "-"), "parameters": count(url, "="),
        "marks": count(url, "[?&#%]"), "secure": url.startswith("https://"), "entropy": entropy(url), "host_entropy": entropy(F.col("host")),
        "extension": F.length(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)),
    }
    return rows.withColumns({f"f_{name}": F.coalesce(value.cast("double"), F.lit(0.0)) for name, value in features.items()})


LEXICAL = [
    "length", "host_length", "path_length", "labels", "depth", "digits", "host_digits", "longest_number", "letters", "hyphens",
    "parameters", "marks", "secure", "entropy", "host_entropy", "extension",
]
FEATURES = [f"f_{n}" for n in LEXICAL] + [f"f_{n}_{w}" for n in STATISTICS for w in ("share", "count")]


@dataclass
class UrlModel:
    trees: BoostedTrees
    #: By statistic: (value, share, count) of the labelled urls, a row for each value.
    shares: dict[str, DataFrame]
    overall: float

    def features(self, rows: DataFrame) -> DataFrame:
        out = rows
        for name, expression in STATISTICS.items():
            out = out.withColumn(f"v_{name}", F.expr(expression)).join(self.shares[name], f"v_{name}", "left")
            out = out.withColumn(f"f_{name}_share", F.coalesce(f"{name}_share", F.lit(self.overall)))
            out = out.withColumn(f"f_{name}_count", F.coalesce(F.log1p(f"{name}_count"), F.lit(0.0)))
        return lexical(out)  # last, so that the joins move no features

    def score(self, rows: DataFrame) -> DataFrame:
        return self.features(rows).withColumn("score", self.trees.score([F.col(name) for name in FEATURES]))


def train_urls(ruled: DataFrame, sample: int = SAMPLE) -> UrlModel:
    """A model from (url, host, path, ruled) rows: shares from all labelled urls,
    trees from the ones with the least hashes."""
    labelled = (
        ruled.filter(F.col("ruled").isNotNull())
        .select("url", "host", "path", (F.col("ruled") == "block").cast("int").alias("label"))
        .distinct()
    )
    labelled = materialize(labelled, "labelled-urls")
    overall = labelled.agg(F.avg("label").alias("share")).first().share
    overall = 0.5 if overall is None else float(overall)
    shares = {}
    for name, expression in STATISTICS.items():
        shares[name] = materialize(
            labelled.groupBy(F.expr(expression).alias(f"v_{name}")).agg(
                ((F.sum("label") + SMOOTH * overall) / (F.count("*") + SMOOTH)).alias(f"{name}_share"),
                F.count("*").cast("double").alias(f"{name}_count"),
            ),
            f"urls-by-{name}",
        )
    model = UrlModel(BoostedTrees(()), shares, overall)
    chosen = materialize(labelled.orderBy(F.xxhash64("url"), "url").limit(sample), "sampled-urls")
    rows = materialize(model.features(chosen).select("label", *FEATURES), "url-features")
    model.trees = fit_trees(rows, FEATURES, "label", ROUNDS, DEPTH)
    return model


def judge_urls(pages: DataFrame, rules: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' score of every url."""
    ruled = with_rule(pages, RULES if rules is None else rules)
    scored = train_urls(ruled, sample).score(ruled)
    by_score = F.when(F.col("score") > BLOCK_FROM, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score")
