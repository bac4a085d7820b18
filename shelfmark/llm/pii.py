"""Personal data: candidates judged by boosted trees (operator 6, native).

Per kind (email, ip, card, phone) two patterns run over a text. The base pattern
with its validity rule gives spans that are always kept. A wider generator
proposes all that might be of the kind, valid or not. For ip, card and phone it
finds whole runs of digit groups, of any length, and proposes every stretch of a
run from the begin of one group to the end of another that is within ``STRETCH``,
so proposals overlap within a kind as well as across kinds, and a number beside
other numbers is a proposal of its own. Emails have one proposal at a place.
Boosted trees see a proposal's format (length,
digits, groups, separators, repeated characters) and context (characters before
and after, what the text just before says), but not the validity rules, so a
mistyped card number looks like a card. They are fitted to tell proposals that
hold a valid span of their kind from the others, on a sample of at most
``SAMPLE`` documents. A threshold for each kind is calibrated on all rows that
the trees were not fitted on: the least score above which the precision's lower confidence bound
reaches ``PRECISION``; where none does, the kind gets no added spans. Of
overlapping additions the one with the highest score stays, and none overlaps a
base span.

Everything is JVM expressions, no Python: one pass over all texts to calibrate, of
which only counts by kind and percent are shuffled, and one to find spans.
Places are code points, ends are exclusive.

Edge cases: null and empty texts have no spans; patterns are possessive, so
runs of any length match without backtracking; without candidates in the sample
only base spans are found. Rows are judged one by one, so repeated rows repeat
their result and extra columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .order_minhash import let
from .trees import BoostedTrees, fit_trees

KINDS = ["email", "ip", "card", "phone"]

# The base patterns, written so that they match the same spans
# without backtracking. \G lets a match begin where the last one ended.
NAME = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{NAME})){NAME}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Wider generators: emails, and the runs of digit groups of the other kinds.
#: What they find need not be valid.
GENERATORS = {
    "email": r"(?<![^\x00-\x20\"'<>(),;:])[^\x00-\x20@\"'<>(),;:]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[^\x00-\x20@\"'<>(),;:]{3,255}+",
    "ip": r"(?<![0-9])[0-9]++(?:[.,][0-9]++){2,}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){7,}+",
    "phone": r"(?:\+|00|\()?[0-9](?:[\x20()./-]{0,3}[0-9]){5,}+",
}

#: A group of a run, and the least and the most that a stretch of one has: groups
#: of an ip, digits of a card or phone.
GROUPS = {"ip": r"[0-9]++", "card": r"[0-9]++", "phone": r"[+(]?[0-9]++"}
STRETCH = {"ip": (3, 10), "card": (8, 30), "phone": (6, 20)}

#: Bound on the documents whose candidates the trees are fitted on.
SAMPLE = 20_000
ROUNDS, DEPTH = 12, 3
PRECISION = 0.95
CONTEXT = 24


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> of a pattern's matches in a text.

    Splitting at the matches gives the gaps between them, so places are sums of
    lengths and no text is searched again.
    """
    empty = F.lit(None).cast("array<struct<start:int,end:int,match:string>>")

    def placed(found: Column) -> Column:
        gaps, hits = found["gaps"], found["hits"]

        def step(done: Column, i: Column) -> Column:
            start = done["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(hits, i))
            span = F.struct(start.alias("start"), end.alias("end"), F.get(hits, i).alias("match"))
            return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out"))
        every = F.sequence(F.lit(0), F.size(hits) - 1)
        return F.aggregate(every, begin, step, lambda done: done["out"])

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    found = F.when(text.rlike(pattern), let(both, placed)).otherwise(empty)
    return F.coalesce(found, F.array().cast("array<struct<start:int,end:int,match:string>>"))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(number: Column) -> Column:
    """Whether a string of digits passes the check of card numbers."""

    def weigh(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(number, F.length(number) - i, F.lit(1))) - 48
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), weigh, lambda total: total % 10 == 0)


def valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: part.rlike(r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))
    if kind == "card":
        return let(digits(match), lambda d: F.length(d).between(13, 19) & F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False)))
    return F.length(digits(match)).between(9, 15)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(spans(text, BASE[kind]), lambda s: valid(kind, s["match"]))


FEATURES = [
    "kind", "length", "digits", "letters", "upper", "groups", "longest", "dots", "dashes", "blanks", "brackets", "at",
    "plus", "slashes", "distinct", "last_letters", "before_word", "before_blank", "before_equals", "after_word", "after_blank", "number_word",
]


def _features(kind: str, match: Column, before: Column, after: Column) -> list[Column]:
    """Format and context of a candidate, in the order of ``FEATURES``."""

    def count(pattern: str) -> Column:
        return F.length(match) - F.length(F.regexp_replace(match, pattern, ""))

    groups = F.filter(F.split(match, "[^0-9]+"), lambda g: g != "")
    near, far = F.substring(before, -1, 1), F.substring(after, 1, 1)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    plain = [
        F.lit(float(KINDS.index(kind))), F.length(match), count("[0-9]"), count(r"\p{L}"), count(r"\p{Lu}"), F.size(groups),
        F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), count(r"\."), count("-"), count(" "), count(r"[()]"),
        count("@"), count(r"\+"), count("/"), F.size(F.array_distinct(F.split(match, ""))),
        F.length(F.regexp_extract(match, r"\.(\p{L}+)$", 1)),
        flag(near.rlike(r"[\p{L}\p{N}_]")), flag(near.rlike(r"\s") | (near == "")), flag(before.rlike(r"[=:][\s\"]*$")),
        flag(far.rlike(r"[\p{L}\p{N}_]")), flag(far.rlike(r"\s") | (far == "")),
        flag(F.lower(before).rlike(r"(tel|phone|fax|call|mobile|card|visa|mail|ip|addr|host)\W*$")),
    ]
    return [c.cast("double") for c in plain]


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def stretches(run: Column, kind: str) -> Column:
    """array<struct<start, end, match>>: the stretches of a run of digit groups."""
    least, most = STRETCH[kind]

    def of(groups: Column) -> Column:
        def ending(end: Column, begin: Column) -> Column:
            match = F.substring(run["match"], begin["start"] + 1, end["end"] - begin["start"])
            return F.struct((run["start"] + begin["start"]).alias("start"), (run["start"] + end["end"]).alias("end"), match.alias("match"))

        def beginning(begin: Column, i: Column) -> Column:
            if kind == "ip":
                return F.transform(F.slice(groups, i + least, most - least + 1), lambda end: ending(end, begin))
            # No stretch has more groups than digits.
            all_of_it = F.transform(F.slice(groups, i + 1, most), lambda end: ending(end, begin))
            return F.filter(all_of_it, lambda c: F.length(F.translate(c["match"], " ()./-+", "")).between(least, most))

        return F.flatten(F.transform(groups, beginning))

    return let(spans(run["match"], GROUPS[kind]), of)


def proposals(text: Column, kind: str, taken: Column | None = None) -> Column:
    """array<struct<start, end, match>>: all that might be of a kind, or of it what
    overlaps none of the spans ``taken``."""
    found = spans(text, GENERATORS[kind])

    def free(run: Column) -> Column:
        whole = F.array(run) if kind == "email" else stretches(run, kind)
        if taken is None:
            return whole
        near = F.filter(taken, lambda b: overlaps(b, run))
        return let(near, lambda few: F.filter(whole, lambda c: ~F.exists(few, lambda b: overlaps(b, c))))

    return F.flatten(F.transform(found, free))


def described(text: Column, kind: str, span: Column) -> Column:
    """Format and context features of a proposal."""
    before = F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, F.least(span["start"], F.lit(CONTEXT)))
    after = F.substring(text, span["end"] + 1, F.lit(2))
    return F.array(*_features(kind, span["match"], before, after))


def with_base(docs: DataFrame) -> DataFrame:
    """Rows with ``base``, a field for each kind."""
    return docs.withColumn("base", F.struct(*[base_spans(F.col("text"), kind).alias(kind) for kind in KINDS]))


def with_candidates(docs: DataFrame) -> DataFrame:
    """Rows with ``base`` and ``candidates``: place, format and context features,
    and whether a base span of the kind lies within."""
    text = F.col("text")

    def of(kind: str) -> Column:
        def one(span: Column) -> Column:
            holds = F.exists(f"base.{kind}", lambda b: (b["start"] >= span["start"]) & (b["end"] <= span["end"]))
            return F.struct(
                F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), holds.alias("holds"),
                described(text, kind, span).alias("features"),
            )

        return F.transform(proposals(text, kind), one)

    return with_base(docs).withColumn("candidates", F.flatten(F.array(*map(of, KINDS))))


@dataclass(frozen=True)
class PiiModel:
    trees: BoostedTrees
    #: Least score of an added span by kind; above 1 for none.
    thresholds: dict[str, float]

    def score(self, features: Column) -> Column:
        return self.trees.score([F.get(features, F.lit(i)) for i in range(len(FEATURES))])


def lower_bound(hits: int, total: int) -> float:
    """Wilson's lower 95 % bound of a share."""
    if not total:
        return 0.0
    z, share = 1.645, hits / total
    return (share + z * z / (2 * total) - z * ((share * (1 - share) + z * z / (4 * total)) / total) ** 0.5) / (1 + z * z / total)


def cutoffs(counts: list[tuple[str, int, int, int]], precision: float) -> dict[str, float]:
    """Threshold by kind from (kind, percent, right, all) counts of scores."""
    out = {}
    for kind in KINDS:
        right = total = 0
        out[kind] = 2.0
        for _, percent, hits, n in sorted((c for c in counts if c[0] == kind), key=lambda c: -c[1]):
            right, total = right + hits, total + n
            if lower_bound(right, total) >= precision:
                out[kind] = percent / 100
    return out


def train_pii(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> PiiModel:
    """Trees from most of the ``sample`` documents with the least id hashes,
    thresholds from all other rows, those without doc_id too."""
    chosen = docs.filter("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    fitting = materialize(chosen.filter(F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(10)) >= 4), "pii-fitting")
    fitting = F.broadcast(fitting)  # at most ``sample`` ids
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def candidates(of: DataFrame) -> DataFrame:
        return with_candidates(of.select("text")).select(F.explode("candidates").alias("c")).select(
            F.col("c.kind").alias("kind_name"), F.col("c.holds").cast("int").alias("label"), F.col("c.features").alias("features")
        )

    fold = texts.join(fitting, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    names = [f"f_{name}" for name in FEATURES]
    rows = candidates(fold).select("label", *[F.get("features", F.lit(i)).alias(name) for i, name in enumerate(names)])
    trees = fit_trees(materialize(rows, "pii-candidates"), names, "label", ROUNDS, DEPTH)
    model = PiiModel(trees, dict.fromkeys(KINDS, 2.0))
    rest = candidates(texts.join(fitting, "doc_id", "left_anti"))
    percents = rest.select("kind_name", "label", F.floor(model.score(F.col("features")) * 100).cast("int").alias("percent"))
    # At most 101 rows for each kind.
    counts = percents.groupBy("kind_name", "percent").agg(F.sum("label").alias("hits"), F.count("*").alias("n")).collect()
    return PiiModel(trees, cutoffs([(r.kind_name, r.percent, r.hits, r.n) for r in counts], precision))


def find_pii(docs: DataFrame, model: PiiModel) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of kind number, start, end.

    ``found`` has the base spans and the added ones, by kind, then start.
    """
    rows = with_base(docs)

    def numbered(i: int) -> Column:
        return F.transform(f"base.{KINDS[i]}", lambda s: F.struct(F.lit(i).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    base = F.flatten(F.array(*[numbered(i) for i in range(len(KINDS))]))
    rows = rows.withColumn("base_spans", F.array_sort(base))

    def scored(i: int) -> Column:
        def one(c: Column) -> Column:
            minus = -let(described(F.col("text"), KINDS[i], c), model.score)
            return F.struct(minus.alias("minus"), c["start"].alias("start"), c["end"].alias("end"), F.lit(i + 1).alias("number"))

        return F.transform(proposals(F.col("text"), KINDS[i], F.col("base_spans")), one)

    fresh = F.flatten(F.array(*map(scored, range(len(KINDS)))))
    limits = F.array(*[F.lit(model.thresholds[kind]) for kind in KINDS])
    likely = F.array_sort(F.filter(fresh, lambda c: -c["minus"] >= F.get(limits, c["number"] - 1)))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    added = F.aggregate(
        likely, none,
        lambda kept, c: F.when(F.exists(kept, lambda k: overlaps(k, c)), kept).otherwise(
            F.concat(kept, F.array(F.struct((c["number"] - 1).alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))
        ),
    )
    return rows.withColumn("found", F.array_sort(F.concat("base_spans", added)))


def written(spans_of_text: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans_of_text, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, found: Column) -> Column:
    """A text in which each span's place is taken by its kind in brackets;
    overlapping spans are one, named by the first."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        out = F.concat(done["out"], gap, F.lit("["), F.get(names, s["kind"]), F.lit("]"))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(s["start"] < done["at"], done["out"]).otherwise(out).alias("out"))

    whole = F.aggregate(ordered, begin, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)


def pii_report(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = find_pii(texts, train_pii(texts))
    return found.select(
        "doc_id",
        *[F.size(f"base.{kind}").cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(written(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
