"""Document fingerprints: Order MinHash (operator 5, native).

A text's k-mers are runs of ``K`` successive words, numbered by occurrence, so
that a repeat is an element of its own. A hash deals these elements into
``SLOTS`` slots; each slot keeps its two minimal ones, puts them back in text
order and hashes the pair. Two texts agree on a slot if they share its minimal
elements *and* their order, so moving text about lowers the likeness where plain
MinHash would not notice. Dealing one hash into slots replaces one permutation
for each slot: the work for a text is one or two sorts of its k-mers.

All of it is array functions in the JVM: no Python, no exploded k-mers. The
likeness of two fingerprints is the share of equal slots among those that either
text fills.

A document's successor is found by dealing rows into ranges of doc_id; the first
row of a range also goes, as a guest, to the end of the range before. So texts
are shuffled once and no range is larger than its share of ids.

Edge cases: null is the empty text; a text of fewer words than ``K`` is one
k-mer; texts without words have empty slots only, are alike to each other (1)
and to nothing else (0). Rows are ordered by doc_id (null first), then text, and
the last is followed by the first, so the only row of a table is its own
successor. Repeated rows keep their own results; extra columns do not matter.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, SLOTS = 3, 64
#: Rows of one range of ids, and the most ranges.
RANGE_ROWS, MOST_RANGES = 2_000, 1 << 15
#: Low bits of an element hold its place in the text, the high ones its hash.
LOW = (1 << 24) - 1
EMPTY = "...."


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hash_of(element: Column) -> Column:
    return element.bitwiseAND(F.lit(~LOW).cast("bigint"))


def _slot_of(element: Column) -> Column:
    return F.shiftrightunsigned(element, 64 - 6).cast("int")


def _element(hashed: Column, place: Column) -> Column:
    return _hash_of(hashed).bitwiseOR(place.bitwiseAND(F.lit(LOW).cast("bigint")))


def _kmers(text: Column) -> Column:
    """Elements of all k-mers, sorted, so that repeats stand in text order."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def elements(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0)))
        kmer = lambda i: F.xxhash64(*[F.coalesce(F.get(w, i + k), F.lit("")) for k in range(K)])
        return F.when(F.size(w) > 0, F.sort_array(F.transform(starts, lambda i: _element(kmer(i), i.cast("bigint")))))

    return let(words, elements)


def _numbered(kmers: Column) -> Column:
    """The n-th occurrence of a k-mer hashed anew with n, from the second on."""

    def number(s: Column) -> Column:
        last = F.size(s) - 1
        firsts = F.filter(
            F.sequence(F.lit(0), last), lambda i: (i == 0) | (_hash_of(F.get(s, i)) != _hash_of(F.get(s, i - 1)))
        )

        def spread(begins: Column) -> Column:
            def run(begin: Column, j: Column) -> Column:
                end = F.coalesce(F.get(begins, j + 1) - 1, last)
                anew = lambda i: _element(F.xxhash64(_hash_of(F.get(s, i)), i - begin), F.coalesce(F.get(s, i), F.lit(0)))
                return F.transform(F.sequence(begin, end), lambda i: F.when(i == begin, F.coalesce(F.get(s, i), F.lit(0))).otherwise(anew(i)))

            return F.when(F.size(begins) == F.size(s), s).otherwise(F.sort_array(F.flatten(F.transform(begins, run))))

        return let(firsts, spread)

    return let(kmers, number)


def slots(text: Column) -> Column:
    """16 bits for each slot of a text, -1 for an empty slot."""

    def minimal(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i < 2) | (_slot_of(F.get(s, i - 2)) != _slot_of(x)))

    def pairs(kept: Column) -> Column:
        def entry(x: Column, i: Column) -> Column:
            follower = F.get(kept, i + 1)
            alone = F.coalesce(_slot_of(follower) != _slot_of(x), F.lit(True))
            before = x.bitwiseAND(F.lit(LOW).cast("bigint")) <= follower.bitwiseAND(F.lit(LOW).cast("bigint"))
            value = (
                F.when(alone, F.xxhash64(_hash_of(x)))
                .when(before, F.xxhash64(_hash_of(x), _hash_of(follower)))
                .otherwise(F.xxhash64(_hash_of(follower), _hash_of(x)))
            )
            opens = (i == 0) | (_slot_of(F.get(kept, i - 1)) != _slot_of(x))
            return F.when(opens, F.struct(_slot_of(x).alias("slot"), value.bitwiseAND(F.lit(0xFFFF).cast("bigint")).cast("int").alias("value")))

        return F.map_from_entries(F.filter(F.transform(kept, entry), lambda e: e.isNotNull()))

    def laid_out(found: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda k: F.coalesce(F.element_at(found, k), F.lit(-1)))

    filled = let(let(let(_numbered(_kmers(text)), minimal), pairs), laid_out)
    return F.coalesce(filled, F.array_repeat(F.lit(-1), SLOTS))


def fingerprint(values: Column) -> Column:
    """Slots as text, four characters for each."""
    return F.array_join(F.transform(values, lambda v: F.when(v < 0, F.lit(EMPTY)).otherwise(F.lower(F.lpad(F.hex(v), 4, "0")))), "")


def likeness(one: Column, other: Column) -> Column:
    """Share of equal slots among those filled in either; 1 if neither has any."""
    pairs = F.zip_with(one, other, lambda a, b: F.when((a >= 0) | (b >= 0), (a == b).cast("int")))
    known = F.filter(pairs, lambda p: p.isNotNull())
    return let(known, lambda k: F.when(F.size(k) == 0, F.lit(1.0)).otherwise(F.aggregate(k, F.lit(0), lambda n, p: n + p) / F.size(k)))


def with_successor(docs: DataFrame, *carried: str) -> DataFrame:
    """Rows of (doc_id, text, *carried) with ``next``: text and carried columns
    of the next row in ascending (doc_id, text), after the last the first."""
    spark = docs.sparkSession
    rows, known = docs.agg(F.count("*"), F.count("doc_id")).first()
    ranges = max(1, min(MOST_RANGES, rows // RANGE_ROWS))
    bounds: list[int] = []
    if known:
        shares = [k / ranges for k in range(ranges)]
        found = docs.agg(
            F.percentile_approx("doc_id", shares, max(10_000, 2 * ranges)).alias("at"), F.min("doc_id").alias("least")
        ).first()
        bounds = sorted({found.least, *found.at})
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = [1 << k for k in range(max(len(bounds), 1).bit_length(), -1, -1)]
    place = F.coalesce(
        F.aggregate(
            F.lit(steps) if len(steps) > 1 else F.array(F.lit(steps[0])),
            F.lit(0),
            lambda low, step: F.when(F.coalesce(F.get(table, low + step) <= F.col("doc_id"), F.lit(False)), low + step).otherwise(low),
        ),
        F.lit(0),
    )
    count = max(len(bounds), 1)
    opens = F.col("doc_id") == F.get(table, F.col("range"))
    if known < rows:
        opens = F.when(F.col("range") == 0, F.col("doc_id").isNull()).otherwise(opens)
    here = F.struct(F.col("range"), F.lit(0).alias("guest"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(count)).alias("range"), F.lit(1).alias("guest"))
    dealt = docs.withColumn("range", place).withColumn(
        "stay", F.explode(F.when(opens, F.array(here, before)).otherwise(F.array(here)))
    )
    following = Window.partitionBy("stay.range").orderBy("stay.guest", F.col("doc_id").asc_nulls_first(), "text")
    joined = dealt.withColumn("next", F.lead(F.struct("text", *carried)).over(following))
    return joined.filter("stay.guest = 0").drop("range", "stay")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, with their likeness."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_successor(texts.withColumn("slots", slots(F.col("text"))), "slots")
    tail = F.expr("length(text) div 4").cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - tail), F.substring("next.text", F.lit(1), tail)
    )
    done = paired.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), "slots", F.col("next.slots").alias("next_slots"), edited.alias("edited"))
    done = done.withColumn("edited_slots", slots(F.col("edited")))
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("slots")).alias("fingerprint"),
        fingerprint(F.col("edited_slots")).alias("edited_fingerprint"),
        likeness(F.col("slots"), F.col("edited_slots")).alias("near_edited"),
        likeness(F.col("slots"), F.col("next_slots")).alias("near_next"),
    )
