"""Near-duplicates: MinHash with tensored banding, confirmed on whole shingle sets.

A text's set holds its distinct four-word shingles as 64-bit numbers. Texts with equal sets
form a class, and one member stands for it. Two small collections of ``HALVES`` keys, each of
``ROWS`` minhashes, are computed per class; every pair of a left and a right key is one table
key, so 2 * HALVES * ROWS = 32 minhashes serve HALVES ** 2 = 64 tables of four minhashes each.
Two texts of similarity 0.8 share at least one table key with probability
(1 - (1 - 0.8 ** ROWS) ** HALVES) ** 2 = 0.9994, more similar ones more surely.

Classes that share a key are held against the first of the key, and links are confirmed by
intersecting the sets. Where a key's classes are then still in several components, the classes
outside its largest component are held against those of other components. These pairs are not
enumerated: a join on the rarest shingles, bounded by what can still be shared after them, yields
the ones that may be similar, and loses none. So no group is paired with itself as a whole.

Defined results: a NULL or empty text, or one of white space, has an empty set and is its own
component; rows without an id link nothing, have no component and are kept; rows that share an
id are judged by their own text; repeated rows get equal results; columns of the documents
other than id and text do not matter.
"""

from __future__ import annotations

import hashlib
import string

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.llm.common import (
    WordIds,
    as_bytes,
    mix,
    place_factors,
    restored,
    set_aside,
    whole_text,
    window_hashes,
    with_computed,
)
from stockweave.llm.graph import components
from stockweave.session import materialise

SHINGLE = 4
HALVES = 8
ROWS = 2
PERCENT = 80
FILTER_BITS = 1 << 22
# White space between words, as a class of a pattern.
_SPACE = r"\x20\x09-\x0D"
PARITY_WORDS = 8  # 64-bit words of a set's parity bits


class Shingles:
    """Sets and keys of texts."""

    def __init__(self, size: int = SHINGLE):
        self.ids = WordIds()
        self.size = size
        self.factors = place_factors(2 * HALVES * ROWS)

    def of(self, text: bytes) -> np.ndarray:
        """Distinct shingles, sorted; one of all words where there are fewer than ``size``."""
        ids = self.ids.of(text.lower().split())
        return np.unique(window_hashes(ids, min(self.size, len(ids)))) if len(ids) else np.empty(0, np.uint64)

    def halves(self, shingles: np.ndarray) -> tuple[list[int], list[int]]:
        """The left and the right collection of keys."""
        least = np.array([(shingles * factor).min() for factor in self.factors])
        keys = np.zeros(2 * HALVES, np.uint64)
        for row, factor in enumerate(self.factors[:ROWS]):
            keys += least[row::ROWS] * factor
        keys = mix(keys).view(np.int64).tolist()
        return keys[:HALVES], keys[HALVES:]


def set_key(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity(shingles: np.ndarray) -> np.ndarray:
    """For every one of 512 parts, whether the set has an odd number of shingles in it, as bits.

    Two sets have at least as many shingles apart as bits in which they differ.
    """
    odd = np.bincount((shingles % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key (equal for equal sets), left and right keys."""

    def prepare():
        shingles = Shingles()

        def compute(part):
            n, key, left, right = [], [], [], []
            for text in as_bytes(part.column("text")):
                own = shingles.of(text)
                halves = shingles.halves(own) if len(own) else (None, None)
                n.append(len(own))
                key.append(set_key(own) if len(own) else None)
                left.append(halves[0])
                right.append(halves[1])
            return n, key, left, right

        return compute

    added = "n_shingles bigint, key bigint, left array<bigint>, right array<bigint>"
    return with_computed(docs.select("doc_id", whole_text().alias("text")), added, prepare, ["text"])


def _similar_size(a: Column, b: Column) -> Column:
    """Sets further apart in size cannot reach the similarity."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _shared_keys(classes: DataFrame) -> DataFrame:
    """(bucket, first, first_n, key, n): classes by table key, for keys of at least two classes."""
    entries = classes.select(
        F.explode(
            F.flatten(
                F.transform(
                    "left",
                    lambda x, i: F.transform("right", lambda y, j: F.xxhash64(i * HALVES + j, x, y)),
                )
            )
        ).alias("bucket"),
        "key",
        "n",
    )
    firsts = (
        entries.groupBy("bucket")
        .agg(F.count("*").alias("classes"), F.min(F.struct("key", "n")).alias("first"))
        .where("classes > 1")
        .select("bucket", F.col("first.key").alias("first"), F.col("first.n").alias("first_n"))
    )
    return entries.join(firsts, "bucket")


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, shingles, parity) of the ``wanted`` classes (key, comp), from the text of the member ``comp``.

    A bitmap over hashed ids, of FILTER_BITS / 64 rows at most and so safe to broadcast, keeps
    most other texts from being read into sets or shuffled; the join after it is exact.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    places = [F.shiftright(place, 6).alias("word"), F.pmod(place, F.lit(64)).cast("int").alias("bit")]
    members = wanted.select(F.col("key"), F.col("comp").alias("doc_id"))
    bitmap = members.select(*places).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    likely = (
        docs.select("doc_id", "text", *places)
        .join(F.broadcast(bitmap), "word")
        .where(F.getbit("bits", "bit") == 1)
        .select("doc_id", "text")
    )

    def prepare():
        shingles = Shingles()

        def compute(part):
            sets = [shingles.of(text) for text in as_bytes(part.column("text"))]
            return [set_key(s) for s in sets], [s.view(np.int64) for s in sets], [parity(s) for s in sets]

        return compute

    sets = with_computed(likely, "key bigint, shingles array<bigint>, parity array<bigint>", prepare, ["text"])
    return sets.join(members, ["key", "doc_id"], "left_semi").drop("doc_id").dropDuplicates(["key"])


def pairs_confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``pairs`` (a, b) of keys whose sets are similar enough."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    enough = 100 * both >= PERCENT * (F.size("of_a") + F.size("of_b") - both)
    return pairs.join(left, "a").join(right, "b").where(enough).select("a", "b")


def _undecided(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, n, comp, outsider) of the classes in keys whose classes are in several components.

    An outsider is in some key's classes without being in their largest component, so any two
    classes of a key that are in different components have an outsider among them.
    """
    rows = shared.join(labels, "key").select("bucket", "key", "n", "comp")
    parts = rows.groupBy("bucket", "comp").agg(F.count("*").alias("m"))
    most = (
        parts.groupBy("bucket")
        .agg(F.count("*").alias("components"), F.max(F.struct("m", "comp")).alias("top"))
        .where("components > 1")
        .select("bucket", F.col("top.comp").alias("most"))
    )
    return (
        rows.join(most, "bucket")
        .groupBy("key", "n", "comp")
        .agg(F.max(F.col("comp") != F.col("most")).alias("outsider"))
    )


def _across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): an outsider and a class of another component that may be similar enough.

    Sets are ordered from rare to frequent shingles. Two similar sets share a shingle near the
    start of both, and what follows the first shared one bounds how many they share; their parity
    bits bound how many they do not share. The join on shingles keeps a pair only if both bounds
    allow the similarity. Nothing similar is lost.
    """
    shingles = sets.join(members, "key", "left_semi").select("key", F.explode("shingles").alias("shingle"))
    repeated = shingles.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ordered = (
        shingles.join(repeated, "shingle")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("ordered"))
        .join(members, "key")
        .join(sets.select("key", "parity"), "key")
    )
    # ``left`` counts the shingles from a place on; shingles of one set only come before all others.
    own = ["key", "n", "comp", "outsider", "parity"]
    places = ordered.select(*own, F.size("ordered").alias("size"), F.posexplode("ordered"))
    places = places.select(*own, (F.col("size") - F.col("pos")).alias("left"), "col.shingle")
    places = materialise(places.where(100 * F.col("left") >= PERCENT * F.col("n")), "places")
    one = places.where("outsider").select(
        "shingle",
        F.col("key").alias("x"),
        F.col("n").alias("x_n"),
        F.col("comp").alias("x_comp"),
        F.col("left").alias("x_left"),
        F.col("parity").alias("x_parity"),
    )
    # At the first shared shingle no more than the least ``left`` can be shared.
    enough = (100 + PERCENT) * F.least("left", "x_left") >= PERCENT * (F.col("n") + F.col("x_n"))
    differing = sum((F.bit_count(F.col("parity")[i].bitwiseXOR(F.col("x_parity")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    # Similar sets of n and m shingles have (100 - PERCENT) / (100 + PERCENT) * (n + m) apart at most.
    near = (100 + PERCENT) * differing <= (100 - PERCENT) * (F.col("n") + F.col("x_n"))
    # Two outsiders meet once.
    once = ~F.col("outsider") | (F.col("key") < F.col("x"))
    may = once & (F.col("comp") != F.col("x_comp")) & _similar_size(F.col("n"), F.col("x_n")) & enough & near
    pairs = places.join(one, (places["shingle"] == one["shingle"]) & may)
    return pairs.select(F.least("x", "key").alias("a"), F.greatest("x", "key").alias("b")).distinct()


def linked(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, comp) of the ``classes`` (key, comp, n, left, right), which are stored, once linked."""
    owned = classes.select("key", F.col("comp").alias("own"))
    shared = materialise(_shared_keys(classes).join(owned, "key"), "buckets")
    usable = _similar_size(F.col("n"), F.col("first_n")) & (F.col("key") != F.col("first"))
    pairs = materialise(
        shared.where(usable).select(F.least("first", "key").alias("a"), F.greatest("first", "key").alias("b")).distinct(),
        "pairs",
    )
    sets = materialise(_sets(docs, shared.select("key", F.col("own").alias("comp")).distinct()), "sets")
    edges = materialise(pairs_confirmed(pairs, sets), "links")
    labels = components(classes.select("key", "comp"), edges)
    members = materialise(_undecided(shared, labels), "members")
    more = _across(members, sets).join(pairs, ["a", "b"], "left_anti")
    new = materialise(pairs_confirmed(more, sets), "links")
    return components(labels, new)


def duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document. Stores tables, so it runs jobs."""
    docs = docs.select("doc_id", whole_text().alias("text"))
    signed = materialise(signatures(docs), "signatures")
    classes = materialise(
        signed.where("doc_id IS NOT NULL AND key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("comp"),
            F.first("n_shingles").alias("n"),
            F.first("left").alias("left"),
            F.first("right").alias("right"),
        ),
        "classes",
    )
    found = linked(docs, classes).withColumnRenamed("comp", "component")
    rows = signed.select("doc_id", "n_shingles", "key").join(found, "key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The document of each component with the smallest id, once, in the columns of ``docs``.

    Rows without an id all stay. Rows that share the id kept but differ in their words all stay, once
    each, as an id alone does not make them copies; of rows equal in their words the one with the least hash of
    all columns stays.
    """
    kept = duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    lower = F.translate(whole_text(), string.ascii_uppercase, string.ascii_lowercase)
    words = F.btrim(F.regexp_replace(lower, f"[{_SPACE}]+", " "))
    rows = set_aside(docs, "doc_id", "text").withColumn("_words", F.md5(words))
    same = Window.partitionBy("doc_id", "_words").orderBy(F.xxhash64("row", "text"))
    numbered = rows.join(kept, "doc_id", "left_semi").withColumn("copy", F.row_number().over(same))
    own = ["row", "doc_id", "text"]
    once = numbered.where("copy = 1").select(*own)
    return restored(once.union(rows.where("doc_id IS NULL").select(*own)), docs.columns)
