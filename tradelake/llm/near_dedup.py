"""MinHash near-duplicates: an inverted join over signature coordinates.

1. Every text gets the hashes of its distinct word shingles and a MinHash
   signature of ``coordinates`` values.  Texts with the same shingle set form
   a class, represented by its smallest id, so exact copies cost one row.
2. Each class is posted under its (coordinate, value) pairs.  Pairs with one
   document are dropped, and a class with fewer than ``matches`` shared pairs
   is out at once.  A short signature does this for all classes; those left
   are posted anew under a long one, whose higher match threshold tells near
   copies from texts that share a passage.  Two signatures that agree in at
   least ``matches`` coordinates agree in one of each other's
   ``coordinates - matches + 1`` rarest pairs (prefix), so only that prefix
   is merged.
3. Collisions of candidates are counted over all their shared pairs; those
   with ``matches`` or more are confirmed on the full shingle sets.  Lists
   are merged with skips: members meet the most typical and the first
   document of a list first, linked ones are contracted into components, and
   a list whose members are all in one component is skipped.
4. Members of the other lists are compared across components, found by the
   rarest shingles of their full sets: two sets of the wanted similarity
   share one early enough in each other's order for the overlap they need.
   So a group of n near copies costs about n comparisons, not n squared,
   while no link between two components is lost.

With the defaults (10 matches of 32, then 94 of 160) a pair of similarity 0.8
escapes the collision counts with a probability of about 1e-8.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import (blocks, hash_strings, mix, released, split_words,
                                  window_hashes, written)

#: (coordinates, matches) of the short and of the long signature.
SHORT = (32, 10)
LONG = (160, 94)
#: Ratio of set sizes that fall into one class.
BAND = 1.05


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text: (flat hashes, offsets).

    A-Z are lower-cased; a text of fewer words than ``width`` has its whole
    sequence as the only shingle, one without words has none.
    """
    codes, offsets, words = split_words(texts, lower=True)
    hashes = hash_strings(words)[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled, starts = window_hashes(hashes, offsets, width)
    counts = np.diff(offsets)
    first = np.searchsorted(starts, offsets[:-1])
    last = np.searchsorted(starts, offsets[1:])
    sets = []
    for i, n in enumerate(counts.tolist()):
        if n >= width:
            sets.append(np.unique(rolled[first[i]:last[i]]))
        elif n:
            own = hashes[offsets[i]:offsets[i + 1]].tobytes()
            sets.append(np.array([xxhash.xxh3_64_intdigest(own, seed=n)], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])
    return np.concatenate([np.zeros(0, np.uint64), *sets]), ends


def minhash(flat: np.ndarray, ends: np.ndarray, coordinates: int) -> np.ndarray:
    """One row per non-empty set: 64-bit keys of its (coordinate, value) pairs."""
    rng = np.random.default_rng(20)
    factors = rng.integers(1 << 62, 1 << 63, coordinates, dtype=np.uint64) | np.uint64(1)
    shifts = rng.integers(1 << 62, 1 << 63, coordinates, dtype=np.uint64)
    starts = ends[:-1][np.diff(ends) > 0]
    out = np.zeros((len(starts), coordinates), np.uint64)
    if len(starts):
        for k in range(coordinates):
            low = np.minimum.reduceat(flat * factors[k] + shifts[k], starts)
            out[:, k] = mix(low ^ mix(np.full(1, k + 1, np.uint64)))
    return out


def _sketch(texts: pa.Array, width: int, coordinates: int) -> list[pa.Array]:
    """Per text: set size, digest of the set (null: empty) and signature."""
    flat, ends = shingle_sets(texts, width)
    sizes = np.diff(ends)
    keys = [xxhash.xxh3_128_digest(flat[a:b].tobytes()) if b > a else None
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
    signatures = minhash(flat, ends, coordinates).view(np.int64)
    bounds = np.concatenate([[0], np.cumsum((sizes > 0) * coordinates)]).astype(np.int32)
    return [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(signatures.ravel()))]


def _jaccard(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b, ta, tb) whose full sets have a similarity of percent/100."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, ["ta", "tb"]):
                (x, xe), (y, ye) = (shingle_sets(part.column(c), width) for c in ("ta", "tb"))
                keep = []
                for i in range(part.num_rows):
                    s, t = x[xe[i]:xe[i + 1]], y[ye[i]:ye[i + 1]]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    keep.append(100 * both >= percent * (len(s) + len(t) - both) > 0)
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, pairs.select("a", "b").schema)


def _band(size: Column) -> Column:
    """Class of a set's size; those of one class differ by less than BAND."""
    return F.floor(F.log(size) / math.log(BAND))


def _across(texts: DataFrame, open_: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may have the similarity.

    Sets of n and m shingles need ``percent / (100 + percent) * (n + m)`` in
    common.  With shingles in one order, rarest first, the first common one
    has so many from there on in both sets.  Components of one size are
    compared before their members are, and only with sizes that the number of
    shingles from there on allows: texts that share a template of up to some 85 %
    of their shingles don't meet through it, however many they are.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, ["text"]):
                flat, ends = shingle_sets(part.column("text"), width)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.ListArray.from_arrays(
                        pa.array(ends.astype(np.int32)), pa.array(flat.view(np.int64)))],
                    names=["rep", "shingles"])

    own = written(texts.join(open_.select(F.col("rep").alias("id")).hint("merge"), "id",
                             "left_semi").mapInArrow(sets, "rep bigint, shingles array<bigint>"),
                  "near-sets")
    every = own.select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    common = written(every.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1"),
                     "near-common")
    ordered = (every.join(common.hint("merge"), "s").groupBy("rep", "n")
               .agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("list")))
    # left: shingles of the set from this one on; those of one set only come first
    early = (ordered.select("rep", "n", F.size("list").alias("k"),
                            F.posexplode("list.s").alias("at", "s"))
             .select("rep", "n", "s", (F.col("k") - F.col("at")).alias("left"))
             .filter(F.col("left") * 100 >= F.col("n") * percent)
             .join(open_.hint("merge"), "rep")
             .withColumn("band", _band(F.col("n"))))
    early = written(early, "near-early")
    first = written(early.groupBy("s", "band", "c", "n").agg(F.max("left").alias("left")),
                    "near-first")
    a = first.select("s", "band", *(F.col(x).alias(f"{x}1") for x in ("c", "n", "left")))
    # sizes that a set with so many shingles from here on can be near to
    most = F.least(F.col("n") * (100 / percent), F.col("left") * ((100 + percent) / percent) - F.col("n"))
    low, high = _band(F.col("n") * (percent / 100) * (1 - 1e-9)), _band(most * (1 + 1e-9))
    b = (first.withColumn("low", low).withColumn("high", high).filter("low <= high")
         .select("s", *(F.col(x).alias(f"{x}2") for x in ("c", "n", "left")),
                 F.explode(F.sequence("low", "high")).alias("band")))
    fits = (f"least(left1, left2) * {100 + percent} >= (n1 + n2) * {percent} and "
            f"least(n1, n2) * 100 >= greatest(n1, n2) * {percent}")
    meet = a.join(b.hint("merge"), ["s", "band"]).filter(f"c1 < c2 and {fits}").select(
        "s", "c1", "n1", "c2", "n2")
    x = early.select("s", *(F.col(v).alias(f"{v}1") for v in ("rep", "c", "n", "left")))
    y = early.select("s", *(F.col(v).alias(f"{v}2") for v in ("rep", "c", "n", "left")))
    return (meet.join(x.hint("merge"), ["s", "c1", "n1"]).join(y.hint("merge"), ["s", "c2", "n2"])
            .filter(fits).select(F.least("rep1", "rep2").alias("a"),
                                 F.greatest("rep1", "rep2").alias("b")).distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b)
    reaches, by alternating large-star and small-star contraction.  Every
    round is written, and the loop ends when a round changes nothing."""

    def pointed(e: DataFrame, node: str, other: str) -> tuple[DataFrame, DataFrame]:
        near = e.select(F.col(node).alias("u"), F.col(other).alias("v"))
        return near, near.groupBy("u").agg(F.min("v").alias("m"))

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "cc")
    state = mark(now)
    while True:
        both = now.union(now.select("b", "a"))
        near, low = pointed(both, "a", "b")
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (near.join(written(low, "cc-low").hint("merge"), "u").filter("v > u")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct())
        near, low = pointed(written(large, "cc-large"), "b", "a")
        low = written(low, "cc-low")
        small = (near.join(low.hint("merge"), "u")
                 .select(F.col("m").alias("a"), F.col("v").alias("b"))
                 .union(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
                 .filter("a <> b").distinct())
        now = written(small, "cc")
        before, state = state, mark(now)
        if state == before:
            return now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))


def _linked(keyed: DataFrame, *how) -> DataFrame:
    """(id, n_shingles, component) of every row of ``keyed`` (id, text), whose ids
    don't repeat.  Null ids are linked with nothing and have a null component.
    Tables that the result does not read are deleted."""
    with released(keyed.sparkSession) as keep:
        rows, ids = map(keep, _linked_classes(keyed, *how))
    return (rows.drop("signature").join(ids.hint("merge"), "key", "left")
            .select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce(
                "component", "id")).alias("component")))


def _linked_classes(keyed: DataFrame, shingle: int, percent: int, short: tuple[int, int],
                    long: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Written tables of the rows (id, n_shingles, key) and of the component of
    every key that has one."""

    def sketched(texts: DataFrame, coordinates: int) -> DataFrame:
        def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in blocks(batch, ["text"]):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), *_sketch(part.column("text"), shingle, coordinates)],
                        names=["id", "n_shingles", "key", "signature"])

        return texts.mapInArrow(
            sketch, "id bigint, n_shingles bigint, key binary, signature array<bigint>")

    def posted(classes: DataFrame) -> DataFrame:
        """Postings (pair, rep, n, df) of the pairs that several classes have."""
        every = classes.select("rep", "n", F.explode("signature").alias("pair"))
        several = written(every.groupBy("pair").agg(F.count("*").alias("df")).filter("df > 1"),
                          "near-shared")
        return every.join(several.hint("merge"), "pair")

    rows = written(sketched(keyed, short[0]), "near-rows")
    classes = written(rows.filter("key is not null and id is not null").groupBy("key")
                      .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"),
                           F.first("signature").alias("signature")), "near-classes")
    likely = (posted(classes).groupBy("rep").agg(F.count("*").alias("shared"))
              .filter(F.col("shared") >= short[1]).select(F.col("rep").alias("id")))
    texts = written(keyed.join(likely.hint("merge"), "id", "left_semi"), "near-texts")

    # inverted index over the long signatures of the classes left
    matches = long[1]
    indexed = written(sketched(texts, long[0]).filter("key is not null").select(
        F.col("id").alias("rep"), F.col("n_shingles").alias("n"), "signature"), "near-indexed")
    members = written(
        posted(indexed).groupBy("rep", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "pair"))).alias("pairs"))
        .filter(F.size("pairs") >= matches)
        .select("rep", "n", F.col("pairs.pair").alias("pairs"),
                F.aggregate("pairs.df", F.lit(0).cast("bigint"), lambda x, y: x + y)
                .alias("typical"),
                F.transform("pairs", lambda x: F.shiftright(x["pair"], 32).cast("int"))
                .alias("marks")), "near-members")
    prefix = written(members.select("rep", "typical", F.explode(
        F.slice("pairs", F.lit(1), F.size("pairs") - (matches - 1))).alias("pair")).distinct(),
        "near-prefix")

    def colliding(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with their number of common pairs, if ``matches`` or more."""
        a = members.select(F.col("rep").alias("a"), F.col("marks").alias("pa"))
        b = members.select(F.col("rep").alias("b"), F.col("marks").alias("pb"))
        return (pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
                .select("a", "b", F.size(F.array_intersect("pa", "pb")).alias("n"))
                .filter(F.col("n") >= matches))

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
        b = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
        return _jaccard(pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b"),
                        shingle, percent)

    def apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
        a = components.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        b = components.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        return (pairs.join(a.hint("merge"), "a", "left").join(b.hint("merge"), "b", "left")
                .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
                .select(*pairs.columns))

    # most typical and first document of every list; best match of each document first
    ends = written(prefix.groupBy("pair").agg(
        F.min("rep").alias("low"), F.max_by("rep", F.struct("typical", "rep")).alias("high"),
        F.count("*").alias("k")).filter("k > 1"), "near-ends")
    stars = (prefix.join(ends.hint("merge"), "pair")
             .select("rep", F.explode(F.array("low", "high")).alias("end"))
             .select(F.least("rep", "end").alias("a"), F.greatest("rep", "end").alias("b"))
             .filter("a < b").distinct())
    stars = written(colliding(stars), "near-stars")
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("a"))
    edges = [written(confirmed(best), "near-edges")]
    components = written(connected_components(edges[0]), "near-components")
    edges.append(written(confirmed(apart(stars, components).select("a", "b")), "near-edges"))
    components = written(connected_components(reduce(DataFrame.union, edges)), "near-components")

    # members of lists that still hold several components
    placed = written(
        prefix.join(components.select(F.col("node").alias("rep"), "component").hint("merge"),
                    "rep", "left").select("pair", "rep", F.coalesce("component", "rep").alias("c")),
        "near-placed")
    several = written(placed.groupBy("pair").agg(F.min("c").alias("x"), F.max("c").alias("y"))
                      .filter("x < y").select("pair"), "near-several")
    open_ = written(placed.join(several.hint("merge"), "pair", "left_semi")
                    .select("rep", "c").distinct(), "near-open")
    rest = _across(texts, open_, shingle, percent).join(
        stars.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    edges.append(written(confirmed(written(rest, "near-rest")), "near-edges"))
    components = connected_components(reduce(DataFrame.union, edges))

    ids = written(classes.select("key", "rep").join(
        components.select(F.col("node").alias("rep"), "component").hint("merge"), "rep", "left")
        .select("key", F.coalesce("component", "rep").alias("component")), "near-ids")
    return rows, ids


def _linked_rows(keyed: DataFrame, *how) -> DataFrame:
    """``_linked`` where ids repeat: rows are linked under numbers of their own,
    then the components that hold rows of one id are joined."""
    with released(keyed.sparkSession) as keep:
        groups, found = map(keep, _grouped_rows(keyed, *how))
    least = groups.groupBy("g").agg(F.min("id").alias("component"))
    return (groups.join(least.hint("merge"), "g").select("id", "n_shingles", "component")
            .unionByName(found.filter("id is null")))


def _grouped_rows(keyed: DataFrame, *how) -> tuple[DataFrame, DataFrame]:
    numbered = written(keyed.withColumn("row", F.monotonically_increasing_id()), "near-numbered")
    found = written(_linked(numbered.select(
        F.when(F.col("id").isNotNull(), F.col("row")).alias("id"), "text"), *how), "near-found")
    placed = written(
        found.filter("id is not null").select(F.col("id").alias("row"), "n_shingles", "component")
        .join(numbered.select("row", "id").hint("merge"), "row"), "near-rows-placed")
    pairs = written(placed.select("id", "component").distinct(), "near-id-components")
    low = (pairs.groupBy("id").agg(F.min("component").alias("a"), F.count("*").alias("n"))
           .filter("n > 1").select("id", "a"))
    joined = connected_components(written(
        pairs.join(low.hint("merge"), "id").select("a", F.col("component").alias("b")),
        "near-id-edges"))
    groups = written(
        placed.join(joined.select(F.col("node").alias("component"), F.col("component").alias("g"))
                    .hint("merge"), "component", "left")
        .select("id", "n_shingles", F.coalesce("g", "component").alias("g")), "near-groups")
    return groups, found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80, short: tuple[int, int] = SHORT,
                    long: tuple[int, int] = LONG) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id`` (smallest
    id that its links reach, itself included) and ``kept`` (it is that id).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  Null and blank
    texts have no shingles and are linked with nothing.  Rows that repeat an
    id are one document: its links are those of all its texts, and all its
    rows carry its component.  A row with a null id is linked with nothing and
    kept, with a null component.  Other columns are ignored, whatever their
    names.
    """
    keyed = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    ids_repeat = not (keyed.filter("id is not null").groupBy("id").agg(F.count("*").alias("n"))
                      .filter("n > 1").limit(1).isEmpty())
    found = (_linked_rows if ids_repeat else _linked)(keyed, shingle, percent, short, long)
    return (found.select(F.col("id").alias(id_col), "n_shingles",
                         F.col("component").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
