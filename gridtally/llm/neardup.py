"""Near-duplicates by MinHash signatures and a multi-index Hamming join.

1. Every text becomes its set of word shingles (64-bit hashes), and a signature
   of ``CHUNKS * CHUNK`` minima of 16 bits.  Equal sets form one class; only a
   class goes on.
2. Signatures are cut into ``CHUNKS`` chunks.  If two differ in at most
   ``2 * CHUNKS - 1`` places, some chunk differs in at most one.  So for every
   chunk and every place in it the chunk without that place is a key: all pairs
   under that distance share a key, and are candidates.
3. Candidate pairs are never listed.  Classes that keys connect form a region;
   a region is cut into blocks of bounded size, and links are confirmed on full
   sets block by block, then between blocks.  Two classes that are already
   connected need no comparison, which leaves the components as they are.  Blocks
   of a large region hold sets of one range of sizes; only neighbouring ranges can
   hold links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import stage
from .common import batch, free_names, likely, parted, raw_texts
from .components import components

WORDS = 5
CHUNKS = 10
CHUNK = 6
#: Classes that are compared in one task at once.
BLOCK = 512
#: Bytes of the sets in a block, unless one set alone has more.
BLOCK_BYTES = 1 << 26
#: Words whose hashes a task remembers at most.
KNOWN_WORDS = 1_000_000
#: More than the blocks of one range of sizes in a region.
_PLACES = 1 << 40

_MIX = np.random.default_rng(20240501)
_WORD_FACTORS = _MIX.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIN_FACTORS = _MIX.integers(0, 2**63, CHUNKS * CHUNK, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIN_SHIFTS = _MIX.integers(0, 2**63, CHUNKS * CHUNK, dtype=np.uint64)


def _scatter(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on one another."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


class Shingler:
    """Texts to sorted arrays of distinct shingle hashes."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        # ASCII white space parts words; only A-Z change case
        words = text.lower().split()
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(len(words), WORDS)
        if not n:
            return hashes
        count = len(words) - n + 1
        shingles = np.full(count, n, np.uint64)
        for i in range(n):
            shingles += hashes[i : i + count] * _WORD_FACTORS[i]
        return np.unique(_scatter(shingles))


def signature(shingles: np.ndarray) -> bytes:
    """16 bits of the minimum under each of the hash functions."""
    minima = np.empty(len(_MIN_FACTORS), np.uint64)
    for i, (factor, shift) in enumerate(zip(_MIN_FACTORS, _MIN_SHIFTS, strict=True)):
        minima[i] = (shingles * factor + shift).min()
    return (_scatter(minima) >> np.uint64(48)).astype("<u2").tobytes()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_key", pa.int64()),
            ("n_shingles", pa.int64()),
            ("set_key", pa.binary()),
            ("signature", pa.binary()),
        ]
    )
    shingler = Shingler()
    for rows in batches:
        counts, keys, signatures = [], [], []
        for text in raw_texts(rows.column(2)):
            shingles = shingler(text)
            counts.append(len(shingles))
            keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            signatures.append(signature(shingles) if len(shingles) else b"")
        yield batch(schema, [rows.column(0), rows.column(1), counts, keys, signatures])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("set_key", pa.binary()), ("shingles", pa.binary())])
    shingler = Shingler()
    for rows in batches:
        found = [shingler(text).tobytes() for text in raw_texts(rows.column(0))]
        yield batch(schema, [[xxhash.xxh3_128_digest(f) for f in found], found])


def chunk_keys() -> Column:
    """Per chunk and allowed error: the chunk without that place, as an array."""
    keys = []
    for chunk in range(CHUNKS):
        for skip in range(CHUNK):
            first = 2 * chunk * CHUNK
            keys.append(
                F.xxhash64(
                    F.lit(chunk * CHUNK + skip),
                    F.substring("signature", first + 1, 2 * skip),
                    F.substring("signature", first + 2 * skip + 3, 2 * (CHUNK - 1 - skip)),
                )
            )
    return F.array(*keys)


class Forest:
    """Union-find over positions; the smallest position names a tree."""

    def __init__(self, n: int) -> None:
        self.above = list(range(n))

    def find(self, x: int) -> int:
        while self.above[x] != x:
            self.above[x] = x = self.above[self.above[x]]
        return x

    def unite(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.above[max(x, y)] = min(x, y)


def link(sets: list[np.ndarray], labels: list[int], percent: int) -> list[int]:
    """New labels after all links between sets of different labels.

    ``100 * common >= percent * union`` links two sets.  Sets are visited by
    size; one is compared with those not yet connected to it whose size allows a
    link.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    sizes = np.array([len(sets[i]) for i in order])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    distinct, number = np.unique(
        np.concatenate([sets[i] for i in order]), return_inverse=True
    )
    marked = np.zeros(len(distinct), bool)
    names = sorted(set(labels))
    place = {name: i for i, name in enumerate(names)}
    forest = Forest(len(names))
    tree = [place[labels[i]] for i in order]
    for x in range(len(order) - 1):
        # larger sets up to size / percent
        end = int(np.searchsorted(sizes * percent, sizes[x] * 100, side="right"))
        own = forest.find(tree[x])
        others = [y for y in range(x + 1, end) if forest.find(tree[y]) != own]
        if not others:
            continue
        mine = number[offsets[x] : offsets[x + 1]]
        marked[mine] = True
        if 4 * len(others) > end - x:
            low, high = others[0], others[-1] + 1
            hits = marked[number[offsets[low] : offsets[high]]]
            shared = np.add.reduceat(hits, offsets[low:high] - offsets[low], dtype=np.int64)
            shared = shared[np.array(others) - low]
        else:
            shared = np.array(
                [np.count_nonzero(marked[number[offsets[y] : offsets[y + 1]]]) for y in others]
            )
        marked[mine] = False
        union = sizes[x] + sizes[others] - shared
        for y in np.array(others)[100 * shared >= percent * union].tolist():
            forest.unite(tree[x], tree[y])
    return [names[forest.find(place[label])] for label in labels]


def _grade(percent: int) -> Column:
    """Range of sizes of a set: linked sets are in the same range or in neighbouring ones."""
    # a little wider than the largest ratio of linked sizes, so that rounding cannot part them
    step = 1.000001 * math.log(100 / min(max(percent, 1), 99))
    return F.floor(F.log("n_shingles") / step)


def _linker(percent: int):
    """Rows sorted by (region, piece) come in; (rep, old label, new label) go out."""
    schema = pa.schema([("rep", pa.int64()), ("label", pa.int64()), ("merged", pa.int64())])

    def settle(group: list[tuple]) -> pa.RecordBatch:
        reps, labels, sets = zip(*group, strict=True)
        merged = link(list(sets), list(labels), percent)
        return batch(schema, [list(reps), list(labels), merged])

    def link_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for rows in batches:
            columns = [rows.column(i) for i in range(4)]
            for region, piece, rep, label, shingles in zip(
                *(c.to_pylist() for c in columns), rows.column(4), strict=True
            ):
                if (region, piece) != now:
                    if len(group) > 1:
                        yield settle(group)
                    now, group = (region, piece), []
                group.append((rep, label, np.frombuffer(shingles.as_py(), np.uint64)))
        if len(group) > 1:
            yield settle(group)

    return link_rows


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    """Confirm links within each (region, piece) of (region, piece, rep, label, shingles)."""
    return (
        rows.select("region", "piece", "rep", "label", "shingles")
        .repartition("region", "piece")
        .sortWithinPartitions("region", "piece", "rep")
        .mapInArrow(_linker(percent), "rep long, label long, merged long")
    )


def _relabel(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """Apply (label, merged) pairs to the labels of rows."""
    return (
        rows.join(merged.withColumnRenamed("label", "_old"), F.col("label") == F.col("_old"), "left")
        .withColumn("label", F.coalesce("merged", "label"))
        .drop("_old", "merged")
    )


def class_components(
    classes: DataFrame, docs: DataFrame, percent: int, block: int = BLOCK
) -> DataFrame:
    """(rep, label) of the classes that share a key with another class.

    ``classes`` has rep, set_key, first_id, n_shingles and signature: a number, what
    tells equal sets, the smallest id among the ``docs`` (doc_id, text) with this set,
    and its size.
    """
    keys = classes.select("rep", F.explode(chunk_keys()).alias("key"))
    hubs = (
        keys.groupBy("key")
        .agg(F.min("rep").alias("hub"), F.max("rep").alias("_last"))
        .where(F.col("hub") < F.col("_last"))
        .select("key", "hub")
    )
    # staged, so that the join has a shuffle on both sides and hot keys are split
    shared = stage(keys.join(stage(hubs, "hubs"), "key"), "shared-keys")
    regions = components(shared, "rep", "hub").withColumnsRenamed(
        {"node": "rep", "component": "region"}
    )
    sized = stage(regions.join(classes.select("rep", "set_key", "first_id", "n_shingles"), "rep"), "sized")
    # staged like the keys: a large region is split by the join
    weight = 8 * F.sum("n_shingles")
    wide = (F.count(F.lit(1)) > block) | (weight > BLOCK_BYTES)
    regions = stage(sized.groupBy("region").agg(wide.alias("wide")), "region-sizes")
    # a small region is one block, a large one has blocks of every range of sizes
    sized = sized.join(regions, "region").withColumn(
        "grade", F.when(F.col("wide"), _grade(percent)).otherwise(0)
    )
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / block, weight / BLOCK_BYTES))
    grades = stage(sized.where("wide").groupBy("region", "grade").agg(blocks.alias("blocks")), "grade-sizes")
    placed = sized.join(grades, ["region", "grade"], "left").select(
        "rep",
        "set_key",
        "first_id",
        "region",
        "wide",
        "grade",
        F.when(F.col("wide"), F.col("grade") * _PLACES + F.pmod(F.xxhash64("rep"), "blocks"))
        .otherwise(0)
        .alias("place"),
    )
    placed = stage(placed, "placed")
    named = placed.select(F.col("first_id").alias("doc_id"))
    # an id may have several texts, and equal sets have one key: both are told by it
    sets = (
        likely(docs, "doc_id", named)
        .join(named, "doc_id", "left_semi")
        .select("text")
        .mapInArrow(_sets, "set_key binary, shingles binary")
        .dropDuplicates(["set_key"])
    )
    members = stage(
        placed.join(sets, "set_key").drop("set_key", "first_id").withColumn("label", F.col("rep")), "members"
    )
    inner = _compare(members.withColumn("piece", F.col("place")), percent)
    labels = stage(
        members.select("rep", "region", "wide", "grade", "place").join(
            inner.select("rep", F.col("merged").alias("label")), "rep", "left"
        ).withColumn("label", F.coalesce("label", "rep")),
        "labels",
    )
    wide = labels.where("wide")
    if not wide.limit(1).count():
        return labels.select("rep", "label")
    shingles = members.where("wide").select("rep", "shingles")

    # one class of every label and block first: most labels of a region meet here
    first = wide.groupBy("region", "place", "label").agg(F.min("rep").alias("rep"))
    first = stage(first, "firsts")
    counts = stage(first.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "first-sizes")
    first = first.join(counts, "region").select(
        "region",
        F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / block)).alias("piece"),
        "rep",
        "label",
    )
    merged = _compare(first.join(shingles, "rep"), percent).where("label <> merged")
    pairs = components(merged.select("label", "merged"), "label", "merged")
    wide = stage(
        _relabel(wide, pairs.withColumnsRenamed({"node": "label", "component": "merged"})), "wide"
    )

    # then every two blocks that hold classes with a common key, different labels and
    # sizes that allow links
    marks = (
        shared.select("key", "rep")
        .join(wide.select("rep", "region", "grade", "place", "label"), "rep")
        .groupBy("key", "region", "grade", "place")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
    )
    marks = stage(marks, "marks")
    other = marks.select(
        "key", *[F.col(c).alias(f"{c}2") for c in ("grade", "place", "low", "high")]
    )
    crossing = (
        marks.join(other, "key")
        .where("place < place2 AND grade2 - grade <= 1 AND (low <> high OR low2 <> high2 OR low <> low2)")
        .select("region", "place", "place2")
        .distinct()
    )
    pieces = crossing.withColumn("piece", F.xxhash64("place", "place2")).select(
        "region", "piece", F.explode(F.array("place", "place2")).alias("place")
    )
    merged = _compare(
        pieces.join(wide.join(shingles, "rep"), ["region", "place"]), percent
    ).where("label <> merged")
    pairs = components(merged.select("label", "merged"), "label", "merged")
    wide = _relabel(wide, pairs.withColumnsRenamed({"node": "label", "component": "merged"}))
    return labels.where("NOT wide").select("rep", "label").unionByName(wide.select("rep", "label"))


def _grouped(docs: DataFrame, percent: int, block: int) -> DataFrame:
    """Every row of (doc_id, text): doc_id, n_shingles, component_id, set_key, text_key, first.

    ``first`` tells the rows of the set that stands for its group: of the sets with
    the smallest id of the group, the one with the smallest key.
    """
    found = stage(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
            _signatures, "doc_id long, text_key long, n_shingles long, set_key binary, signature binary"
        ),
        "signatures",
    )
    linked = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    # numbered, since an id may name several texts; staged, so that the numbers stay
    classes = stage(
        linked.groupBy("set_key")
        .agg(
            F.min("doc_id").alias("first_id"),
            *[F.first(c).alias(c) for c in ("n_shingles", "signature")],
        )
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    labels = stage(class_components(classes, docs, percent, block), "class-labels")
    named = stage(
        classes.join(labels, "rep", "left").select(
            "set_key", "first_id", F.coalesce("label", "rep").alias("label")
        ),
        "named-classes",
    )
    # staged: the label of a large group is split by the join
    heads = stage(
        named.groupBy("label").agg(F.min(F.struct("first_id", "set_key")).alias("head")), "group-heads"
    )
    groups = stage(
        named.join(heads, "label").select(
            "set_key",
            F.col("head.first_id").alias("component_id"),
            (F.col("set_key") == F.col("head.set_key")).alias("first"),
        ),
        "groups",
    )
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id"))
    return found.join(groups, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce(alone, "component_id")).alias("component_id"),
        "set_key",
        "text_key",
        F.coalesce(
            F.when(F.col("n_shingles") > 0, F.col("first") & (F.col("doc_id") == F.col("component_id"))),
            F.lit(True),
        ).alias("first"),
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents with ``100 * common >= percent * union`` shingles are linked;
    ``component_id`` is the smallest id that links reach, ``kept`` marks it.  A
    text of fewer than five words is one shingle; a NULL text or one without
    words is empty and linked with nothing, as is a row without an id (its
    component is NULL, and it is kept).  Repeated rows give repeated results.
    Where an id has several texts, each row has the component of its own text,
    and links of one text do not connect the other.  An empty table gives an
    empty result; other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _grouped(docs, percent, block).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = 85,
    block: int = BLOCK,
) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near-duplicates.

    It has the smallest id of its group; where that id has several texts in the
    group, or rows are repeated, the smallest row by text, then by the other columns
    from left to right.  Different texts of one id that are no near-duplicates stay
    each.  Texts without words stay, one of each id; rows without an id all stay.
    """
    own_id, own_set, own_text, whole = free_names(docs, "_doc_id", "_set_key", "_text_key", "_row")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = _grouped(texts, percent, block).where("doc_id IS NOT NULL")
    # staged, so that no aggregate keeps the join by set from splitting the rows of many copies
    rows = stage(
        found.select(
            F.col("doc_id").alias(own_id),
            F.col("set_key").alias(own_set),
            F.col("text_key").alias(own_text),
            "first",
        ),
        "own-rows",
    )
    first = rows.where("first").drop("first")
    counts = first.groupBy(own_id, own_set).agg(F.count(F.lit(1)).alias("_n"))
    many = stage(counts.where("_n > 1").select(own_id, own_set), "many")
    repeated = not many.isEmpty()
    away = rows.where("NOT first").select(own_id, own_text)
    if repeated:
        members = stage(first.distinct().join(many, [own_id, own_set], "left_semi"), "repeated")
        away = away.unionByName(members.select(own_id, own_text))
    away = stage(away.distinct(), "away")
    # only rows that may go are shuffled with their texts; most stay where they are
    same = (F.col(id_col).cast("long") == F.col(own_id)) & (F.xxhash64(F.col(text_col)) == F.col(own_text))
    no_id = F.col(id_col).cast("long").isNull()
    doubtful, sure = parted(docs.where(~no_id), id_col, away.select(own_id))
    kept = sure.unionByName(doubtful.join(away, same, "left_anti")).unionByName(docs.where(no_id))
    if not repeated:
        return kept
    # of the rows of one id and set the smallest stays; partial minima are formed before the shuffle
    order = [text_col, *[c for c in docs.columns if c != text_col]]
    picked = (
        likely(docs, id_col, members.select(own_id))
        .join(members, same)
        .groupBy(own_id, own_set)
        .agg(F.min(F.struct(*[F.col(c) for c in order])).alias(whole))
        .select(*[F.col(whole)[c].alias(c) for c in docs.columns])
    )
    return kept.unionByName(picked)
