"""Searches of a stated set of vectors against all vectors, block by block.

All vectors are cut into blocks of bounded size, which are shuffled once.  Blocks of
queries are sent to every block: a task reads a block, prepares it once, and answers
the blocks of queries that follow it one after the other.  Each answer holds the best
of the block, and these are merged by query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batch

#: Vectors of one block of candidates, and of one block of queries, at most.
CANDIDATES = 4096
QUERIES = 1024
#: Bytes of the components of a block, at most; long vectors make blocks of fewer.
BLOCK_BYTES = 32_000_000

#: A block (ids, matrix, what was stored with it) to a function of (query ids, matrix)
#: that yields (position of the query, candidate ids, scores) for each query.
Answers = Callable[[np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]]
Prepare = Callable[[np.ndarray, np.ndarray, bytes], Answers]

_BLOCK = pa.schema(
    [("block", pa.int64()), ("ids", pa.binary()), ("uids", pa.binary()), ("lengths", pa.binary()),
     ("values", pa.binary()), ("stored", pa.binary())]
)
BLOCK_TYPE = "block long, ids binary, uids binary, lengths binary, values binary, stored binary"


def usable(vector: Column) -> Column:
    """Not NULL, and every component is a finite number."""
    infinite = F.lit(float("inf"))
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinite)
    )
    return vector.isNotNull() & ~bad


def usable_rows(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    """``id, uid, vector, is_query`` of the rows that take part; ``uid`` names an id and its vector."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    return rows.withColumn("uid", F.xxhash64("id", "vector"))


def _matrix(lengths: bytes, values: bytes, width: int) -> np.ndarray:
    """Vectors as rows of ``width`` components; missing ones are 0."""
    sizes = np.frombuffer(lengths, "<i4")
    matrix = np.zeros((len(sizes), width))
    matrix[np.arange(width) < sizes[:, None]] = np.frombuffer(values, "<f8")
    return matrix


def _width(lengths: bytes) -> int:
    return int(np.frombuffer(lengths, "<i4").max(initial=0))


def _packer(store: Callable[[np.ndarray], bytes] | None):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by block come in, one row per block goes out."""
        now, held = None, []

        def row() -> pa.RecordBatch:
            ids, uids, vectors = zip(*held, strict=True)
            lengths = np.array([len(v) for v in vectors], "<i4").tobytes()
            values = np.concatenate(vectors).astype("<f8").tobytes()
            stored = store(_matrix(lengths, values, _width(lengths))) if store else b""
            sides = (np.array(ids, "<i8").tobytes(), np.array(uids, "<i8").tobytes(), lengths, values, stored)
            return batch(_BLOCK, [[now], *([side] for side in sides)])

        for rows in batches:
            blocks, ids, uids = (rows.column(i).to_pylist() for i in range(3))
            vectors = rows.column(3)
            for i, block in enumerate(blocks):
                if held and block != now:
                    yield row()
                    held = []
                now = block
                held.append((ids[i], uids[i], vectors[i].values.to_numpy(zero_copy_only=False)))
        if held:
            yield row()

    return pack


def blocks_of(rows: DataFrame, n_blocks: int, store: Callable[[np.ndarray], bytes] | None = None) -> DataFrame:
    """``n_blocks`` rows of ``BLOCK_TYPE`` from rows of (id, uid, vector), dealt by the uid.

    ``store`` makes of the matrix of a block what is stored with it.
    """
    return (
        rows.select(F.pmod("uid", F.lit(n_blocks)).alias("block"), "id", "uid", "vector")
        .repartition("block")
        .sortWithinPartitions("block", "id", "uid")
        .mapInArrow(_packer(store), BLOCK_TYPE)
    )


def block_counts(rows: DataFrame, candidates: int, queries: int) -> tuple[int, int]:
    """Numbers of blocks of candidates and of queries that bound a block in rows and bytes."""
    n, m, longest = rows.agg(
        F.count(F.lit(1)), F.count_if("is_query"), F.max(F.size("vector"))
    ).first()
    most = max(1, BLOCK_BYTES // (8 * max(1, longest or 1)))
    return max(1, -(-n // min(candidates, most))), max(1, -(-m // min(queries, most)))


def few_copies(rows: DataFrame, k: int) -> DataFrame:
    """Of rows with the same id and vector the ``k`` that an answer can hold at most.

    Copies are counted map-side, so that no task gathers those of one row.
    """
    counted = rows.groupBy("id", "uid", "vector").agg(F.count(F.lit(1)).alias("_n"))
    copies = F.explode(F.array_repeat(F.lit(0), F.least("_n", F.lit(k)).cast("int")))
    return counted.select("id", "uid", "vector", copies.alias("_copy")).drop("_copy")


def answers(
    asked: DataFrame, n_asked: int, candidates: DataFrame, n_blocks: int, prepare: Prepare, score_type: str
) -> DataFrame:
    """(query_id, uid, vec_id, score): what every block answers to every query.

    ``asked`` and ``candidates`` are blocks; only those of queries are copied, once per
    block of candidates.  A task holds one block of each side.
    """
    spark = asked.sparkSession
    names = ["ids", "uids", "lengths", "values", "stored"]
    given = candidates.select(F.col("block").alias("to"), F.lit(-1).cast("long").alias("block"), *names)
    sent = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")).alias("to"), "block", *names
    )
    found_type = pa.int64() if score_type == "long" else pa.float64()
    schema = pa.schema(
        [("query_id", pa.int64()), ("uid", pa.int64()), ("vec_id", pa.int64()), ("score", found_type)]
    )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, to, answers_at = None, None, {}
        for rows in batches:
            for i in range(rows.num_rows):
                place, block, ids, uids, lengths, values, stored = (rows.column(c)[i].as_py() for c in range(7))
                if block < 0:
                    held, to, answers_at = (ids, lengths, values, stored), place, {}
                    continue
                if place != to:
                    continue  # a block without candidates
                # a block is prepared once for queries of its own length, or of a greater one
                width = max(_width(lengths), _width(held[1]))
                if width not in answers_at:
                    matrix = _matrix(held[1], held[2], width)
                    answers_at = {width: prepare(np.frombuffer(held[0], "<i8"), matrix, held[3])}
                q_ids, q_uids = np.frombuffer(ids, "<i8"), np.frombuffer(uids, "<i8")
                at, chosen, scores = [], [], []
                for query, best, score in answers_at[width](q_ids, _matrix(lengths, values, width)):
                    at.append(np.full(len(best), query))
                    chosen.append(best)
                    scores.append(score)
                if at:
                    at = np.concatenate(at)
                    yield batch(schema, [q_ids[at], q_uids[at], np.concatenate(chosen), np.concatenate(scores)])

    tasks = min(n_blocks, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return (
        given.unionByName(sent)
        .select("to", "block", *names)
        .repartition(max(1, tasks), "to")
        .sortWithinPartitions("to", "block")
        .mapInArrow(answer, f"query_id long, uid long, vec_id long, score {score_type}")
    )


def best_answers(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query row, with ``rank``; ties go to the smaller id."""
    best = Window.partitionBy("query_id", "uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    is_query: Column,
    prepare: Prepare,
    k: int,
    score_type: str,
    id_col: str,
    vector_col: str,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of every query row.

    Ties go to the smaller id.  Rows without an id or a usable vector take no
    part; a query row that repeats (id and vector) answers once; candidates with
    the id of the query are its own and left out.  Vectors of different lengths
    count missing components as 0.  An empty table gives an empty result.
    """
    rows = usable_rows(vectors, is_query, id_col, vector_col)
    n_blocks, n_asked = block_counts(rows, candidates, queries)
    asked = blocks_of(rows.where("is_query").dropDuplicates(["id", "uid"]), n_asked)
    given = blocks_of(few_copies(rows, k), n_blocks)
    found = answers(asked, n_asked, given, n_blocks, prepare, score_type)
    return best_answers(found, k).select("query_id", "rank", "vec_id", "score")


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        chosen = np.flatnonzero(scores >= edge)
    else:
        chosen = np.arange(len(scores))
    return chosen[np.lexsort((ids[chosen], -scores[chosen]))[:k]]
