"""Exact top-k inner products over vectors sorted by length.

Vectors are put in descending order of length and cut into slices. The first slice gives
every query a first lower bound for its k-th score. A slice meets a block of queries only
if their lengths allow a better score. Within a slice vectors come by descending length;
both sides are turned by the singular vectors of a sample, so that the leading coordinates
carry most of a product. What they leave open is at most the product of the two remaining
lengths (Cauchy-Schwarz); candidates that cannot reach the bound are dropped, the others
get their exact product.

Nulls: null vectors, null ids and vectors with a null or non-finite component take no part.
Shorter vectors count as filled up with zeros. Of repeated query rows one is answered; no
row with the query's own id is its candidate. Fewer candidates than k give fewer rows. Ties
go to the smaller id. Products are exact below 2**53 in size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.shared import write_table
from foldwise.llm.textbytes import pick

#: Vectors in a slice and queries in a block; both bound what one task holds.
SLICE_ROWS = 4096
BLOCK_ROWS = 1024
#: Vectors met between two updates of the bounds.
STEP_ROWS = 512
#: Vectors the rotation is computed from; it affects speed only, never results.
ROTATION_ROWS = 4096
#: Share of the coordinates in the leading part.
LEADING = 0.25
#: Ways among which pairs of blocks are dealt.
SALT = 64


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, vector`` (little-endian doubles), ``norm`` of all rows that take part."""
    source = pick(vectors, id_col, vector_col).where(
        F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            if not len(lists):
                continue
            offsets = np.asarray(lists.offsets).astype(np.int64)
            values = np.asarray(lists.values.to_numpy(zero_copy_only=False), dtype=float)
            values = np.floor(scale * values)
            bad = np.append(0, np.cumsum(~np.isfinite(values)))
            good = np.flatnonzero(bad[offsets[1:]] == bad[offsets[:-1]])
            rows = [values[offsets[i]:offsets[i + 1]] for i in good.tolist()]
            yield pa.RecordBatch.from_pydict({
                "id": batch.column(0).take(pa.array(good)).cast(pa.int64()),
                "vector": pa.array([r.astype("<f8").tobytes() for r in rows], pa.binary()),
                "norm": pa.array([float(np.sqrt(r @ r)) for r in rows], pa.float64())})

    return source.mapInArrow(run, "id long, vector binary, norm double")


def unpack(blobs: list[bytes], size: int) -> np.ndarray:
    out = np.zeros((len(blobs), size))
    for i, blob in enumerate(blobs):
        row = np.frombuffer(blob, "<f8")
        out[i, :len(row)] = row
    return out


def rotation(sample: np.ndarray) -> np.ndarray:
    """Orthogonal matrix whose columns are the sample's singular vectors, largest first."""
    if not len(sample):
        return np.eye(sample.shape[1])
    return np.linalg.svd(sample, full_matrices=True)[2].T if len(sample) > sample.shape[1] \
        else np.linalg.svd(sample.T @ sample)[0]


class Best:
    """The k best candidates of each query of a block so far."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k, self.floor = ids, k, floor.copy()
        self.query = np.zeros(0, np.int64)
        self.other = np.zeros(0, np.int64)
        self.score = np.zeros(0)

    def add(self, query: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
        own = self.ids[query] == other
        keep = ~own & (score >= self.floor[query])
        query = np.append(self.query, query[keep])
        other = np.append(self.other, other[keep])
        score = np.append(self.score, score[keep])
        order = np.lexsort((other, -score, query))
        query, other, score = query[order], other[order], score[order]
        first = np.searchsorted(query, query)
        keep = np.arange(len(query)) - first < self.k
        self.query, self.other, self.score = query[keep], other[keep], score[keep]
        full = np.arange(len(self.query)) - np.searchsorted(self.query, self.query) == self.k - 1
        at = self.query[full]
        self.floor[at] = np.maximum(self.floor[at], self.score[full])


def meet(best: Best, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
         turn: np.ndarray) -> None:
    """Hold a slice, sorted by descending length, against a block of queries."""
    lead = max(1, math.ceil(queries.shape[1] * LEADING)) if queries.shape[1] else 0
    turned_q = queries @ turn
    rest_q = np.sqrt((turned_q[:, lead:] ** 2).sum(axis=1))
    length_q = np.sqrt((queries ** 2).sum(axis=1))
    for a in range(0, len(vectors), STEP_ROWS):
        part, names = vectors[a:a + STEP_ROWS], ids[a:a + STEP_ROWS]
        longest = np.sqrt((part[0] ** 2).sum())
        slack = 1e-7 * (length_q * longest + 1)
        alive = np.flatnonzero(length_q * longest + slack >= best.floor)
        if not len(alive):
            continue
        turned = part @ turn
        rest = np.sqrt((turned[:, lead:] ** 2).sum(axis=1))
        bound = turned_q[alive, :lead] @ turned[:, :lead].T
        bound += np.outer(rest_q[alive], rest) + slack[alive, None]
        q, c = np.nonzero(bound >= best.floor[alive, None])
        if len(q) > 0.05 * bound.size:  # one product of matrices is then the shorter way
            exact = (queries[alive] @ part.T)[q, c]
        else:
            exact = np.einsum("ij,ij->i", queries[alive[q]], part[c])
        best.add(alive[q], names[c], exact)


def search(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id",
           vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """The ``k`` largest inner products of every query row against all other rows.

    Components become ``floor(scale * x)``. ``is_query`` is a condition on a column ``id``.
    Returns ``query_id long, rank int, vec_id long, score long``.
    """
    spark = vectors.sparkSession
    whole = write_table(quantised(vectors, id_col, vector_col, scale), "vectors")
    size, count = whole.agg(F.max(F.octet_length("vector")) / 8, F.count(F.lit(1))).first()
    size, slices = int(size or 0), max(1, -(-count // SLICE_ROWS))
    sample = whole.orderBy(F.xxhash64("id"), "id").limit(ROTATION_ROWS).toArrow()
    turn = rotation(unpack(sample["vector"].to_pylist(), size)) if size else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(turn)  # one square matrix of the vector length

    def pack(batches, rows: int):
        ids, blobs, part = [], [], 0
        base = TaskContext.get().partitionId() << 32

        def block():
            matrix = unpack(blobs, size)
            lengths = np.sqrt((matrix ** 2).sum(axis=1))
            return pa.RecordBatch.from_pydict({
                "block": pa.array([base + part], pa.int64()),
                "ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                "matrix": pa.array([matrix.astype("<f8").tobytes()], pa.binary()),
                "longest": pa.array([float(lengths.max())], pa.float64())})

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(i)
                blobs.append(v)
                if len(ids) == rows:
                    yield block()
                    ids, blobs, part = [], [], part + 1
        if ids:
            yield block()

    schema = "block long, ids binary, matrix binary, longest double"
    # Equal lengths are told apart by the id, so one common length fills many slices.
    ordered = (whole.repartitionByRange(slices, F.desc("norm"), "id")
               .sortWithinPartitions(F.desc("norm"), "id"))
    sliced = write_table(ordered.select("id", "vector").mapInArrow(
        lambda b: pack(b, SLICE_ROWS), schema), "vector-slices")
    top = sliced.orderBy(F.desc("longest"), "block").limit(1).toArrow().to_pylist()

    def blocked(batches):
        for batch in pack(batches, BLOCK_ROWS):
            row = batch.to_pylist()[0]
            ids = np.frombuffer(row["ids"], "<i8")
            best = Best(ids, k, np.full(len(ids), -np.inf))
            for lead in top:
                meet(best, np.frombuffer(row["matrix"], "<f8").reshape(len(ids), size),
                     np.frombuffer(lead["ids"], "<i8"),
                     np.frombuffer(lead["matrix"], "<f8").reshape(-1, size), shared.value)
            for name, value in (("floors", best.floor.astype("<f8").tobytes()),
                                ("floor", float(best.floor.min()))):
                kind = pa.binary() if name == "floors" else pa.float64()
                batch = batch.append_column(name, pa.array([value], kind))
            yield batch

    queries = whole.where(is_query).dropDuplicates(["id"]).select("id", "vector")
    blocks = write_table(queries.mapInArrow(
        blocked, schema + ", floors binary, floor double"), "query-blocks")
    # Which block meets which slice: lengths only, decided before any vector moves.
    salts = F.sequence(F.lit(0), F.lit(SALT - 1))
    reach = blocks.select(F.col("block").alias("q_block"), F.col("longest").alias("q_longest"),
                          "floor").withColumn("salt", F.explode(salts))
    lengths = sliced.select("block", "longest").withColumn(
        "salt", F.pmod(F.xxhash64("block"), F.lit(SALT)).cast("int"))
    pairs = reach.join(lengths, "salt").where(
        F.col("q_longest") * F.col("longest") * (1 + 1e-6) + 1e-6 >= F.col("floor")).select(
        "q_block", "block")
    rows = (pairs.join(blocks.select(F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
                                     F.col("matrix").alias("q_matrix"), "floors"), "q_block")
            .join(sliced.select("block", "ids", "matrix"), "block"))

    def scored(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = np.frombuffer(row["q_ids"], "<i8")
                best = Best(ids, k, np.frombuffer(row["floors"], "<f8"))
                meet(best, np.frombuffer(row["q_matrix"], "<f8").reshape(len(ids), size),
                     np.frombuffer(row["ids"], "<i8"),
                     np.frombuffer(row["matrix"], "<f8").reshape(-1, size), shared.value)
                yield pa.RecordBatch.from_pydict({
                    "query_id": pa.array(ids[best.query]), "vec_id": pa.array(best.other),
                    "score": pa.array(best.score.astype(np.int64))})

    found = rows.select("q_ids", "q_matrix", "floors", "ids", "matrix").mapInArrow(
        scored, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
