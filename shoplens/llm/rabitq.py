"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Every vector is turned by one random rotation (from a seed) and kept as one
bit per dimension, with two scalars: its norm, and the inner product f of its
unit vector with its own code.  For a query q the estimate of <o, q> is
``norm * <code, Rq> / f``; its error is at most ``norm * |q| * sqrt((1 - f^2) /
f^2) * epsilon / sqrt(D - 1)`` with high probability.  Within a block of rows
the twenty best by estimate are scored exactly, and every row whose upper
bound reaches the last of them is scored too: only those original vectors are
read.  Scores are sums in component order in double precision, so equal
vectors tie exactly; ties go to the smaller id.

Queries meet all rows block by block: rows are dealt to blocks of bounded size
by hash, and each pair of a query block and a row block is one group.

Defined cases: vectors that are null, empty, zero or hold a null, NaN or
infinite component take no part, nor does a row with a null id; vectors of
different lengths are not compared; rows that repeat an id and vector count
once, and a row that carries the query's own id is never its candidate.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import stored

#: Rows and queries in a block: bounds the memory of one group.
ROWS_A_BLOCK = 16_384
QUERIES_A_BLOCK = 2_048
EPSILON = 2.5
SEED = 20_240_521
INDEX = "vec_id long, dim int, norm double, own double, code binary, vector binary"


def rotation(dim: int):
    import numpy as np

    return np.linalg.qr(np.random.default_rng(SEED + dim).standard_normal((dim, dim)))[0]


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull())
            .filter(F.coalesce(F.forall(v, good) & F.exists(v, lambda x: x != 0), F.lit(False))))


def encode_rows(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (vec_id, v) -> INDEX rows, one matrix product per length."""
    import numpy as np

    for batch in stream:
        lists = batch.column(1)
        flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        lengths = np.diff(offsets)
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            x = flat[offsets[at][:, None] + np.arange(dim)]
            # Scaled first, so that squares neither overflow nor vanish.
            scale = np.abs(x).max(axis=1, keepdims=True)
            norm = np.sqrt(((x / scale) ** 2).sum(axis=1, keepdims=True)) * scale
            turned = (x / norm) @ rotation(int(dim))
            bits = turned >= 0
            own = np.abs(turned).sum(axis=1) / math.sqrt(dim)
            codes = np.packbits(bits, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), dim, np.int32)), pa.array(norm[:, 0]),
                 pa.array(own), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([r.tobytes() for r in x.astype("<f8")], pa.binary())],
                names=["vec_id", "dim", "norm", "own", "code", "vector"])


def build_index(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The written index: one row for every valid vector."""
    return stored(valid_vectors(df, id_col, vector_col).mapInArrow(encode_rows, INDEX), "one-bit-index")


def _matrix(column: pa.ChunkedArray, dtype: str):
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), -1)


def search_block(wanted: int, epsilon: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best ``wanted`` of a block of rows for each query of a block of queries."""

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        import numpy as np

        found: list[tuple] = []
        if queries.num_rows and rows.num_rows:
            dim = rows.column("dim")[0].as_py()
            q_ids, q = queries.column("vec_id").to_numpy(), _matrix(queries.column("vector"), "<f8")
            ids, x = rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"), "<f8")
            # Rows that repeat an id take no other id's place.
            k = wanted + len(ids) - len(np.unique(ids))
            norm, own = rows.column("norm").to_numpy(), rows.column("own").to_numpy()
            signs = np.unpackbits(_matrix(rows.column("code"), "u1"), axis=1, count=dim).astype(np.float32) * 2 - 1
            signs /= np.float32(math.sqrt(dim))
            q_norm = queries.column("norm").to_numpy()
            turned = ((q / q_norm[:, None]) @ rotation(dim)).astype(np.float32)
            rate = norm / own
            slack = norm * np.sqrt(np.maximum(1 - own * own, 0)) / own * epsilon / math.sqrt(max(dim - 1, 1)) + norm * 1e-5
            for at in range(0, len(q), 128):
                estimates = signs @ turned[at:at + 128].T
                for j in range(estimates.shape[1]):
                    qi = at + j
                    est = estimates[:, j] * rate * q_norm[qi]
                    other = ids != q_ids[qi]
                    est[~other] = -np.inf
                    first = np.argpartition(-est, min(2 * k, len(est) - 1))[:2 * k]
                    first = first[other[first]]
                    if not len(first):
                        continue
                    sure = np.sort(x[first] @ q[qi])[::-1]
                    if len(sure) >= k:
                        bar = sure[k - 1] - abs(sure[k - 1]) * 1e-12
                        keep = np.flatnonzero((est + slack * q_norm[qi] >= bar) & other)
                    else:
                        keep = np.flatnonzero(other)
                    rough = x[keep] @ q[qi]
                    if len(keep) > k:
                        least = np.partition(rough, -k)[-k]
                        keep = keep[rough >= least - (np.abs(least) + norm[keep] * q_norm[qi]) * 1e-12]
                    # Component order: the same sum wherever a row stands.
                    score = np.cumsum(x[keep] * q[qi], axis=1)[:, -1]
                    best = np.lexsort((ids[keep], -score))
                    got, seen = [], set()
                    for b in best:
                        i = int(ids[keep[b]])
                        if i not in seen:
                            seen.add(i)
                            got.append((int(q_ids[qi]), i, float(score[b])))
                            if len(got) == wanted:
                                break
                    found += got
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, epsilon: float = EPSILON) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found per query.

    ``queries`` are index rows.  Every query goes to every row block once and
    every row to every query block once; the lists of a query (``k`` rows per
    block) meet in a window.
    """
    blocks = lambda df, size: max(1, -(-df.count() // size))
    n_rows, n_queries = blocks(index, ROWS_A_BLOCK), blocks(queries, QUERIES_A_BLOCK)
    deal = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = queries.select("vec_id", "dim", "norm", "vector", deal(n_queries, 1).alias("qb")).withColumn("rb", every(n_rows))
    r = index.withColumn("rb", deal(n_rows, 2)).withColumn("qb", every(n_queries))
    key = ["dim", "qb", "rb"]
    lists = q.groupBy(*key).cogroup(r.groupBy(*key)).applyInArrow(search_block(k, epsilon), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = lists.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
