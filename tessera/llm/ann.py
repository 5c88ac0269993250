"""Nearest neighbours by cosine: block matrix join over int8 tiles.

Vectors are scaled to unit length, quantised to int8 with one scale each, and
packed into blocks of rows.  Query blocks meet candidate blocks; the int8
product of a tile, times the two scales, is a cosine with a known error bound:
for unit vectors ``x = sx*qx + ex`` and ``y = sy*qy + ey``,
``|x.y - sx*sy*qx.qy| <= |ex| + |sx*qx| * |ey|``.  A pair whose upper bound is
below the k-th largest lower bound of its query in the tile cannot be among the
k nearest; the surviving pairs are computed again in double precision from the
original vectors.  Heaps of k per query are kept over the tiles of a task and
merged across tasks, so each task sends at most k rows for a query.

The search is exact.  Integer products are taken in slices of 1024 components
in float32, where sums below 2**24 are exact.

Defined cases: vectors that are null, empty, all zero or hold a null or
non-finite component take no part, as queries or candidates, nor do rows with a
null id; vectors meet only vectors of their own length; of repeated ids the
smallest vector counts; ties go to the smaller id; with fewer than k candidates
all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Rows of a candidate block and of a query block.
CANDIDATES, QUERIES = 2048, 1024
_SLICE = 1024


def usable(vec: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def _pack(batches, dim_col: str):
    """Rows of a partition, grouped by (dim, block) already, to one row a block."""
    def out(dim, block, ids, vecs):
        order = sorted(range(len(ids)), key=lambda i: (ids[i], tuple(vecs[i])))
        keep = [i for n, i in enumerate(order) if n == 0 or ids[i] != ids[order[n - 1]]]
        m = np.asarray([vecs[i] for i in keep], np.float64)
        return pa.record_batch([
            pa.array([dim], pa.int32()), pa.array([block], pa.int64()),
            pa.array([np.asarray([ids[i] for i in keep], np.int64).tobytes()], pa.binary()),
            pa.array([m.tobytes()], pa.binary())], names=["dim", "block", "ids", "vecs"])
    at, ids, vecs = None, [], []
    for b in batches:
        for dim, block, i, v in zip(*(b.column(c).to_pylist() for c in ("dim", "block", "id", "vec"))):
            if at != (dim, block):
                if at is not None:
                    yield out(*at, ids, vecs)
                at, ids, vecs = (dim, block), [], []
            ids.append(i)
            vecs.append(v)
    if at is not None:
        yield out(*at, ids, vecs)


def _blocks(vectors: DataFrame, per_block: int, parts: int) -> DataFrame:
    """Packed blocks ``dim, block, ids, vecs`` of about ``per_block`` rows of one length.

    An id decides the block, so repeated ids meet in one.
    """
    n = vectors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / per_block).alias("blocks"))
    rows = (vectors.join(F.broadcast(n), "dim")  # a row for each vector length
            .select("dim", F.pmod(F.xxhash64("id"), "blocks").alias("block"), "id", "vec"))
    return (rows.repartition(parts, "dim", "block").sortWithinPartitions("dim", "block")
            .mapInArrow(lambda it: _pack(it, "dim"), "dim int, block bigint, ids binary, vecs binary"))


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, scales, lengths of the quantised rows and of what they miss."""
    scale = np.abs(unit).max(axis=1) / 127.0
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of int8 rows, as float64."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], _SLICE):
        out += a[:, i:i + _SLICE].astype(np.float32) @ b[:, i:i + _SLICE].astype(np.float32).T
    return out


def _side(ids: bytes, vecs: bytes, dim: int):
    m = np.frombuffer(vecs, np.float64).reshape(-1, dim)
    big = np.abs(m).max(axis=1)  # first to a size that squares cannot overflow
    length = np.sqrt(np.einsum("ij,ij->i", m / big[:, None], m / big[:, None])) * big
    return np.frombuffer(ids, np.int64), m, length, quantise(m / length[:, None])


def _tile(heaps: dict, query, cand, k: int) -> None:
    qid, qv, qlen, (qq, qs, qn, qe) = query
    cid, cv, clen, (cq, cs, cn, ce) = cand
    near = int8_product(qq, cq) * qs[:, None] * cs[None, :]
    err = qe[:, None] + qn[:, None] * ce[None, :] + 1e-9
    near[qid[:, None] == cid[None, :]] = -9.0  # own row
    low = near - err
    kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(qid), -8.0)
    floor = np.maximum(kth, [heaps[q][0][0] if len(heaps.get(q, ())) == k else -8.0 for q in qid.tolist()])
    r, c = np.nonzero(near + err >= floor[:, None])
    own = near[r, c] > -5
    r, c = r[own], c[own]
    for s in range(0, len(r), 65536):
        i, j = r[s:s + 65536], c[s:s + 65536]
        score = np.einsum("ij,ij->i", qv[i] / qlen[i][:, None], cv[j] / clen[j][:, None])
        for q, x, v in zip(qid[i].tolist(), cid[j].tolist(), score.tolist()):
            h = heaps.setdefault(q, [])
            if len(h) < k:
                heapq.heappush(h, (v, -x))
            elif (v, -x) > h[0]:
                heapq.heapreplace(h, (v, -x))


def _search(batches, k: int):
    heaps: dict[int, list] = {}
    last, side = None, None
    for b in batches:
        for dim, qi, qv, ci, cv in zip(*(b.column(c) for c in ("dim", "q_ids", "q_vecs", "ids", "vecs"))):
            d, ids = dim.as_py(), ci.as_py()
            if last != ids:
                last, side = ids, _side(ids, cv.as_py(), d)
            _tile(heaps, _side(qi.as_py(), qv.as_py(), d), side, k)
    q, x, v = [], [], []
    for query, h in heaps.items():
        for score, neg in h:
            q.append(query), x.append(-neg), v.append(score)
    yield pa.record_batch([pa.array(q, pa.int64()), pa.array(x, pa.int64()), pa.array(v, pa.float64())],
                          names=["query_id", "vec_id", "score"])


def _merge(pdf, k: int):
    import pandas as pd
    best = heapq.nsmallest(k, zip((-pdf["score"]).tolist(), pdf["vec_id"].tolist()))
    return pd.DataFrame({"query_id": [int(pdf["query_id"].iloc[0])] * len(best), "rank": range(1, len(best) + 1),
                         "vec_id": [i for _, i in best], "score": [-s for s, _ in best]})


def nearest(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest cosines of each row that ``queries`` selects.

    ``queries`` is a condition on the columns of ``vectors``; all rows but the
    query's own are candidates.  A candidate block is read by one task for each
    query block; the blocks of the stated queries are what is copied.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    clean = (vectors.where(F.col(id_col).isNotNull() & usable(F.col(vec_col)))
             .select(F.col(id_col).cast("long").alias("id"), F.size(vec_col).alias("dim"),
                     F.col(vec_col).cast("array<double>").alias("vec"), queries.alias("is_query")))
    cand = _blocks(clean.drop("is_query"), CANDIDATES, parts)
    asked = (_blocks(clean.where("is_query").drop("is_query"), QUERIES, parts)
             .select("dim", F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")))
    counts = clean.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / CANDIDATES).alias("blocks"))
    spread = (asked.join(F.broadcast(counts), "dim")  # a row for each vector length
              .select("dim", "q_ids", "q_vecs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")))
    tiles = spread.join(cand.hint("shuffle_hash"), ["dim", "block"])
    found = (tiles.repartition(parts, "dim", "block").sortWithinPartitions("dim", "block")
             .mapInArrow(lambda it: _search(it, k), "query_id long, vec_id long, score double"))
    return found.groupBy("query_id").applyInPandas(lambda p: _merge(p, k), "query_id long, rank int, vec_id long, score double")
