"""Hard-negative mining by slot-decomposed selection.

Every anchor's positives are its best rows of the same label.  A positive of
score p opens a window of negative scores whose upper limit follows from p, so
the windows of one anchor overlap.  Their upper limits cut the score axis into
disjoint slots.  One scan keeps the best ``k`` different-label rows of each
slot (a bounded state per task, merged by a second combiner), and a window's
answer is the head of a descending suffix of the slots: no row outside a
slot's best ``k`` can be among the best ``k`` of a window made of whole slots,
and the window's lower limit only shortens that head.

Anchors are a stated query set.  They are taken in blocks of bounded size, and
each block is scored against all rows by matrix products inside the scan, so
rows are never shuffled by label or anchor and a hot label changes nothing.
Only the bests of (task, anchor, slot) are shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

ANCHOR_EVERY = 50
N_POSITIVES = 5
N_NEGATIVES = 3
#: Window of negative scores, in percent of the positive's score.
LOW, HIGH = 50, 95
#: Bytes of one anchor block (vectors and running bests), sent to every task.
BLOCK_BYTES = 32 << 20
_ROWS, _ANCHORS = 2048, 512
_LONG = np.iinfo(np.int64)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label") -> DataFrame:
    """``vec_id, label, v`` of the rows that take part, one row per vec_id,
    spread by vec_id."""
    label = F.col(label) if isinstance(label, str) else label
    finite = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & label.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.struct(label.cast("long").alias("label"),
                 F.transform(vector_col, lambda x: F.floor(x.cast("double") * 256)).alias("v")).alias("r"))
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "vec_id").groupBy("vec_id").agg(F.min("r").alias("r")).select("vec_id", "r.label", "r.v")


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column as an int64 matrix, short ones padded by 0."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: floating point only where every sum is below
    2^53; beyond 64 bits they saturate."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = width * max(abs(int(a.max())), abs(int(a.min()))) * max(abs(int(b.max())), abs(int(b.min())))
    if most < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if most < 1 << 63:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, _LONG.min, _LONG.max).astype(np.int64)


class SlotBests:
    """Running best ``k`` (score descending, then id) of every (anchor, slot).

    ``low`` and ``high`` (anchors x slots) are the slots' inclusive limits; an
    unused slot has low above high.  ``floor`` rises to a full slot's k-th
    score, so later rows below it are passed over by one comparison."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.high, self.floor, self.k = high, low.copy(), k
        self.at, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> None:
        """``scores`` of the anchors from ``first`` on against the rows ``ids``."""
        slots, found = self.high.shape[1], []
        rows = slice(first, first + len(scores))
        for j in range(slots):
            a, r = np.nonzero(wanted & (scores >= self.floor[rows, j, None]) & (scores <= self.high[rows, j, None]))
            if len(a):
                found.append(((a + first) * slots + j, scores[a, r].astype(np.int64), ids[r]))
        if found:
            self._merge(*(np.concatenate(x) for x in zip((self.at, self.score, self.ids), *found)))

    def _merge(self, at, score, ids) -> None:
        order = np.lexsort((ids, ~score, at))
        at, score, ids = at[order], score[order], ids[order]
        start = np.r_[True, at[1:] != at[:-1]]
        place = np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]
        keep = place < self.k
        full = place == self.k - 1
        self.floor.reshape(-1)[at[full]] = score[full]
        self.at, self.score, self.ids = at[keep], score[keep], ids[keep]


def _scan(rows: DataFrame, block: dict, low: np.ndarray, high: np.ndarray, k: int, same: bool) -> DataFrame:
    """``anchor_id, slot, vec_id, score``: each task's bests of the block."""
    sent = rows.sparkSession.sparkContext.broadcast((block, low, high))

    def run(batches):
        import pyarrow as pa
        (anchor, low, high), step = sent.value, 64
        best = SlotBests(low, high, k)
        for b in batches:
            ids, labels = (b.column(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "label"))
            v, at = _matrix(b.column("v")), 0
            while at < len(ids):
                some = slice(at, at + step)
                for first in range(0, len(anchor["ids"]), _ANCHORS):
                    part = slice(first, first + _ANCHORS)
                    wanted = (anchor["labels"][part, None] == labels[some]) == same
                    if same:
                        wanted &= anchor["ids"][part, None] != ids[some]
                    best.add(first, _products(anchor["v"][part], v[some]), ids[some], wanted)
                at, step = at + step, min(2 * step, _ROWS)
        yield pa.RecordBatch.from_pydict({"anchor_id": anchor["ids"][best.at // high.shape[1]],
                                          "slot": best.at % high.shape[1], "vec_id": best.ids, "score": best.score})

    out = rows.mapInArrow(run, "anchor_id long, slot long, vec_id long, score long")
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    best = materialize(out.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k))
    sent.destroy()
    return best


def _limits(ids: np.ndarray, anchors: np.ndarray, scores: np.ndarray, n: int, low: int, high: int):
    """The slots of every anchor, from its positives' scores: the distinct
    upper limits, highest first, each slot down to the next limit or to the
    lower limit of the positive that opens it."""
    lo, hi = np.full((len(ids), n), 1, np.int64), np.zeros((len(ids), n), np.int64)
    at, seen = {i: j for j, i in enumerate(ids.tolist())}, {}
    for anchor, p in sorted(zip(anchors.tolist(), scores.tolist()), key=lambda x: -x[1]):
        u, l = p * high // 100, -(-p * low // 100)
        if l <= u and seen.setdefault(anchor, [])[-1:] != [u]:
            j = len(seen[anchor])
            lo[at[anchor], j], hi[at[anchor], j] = l, u
            if j:
                lo[at[anchor], j - 1] = max(lo[at[anchor], j - 1], u + 1)
            seen[anchor].append(u)
    return lo, hi


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        label: Column | str = "label", anchor_every: int = ANCHOR_EVERY, n_positives: int = N_POSITIVES,
                        n_negatives: int = N_NEGATIVES, low: int = LOW, high: int = HIGH,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every anchor (vec_id divisible by ``anchor_every``)
    and each of its best ``n_positives`` rows of the same label, the best
    ``n_negatives`` rows of another label whose score lies between ``low`` and
    ``high`` percent of the positive's.

    Components become ``floor(256 x)``, scores are exact integer inner
    products (they saturate at 64 bits) and ties go to the lesser vec_id.
    Rows with a null id, label or vector, or a null or non-finite component
    take no part; an empty vector scores 0, and of vectors of different
    length the shorter is padded by zeros.  Of rows that share a vec_id, the
    one with the least (label, vector) counts, so repeated rows count once.  A
    positive with an empty window has no rows, nor has a negative positive.
    Extra columns are ignored, whatever their names; an empty table gives no
    rows."""
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors, id_col, vector_col, label))
    anchors = rows.where(F.col("vec_id") % anchor_every == 0)
    n, width = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    each = 8 * (width + 4 * n_positives + 4 * n_positives * max(n_negatives, 1))
    blocks = max(1, -(-n * each // block_bytes))
    all_positives, all_negatives = [], []
    for b in range(blocks):
        taken = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow().combine_chunks()
        if not taken.num_rows:
            continue
        ids, labels = (taken[c].to_numpy() for c in ("vec_id", "label"))
        block = {"ids": ids, "labels": labels, "v": _matrix(taken["v"].chunk(0))}
        whole = np.full((len(ids), 1), _LONG.min), np.full((len(ids), 1), _LONG.max)
        positives = _scan(rows, block, *whole, n_positives, same=True)
        scored = positives.select("anchor_id", "score").toArrow()
        slots = _limits(ids, scored["anchor_id"].to_numpy(), scored["score"].to_numpy(), n_positives, low, high)
        all_positives.append(positives)
        all_negatives.append(_scan(rows, block, *slots, n_negatives, same=False))
    if not all_positives:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    return _answers(_union(all_positives), _union(all_negatives), n_negatives, low, high)


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _answers(positives: DataFrame, slots: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """Suffix merges: an anchor's slot bests in descending order; a window
    takes the first ``k`` from its upper limit on, as far as its lower limit."""
    merged = slots.groupBy("anchor_id").agg(F.sort_array(F.collect_list(
        F.struct(F.bitwise_not("score").alias("down"), F.col("vec_id"), F.col("score")))).alias("down"))
    q, m = F.expr("(score - pmod(score, 100)) div 100"), F.pmod("score", F.lit(100))
    windows = positives.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        (q * high + F.floor(m * high / 100)).alias("upper"), (q * low + F.ceil(m * low / 100)).alias("lower"))
    found = windows.join(merged, "anchor_id").select(
        "anchor_id", "positive_id", "positive_score", "lower",
        F.posexplode(F.slice(F.filter("down", lambda x: x["score"] <= F.col("upper")), 1, k)).alias("at", "x"))
    return found.where("x.score >= lower").select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("negative_id"),
        "positive_score", F.col("x.score").alias("negative_score"))
