"""Repeated passages by windows at minimisers.

In every run of ``min_words`` words one content-selected position, the
minimiser, is retained, the same one wherever the run occurs.  Runs whose
minimiser's first words occur nowhere else leave.  The hashes of all others
are sorted over the whole cluster with their places, so that equal runs are
neighbours, whatever stands left or right of them; a hot run is spread over
many tasks by its places.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, release, texts_of

MIN_WORDS = 50
GRAM_WORDS = 8
_STRETCH = 1 << 23  # words whose minimisers are found at once; positions take 24 bits


def word_hashes(text: bytes, seen: dict[bytes, int]) -> np.ndarray:
    import xxhash
    words = text.lower().split()
    return np.array([seen[w] if w in seen else seen.setdefault(w, xxhash.xxh64_intdigest(w, 5)) for w in words], np.uint64)


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, by block-wise running minima."""
    n = len(x)
    pad = -n % w
    blocks = np.append(x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes.  It is a polynomial, so that of a
    run comes from those of its two halves."""
    size, power = 1, 0x9E3779B97F4A7C15
    g = h
    for bit in f"{k:b}"[1:]:
        g = g[:len(g) - size] * np.uint64(power) + g[size:]
        size, power = 2 * size, power * power % (1 << 64)
        if bit == "1":
            g = g[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[size:]
            size, power = size + 1, power * 0x9E3779B97F4A7C15 % (1 << 64)
    g = g ^ (g >> np.uint64(29))
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g


def owners(h: np.ndarray, min_words: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser position of each run of ``min_words`` words, and the hash of each run of ``k``."""
    w = min_words - k + 1
    if len(h) < min_words:
        return np.array([], np.int64), np.array([], np.uint64)
    g = grams(h, k)
    found, low = [], np.uint64((1 << 24) - 1)
    for at in range(0, max(1, len(g) - w + 1), _STRETCH):
        part = g[at:at + _STRETCH + w - 1]
        key = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        found.append((_window_min(key, w) & low).astype(np.int64) + at)
    return np.concatenate(found), g


def minimisers(h: np.ndarray, min_words: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Retained positions of a text and the hashes of their first ``k`` words."""
    own, g = owners(h, min_words, k)
    pos = np.unique(own)
    return pos, g[pos].view(np.int64)


_MATCH = "doc_id long, rk long, start long, other_id long, later boolean"
_KEY = ["run", "more", "doc_id", "rk", "start"]


def _equal_neighbours(rows):
    """Matches of neighbours in a sorted Arrow table of ``_KEY`` columns."""
    import pyarrow as pa
    n = rows.num_rows
    run, more, rk, start = (rows.column(x).to_numpy() for x in ("run", "more", "rk", "start"))
    ids = rows.column("doc_id")
    doc, null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
    agree = lambda x: x[1:] == x[:-1]
    itself = agree(doc) & agree(null) & agree(rk) & agree(start)  # a repeated row meets itself
    first = np.flatnonzero(agree(run) & agree(more) & ~itself) if n > 1 else np.array([], np.int64)
    at, other = np.concatenate([first, first + 1]), np.concatenate([first + 1, first])
    return {"doc_id": ids.take(pa.array(at)), "rk": rk[at], "start": start[at], "other_id": ids.take(pa.array(other)),
            "later": at > other}


def matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
            gram_words: int = GRAM_WORDS) -> DataFrame:
    """``doc_id, rk, start, other_id, later``: starts of runs of ``min_words``
    words that occur at another place too, with the id of a neighbour among the
    equal runs.  ``later`` marks all places of a run but the first by doc_id
    (null first), text hash and start."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("rk"), text.alias("text"))

    def retained(cols):
        seen, parts, size = {}, [], []
        for t in texts_of(cols["text"]):
            parts.append(minimisers(word_hashes(t, seen), min_words, gram_words))
            size.append(len(parts[-1][0]))
        if not parts:
            return None
        pos, g = (np.concatenate(x) for x in zip(*parts))
        at = np.repeat(np.arange(len(size)), size)
        return {"doc_id": cols["doc_id"].take(at), "rk": cols["rk"].to_numpy()[at], "pos": pos, "g": g}
    suffixes = materialize(map_batches(rows, retained, "doc_id long, rk long, pos long, g long"))
    shared = materialize(suffixes.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"))
    wanted = suffixes.join(shared.hint("merge"), "g").groupBy(F.col("doc_id").alias("w_id"), F.col("rk").alias("w_rk")).agg(
        F.collect_set("pos").alias("pos"))  # of one text
    wanted = materialize(wanted)
    release(suffixes, shared)
    texts = rows.join(wanted.hint("merge"), (rows["rk"] == wanted["w_rk"]) & rows["doc_id"].eqNullSafe(wanted["w_id"])).select(
        "doc_id", "rk", "pos", "text")

    def runs(cols):
        import pyarrow as pa
        seen, parts, size = {}, [], []
        for key, at, t in zip(cols["rk"].to_pylist(), cols["pos"], texts_of(cols["text"])):
            h = word_hashes(t, seen)
            own, _ = owners(h, min_words, gram_words)
            start = np.flatnonzero(np.isin(own, at.values.to_numpy()))
            run = grams(h, min_words)[start].view(np.int64)
            more = (grams(h ^ np.uint64(0xA5A5A5A5A5A5A5A5), min_words)[start] >> np.uint64(33)).astype(np.int32)
            parts.append((np.full(len(start), key, np.int64), start, run, more))
            size.append(len(start))
        if not parts:
            return None
        rk, start, run, more = (np.concatenate(x) for x in zip(*parts))
        ids = cols["doc_id"].take(pa.array(np.repeat(np.arange(len(size)), size)))
        return {"run": run, "more": more, "doc_id": ids, "rk": rk, "start": start}
    entries = map_batches(texts, runs, "run long, more int, doc_id long, rk long, start long")
    ordered = entries.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY)

    def neighbours(batches):
        import pyarrow as pa
        schema = pa.schema([("doc_id", pa.int64()), ("rk", pa.int64()), ("start", pa.int64()), ("other_id", pa.int64()),
                            ("later", pa.bool_()), ("edge", pa.int32()), ("run", pa.int64()), ("more", pa.int32())])
        last = None

        def edge(row, which):
            x = row.to_pylist()[0] | {"other_id": None, "later": None, "edge": which}
            return pa.RecordBatch.from_pylist([x], schema=schema)
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                yield edge(batch.slice(0, 1), 0)
            table = pa.Table.from_batches([x for x in (last, batch) if x is not None]).combine_chunks().to_batches()[0]
            found = _equal_neighbours(table)
            last = batch.slice(batch.num_rows - 1)
            if n := len(found["rk"]):
                yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) if f.name in found else pa.nulls(n, f.type) for f in schema], schema=schema)
        if last is not None:  # the first and the last run of a partition meet the neighbouring partitions' below
            yield edge(last, 1)
    compared = materialize(ordered.mapInArrow(neighbours, _MATCH + ", edge int, run long, more int"))
    release(wanted)
    inside = compared.where("edge is null").select("doc_id", "rk", "start", "other_id", "later")

    def at_edges(batches):
        import pyarrow as pa
        got = [b for b in batches if b.num_rows]
        if got:
            found = _equal_neighbours(pa.Table.from_batches(got).combine_chunks().to_batches()[0])
            names = ["doc_id", "rk", "start", "other_id", "later"]
            yield pa.RecordBatch.from_arrays([pa.array(found[n], pa.bool_() if n == "later" else pa.int64()) for n in names], names)
    # Two runs of each partition, in order: as many rows as there are partitions, times two.
    edges = compared.where("edge is not null").select(*_KEY, "edge").coalesce(1).sortWithinPartitions(*_KEY, "edge")
    return inside.unionByName(edges.select(*_KEY).mapInArrow(at_edges, _MATCH))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      gram_words: int = GRAM_WORDS) -> DataFrame:
    """One row per text that shares a passage of ``min_words`` words or more
    with another place: ``doc_id, rk, n_repeated`` (words inside such
    passages), ``passages`` ([start, stop) word ranges, joined where they
    touch), ``removable`` (the ranges of runs that a lesser doc_id, text hash and
    start has too: the copy there is kept, or goes for a lesser one, so that
    dropping them all leaves one copy of each word) and ``other_ids`` (ids of
    neighbours among the texts that share them, in the order of doc_id).

    Words are cut at ASCII white space, with A-Z lower-cased.  Null, empty and
    shorter texts have no such passage.  A repeated row (same id and text) is
    one text.  A passage that occurs twice in one text counts.  Texts with null
    id are compared like others; their partners list no null."""
    found = matches(docs, id_col, text_col, min_words, gram_words)
    # A run's start times two, plus one where it is removable.
    per = found.groupBy("doc_id", "rk").agg(F.collect_list(F.col("start") * 2 + F.col("later").cast("long")).alias("m"),
                                            F.collect_set("other_id").alias("other_ids"))

    def joined(starts):
        starts = np.unique(starts)
        cut = np.flatnonzero(np.diff(starts) > min_words) + 1
        return [[int(x[0]), int(x[-1]) + min_words] for x in np.split(starts, cut) if len(x)]

    def f(cols):
        out = {n: cols[n] for n in ("doc_id", "rk", "other_ids")} | {"n_repeated": [], "passages": [], "removable": []}
        for m in cols["m"]:
            code = m.values.to_numpy()
            all_ = joined(code >> 1)
            out["n_repeated"].append(sum(e - s for s, e in all_))
            out["passages"].append(all_)
            out["removable"].append(joined(code[code & 1 == 1] >> 1))
        return out
    return map_batches(per, f, "doc_id long, rk long, n_repeated long, passages array<array<long>>, removable array<array<long>>, other_ids array<long>")
