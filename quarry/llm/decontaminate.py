"""Benchmark decontamination: one Aho-Corasick automaton over normalised
benchmark windows; every text is scanned once and hits are mapped back to
word numbers and to character offsets of the original text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialize, texts_of

WINDOW_WORDS = 10
#: Benchmark bytes in one automaton; a larger benchmark takes more passes.
MAX_AUTOMATON_BYTES = 16 << 20

#: Word bytes are digits, letters and every byte of a multi-byte character;
#: A-Z become a-z; all others separate words.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def windows_of(words: list[bytes], size: int = WINDOW_WORDS) -> set[bytes]:
    if not words:
        return set()
    if len(words) < size:
        return {b" ".join(words)}
    return {b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)}


def build_automaton(items: list[tuple[str, bytes]], size: int = WINDOW_WORDS):
    """``items`` are (item_id as text, text); the automaton's values are
    (number of words, item ids)."""
    import ahocorasick
    owners: dict[bytes, set[str]] = {}
    for item_id, text in items:
        for w in windows_of(words_of(text), size):
            owners.setdefault(w, set()).add(item_id)
    a = ahocorasick.Automaton()
    for w, ids in owners.items():
        a.add_word(" " + w.decode("latin-1") + " ", (w.count(b" ") + 1, tuple(ids)))
    if owners:
        a.make_automaton()
    return a if owners else None


def scan(text: bytes, automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit word ranges [start, end) joined where they touch,
    and the ids of the items found."""
    words = words_of(text)
    if not words or automaton is None:
        return len(words), [], set()
    flat = " " + b" ".join(words).decode("latin-1") + " "
    found = list(automaton.iter(flat))
    if not found:
        return len(words), [], set()
    ends = np.cumsum([len(w) + 1 for w in words])  # flat offset of the blank after each word
    ranges, ids = [], set()
    for at, (n, owners) in found:
        e = int(np.searchsorted(ends, at)) + 1
        ids.update(owners)
        ranges.append((e - n, e))
    return len(words), _merge(ranges), ids


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[list[int]]:
    """Word ranges as [start, end) character offsets of the original text."""
    if not ranges:
        return []
    is_word = np.frombuffer(text.translate(WORDS), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], is_word.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])  # characters before each byte
    return [[int(chars[starts[s]]), int(chars[ends[e - 1]])] for s, e in ranges]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int):
    """The benchmark in parts of bounded size, each small enough to be sent to
    every task."""
    items = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).dropna().distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = -(-total // most) if total else 0
    part = F.pmod(F.xxhash64("t"), F.lit(max(n, 1)))
    for k in range(n):
        yield [(r["i"], r["t"].encode()) for r in items.where(part == k).collect()]


def _merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges sorted and joined where they overlap or touch."""
    merged: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", size: int = WINDOW_WORDS,
                       max_block_bytes: int = MAX_AUTOMATON_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, rk`` (xxhash64 of the text), ``n_words,
    n_hit, items, spans``: words of the text, words inside any benchmark
    window, ids of the items found (sorted as strings) and the hit [start, end)
    character spans of the original text.

    Null and empty texts have no words.  Items with null id or text are left
    out; repeated items count once.  An empty benchmark finds nothing.  Each
    row is judged alone, so repeated ids and ties need no rule.  Columns other
    than the two named are not read."""
    sc = docs.sparkSession.sparkContext
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("rk"),
                      F.col(text_col).cast("string").alias("text"))
    found = "n_words long, n_hit long, hits array<array<long>>, items array<string>, spans array<array<long>>"

    def one(df: DataFrame, items, first: bool, last: bool) -> DataFrame:
        sent = sc.broadcast(items)

        def start():
            automaton = build_automaton(sent.value, size)

            def f(cols):
                out = {"doc_id": cols["doc_id"], "rk": cols["rk"], "text": cols["text"], "n_words": [], "n_hit": [],
                       "hits": [], "items": [], "spans": []}
                before = zip(cols["hits"].to_pylist(), cols["items"].to_pylist()) if not first else iter([])
                for t in texts_of(cols["text"]):
                    n, ranges, ids = scan(t, automaton)
                    old_ranges, old_ids = next(before, ((), ()))
                    ranges = _merge([*ranges, *map(tuple, old_ranges)])
                    out["n_words"].append(n)
                    out["n_hit"].append(sum(e - s for s, e in ranges))
                    out["hits"].append(list(map(list, ranges)))
                    out["items"].append(sorted({*ids, *old_ids}))
                    out["spans"].append(original_spans(t, ranges))
                return out
            return f
        return map_batches(df, None, f"doc_id long, rk long, {found}" if last else f"doc_id long, rk long, text string, {found}", start)

    blocks = list(_blocks(benchmark, item_id, item_text, max_block_bytes)) or [[]]
    for k, items in enumerate(blocks):
        out = one(materialize(out) if k else out, items, not k, k == len(blocks) - 1)
    return out.select("doc_id", "rk", "n_words", "n_hit", "items", "spans")


def decontamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest columns of ``find_contamination``."""
    r = find_contamination(docs, benchmark)
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without any benchmark window, all columns kept."""
    hit = materialize(find_contamination(docs, benchmark, id_col, text_col).where("n_hit > 0").select(
        F.col("doc_id").alias("_hit_id"), F.col("rk").alias("_hit_key")).distinct())
    rk = F.xxhash64(docs[text_col].cast("string"))
    return docs.join(hit, docs[id_col].cast("long").eqNullSafe(hit["_hit_id"]) & (rk == hit["_hit_key"]), "left_anti")
