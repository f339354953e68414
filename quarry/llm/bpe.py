"""BPE encoding and decoding in batched numpy merge rounds.

The symbols of many words lie in one flat array.  In each round all adjacent
pairs are looked up by binary search over the sorted pair keys, every word
takes its lowest-ranked pair, and all its occurrences in that word are merged
at once, left to right; words without a pair drop out.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts_of

#: Words whose pieces a Python worker remembers before it starts afresh.
CACHE_WORDS = 400_000
#: Bytes of text coded at a time; their chunks, ids and tokens take some forty times as much.
RUN_BYTES = 1 << 20
#: Characters of the Unicode property White_Space (fixed by Unicode).
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 bytes stand for themselves, the others take
    the code points from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """What merging needs of a tokenizer file, as arrays."""

    def __init__(self, spec: dict):
        model = spec["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t.get("special")}
        self.text = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.size = max(self.text) + 1
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + suffix] for c in alphabet], np.int64)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        keys, made = left * self.size + right, np.array([vocab[a + b] for a, b in merges], np.int64)
        # A pair listed twice keeps its last rank, as in a map from pair to rank.
        order = np.lexsort((-np.arange(len(keys)), keys))
        order = order[np.concatenate([[True], np.diff(keys[order]) != 0])] if len(keys) else order
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Position of each pair among the sorted keys, -1 where it has no merge."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, at, -1)

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word (no word is empty)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        sym = self.inner[flat]
        last = np.cumsum(size) - 1
        sym[last] = self.final[flat[last]]
        word = np.repeat(np.arange(len(words)), size)
        none = len(self.keys) + 1
        inside = np.append(word[1:] == word[:-1], False)  # has a right neighbour in its word
        at = np.full(len(sym), -1)
        at[inside] = self._look(sym[inside], sym[1:][inside[:-1]])
        done_sym, done_word = [], []
        while len(sym):
            rank = np.where(at >= 0, self.rank[at], none) if len(self.keys) else np.full(len(sym), none)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(sym))))
            over = best == none
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
                if over.all():
                    break
                sym, word, at, rank, best = (x[~over] for x in (sym, word, at, rank, best))
            where = np.flatnonzero(rank == best)
            # Of hits that overlap (one symbol again and again), every second one counts.
            new_run = np.concatenate([[True], (np.diff(where) > 1) | (word[where[1:]] != word[where[:-1]])])
            start = np.maximum.accumulate(np.where(new_run, np.arange(len(where)), 0))
            where = where[(np.arange(len(where)) - start) % 2 == 0]
            sym[where] = self.made[at[where]]
            stay = np.ones(len(sym), bool)
            stay[where + 1] = False
            place = np.cumsum(stay) - 1
            sym, word, at = sym[stay], word[stay], at[stay]
            # Only the pairs beside a merge are new.
            m = place[where]
            touched = np.zeros(len(sym) + 1, bool)
            touched[m] = touched[m - 1] = True  # position -1 is spare
            m = np.flatnonzero(touched[:-1])
            at[m] = -1
            m = m[m < len(sym) - 1]
            m = m[word[m] == word[m + 1]]
            at[m] = self._look(sym[m], sym[m + 1])
        if not done_sym:
            return [[] for _ in words]
        word = np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        ids = np.concatenate(done_sym)[order].tolist()
        ends = np.cumsum(np.bincount(word, minlength=len(words))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]


class Codec:
    """Encodes and decodes texts; remembers the pieces of words it has seen.

    Text path: special tokens are cut out of the raw text, the rest is
    normalised (NFC, white space to a blank, lower case character by character)
    and cut at white space, which no word of the tokenizer's pattern contains.
    What stands between white space (a chunk) is cut into words by the pattern
    and each word's UTF-8 bytes are merged, once per chunk that is new."""

    def __init__(self, spec: dict, cache_words: int = CACHE_WORDS):
        import regex
        self.v, self.most = Vocabulary(spec), cache_words
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # The file's pattern writes \\s for Unicode White_Space.
        self.word = regex.compile(pattern.replace("[^\\s", f"[^{WHITE}"))
        self.wide_white = [c for c in WHITE if not c.isascii()]
        names = sorted(self.v.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.mark = names[0][:2].encode() if names else b""
        self.id_text = [str(i) for i in range(self.v.size)]
        self.cache: dict[bytes | int, tuple[str, str]] = {}

    def chunks(self, raw: bytes) -> list[bytes]:
        if not raw.isascii():
            text = unicodedata.normalize("NFC", raw.decode())
            for c in self.wide_white:
                if c in text:
                    text = text.replace(c, " ")
            raw = text.replace("\u03a3", "\u03c3").lower().encode()  # no rule for a final sigma
        return raw.lower().split()

    def pieces(self, raw: bytes) -> list:
        """Chunks (bytes) and special tokens (int) of a UTF-8 text."""
        if self.special is None or self.mark not in raw:
            return self.chunks(raw)
        out: list = []
        for k, part in enumerate(self.special.split(raw.decode())):
            out.extend([self.v.special[part]] if k % 2 else self.chunks(part.encode()))
        return out

    def learn(self, wanted: set) -> None:
        """Have every piece of ``wanted`` in the cache: its ids and its tokens,
        each as text joined by blanks."""
        new = [w for w in wanted if w not in self.cache]
        if len(self.cache) + len(new) > self.most:
            self.cache.clear()
            new = list(wanted)
        name, text = self.id_text, self.v.text
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            self.cache.update({i: (name[i], text[i]) for i in part if isinstance(i, int)})
            chunks = [w for w in part if not isinstance(w, int)]
            words = [self.word.findall(w.decode()) for w in chunks]
            flat = list({x for w in words for x in w})
            codes = dict(zip(flat, self.v.merge([x.encode() for x in flat]) if flat else []))
            for w, parts in zip(chunks, words):
                ids = codes[parts[0]] if len(parts) == 1 else [i for x in parts for i in codes[x]]
                self.cache[w] = (" ".join([name[i] for i in ids]), " ".join([text[i] for i in ids]))

    def code(self, raw: list) -> tuple[str, str]:
        """Ids and tokens of a text's pieces, as text joined by blanks."""
        got = [self.cache[w] for w in raw]
        return " ".join([x[0] for x in got]), " ".join([x[1] for x in got])

    def encode(self, text: str) -> list[int]:
        p = self.pieces(text.encode())
        self.learn(set(p))
        return list(map(int, self.code(p)[0].split()))

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by blanks (the file has no decoder); unknown ids are left out."""
        return " ".join([self.v.text[i] for i in ids if i in self.v.text])


def load_spec(path: str) -> dict:
    """The tokenizer file, read on the driver (a vocabulary of fixed size)."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``
    and, unless ``ids`` is false, ``token_ids``.  The digests are of the decimal
    ids joined by one blank and of the decoded text.  Null counts as empty and
    has no tokens; each row is coded alone, so repeats and ties need no rule."""
    sent = docs.sparkSession.sparkContext.broadcast(load_spec(path))

    def start():
        codec = Codec(sent.value)

        def f(cols):
            out = {"doc_id": cols["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "token_ids": []}
            pieces = [codec.pieces(t) for t in texts_of(cols["text"])]
            codec.learn(set().union(*pieces))
            for p in pieces:
                text, tokens = codec.code(p)
                out["n_tokens"].append(text.count(" ") + 1 if text else 0)
                out["ids_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(tokens.encode()).hexdigest())
                if ids:
                    out["token_ids"].append(np.array(text.split(), np.int32))
            return out
        return f
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    return map_batches(_rows(docs, id_col, text_col), None, schema, start, most=RUN_BYTES)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """``doc_id, decoded``: the decoded text of every row of token ids; null
    or empty ids give the empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(load_spec(path))

    def start():
        codec = Codec(sent.value)

        def f(cols):
            return {"doc_id": cols["doc_id"], "decoded": [codec.decode(x or []) for x in cols["token_ids"].to_pylist()]}
        return f
    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("token_ids"))
    return map_batches(rows, None, "doc_id long, decoded string", start)
