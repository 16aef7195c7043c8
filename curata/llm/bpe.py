"""BPE encoding and decoding by batched merge rounds in numpy.

Texts are split at the special strings, normalised (NFC, white space to one
space, lower case) and cut into pre-tokens as the vocabulary file says. The
pre-tokens that a worker has not met are encoded together: their symbols lie in
one flat array, each round finds the ranks of all neighbouring pairs by binary
search in the sorted pair keys, and merges the lowest-ranked pair of every word,
left to right. A worker keeps what it has encoded in a cache of bounded size.

Nulls count as empty texts, which have no tokens and decode to an empty text.
Repeated rows are encoded again. Columns of the input pass through; a new column
takes the place of one of its name.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curata.llm.common import map_texts, table, worker_cache

#: White-space-delimited strings that a worker remembers before it starts afresh.
CACHE_ENTRIES = 200_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def newer_case() -> dict[int, str]:
    """Lower case of letters that Unicode 16 and 17 added, which the library knows and Python may not."""
    # fixed values: Unicode's case pairs
    single = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B}
    ranges = [(0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B)]
    return {a: chr(b) for a, b in single.items()} | {c: chr(c + d) for a, b, d in ranges for c in range(a, b + 1)}


class WordBpe:
    """The model of a word-end BPE file: encodes batches of texts, decodes ids."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        spec = json.loads(open(path, encoding="utf-8").read())
        vocab: dict[str, int] = spec["model"]["vocab"]
        end = spec["model"]["end_of_word_suffix"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pretokens = regex.compile(pattern + "| ").findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        signs = byte_symbols()
        self.inner = np.array([vocab[c] for c in signs], np.int64)
        self.final = np.array([vocab[c + end] for c in signs], np.int64)
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.size = max(names) + 1
        left, right, made = [], [], []
        for pair in spec["model"]["merges"]:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left.append(vocab[a])
            right.append(vocab[b])
            made.append(vocab[a + b])
        keys = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), np.array(made, np.int64)
        # decoding: the UTF-8 of every token and a space, in one flat array
        spelt = [(names.get(i, "") + " ").encode() for i in range(self.size)]
        self.spelt_at = np.concatenate([[0], np.cumsum([len(s) for s in spelt])])
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.newer = newer_case()
        self.has_newer = re.compile("[" + "".join(map(chr, self.newer)) + "]").search
        self.cache_entries = cache_entries
        self._forget()

    # -- encoding ---------------------------------------------------------
    def _forget(self) -> None:
        self.seen = _Index()
        self.ids = np.zeros(0, np.int32)
        self.at = np.zeros(1, np.int64)

    def merge(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty words given as bytes on end, flat, and the number of ids of each word."""
        ends = np.cumsum(lengths)
        sym = self.inner[raw]
        sym[ends - 1] = self.final[raw[ends - 1]]
        word = np.repeat(np.arange(len(lengths)), lengths)
        done_sym, done_word = [], []
        none = np.int64(len(self.ranks))
        while len(sym):
            joined = word[1:] == word[:-1]
            key = sym[:-1] * self.size + sym[1:]
            place = np.searchsorted(self.keys, key)
            place[place == len(self.keys)] = 0
            rank = np.where(joined & (self.keys[place] == key), self.ranks[place], none)
            first = np.flatnonzero(np.r_[True, ~joined])
            best = np.minimum.reduceat(np.r_[rank, none], first)
            which = np.cumsum(np.r_[True, ~joined]) - 1
            live = best[which] < none
            if not live.all():
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                if not live.any():
                    break
            hit = (rank == best[which[:-1]]) & (rank < none)
            at = np.flatnonzero(hit)
            # of overlapping pairs (a a a), every other one counted from the left
            start = np.r_[True, np.diff(at) > 1]
            run = at[np.flatnonzero(start)][np.cumsum(start) - 1]
            at = at[(at - run) % 2 == 0]
            sym[at] = self.made[rank[at]]
            live[at + 1] = False
            sym, word = sym[live], word[live]
        if not done_sym:
            return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(lengths))

    def _learn(self, chunks: list[str]) -> None:
        """Appends the ids of new chunks, in their order."""
        special = [(i, self.special[c[1:]]) for i, c in enumerate(chunks) if c[0] == " "]
        for i, _ in special:
            chunks[i] = ""
        joined = " ".join(chunks)
        pieces = self.pretokens(joined)  # with the spaces between chunks: together they are the whole string
        raw = np.frombuffer(joined.encode(), np.uint8)
        lengths = np.fromiter(map(len, pieces if joined.isascii() else map(str.encode, pieces)), np.int64, len(pieces))
        gap = raw[np.cumsum(lengths) - lengths] == 32 if len(pieces) else np.zeros(0, bool)
        owner = np.cumsum(gap)[~gap]
        ids, counts = self.merge(raw[raw != 32], lengths[~gap])
        per_chunk = np.bincount(owner, weights=counts, minlength=len(chunks)).astype(np.int64)
        if special:
            rows, values = np.array(special, np.int64).T
            ids = np.insert(ids, np.concatenate([[0], np.cumsum(per_chunk)])[rows], values)
            per_chunk[rows] = 1
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(per_chunk)])

    def normalise(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if self.has_newer(text):
                text = text.translate(self.newer)
        return text.replace("Σ", "σ").lower()  # character by character: no final form of sigma

    def chunks(self, text: str) -> list[str]:
        """Pieces between white space; a special string is one piece, marked by a leading space."""
        out: list[str] = []
        for i, part in enumerate(self.at_special.split(text) if "<|" in text else [text]):
            if i % 2:
                out.append(" " + part)
            elif any(c in part for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split, not to the pattern
                out += [c for c in regex.split(r"\s+", self.normalise(part)) if c]
            else:
                out += self.normalise(part).split()
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, flat, and where each text begins (one more entry than texts)."""
        if len(self.seen) > self.cache_entries:
            self._forget()
        all_chunks: list[str] = []
        ends = []
        for t in texts:
            all_chunks += self.chunks(t)
            ends.append(len(all_chunks))
        before = len(self.seen)
        index = np.fromiter(map(self.seen.__getitem__, all_chunks), np.int64, len(all_chunks))
        if len(self.seen) > before:
            self._learn(list(self.seen)[before:])
        flat, sizes = _gather(self.ids, self.at, index)
        return flat, np.concatenate([[0], np.cumsum(sizes)])[np.array([0, *ends], np.int64)]

    # -- decoding ---------------------------------------------------------
    def decode(self, ids: np.ndarray, at: np.ndarray) -> list[bytes]:
        """UTF-8 of each text: its tokens with a space between."""
        flat, sizes = _gather(self.spelt, self.spelt_at, ids.astype(np.int64))
        ends = np.concatenate([[0], np.cumsum(sizes)])[at]
        data = flat.tobytes()
        return [data[a : b - 1] if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


class _Index(dict):
    """Numbers keys in the order of their first use."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def _gather(values: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a ragged array, flat, and their sizes."""
    sizes = at[rows + 1] - at[rows]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    take = np.arange(total) + np.repeat(at[rows] - (ends - sizes), sizes)
    return values[take], sizes


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None, digests: bool = False) -> DataFrame:
    """``docs`` with its token ids and the text that these decode to.

    Adds ``token_ids`` (array of int), ``n_tokens`` and ``decoded_text``; with
    ``digests`` adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` instead.
    """
    full = [("token_ids", T.ArrayType(T.IntegerType())), ("n_tokens", T.LongType()), ("decoded_text", T.StringType())]
    short = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]

    def make():
        model = worker_cache("bpe", vocabulary, lambda: WordBpe(vocabulary))

        def work(texts: list[str]) -> dict[str, pa.Array]:
            ids, at = model.encode(texts)
            decoded = model.decode(ids, at)
            out = {"n_tokens": pa.array(np.diff(at))}
            if digests:
                raw, ends = memoryview(ids.astype("<u4").tobytes()), (at * 4).tolist()
                out["ids_sha256"] = pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())
                out["decoded_sha256"] = pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())
            else:
                out["token_ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                out["decoded_text"] = pa.array(decoded, pa.binary()).cast(pa.string())
            return out

        return work

    return map_texts(docs, make, short if digests else full, text, keep)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"], digests=True)
