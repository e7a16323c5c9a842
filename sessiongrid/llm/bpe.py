"""Byte-level BPE encoding and decoding by a pair occurrence index.

The distinct pre-tokens of a partition are laid out in one array of symbols. An index maps each mergeable pair
to all of its positions; a heap holds the ranks that are active. Ranks are applied in ascending order, each to all
its positions from left to right, and the lists of the neighbouring pairs are updated. A merged symbol can only
stand in merges of a higher rank, so the global order gives each word what merging it alone would give.

Nulls count as the empty text (no ids). Texts are never cut. Repeated rows are encoded alike, each in its own row;
an empty table gives an empty result; extra columns are kept by ``encode`` unless they bear an output's name, which
is then replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pre-tokenisation of byte-level vocabularies (fixed values).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts in which the standard library's classes agree with it, twice as fast.
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
NOT_LATIN = "[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ͷ]"
#: Words kept with their ids in a worker, and characters taken together; bounds on memory, not on results.
CACHE_WORDS, SLICE_CHARS = 60_000, 4_000_000


class ByteBPE:
    """Vocabulary and merges of a tokenizers JSON file with a ByteLevel pre-tokenizer."""

    def __init__(self, path: str):
        import unicodedata

        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # Bytes outside the printable ranges are written as code points from 256 on, in ascending order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        char_of = {b: c for c, b in byte_of.items()}
        vocab = spec["model"]["vocab"]
        self._byte_ids = np.array([vocab[char_of[b]] for b in range(256)], dtype=np.int32)
        known = {i: bytes(byte_of[c] for c in tok) for tok, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        known |= {i: t.encode() for t, i in self.special.items()}
        # three numbers a merge: objects for each would be most of a worker's model
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merges = np.fromiter((i for a, b in merges for i in (vocab[a], vocab[b], vocab[a + b])), np.int32).reshape(-1, 3)
        keys = self.merges[:, 0].astype(np.int64) << 32 | self.merges[:, 1]
        self._ranks = np.argsort(keys, kind="stable").astype(np.int32)
        self._keys = keys[self._ranks]
        flat = [known[i] for i in range(max(known) + 1)]
        self._token_len = np.array(list(map(len, flat)), dtype=np.int64)
        self._token_at = np.cumsum(self._token_len) - self._token_len
        self._token_flat = np.frombuffer(b"".join(flat), dtype=np.uint8)
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._latin, self._not_latin, self._any = re.compile(LATIN_PATTERN), re.compile(NOT_LATIN), regex.compile(PATTERN)
        self._category, self._path, self._own = unicodedata.category, path, None
        self._forget()

    def token_bytes(self) -> list[bytes]:
        """The bytes of every token in the order of their ids."""
        return [self._token_flat[a : a + n].tobytes() for a, n in zip(self._token_at.tolist(), self._token_len.tolist())]

    def _forget(self) -> None:
        self._words = _Numbers()
        self._word_ids, self._word_len, self._word_at = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def pretokens(self, text: str) -> list[str]:
        if not self._not_latin.search(text):
            return self._latin.findall(text)
        if any(self._category(c) == "Cn" for c in set(text)):
            # Code points that Unicode versions disagree on: the library's own splitter decides.
            if self._own is None:
                from tokenizers import Tokenizer

                self._own = Tokenizer.from_file(self._path).pre_tokenizer
            return [text[a:b] for _, (a, b) in self._own.pre_tokenize_str(text)]
        return self._any.findall(text)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; -1 where the pair is no merge. Ends of words are negative symbols."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (left >= 0) & (right >= 0), self._ranks[at], -1)

    def _merge(self, words: list[str]) -> list[np.ndarray]:
        """Symbols of all words in one array, each word's end marked -1 and merged places -2."""
        coded = [w.encode("utf-8", "surrogatepass") for w in words]
        raw = np.frombuffer(b"".join(coded), dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded))) + np.arange(len(coded))
        n = len(raw) + len(coded)
        symbol = np.full(n, -1, np.int32)
        inner = np.ones(n, bool)
        inner[ends] = False
        symbol[inner] = self._byte_ids[raw]
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(ranks: np.ndarray, places: np.ndarray) -> None:
            """Put places under their pair's rank."""
            found = ranks >= 0
            ranks, places = ranks[found], places[found]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for r, p in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts) if len(cuts) else [places]):
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(active, r)

        note(self._rank(symbol[:-1], symbol[1:]), np.arange(n - 1, dtype=np.int32))
        while active:
            r = heapq.heappop(active)
            a, b, new = self.merges[r].tolist()
            places = np.unique(np.concatenate(index.pop(r)))
            places = places[(symbol[places] == a) & (symbol[after[places]] == b)]  # earlier merges took the others
            if a == b and len(places) > 1:  # runs of one symbol pair up from the left
                taken, last = [], -1
                for i, j in zip(places.tolist(), after[places].tolist()):
                    if i != last:
                        taken.append(i)
                        last = j
                places = np.array(taken, dtype=np.int32)
            if not len(places):
                continue
            right = after[places]
            behind = after[right]
            symbol[places], symbol[right] = new, -2
            after[places], before[behind] = behind, places
            ahead = before[places]
            known = ahead >= 0
            ahead = ahead[known]
            left = np.concatenate([symbol[ahead], symbol[places]])
            note(self._rank(left, np.concatenate([symbol[places[known]], symbol[behind]])), np.concatenate([ahead, places]))
        return [symbol, ends]

    def _learn(self) -> None:
        """Encode the words that have come in since the last call."""
        known = len(self._word_len)
        words = list(self._words)[known:]
        if not words:
            return
        symbol, ends = self._merge([w for w in words if w not in self.special] or [""])
        lens = np.diff(np.concatenate([[0], np.cumsum(symbol >= 0)[ends]]))
        ids = symbol[symbol >= 0]
        if any(w in self.special for w in words):
            own, k, at, out, out_len = self.special, 0, 0, [], []
            for w in words:
                if w in own:
                    out.append(np.array([own[w]], np.int32))
                else:
                    out.append(ids[at : at + lens[k]])
                    at, k = at + lens[k], k + 1
                out_len.append(len(out[-1]))
            ids, lens = np.concatenate(out), np.array(out_len, np.int64)
        self._word_ids = np.concatenate([self._word_ids, ids])
        self._word_len = np.concatenate([self._word_len, lens])
        self._word_at = np.cumsum(self._word_len) - self._word_len

    def _encode_slice(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self._words) > CACHE_WORDS:
            self._forget()
        number, numbered = self._words.__getitem__, []
        for t in texts:
            parts = []
            for p in self._special.split(t) if self._special and t else [t or ""]:
                if p in self.special:
                    parts.append(p)
                elif p:
                    parts += self.pretokens(p)
            numbered.append(np.fromiter(map(number, parts), np.int32, len(parts)))
        self._learn()
        return [gather(self._word_ids, self._word_at[w], self._word_len[w]) for w in numbered]

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Per text, its ids. Texts are taken together up to SLICE_CHARS, a longer one alone."""
        out, some, chars = [], [], 0
        for t in texts:
            some.append(t)
            chars += len(t or "")
            if chars >= SLICE_CHARS:
                out += self._encode_slice(some)
                some, chars = [], 0
        return out + (self._encode_slice(some) if some else [])

    def decode(self, ids: np.ndarray) -> str:
        return gather(self._token_flat, self._token_at[ids], self._token_len[ids]).tobytes().decode("utf-8", "replace")


class _Numbers(dict):
    """Numbers its keys in the order of their first look-up."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


def gather(flat: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs flat[at : at + length], one behind the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(at - ends + length, length) + np.arange(total)]


def _appended(df: DataFrame, fields: list[T.StructField]) -> tuple[DataFrame, T.StructType]:
    """df without columns named like an output, and the schema with the outputs behind."""
    names = {f.name.lower() for f in fields}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    return kept, T.StructType([*kept.schema.fields, *fields])


def encode(df: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """df with ``ids`` (array of int) of each whole text."""
    kept, schema = _appended(df, [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ByteBPE(tokenizer_path)
        for batch in batches:
            coded = model.encode_batch(batch.column(batch.schema.get_field_index(text_col)).to_pylist())
            offsets = np.cumsum([0, *map(len, coded)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *coded])))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return kept.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids") -> DataFrame:
    """df with ``decoded``, the text that the ids stand for; null ids give the empty text."""
    kept, schema = _appended(df, [T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ByteBPE(tokenizer_path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            texts = pa.array([model.decode(ids[i].values.to_numpy() if ids[i].is_valid else np.zeros(0, np.int32)) for i in range(len(ids))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return kept.mapInArrow(run, schema)


def round_trip(df: DataFrame, tokenizer_path: str, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: key, n_tokens, ids_sha256 and decoded_sha256, encoded and decoded in one pass over the text."""
    chosen = df.select(F.col(key), F.col(text_col).alias("text"))
    schema = T.StructType([chosen.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sha = ByteBPE(tokenizer_path), lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            texts = batch.column(1)
            key_values, at = batch.column(0), 0
            while at < len(texts):  # as many rows at a time as fit a slice
                n, chars = 0, 0
                some = []
                while at + n < len(texts) and chars < SLICE_CHARS:
                    some.append(texts[at + n].as_py())
                    chars += len(some[-1] or "")
                    n += 1
                coded = model.encode_batch(some)
                yield pa.RecordBatch.from_arrays(
                    [key_values.slice(at, n), pa.array(list(map(len, coded)), pa.int64()), pa.array([sha(c.astype("<u4").tobytes()) for c in coded], pa.string()), pa.array([sha(model.decode(c).encode()) for c in coded], pa.string())],
                    names=schema.names,
                )
                at += n

    return chosen.mapInArrow(run, schema)
