"""Byte-level BPE: encoding by a priority queue over a linked symbol list, decoding by the vocabulary.

A word's bytes form a doubly linked list of symbols.  A heap holds (merge rank,
position); a popped entry whose pair no longer stands there is stale and skipped.
Frequent words are remembered, within a bound.  Added tokens of the vocabulary are
found in the raw text first, as the public library does.

Defined results: null and empty texts have no ids; a text of any length is encoded
whole, in pieces of words that bound memory; repeated rows are encoded each.  Only the
id and text columns are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from halocline.llm.shared import columns_of, read

VOCABULARY = "byte_bpe_50k.json"
#: Splits a text into words before the merges (fixed by the vocabulary).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts of ASCII and Latin letters only, where the standard module agrees and is faster.
LATIN = "A-Za-zÀ-ÖØ-öø-ſ"
LATIN_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+"
PIECE_WORDS = 50_000
SHIFT = 20


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """A vocabulary and its merges.  ``MOST`` bounds the remembered words."""

    MOST = 300_000

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab: dict[str, int] = file["model"]["vocab"]
        chars = byte_characters()
        self.added = {x["content"]: x["id"] for x in file["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(chars[c] for c in token)
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.ids = list(range(size))  # one object for each id
        self.decimal = [str(i) for i in range(size)]
        self.of_byte = [0] * 256
        for c, b in chars.items():
            self.of_byte[b] = self.ids[vocab[c]]
        self.pairs: dict[int, int] = {}
        for rank, pair in enumerate(file["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.pairs[vocab[left] << SHIFT | vocab[right]] = rank << SHIFT | vocab[left + right]
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.words = regex.compile(WORDS)
        self.latin_words = re.compile(LATIN_WORDS)
        self.not_latin = re.compile(rf"[^\t\n\r -~{LATIN}]")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word by its merges."""
        ids = [self.of_byte[b] for b in word.encode("utf-8", "surrogatepass")]
        n, find = len(ids), self.pairs.get
        heap = []
        for i in range(n - 1):
            if (m := find(ids[i] << SHIFT | ids[i + 1])) is not None:
                heap.append((m >> SHIFT) << 32 | i)
        if not heap:
            return tuple(ids)
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            m = find(ids[i] << SHIFT | ids[j])
            if m is None or m >> SHIFT != entry >> 32:
                continue  # stale: one side has been merged since
            ids[i], ids[j] = m & ((1 << SHIFT) - 1), -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := find(ids[i] << SHIFT | ids[k])) is not None:
                    heappush(heap, (m >> SHIFT) << 32 | i)
            h = before[i]
            if h >= 0 and (m := find(ids[h] << SHIFT | ids[i])) is not None:
                heappush(heap, (m >> SHIFT) << 32 | h)
        return tuple(self.ids[i] for i in ids if i >= 0)

    def remember(self, word: str) -> tuple[int, ...]:
        if (found := self.older.get(word)) is None:
            found = self.word(word)
        if len(self.known) >= self.MOST // 2:
            self.older, self.known = self.known, {}
        self.known[word] = found
        return found

    def _words_of(self, text: str) -> Iterator[list[str]]:
        pattern = self.words if self.not_latin.search(text) else self.latin_words
        if len(text) <= 4 * PIECE_WORDS:
            yield pattern.findall(text)
            return
        matches = (m.group() for m in pattern.finditer(text))
        while piece := list(islice(matches, PIECE_WORDS)):
            yield piece

    def encode_pieces(self, text: str) -> Iterator[list[int]]:
        """Ids in order, some words at a time."""
        for part in self.special.split(text) if self.special and any(a in text for a in self.added) else [text]:
            if part in self.added:
                yield [self.added[part]]
            elif part:
                for words in self._words_of(part):
                    for w in set(words).difference(self.known):
                        self.remember(w)
                    known = self.known
                    try:
                        yield list(chain.from_iterable(map(known.__getitem__, words)))
                    except KeyError:  # the memory turned over within the piece
                        yield list(chain.from_iterable(known.get(w) or self.remember(w) for w in words))

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(self.encode_pieces(text or "")))

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[str, Bpe] = {}


def load(vocabulary: str | None = None) -> Bpe:
    """The vocabulary file, read once in a process; the public file unless a path is given."""
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path(VOCABULARY)
    if vocabulary not in _loaded:
        _loaded[vocabulary] = Bpe(vocabulary)
    return _loaded[vocabulary]


def encode_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids`` (array of int)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch, texts in columns_of(batches):
            ids = pa.array([bpe.encode(t) for t in texts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return df.select(df[id_col].cast("long").alias("doc_id"), df[text_col]).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for batch in batches:
            texts = pa.array([bpe.decode(ids or ()) for ids in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(df: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every text encoded, its ids decoded, both hashed."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        decimal, token = bpe.decimal.__getitem__, bpe.bytes.__getitem__
        for batch, texts in columns_of(batches):
            n, of_ids, of_text = [], [], []
            for text in texts:
                count, a, b = 0, hashlib.sha256(), hashlib.sha256()
                for ids in bpe.encode_pieces(text):
                    a.update((("," if count else "") + ",".join(map(decimal, ids))).encode())
                    # pieces end between words, so never inside a character
                    b.update(b"".join(map(token, ids)).decode("utf-8", "replace").encode())
                    count += len(ids)
                n.append(count)
                of_ids.append(a.hexdigest())
                of_text.append(b.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
