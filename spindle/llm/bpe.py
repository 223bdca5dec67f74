"""Byte-pair encoding and decoding with a published vocabulary.

A word's symbols form a doubly linked list; a heap holds the merges that are
possible now by rank and place.  The lowest is popped, skipped when a merge
has changed its symbols since, and otherwise done, which opens new ones on
either side.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class BpeTokenizer:
    """Word-level BPE of a ``tokenizers`` JSON file whose words are split by a pattern that drops the rest.

    ``encode`` follows the file: its added tokens are cut out of the raw text
    first, what is between is brought to NFC, lower-cased character by character
    and split into words; white space is dropped.  Words are remembered, at most
    ``remember`` of them; long ones are not.
    """

    def __init__(self, path: str, remember: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if model["type"] != "BPE" or split["behavior"] != "Removed" or not split["invert"] or spec["decoder"] is not None:
            raise ValueError("the file is not of the kind this tokenizer reads")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): r for r, m in enumerate(model["merges"])}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # the file's \s is the Unicode property, which `regex` writes so
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}"))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.alphabet = byte_alphabet()
        size = max([*self.vocab.values(), *self.added.values()]) + 1
        self.strings = [""] * size
        for token, i in {**self.vocab, **self.added}.items():
            self.strings[i] = token
        self.known: dict[str, bytes] = {}
        self.remember = remember

    def merge(self, symbols: list[str]) -> list[str]:
        """Symbols after all merges, lowest rank first and leftmost among equals."""
        n, ranks = len(symbols), self.ranks
        right, left = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # stale: one of the two has been merged meanwhile
            symbols[i], symbols[j] = a + b, ""
            k = right[i] = right[j]
            if k >= 0:
                left[k] = i
                if (r := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (r, i, symbols[i], symbols[k]))
            if (h := left[i]) >= 0 and (r := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (r, h, symbols[h], symbols[i]))
        return [s for s in symbols if s]

    def encode_word(self, word: str) -> bytes:
        """Ids of one word as little-endian unsigned 32-bit integers."""
        symbols = [self.alphabet[b] for b in word.encode("utf-8")]
        symbols[-1] += self.suffix
        # a symbol outside the vocabulary is dropped, as there is no unknown token
        ids = [i for s in self.merge(symbols) if (i := self.vocab.get(s)) is not None]
        got = np.array(ids, "<u4").tobytes()
        if len(word) <= 64:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[word] = got
        return got

    def _encode_plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma: characters are lower-cased one by one
        known, encode = self.known, self.encode_word
        return b"".join([known.get(w) or encode(w) for w in self.words.findall(text.lower())])

    def encode(self, text: str) -> bytes:
        if self.specials is None or not any(s in text for s in self.added):
            return self._encode_plain(text)
        return b"".join(np.array([self.added[p]], "<u4").tobytes() if p in self.added else self._encode_plain(p) for p in self.specials.split(text))

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings one after another; without a decoder in the file a blank stands between."""
        strings = self.strings
        return " ".join([strings[i] for i in memoryview(ids).cast("I").tolist()])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> BpeTokenizer:
    """One per Python worker, kept over its tasks."""
    return BpeTokenizer(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers) of every whole text; null text: empty.

    Rows are kept one to one: repeated rows and null ids give rows alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([encode(t) for t in part.column("text").to_pylist()], pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids binary")


def encode_and_decode(docs: DataFrame, path: str) -> DataFrame:
    """As :func:`encode_documents`, with ``n_tokens`` and ``decoded``, the text that the ids give again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for part in slices(batch):
                ids = [t.encode(x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                                                  pa.array([t.decode(x) for x in ids], pa.string())], ["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode every whole text, decode the ids again: counts and digests of both, one row per row of ``docs``.

    An empty or null text has no tokens and decodes to an empty text.  Columns
    other than ``doc_id`` and ``text`` are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            for part in slices(batch):
                ids = [t.encode(x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(t.decode(x).encode("utf-8")).hexdigest() for x in ids]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, RESULT)
