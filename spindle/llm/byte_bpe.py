"""Byte-level BPE encoding and decoding in linear time.

The bytes of a pre-token stand as Latin-1 characters, so that an Aho-Corasick
automaton of the vocabulary can run over them.  A sequence of tokens is what the
merges would give exactly when every two neighbours are *compatible*: merging
their bytes alone by rank never joins the two.  Encoding takes the longest
vocabulary entry at each place; where it is not compatible with the token before
it, the next shorter entry is tried, and where none is left, the last token
is taken back.  A place that failed once is never entered again, which makes
the work linear in the length.  Compatibility of two tokens is remembered.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import slices
from .common import text_or_empty

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
LONG_PIECE = 64  # longer pre-tokens are not remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank out of a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class ByteBpe:
    """BPE over bytes by merge ranks; ids are the ranks.

    ``ranks`` must hold every single byte, and every longer token must be what the
    merges of lower rank give of its bytes but for one last merge; tokens that no
    merges give are only found as whole pre-tokens.  At most ``remember`` pre-tokens
    and as many pairs of neighbours are kept.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = 400_000):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.remember = remember
        self.whole = {t.decode("latin-1"): i for t, i in ranks.items()}
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.length = {i: len(t) for t, i in ranks.items()}
        self.decimal = {i: str(i) for i in ranks.values()}
        # what the vocabularies' library calls white space is the Unicode property
        self.pieces = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}"))
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.known: dict[str, list[int]] = {}
        made = {i for t, i in ranks.items() if len(t) == 1}
        for token, i in sorted(ranks.items(), key=lambda r: r[1]):
            if len(token) > 1 and (pair := self._last_merge(token, i, ranks)):
                self.halves[i] = pair
                self.joined[pair] = i
                made.add(i)
        self.automaton = ahocorasick.Automaton()
        for token, i in self.whole.items():
            if i in made:
                self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.reach = max(map(len, self.whole)) + 1
        # the longest other entry that a token begins with
        self.shorter: dict[int, int] = {}
        for token, i in self.whole.items():
            if len(token) > 1:
                self.shorter[i] = next(s for n in range(len(token) - 1, 0, -1) if (s := self.whole.get(token[:n])) in made)

    @staticmethod
    def _last_merge(token: bytes, rank: int, ranks: dict[bytes, int]) -> tuple[int, int] | None:
        """The two tokens that merges of lower rank make of a token's bytes; None if it is not two."""
        parts = [token[k:k + 1] for k in range(len(token))]
        while len(parts) > 2:
            best, at = min((ranks.get(parts[k] + parts[k + 1], rank), k) for k in range(len(parts) - 1))
            if best >= rank:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return ranks[parts[0]], ranks[parts[1]]

    def fit_together(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay apart when their bytes are merged by rank.

        Undoes the merges of both from the last one back, always the later of the
        two.  Before a merge was done, the tokens that face each other at the border
        must not have had an earlier one with each other (or, as the leftmost of equal
        merges goes first, an equal one that begins further left)."""
        key = (a, b)
        known = self.compatible.get(key)
        if known is not None:
            return known
        joined, halves = self.joined.get, self.halves.get
        # a merge of rank r over the border happens before the border tokens vanish: `until` is the first rank that is too late
        until, answer = float("inf"), True
        while True:
            over = joined((a, b))
            if over is not None and over < until:
                answer = False
                break
            left, right = halves(a), halves(b)
            if left is None and right is None:
                break
            if right is None or (left is not None and a > b):
                until, a = a, left[1]  # the border token of the left side was made by merge `a`, which comes first among equals
            else:
                until, b = b + 1, right[0]
        if len(self.compatible) >= self.remember:
            self.compatible.clear()
        self.compatible[key] = answer
        return answer

    def longest(self, piece: str, at: int) -> int:
        """The longest entry that begins at a place."""
        return next(self.automaton.iter_long(piece[at:at + self.reach]))[1]  # the automaton copies what it is given

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one pre-token, its bytes as Latin-1 characters."""
        whole = self.whole.get(piece)
        if whole is not None:
            return [whole]
        # greedy longest entries in one pass; most pre-tokens need no more
        tokens = [t for _, t in self.automaton.iter_long(piece)]
        fit, n = self.fit_together, len(piece)
        if all(map(fit, tokens, tokens[1:])):
            return tokens
        length, shorter = self.length, self.shorter
        dead = bytearray(n + 1)  # places after which no tokens can follow
        out: list[int] = []
        at, token = 0, tokens[0]
        while at < n:
            while token is not None and (dead[at + length[token]] or (out and not fit(out[-1], token))):
                token = shorter.get(token)
            if token is not None:
                out.append(token)
                at += length[token]
                token = self.longest(piece, at) if at < n else None
            else:
                dead[at] = 1
                last = out.pop()
                at -= length[last]
                token = last  # its end is dead now, so the next shorter one follows
        return out

    def _remembered(self, piece: str) -> list[int]:
        ids = self.encode_piece(piece.encode("utf-8", "replace").decode("latin-1"))
        if len(piece) <= LONG_PIECE:
            if len(self.known) >= self.remember:
                self.known.clear()
            self.known[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text: each match of the pattern by itself."""
        out: list[int] = []
        known, more, extend = self.known.get, self._remembered, out.extend
        for piece in self.pieces.findall(text):
            extend(known(piece) or more(piece))
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The vocabulary's strings one after another."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def as_decimals(self, ids: list[int]) -> str:
        return " ".join(map(self.decimal.__getitem__, ids))


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> ByteBpe:
    """One per Python worker, kept over its tasks."""
    return ByteBpe(read_ranks(path), pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` (list of integers) of every whole text; see :func:`round_trip` for the edge cases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for batch in batches:
            for part in slices(batch, 64):
                ids = [t.encode(x) for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``decoded`` (bytes) of rows as :func:`encode_documents` gives them; null ids count as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for batch in batches:
            for part in slices(batch, 64):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([t.decode(x or []) for x in part.column("ids").to_pylist()], pa.binary())], ["doc_id", "decoded"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Every whole text encoded and its ids decoded again: count and digests, one row per row of ``docs``.

    ``ids_sha256`` is that of the decimal ids joined by blanks, ``decoded_sha256``
    that of the decoded bytes.  A null or empty text has no tokens and decodes to
    nothing.  Repeated rows and null ids give rows alike; an empty table gives
    none.  Texts of any length are encoded whole: time and memory grow in
    proportion, also where a text is one pre-token.  Equal ranks don't occur, and of
    equal merges the leftmost goes first.  Columns other than ``doc_id`` and
    ``text`` are ignored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path, pattern)
        for batch in batches:
            for part in slices(batch, 64):
                counts, digests, decoded = [], [], []
                for text in part.column("text").to_pylist():
                    ids = t.encode(text)
                    counts.append(len(ids))
                    digests.append(hashlib.sha256(t.as_decimals(ids).encode()).hexdigest())
                    decoded.append(hashlib.sha256(t.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.array(counts, np.int64)), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, RESULT)
