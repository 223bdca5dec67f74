"""Token files coded with a static range asymmetric numeral system (rANS).

All blocks share one frequency table, made from counts over the whole corpus.
A block holds whole documents; its tokens go in turn to interleaved coder
states, which numpy advances together.  Each block stands alone, with
checksums, and an index at the file's end gives a checkpoint per block, so
tasks decode blocks in parallel.

File: magic, table checksum; blocks; index (compressed JSON), its length and
checksum, magic.  Numbers are little-endian.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import new_file, open_file, staged, text_or_empty

MAGIC = b"rANS\x01\x00\x00\x00"
SCALE_BITS = 18  # frequencies sum to 2**18: at most half of it may be symbols
LOW = np.uint64(1 << 31)  # states stay in [2**31, 2**63), refilled by 32 bits
LANES = 4096
BLOCK_TOKENS = 1 << 20
FILE_TOKENS = 1 << 26


class SharedTable:
    """Frequencies that sum to ``2**SCALE_BITS``, at least 1 for every symbol, in proportion to ``counts``."""

    def __init__(self, counts: np.ndarray):
        total, n = 1 << SCALE_BITS, len(counts)
        if 2 * n > total:
            raise ValueError(f"at most {total // 2} symbols")
        spare = total - n
        share = counts.astype(np.float64) * (spare / max(1, counts.sum()))
        freq = 1 + share.astype(np.int64)
        left = total - int(freq.sum())  # what rounding down left goes to the largest remainders
        order = np.argsort(-(share - np.floor(share)), kind="stable")
        freq += left // n
        freq[order[: left % n]] += 1
        self.freq = freq.astype(np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - SCALE_BITS)
        self.symbol = np.repeat(np.arange(n, dtype=np.uint32), freq)
        self.checksum = zlib.crc32(self.freq.astype("<u4").tobytes())

    def to_bytes(self) -> bytes:
        return self.freq.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> SharedTable:
        table = cls.__new__(cls)
        table.freq = np.frombuffer(data, "<u4").astype(np.uint64)
        table.first = np.concatenate([[0], np.cumsum(table.freq)[:-1]]).astype(np.uint64)
        table.limit = table.freq << np.uint64(63 - SCALE_BITS)
        table.symbol = np.repeat(np.arange(len(table.freq), dtype=np.uint32), table.freq.astype(np.int64))
        table.checksum = zlib.crc32(data)
        return table


@lru_cache(maxsize=2)
def shared_table(data: bytes) -> SharedTable:
    return SharedTable.from_bytes(data)


def encode_block(tokens: np.ndarray, table: SharedTable, lanes: int = LANES) -> bytes:
    """``n, lanes, words, crc of the ids, crc of the rest``, then the states and the words."""
    tokens = np.ascontiguousarray(tokens, "<u4")
    n = len(tokens)
    lanes = max(1, min(lanes, n))
    bits, half = np.uint64(SCALE_BITS), np.uint64(32)
    state = np.full(lanes, LOW, np.uint64)
    out = []
    for start in range((n - 1) // lanes * lanes if n else -1, -1, -lanes):  # last step first
        s = tokens[start:start + lanes]
        x, f = state[:len(s)], table.freq[s]
        full = x >= table.limit[s]
        out.append(x[full].astype("<u4"))  # the low halves, in lane order
        x = np.where(full, x >> half, x)
        q = x // f
        state[:len(s)] = (q << bits) + (x - q * f) + table.first[s]
    words = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
    body = state.astype("<u8").tobytes() + words.tobytes()
    return struct.pack("<IIIII", n, lanes, len(words), zlib.crc32(tokens.tobytes()), zlib.crc32(body)) + body


def decode_block(data: bytes, table: SharedTable) -> np.ndarray:
    """Ids of a block; a damaged one raises."""
    n, lanes, n_words, ids_crc, body_crc = struct.unpack_from("<IIIII", data)
    if len(data) != 20 + 8 * lanes + 4 * n_words or zlib.crc32(data[20:]) != body_crc:
        raise ValueError("block checksum does not match")
    state = np.frombuffer(data, "<u8", lanes, 20).astype(np.uint64)
    words = np.frombuffer(data, "<u4", n_words, 20 + 8 * lanes).astype(np.uint64)
    bits, half, mask = np.uint64(SCALE_BITS), np.uint64(32), np.uint64((1 << SCALE_BITS) - 1)
    tokens, at = np.empty(n, np.uint32), 0
    for start in range(0, n, lanes):
        x = state[:min(lanes, n - start)]
        slot = x & mask
        s = table.symbol[slot]
        tokens[start:start + len(s)] = s
        x = table.freq[s] * (x >> bits) + slot - table.first[s]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << half) | words[at:at + len(low)]
        at += len(low)
        state[:len(s)] = x
    if at != n_words or not (state == LOW).all() or zlib.crc32(tokens.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("ids checksum does not match")
    return tokens


# The split that the byte-level pre-tokenizer of the vocabulary does.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


# The same split for texts of Latin letters, in the standard library's faster engine, with letters and digits as
# explicit ranges; what differs there is looked for first.
ASCII_PIECES = re.compile(r" ?[a-zA-Z]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[!-/:-@\[-`{-~\x00-\x08\x0e-\x1b\x7f]+|\s+(?!\S)|\s+")
LATIN_PIECES = re.compile(r" ?[a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
NOT_LATIN = re.compile(r"[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]")


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: printable Latin-1 itself, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


END = 0xFF  # stands after each text; no byte of UTF-8
SPACE, LETTER, DIGIT, OTHER, STOP = range(5)


def latin_kinds() -> np.ndarray:
    """The kind of each character up to U+024F as :data:`LATIN_PIECES` takes it."""
    tests = [re.compile(x).match for x in (r"\s", r"[a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ]", "[0-9]")]
    return np.array([next((k for k, test in enumerate(tests) if test(chr(c))), OTHER) for c in range(0x250)], np.uint8)


KINDS = latin_kinds()
BYTE_KINDS = np.concatenate([KINDS[:128], np.full(127, OTHER, np.uint8), [np.uint8(STOP)]])


def piece_starts(raw: np.ndarray, size: int) -> np.ndarray:
    """Where the pre-tokens of :data:`LATIN_PIECES` begin in UTF-8 with ``END`` after each text; two bytes more must follow ``size``."""
    kind = BYTE_KINDS[raw[:size]]
    lead = np.flatnonzero(raw[:size - 1] >= 0xC0)
    lead = lead[raw[lead] != END]
    kind[lead] = kind[lead + 1] = KINDS[(raw[lead] & 31).astype(np.int32) << 6 | raw[lead + 1] & 63]
    start = np.ones(size, bool)
    start[1:] = kind[1:] != kind[:-1]
    start |= kind == STOP
    # the last white space before something else is apart from the white space before it; a blank goes with what follows
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != STOP))
    start[last - (raw[last] >= 0x80)] = True
    start[last[raw[last] == 32] + 1] = False
    # 's 't 'm 'd 're 've 'll
    quote = np.flatnonzero((raw[:size] == 39) & start)
    x, y = raw[quote + 1], raw[quote + 2]
    long = ((x == 114) | (x == 118)) & (y == 101) | (x == 108) & (y == 108)
    some = long | (x == 115) | (x == 116) | (x == 109) | (x == 100)
    quote, after = quote[some], (quote + 2 + long)[some]
    start[quote + 1] = False
    start[after[kind[after] == LETTER]] = True
    return np.flatnonzero(start)


def at_least(a: np.ndarray, n: int) -> np.ndarray:
    """``a`` with room for ``n`` elements."""
    return a if len(a) >= n else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


class PieceTable:
    """Ids by pre-token, for arrays of pre-tokens at once: their bytes as four numbers, and an open hash table.

    Longer pre-tokens than ``LONGEST`` bytes are held until :meth:`forget` only."""

    LONGEST = 32
    MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)

    def __init__(self, dtype: str):
        self.count = self.used = 0
        self.words = [np.zeros(1 << 12, np.uint64) for _ in range(4)]
        self.size, self.first, self.n = (np.zeros(1 << 12, t) for t in (np.int64, np.int64, np.int64))
        self.ids = np.zeros(1 << 12, dtype)
        self.slots = np.full(1 << 13, -1, np.int32)

    def words_of(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """The first 32 bytes of each piece, zeros after it; as many bytes must follow the last."""
        windows = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
        out = [windows[starts] & self.MASKS[np.minimum(sizes, 8)]]
        for k in (8, 16, 24):
            longer = np.flatnonzero(sizes > k)
            word = np.zeros(len(starts), np.uint64)
            word[longer] = windows[starts[longer] + k] & self.MASKS[np.minimum(sizes[longer] - k, 8)]
            out.append(word)
        return out

    def _slot(self, words: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        h = sizes.astype(np.uint64)
        for word, factor in zip(words, self.FACTORS):
            h = (h ^ word) * factor
            h ^= h >> np.uint64(29)
        return ((h * self.FACTORS[4]) >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def find(self, words: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """The entry of each piece, -1 for pieces not held."""
        found = np.full(len(sizes), -1, np.int64)
        todo, slot = np.arange(len(sizes)), self._slot(words, sizes)
        todo, slot = todo[sizes <= self.LONGEST], slot[sizes <= self.LONGEST]
        while len(todo):
            entry = self.slots[slot]
            there = np.flatnonzero(entry >= 0)
            todo, slot, entry = todo[there], slot[there], entry[there]
            same = self.size[entry] == sizes[todo]
            for mine, asked in zip(self.words, words):
                same &= mine[entry] == asked[todo]
            found[todo[same]] = entry[same]
            todo, slot = todo[~same], (slot[~same] + 1) % len(self.slots)
        return found

    def add(self, words: list[np.ndarray], sizes: np.ndarray, ids: list[bytes]) -> None:
        """Entries for different pieces that are not held, the long ones last."""
        old, self.count = self.count, self.count + len(ids)
        for mine, new in zip(self.words, words):
            mine[old:self.count] = new
        n = np.array([*map(len, ids)], np.int64) // self.ids.itemsize
        self.size[old:self.count], self.n[old:self.count] = sizes, n
        self.first[old:self.count] = self.used + np.cumsum(n) - n
        self.ids = at_least(self.ids, self.used + int(n.sum()))
        self.ids[self.used:self.used + int(n.sum())] = np.frombuffer(b"".join(ids), self.ids.dtype)
        self.used += int(n.sum())
        if 2 * self.count > len(self.slots):
            self._place(0, 1 << (4 * self.count).bit_length())
        else:
            self._place(old)

    def room(self, n: int) -> None:
        """Make room for ``n`` entries more."""
        self.words = [at_least(x, self.count + n) for x in self.words]
        self.size, self.first, self.n = (at_least(x, self.count + n) for x in (self.size, self.first, self.n))

    def _place(self, first: int, slots: int = 0) -> None:
        if slots:
            self.slots = np.full(slots, -1, np.int32)
        todo = first + np.flatnonzero(self.size[first:self.count] <= self.LONGEST)
        slot = self._slot([x[todo] for x in self.words], self.size[todo])
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            left = self.slots[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) % len(self.slots)

    def forget_long(self) -> None:
        """Drop the long pieces added last."""
        while self.count and self.size[self.count - 1] > self.LONGEST:
            self.count -= 1
            self.used = int(self.first[self.count])

    def keep(self, n: int) -> None:
        """Drop all entries but the first ``n``."""
        self.used, self.count = int(self.first[n]), n
        self._place(0, len(self.slots))

    def ids_of(self, entries: np.ndarray) -> tuple[bytes, np.ndarray]:
        """All ids one after another, and how many there are up to each entry's end."""
        n = self.n[entries]
        ends = np.cumsum(n)
        at = np.repeat(self.first[entries] - (ends - n), n)
        at += np.arange(len(at))
        return self.ids[at].tobytes(), ends


class PieceEncoder:
    """The ``tokenizers`` library's ids of whole texts, remembered by pre-token.

    Added tokens are cut out first, the text between is split as the library's
    byte-level pre-tokenizer does, and pre-tokens not met before go through the
    library's model.  Texts of Latin letters are split and looked up many at once in
    arrays, others one by one.  Of either kind at most ``remember`` pre-tokens are
    kept, and the half met first, which has the frequent ones, outlives the rest.
    Ids are little-endian, of 2 bytes where the vocabulary allows."""

    def __init__(self, path: str, remember: int = 500_000):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.size = max([*added.values(), self.tokenizer.get_vocab_size(with_added_tokens=True) - 1]) + 1
        self.dtype = ids_dtype(self.size)
        self.added = {k: np.array([i], self.dtype).tobytes() for k, i in added.items()}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.model, self.letters = self.tokenizer.model, byte_letters()
        # nothing stands between a pre-token and the model but its bytes' letters
        self.plain = self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and not self.tokenizer.pre_tokenizer.add_prefix_space
        self.alone = self._letter_alone() if self.plain else None
        self.bare = None if self.alone is None else Tokenizer(self.model)
        self.known: dict[str, bytes] = {}
        self.remember = remember
        self.table = self._new_table()

    def _new_table(self) -> PieceTable:
        table = PieceTable(self.dtype)
        table.add([np.array([w], np.uint64) for w in (END, 0, 0, 0)], np.array([1]), [b""])  # the end of a text has no ids
        return table

    def _letter_alone(self) -> bytes | None:
        """A byte that UTF-8 never has and no merge joins with another: the model's ids on either side of it are as if alone."""
        m = self.model
        if getattr(m, "dropout", None) or getattr(m, "ignore_merges", True) or m.continuing_subword_prefix or m.end_of_word_suffix:
            return None
        entries = self.tokenizer.get_vocab(with_added_tokens=False)
        joined = set("".join(x for x in entries if len(x) > 1))
        return next((bytes([b]) for b in (0xC0, 0xC1, *range(0xF5, 0x100)) if self.letters[b] in entries and self.letters[b] not in joined), None)

    def learn(self, new: list[str], together: int = 64) -> None:
        """Ids of pre-tokens from the library: of many pre-tokens by its model, else by all its steps."""
        if self.alone is None:
            self.known.update((p, np.array(e.ids, self.dtype).tobytes()) for p, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True))
            return
        data = [p.encode() for p in new]
        words = [(self.alone.join(data[i:i + together]) + self.alone).decode("latin-1").translate(self.letters) for i in range(0, len(data), together)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.bare.encode_batch_fast(words, add_special_tokens=False)), self.dtype)
        size = ids.itemsize
        ends = np.flatnonzero(ids == self.model.token_to_id(self.letters[self.alone[0]])) * size
        out = ids.tobytes()
        self.known.update((p, out[a:b]) for p, a, b in zip(new, [0, *(ends[:-1] + size).tolist()], ends.tolist(), strict=True))

    def split(self, text: str) -> list[str]:
        find = (PIECES if NOT_LATIN.search(text) else ASCII_PIECES if text.isascii() else LATIN_PIECES).findall
        if self.specials is None or not any(s in text for s in self.added):
            return find(text)
        return list(chain.from_iterable([p] if p in self.added else find(p) for p in self.specials.split(text)))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.remember:
            self.known = dict(islice(self.known.items(), self.remember // 2))
        self.known.update(self.added)
        latin = [self.plain and not NOT_LATIN.search(t) and not any(s in t for s in self.added) for t in texts]
        many = iter(self._encode_latin([t for t, x in zip(texts, latin, strict=True) if x]))
        one = iter(self._encode_any([t for t, x in zip(texts, latin, strict=True) if not x]))
        return [next(many if x else one) for x in latin]

    def _encode_any(self, texts: list[str]) -> list[bytes]:
        get = self.known.get
        split = [self.split(t) for t in texts]
        ids = [[*map(get, pieces)] for pieces in split]
        holes = [[j for j, x in enumerate(row) if x is None] for row in ids]
        if unknown := list({pieces[j] for pieces, row in zip(split, holes, strict=True) for j in row}):
            self.learn(unknown)
        for pieces, row, gaps in zip(split, ids, holes, strict=True):
            for j in gaps:
                row[j] = get(pieces[j])
        return [b"".join(row) for row in ids]

    def _encode_latin(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        table = self.table
        if table.count > self.remember:
            table.keep(max(1, self.remember // 2))
        end = bytes([END])
        data = end.join([t.encode() for t in texts]) + end
        raw = np.frombuffer(data + bytes(PieceTable.LONGEST + 8), np.uint8)
        starts = piece_starts(raw, len(data))
        sizes = np.diff(starts, append=len(data))
        words = table.words_of(raw, starts, sizes)
        entries = table.find(words, sizes)
        missing = np.flatnonzero(entries < 0)
        if len(missing):
            missing = missing[np.argsort(sizes[missing] > PieceTable.LONGEST, kind="stable")]
            pieces = [data[a:b] for a, b in zip(starts[missing].tolist(), (starts + sizes)[missing].tolist(), strict=True)]
            place: dict[bytes, int] = {}
            which = np.array([place.setdefault(p, len(place)) for p in pieces])
            new = [p.decode() for p in place]
            if here := [p for p in new if p not in self.known]:
                self.learn(here)
            ids = [self.known[p] for p in new]
            for p in here:
                del self.known[p]  # the table has it
            one = missing[np.unique(which, return_index=True)[1]]
            entries[missing] = table.count + which
            table.room(len(new))
            table.add([w[one] for w in words], sizes[one], ids)
        out, ends = table.ids_of(entries)
        table.forget_long()
        ends = ends[raw[starts] == END] * np.dtype(self.dtype).itemsize
        return [out[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


@lru_cache(maxsize=2)
def piece_encoder(path: str) -> PieceEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core already
    return PieceEncoder(path)


def tokenize(docs: DataFrame, path: str, end_id: int | None, rows: int = 256) -> DataFrame:
    """``doc_id, ids, ids_crc`` of every whole text, with ``end_id`` appended; null text: empty."""
    dtype = piece_encoder(path).dtype
    end = b"" if end_id is None else np.array([end_id], dtype).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                ids = [x + end for x in encoder.encode(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary()), pa.array([zlib.crc32(x) for x in ids], pa.int64())], ["doc_id", "ids", "ids_crc"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids binary, ids_crc long")


def ids_dtype(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def count_ids(tokens: DataFrame, size: int) -> DataFrame:
    """``id, n`` over all rows: each task counts its own ids, Spark adds the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                counts += np.bincount(np.frombuffer(b"".join(batch.column("ids").slice(i, 256).to_pylist()), ids_dtype(size)), minlength=size)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


class FileWriter:
    """One token file: whole documents are gathered into blocks."""

    def __init__(self, folder: str, table: SharedTable):
        self.uri, self.stream = new_file(folder, ".rans")
        self.table, self.held, self.docs, self.size = table, [], [], 0
        self.blocks, self.tokens, self.at = [], 0, 0
        self._write(MAGIC + struct.pack("<I", table.checksum))

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.held.append(np.frombuffer(ids, ids_dtype(len(self.table.freq))))
        self.docs.append((doc_id, len(self.held[-1])))
        self.size += len(self.held[-1])
        if self.size >= BLOCK_TOKENS:
            self.flush()

    def flush(self) -> None:
        if self.docs:
            data = encode_block(np.concatenate(self.held), self.table)
            self.blocks.append({"offset": self.at, "bytes": len(data), "first_token": self.tokens,
                                "doc_ids": [d for d, _ in self.docs], "n_tokens": [n for _, n in self.docs]})
            self._write(data)
            self.tokens += self.size
            self.held, self.docs, self.size = [], [], 0

    def close(self) -> tuple[str, int]:
        self.flush()
        index = zlib.compress(json.dumps(self.blocks, separators=(",", ":")).encode(), 1)
        self._write(index + struct.pack("<II", len(index), zlib.crc32(index)) + MAGIC)
        self.stream.close()
        return self.uri, self.tokens


def write_files(tokens: DataFrame, table: bytes, folder: str) -> DataFrame:
    """Write ``doc_id, ids, ids_crc`` in ascending order of these to files; returns the manifest.

    ``file, part, seq, tokens``: files in order of ``(part, seq)`` hold the ids in
    ascending ``doc_id`` (null first; rows that repeat an id by checksum of their
    ids).  Rows are range-partitioned by both, so one id with many rows is split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, done, out = TaskContext.get().partitionId(), [], None
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                out = out or FileWriter(folder, shared_table(table))
                out.add(doc_id, ids.as_py())
                if out.tokens >= FILE_TOKENS:
                    done.append(out.close())
                    out = None
        if out is not None:
            done.append(out.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in done]), pa.array([part] * len(done)), pa.array([*range(len(done))]), pa.array([n for _, n in done])], ["file", "part", "seq", "tokens"])

    rows = tokens.repartitionByRange(F.col("doc_id").asc_nulls_first(), "ids_crc").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids_crc")
    return staged(rows.select("doc_id", "ids").mapInArrow(run, "file string, part long, seq long, tokens long"), "rans-manifest")


def read_index(uri: str, checksum: int) -> list[dict]:
    with open_file(uri) as f:
        size = f.size()
        if f.read_at(12, 0) != MAGIC + struct.pack("<I", checksum):
            raise ValueError(f"{uri}: not a token file of this table")
        tail = f.read_at(16, size - 16)
        length, crc = struct.unpack("<II", tail[:8])
        index = f.read_at(length, size - 16 - length)
        if tail[8:] != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"{uri}: index is damaged")
    return json.loads(zlib.decompress(index))


CHECKPOINTS = "file string, file_start long, offset long, bytes long, first_token long, doc_ids array<long>, n_tokens array<long>"


def checkpoints(manifest: DataFrame, table: bytes) -> DataFrame:
    """One row per block out of the files' indexes; ``file_start`` is the number of ids in all files before."""
    order = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    files = manifest.withColumn("file_start", F.coalesce(F.sum("tokens").over(order), F.lit(0))).select("file", "file_start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("file_start", pa.int64()), ("offset", pa.int64()), ("bytes", pa.int64()), ("first_token", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64()))])
        checksum = shared_table(table).checksum
        for batch in batches:
            for row in batch.to_pylist():
                if blocks := read_index(row["file"], checksum):
                    yield pa.RecordBatch.from_pylist([row | b for b in blocks], schema)

    return files.repartition(F.col("file")).mapInArrow(run, CHECKPOINTS)


def read_documents(blocks: DataFrame, table: bytes) -> DataFrame:
    """Decode the blocks of :func:`checkpoints` in parallel: ``doc_id, start, ids`` per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["file"]) as f:
                    tokens = decode_block(f.read_at(row["bytes"], row["offset"]), shared_table(table)).astype("<u4")
                counts = np.array(row["n_tokens"], np.int64)
                ends = np.cumsum(counts)
                if ends[-1] != len(tokens):
                    raise ValueError(f"{row['file']}: the index does not match the block at {row['offset']}")
                offsets = np.concatenate([[0], ends]).astype("<i8") * 4
                ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(tokens.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(row["file_start"] + row["first_token"] + ends - counts), ids], ["doc_id", "start", "ids"])

    # a fixed number of partitions: the rows are small, so merging them by size would leave few tasks
    spread = blocks.repartition(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col("file"), F.col("offset"))
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def table_of(tokens: DataFrame, size: int) -> bytes:
    """The shared table from counts over all ids; the driver gets one row per vocabulary entry at most."""
    counts = np.zeros(size, np.int64)
    for row in count_ids(tokens, size).collect():
        counts[row["id"]] = row["n"]
    return SharedTable(counts).to_bytes()


def token_files(docs: DataFrame, path: str, end_id: int | None = 2, folder: str | None = None) -> DataFrame:
    """Encode every whole text into token files and read them back.

    One row per row of ``docs``: ``doc_id, start, n_tokens, ids_crc32``; a null or
    empty text has the end id alone.  Columns other than ``doc_id`` and ``text``
    are ignored; an empty table gives no file and no rows."""
    spark = docs.sparkSession
    tokens = staged(tokenize(docs, path, end_id), "rans-tokens")
    table = table_of(tokens, piece_encoder(path).size)
    blocks = checkpoints(write_files(tokens, table, folder or scratch_path(spark, "rans")), table)
    # crc32 is Spark's own function, over the bytes read back
    return read_documents(blocks, table).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
