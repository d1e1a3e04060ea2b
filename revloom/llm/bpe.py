"""Byte-level BPE: encoding by a segment tree over the ranks of adjacent pairs, and decoding.

A pre-token starts as its bytes. Leaf ``i`` of the tree holds the rank of the pair
that begins at symbol ``i`` (infinite where no such pair can be merged), each inner
node the smaller of its two children, ties to the left. The root is then the
leftmost pair of lowest rank. Merging it changes at most three leaves, each updated
along one path to the root, until the root is infinite. A pre-token of n bytes takes
O(n log n) steps, whatever it contains. Short pre-tokens that are new in a batch of
texts are merged side by side, each with a tree of its own.

Texts are cut into chunks (a run of white space and the run of other characters
after it); no pre-token crosses a chunk, so a worker keeps the ids of recent chunks,
and of recent pre-tokens, in tables of bounded size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revloom.llm.common import free_name, release, slices, table

# Entries in either half of a worker's tables of chunks and of pre-tokens.
CACHE_ENTRIES = 50_000
# Texts whose new chunks are encoded together.
ROWS = 64
# Chunks longer than this many characters are encoded each time they occur.
CACHED_CHARS = 64

# Pre-tokens of up to this many bytes are merged side by side, so many symbols at once.
TOGETHER, TOGETHER_SYMBOLS = 64, 1 << 16

# Fixed value: the published pattern that splits a text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space, then anything else; the four separators 1C-1F are not white space here.
CHUNK = r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+"


class _Classes(dict):
    """One stand-in of the same kind for each non-ASCII character, so that the
    pattern sees letters and numbers as the interpreter's Unicode data has them."""

    def __missing__(self, code: int) -> int:
        char = chr(code)
        if code < 128:
            kind = code
        elif char.isalpha():
            kind = ord("é")
        elif unicodedata.category(char)[0] == "N":
            kind = ord("²")
        else:
            kind = 0x3000 if char.isspace() else ord("¿")
        self[code] = kind
        return kind


def byte_symbols() -> dict[str, int]:
    """The printable character by which a vocabulary file shows each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


_NONE = 1 << 62
_LOW = (1 << 32) - 1


def merge_all(symbols: list[int], ranks: dict[int, int], made: list[int]) -> list[int]:
    """Symbols of one pre-token after all merges.

    ``ranks`` maps ``left << 32 | right`` to ``rank << 32``, ``made`` has the new
    symbol of each rank. A node of the tree is ``rank << 32 | position``, so the
    smaller rank wins, then the pair further left.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length()
    tree = [_NONE] * (2 * size)
    rank_of, leaf, found = ranks.get, size, False
    left = symbols[0]
    for right in symbols[1:]:
        rank = rank_of(left << 32 | right)
        if rank is not None:
            tree[leaf] = rank | leaf - size
            found = True
        leaf, left = leaf + 1, right
    if not found:
        return symbols
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a <= b else b
    after, before = list(range(1, n + 1)), list(range(-1, n))
    root = tree[1]
    while root != _NONE:
        i = root & _LOW
        gone = after[i]
        next_one = after[i] = after[gone]
        merged = symbols[i] = made[root >> 32]
        before[next_one] = i
        symbols[gone] = -1
        changed = [(gone, _NONE)] if gone < n - 1 else []
        rank = rank_of(merged << 32 | symbols[next_one]) if next_one < n else None
        changed.append((i, _NONE if rank is None else rank | i))
        previous = before[i]
        if previous >= 0:
            rank = rank_of(symbols[previous] << 32 | merged)
            changed.append((previous, _NONE if rank is None else rank | previous))
        for leaf, value in changed:
            k = size + leaf
            tree[k] = value
            while k > 1:
                beside = tree[k ^ 1]
                if beside < value:
                    value = beside
                k >>= 1
                if tree[k] == value:
                    break
                tree[k] = value
        root = tree[1]
    return [s for s in symbols if s >= 0]


class Ranks:
    """Ranks of pairs, and what they make, as sorted arrays for many look-ups at once."""

    def __init__(self, ranks: dict[int, int], made: list[int]):
        pairs = np.fromiter(ranks.keys(), dtype=np.int64, count=len(ranks))
        order = np.argsort(pairs)
        self.pairs = np.append(pairs[order], np.iinfo(np.int64).max)
        self.values = np.append(np.fromiter(ranks.values(), dtype=np.int64, count=len(ranks))[order], _NONE)
        self.made = np.array([*made, 0], dtype=np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``rank << 32`` of each pair, or none; a negative symbol is in no pair."""
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where((self.pairs[at] == pair) & (right >= 0) & (left >= 0), self.values[at], _NONE)


def merge_many(rows: np.ndarray, sizes: np.ndarray, ranks: Ranks) -> None:
    """``merge_all`` for many pre-tokens side by side, in place; -1 marks what is gone.

    A row of ``rows`` has the ``sizes`` symbols of one pre-token and then -1. Every row
    has a tree of its own, and all roots that are not infinite are merged at once.
    """
    count, width = rows.shape
    leaves = 1 << (width - 2).bit_length()
    every, places = np.arange(count), np.arange(width - 1)
    tree = np.full((count, 2 * leaves), _NONE, dtype=np.int64)
    found = ranks(rows[:, :-1], rows[:, 1:])
    tree[:, leaves : leaves + width - 1] = np.where(found == _NONE, _NONE, found | places)
    level = leaves
    while level > 1:
        below = tree[:, level : 2 * level]
        level //= 2
        np.minimum(below[:, 0::2], below[:, 1::2], out=tree[:, level : 2 * level])
    after = np.tile(np.arange(1, width + 2), (count, 1))
    before = np.tile(np.arange(-1, width + 1), (count, 1))
    live = every[tree[:, 1] != _NONE]
    while len(live):
        root = tree[live, 1]
        i = root & _LOW
        gone = after[live, i]
        beyond = after[live, gone]
        merged = ranks.made[root >> 32]
        after[live, i], before[live, beyond] = beyond, i
        rows[live, i], rows[live, gone] = merged, -1
        # Beyond the last symbol, and before the first, there is no pair.
        right = np.where(beyond < sizes[live], rows[live, np.minimum(beyond, width - 1)], -1)
        previous = before[live, i]
        left = np.where(previous >= 0, rows[live, previous], -1)
        last = np.maximum(previous, 0)
        with_left = ranks(left, merged)
        with_right = ranks(merged, right)
        inside = gone < leaves
        tree[live[inside], leaves + gone[inside]] = _NONE
        tree[live, leaves + i] = np.where(with_right == _NONE, _NONE, with_right | i)
        kept = previous >= 0
        tree[live[kept], leaves + last[kept]] = np.where(with_left == _NONE, _NONE, with_left | last)[kept]
        for leaf in (np.minimum(gone, leaves - 1), i, last):
            k = leaves + leaf
            while leaves > 1 and k[0] > 1:
                k = k >> 1
                tree[live, k] = np.minimum(tree[live, 2 * k], tree[live, 2 * k + 1])
        live = live[tree[live, 1] != _NONE]


class _Known(dict):
    """Ids of recent chunks. When it is full, what was used since the last time
    it was full is kept within reach and the rest forgotten."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.encode(chunk)
        self.put(chunk, ids)
        return ids

    def put(self, chunk: str, ids: bytes) -> None:
        if len(chunk) <= CACHED_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids

    def lacking(self, chunks) -> list[str]:
        """Those of the chunks that would be kept, but are not known yet."""
        older = self.older
        return [c for c in set(chunks) if len(c) <= CACHED_CHARS and c not in self and c not in older]


class Codec:
    """Encoder and decoder of one vocabulary file in the JSON form of byte-level BPE."""

    def __init__(self, content: dict):
        model = content["model"]
        vocab: dict[str, int] = model["vocab"]
        symbols = byte_symbols()
        self.first = [0] * 256
        for char, byte in symbols.items():
            self.first[byte] = vocab[char]
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for left, right in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.ranks.setdefault(vocab[left] << 32 | vocab[right], len(self.made) << 32)
            self.made.append(vocab[left + right])
        names = dict(vocab)
        self.special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        names.update(self.special)
        self.bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            # A name with other characters than byte symbols stands for itself.
            known = all(c in symbols for c in name)
            self.bytes[i] = bytes(symbols[c] for c in name) if known else name.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self.pattern, self.chunks, self.classes = regex.compile(PATTERN), re.compile(CHUNK), _Classes()
        self.known = _Known(self._encode_chunk)
        self.parts = _Known(self._encode_part)
        self.sorted_ranks = Ranks(self.ranks, self.made)
        self.first_of = np.array(self.first, dtype=np.int64)

    def _parts_of(self, chunk: str) -> list[str]:
        if chunk.isalpha() or chunk[0] == " " and chunk[1:].isalpha():
            return [chunk]  # letters only, as nearly all chunks
        return [chunk[m.start() : m.end()] for m in self.pattern.finditer(chunk.translate(self.classes))]

    def _encode_chunk(self, chunk: str) -> bytes:
        return b"".join([self.parts[part] for part in self._parts_of(chunk)])

    def learn(self, chunks) -> None:
        """Encode the new ones of many chunks together, for later look-ups."""
        chunks = self.known.lacking(chunks)
        parts_of = [self._parts_of(c) for c in chunks]
        by_width: dict[int, list[str]] = {}
        for part in self.parts.lacking([p for parts in parts_of for p in parts]):
            size = len(part.encode())
            if 2 <= size <= TOGETHER:
                by_width.setdefault(1 << (size - 2).bit_length(), []).append(part)
        for leaves, parts in by_width.items():
            step = max(1, TOGETHER_SYMBOLS // leaves)
            for at in range(0, len(parts), step):
                self._learn_parts(parts[at : at + step], leaves + 1)
        for chunk, parts in zip(chunks, parts_of, strict=True):
            self.known.put(chunk, b"".join([self.parts[part] for part in parts]))

    def _learn_parts(self, parts: list[str], width: int) -> None:
        raw = [p.encode() for p in parts]
        sizes = np.array([len(r) for r in raw])
        rows = np.full((len(raw), width), -1, dtype=np.int64)
        rows[np.arange(width) < sizes[:, None]] = self.first_of[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        merge_many(rows, sizes, self.sorted_ranks)
        stay = rows >= 0
        ids, ends = rows[stay].astype(np.int32).tobytes(), 4 * np.cumsum(stay.sum(axis=1))
        start = 0
        for part, end in zip(parts, ends.tolist(), strict=True):
            self.parts.put(part, ids[start:end])
            start = end

    def _encode_part(self, part: str) -> bytes:
        symbols = [self.first[b] for b in part.encode()]
        return array("i", merge_all(symbols, self.ranks, self.made)).tobytes()

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts; a special token's name in a text is that token."""
        names, cut = self.special, []
        for text in texts:
            parts = self.special_pattern.split(text or "") if names else [text or ""]
            cut.append([[part] if part in names else self.chunks.findall(part) for part in parts])
        self.learn(chain.from_iterable(chain.from_iterable(cut)))
        look_up = self.known.__getitem__
        found = []
        for pieces in cut:
            ids = [
                array("i", [names[p[0]]]).tobytes() if len(p) == 1 and p[0] in names else b"".join(map(look_up, p))
                for p in pieces
            ]
            found.append(np.frombuffer(b"".join(ids), dtype=np.int32))
        return found

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        """Text of the ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """The worker's codec for a broadcast vocabulary, built once per process."""
    key = hash(shared.value)
    if key not in _codecs:
        _codecs[key] = Codec(json.loads(shared.value))
    return _codecs[key]


def load(spark: SparkSession, path: str):
    """Broadcast a vocabulary file (a few MB, whatever the size of the corpus)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(df: DataFrame, vocabulary, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Add the token ids of the whole ``text`` as ``ids``; null counts as empty.

    Other columns are kept; ``ids`` gets underscores added if the name is taken. With
    ``decoded`` the text that the ids stand for is added as well, from the ids alone.
    """
    ids = free_name(df, ids)
    added = {ids: "array<int>"} | ({free_name(df, decoded): "string"} if decoded else {})

    def run(frames):
        codec = _codec(vocabulary)
        for frame in slices(frames, ROWS):
            column = frame.column(frame.schema.get_field_index(text)).to_pylist()
            found = codec.encode_all(column)
            ends = np.cumsum([0, *map(len, found)], dtype=np.int64).astype(np.int32)
            values = np.concatenate(found) if found else np.zeros(0, dtype=np.int32)
            new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values))]
            if decoded:
                new.append(pa.array([codec.decode(x.tolist()) for x in found], pa.string()))
            yield pa.RecordBatch.from_arrays([*frame.columns, *new], names=[*frame.schema.names, *added])
        release()

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{n}` {k}" for n, k in added.items()]
    return df.mapInArrow(run, ", ".join(columns))


def decode(df: DataFrame, vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that ``ids`` stand for; null ids give null."""

    text = free_name(df, text)

    def run(frames):
        codec = _codec(vocabulary)
        for frame in slices(frames):
            column = frame.column(frame.schema.get_field_index(ids))
            found = [codec.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in column]
            strings = pa.array(found, pa.string())
            yield pa.RecordBatch.from_arrays([*frame.columns, strings], names=[*frame.schema.names, text])
        release()

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{columns}, `{text}` string")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def round_trip(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` with ``ids`` and ``decoded`` added."""
    return encode(df, load(df.sparkSession, path or vocabulary_path()), decoded="decoded")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; counts and digests of both."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = F.coalesce(F.array_join("ids", ","), F.lit(""))
    return round_trip(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op3_bpe": op3_bpe}
ORACLE: dict[str, str] = {}
