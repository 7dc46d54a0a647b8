"""Byte-level BPE encoding and decoding with the ranks of a tiktoken file.

Text is cut by the pre-tokenizer pattern; every distinct piece of a batch is encoded once in
length-bucketed padded numpy matrices. In each round every row of a matrix merges its leftmost pair of
minimum rank; pair ranks come from an open-addressing hash table, and finished rows leave the matrix.
Pieces over ``LONG`` bytes go one at a time through the same merges, all non-overlapping places of the
minimum rank in one round where no pair that such a merge creates has a lower rank (else one merge, so
the order of merges stays that of the one-by-one algorithm).

Defined results: a null text counts as empty; empty text has no ids; repeated rows are encoded alike; an
empty table gives an empty table. Only the named key and text columns are read, so other columns of
the input, whatever their names, do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import mix64, text_slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG = 256
CELLS = 300_000  # of a matrix, so that it stays in the processor's cache
NONE = np.int32(2**31 - 1)
CACHE_ENTRIES = 250_000  # pieces kept per Python worker; a full cache is emptied, results don't depend on it

# White space as Unicode defines it; Python's \s also takes \x1c-\x1f.
_SPACE = r"\t-\r \x85\xa0  -     　"
# Characters up to U+024F and general punctuation: here letters and numbers are a few ranges, so that the
# standard library's faster engine gives the same pieces.
_PLAIN = re.compile(r"[\x00-ɏ‐-‧‰-⁞€]*")
_LETTER, _NUMBER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_FIXED_ENDS = r"'s|'t|'re|'ve|'m|'ll|'d"


class Pieces:
    """The pre-tokenizer: ``findall`` of the vocabulary's pattern."""

    def __init__(self, pattern: str = public_tokenizers.PATTERN) -> None:
        self.whole = regex.compile(pattern.replace(r"\S", f"[^{_SPACE}]").replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]"))
        self.plain = None
        if pattern == public_tokenizers.PATTERN:
            self.plain = re.compile(f"{_FIXED_ENDS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")

    def __call__(self, text: str) -> list[str]:
        return (self.plain if self.plain and _PLAIN.fullmatch(text) else self.whole).findall(text)


class Codec:
    """Ranks of a tiktoken file, with the hashed pair table."""

    def __init__(self, lines: list[bytes]) -> None:
        ranks = self.rank_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))}
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = self._key(np.array(left, np.int32), np.array(right, np.int32))
        size = 1 << int(np.ceil(np.log2(max(4, 4 * len(keys)))))
        self.mask = np.uint64(size - 1)
        self.keys, self.ranks, self.probes = np.zeros(size, np.uint64), np.full(size, NONE), 0
        open_ = np.arange(len(keys))
        slot = mix64(keys) & self.mask
        values = np.array(merged, np.int32)
        while len(open_):  # linear probing: each round the first key that asks for an empty slot gets it
            self.probes += 1
            free = self.keys[slot[open_]] == 0
            _, first = np.unique(slot[open_[free]], return_index=True)
            won = open_[free][first]
            self.keys[slot[won]], self.ranks[slot[won]] = keys[won], values[won]
            open_ = np.setdiff1d(open_, won, assume_unique=True)
            slot[open_] = (slot[open_] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return ((left.astype(np.uint64) + np.uint64(1)) << np.uint64(32)) | right.astype(np.uint64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge, NONE where there is none or a side is padding (-1)."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        out = np.full(left.size, NONE)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        key = self._key(left[at], right[at])
        slot = mix64(key) & self.mask
        for _ in range(self.probes):
            held = self.keys[slot]
            hit = held == key
            out[at[hit]] = self.ranks[slot[hit]]
            on = ~hit & (held != 0)
            if not on.any():
                break
            at, key, slot = at[on], key[on], (slot[on] + np.uint64(1)) & self.mask
        return out.reshape(shape)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list = [None] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        whole = list(map(self.rank_of.get, pieces))  # a piece that is a token is that token, as in tiktoken
        for i, rank in enumerate(whole):
            if rank is not None:
                out[i] = [rank]
        sizes[[i for i, rank in enumerate(whole) if rank is not None]] = -1
        widths = np.where(sizes <= 16, sizes, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        widths[sizes > LONG] = -1
        for width in np.unique(widths[sizes >= 0]):
            rows = np.flatnonzero((widths == width) & (sizes >= 0))
            if width == -1:
                for i in rows:
                    out[i] = self._long(pieces[i]).tolist()
                continue
            step = max(1, CELLS // max(1, int(width)))
            for k in range(0, len(rows), step):
                self._bucket(pieces, rows[k : k + step], int(width), out)
        return out

    def _bucket(self, pieces: list[bytes], rows: np.ndarray, width: int, out: list) -> None:
        if width == 0:
            for i in rows:
                out[i] = []
            return
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width)
        n = np.fromiter((len(pieces[i]) for i in rows), np.int64, len(rows))
        columns = np.arange(width)
        ids = np.where(columns < n[:, None], self.single[raw], np.int32(-1))
        ranks = np.full((len(rows), width), NONE)
        ranks[:, :-1] = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1)  # the first of equal minima: the leftmost
            every = np.arange(len(rows))
            best = ranks[every, at]
            done = best == NONE
            if done.any():
                for i, own, k in zip(rows[done].tolist(), ids[done].tolist(), n[done].tolist(), strict=True):
                    out[i] = own[:k]
                go = ~done
                rows, n, ids, ranks, at, best = rows[go], n[go], ids[go], ranks[go], at[go], best[go]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, source, 1), np.take_along_axis(ranks, source, 1)
            n -= 1
            ids[every, at] = best
            ids[every, n] = -1
            ranks[every, n - 1] = NONE
            after = np.where(at + 1 < n, ids[every, np.minimum(at + 1, width - 1)], np.int32(-1))
            before = np.where(at > 0, ids[every, np.maximum(at - 1, 0)], np.int32(-1))
            ranks[every, at] = self.pair_ranks(best, after)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.pair_ranks(before[inner], best[inner])

    def _long(self, piece: bytes) -> np.ndarray:
        ids = self.single[np.frombuffer(piece, np.uint8)]
        while len(ids) > 1:
            ranks = self.pair_ranks(ids[:-1], ids[1:])
            best = ranks.min()
            if best == NONE:
                break
            at = np.flatnonzero(ranks == best)
            run = np.cumsum(np.r_[True, np.diff(at) > 1]) - 1
            at = at[(at - at[np.searchsorted(run, run)]) % 2 == 0]
            new = np.full(len(at), best)
            left = np.where(at > 0, ids[np.maximum(at - 1, 0)], -1).astype(np.int32)
            right = np.where(at + 2 < len(ids), ids[np.minimum(at + 2, len(ids) - 1)], -1).astype(np.int32)
            lowest = min(self.pair_ranks(left, new).min(), self.pair_ranks(new, right).min(), self.pair_ranks(new[:1], new[:1])[0])
            if lowest < best:
                at = at[:1]
            ids = ids.copy()
            ids[at] = best
            ids = np.delete(ids, at + 1)
        return ids

    def decode(self, ids) -> bytes:
        """The bytes of a sequence of ids; special or unknown ids raise."""
        return b"".join([self.bytes_of[i] for i in ids])


_codecs: dict[str, Codec] = {}


def codec(vocabulary: str = VOCABULARY) -> Codec:
    """The codec of one vocabulary file, once per process. A name is looked up among the public
    tokenizers; a path is opened as it is (every machine has the tokenizer files installed)."""
    if vocabulary not in _codecs:
        path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
        with open(path, "rb") as f:
            _codecs[vocabulary] = Codec(f.read().splitlines())
    return _codecs[vocabulary]


class Encoder:
    """Encodes whole texts; distinct pieces are kept between batches."""

    def __init__(self, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> None:
        self.codec, self.pieces = codec(vocabulary), Pieces(pattern)
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def __call__(self, texts: list[str]) -> Iterator[list[tuple[int, str, bytes]]]:
        """For each text its pieces' (number of ids, ids as text, bytes that these ids decode to)."""
        for part in text_slices(texts):
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
            cut = [self.pieces(t) for t in texts[part]]
            found = [list(map(self.known.get, words)) for words in cut]
            gaps = [k for k, values in enumerate(found) if None in values]
            new = list({p for k in gaps for p, v in zip(cut[k], found[k], strict=True) if v is None})
            for piece, ids in zip(new, self.codec.encode_pieces([p.encode("utf-8") for p in new]), strict=True):
                self.known[piece] = (len(ids), ",".join(map(str, ids)), self.codec.decode(ids))
            for k in gaps:
                found[k] = list(map(self.known.__getitem__, cut[k]))
            yield from found


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY,
           pattern: str = public_tokenizers.PATTERN, ids: bool = True, digests: bool = False) -> DataFrame:
    """Per row the key, n_tokens, with ``ids`` the array of ids, and with ``digests`` ids_sha256 (of the
    decimal ids joined by commas) and decoded_sha256 (of the bytes that the ids decode to)."""
    key_type = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, n_tokens long" + ", ids array<int>" * ids + ", ids_sha256 string, decoded_sha256 string" * digests

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary, pattern)
        for batch in batches:
            keys, texts, done = batch["key"].tolist(), [t or "" for t in batch["text"]], 0
            rows: dict[str, list] = {c.split(" ")[0].strip("`"): [] for c in schema.split(", ")}
            held = 0
            for pieces in encoder(texts):
                n = sum([p[0] for p in pieces])
                as_text = ",".join([p[1] for p in pieces])
                rows[key].append(keys[done])
                rows["n_tokens"].append(n)
                if ids:
                    rows["ids"].append(np.array(as_text.split(",") if pieces else [], np.int32))
                if digests:
                    rows["ids_sha256"].append(hashlib.sha256(as_text.encode()).hexdigest())
                    rows["decoded_sha256"].append(hashlib.sha256(b"".join([p[2] for p in pieces])).hexdigest())
                done, held = done + 1, held + ids * n
                if held > 4_000_000:
                    yield pd.DataFrame(rows).astype({key: object})
                    rows, held = {c: [] for c in rows}, 0
            yield pd.DataFrame(rows).astype({key: object})

    return df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInPandas(run, schema)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row the key, the decoded bytes and, where they are UTF-8, the text (null ids: empty; ids
    outside the vocabulary raise; bytes that are not UTF-8: text with replacement characters)."""
    key_type = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = codec(vocabulary)
        for batch in batches:
            raw = [own.decode(x.tolist() if x is not None else []) for x in batch["ids"]]
            yield pd.DataFrame({key: batch["key"].astype(object), "bytes": raw, "text": [b.decode("utf-8", "replace") for b in raw]})

    return df.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInPandas(run, f"`{key}` {key_type}, bytes binary, text string")
