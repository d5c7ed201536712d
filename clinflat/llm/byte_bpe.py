"""Byte-level BPE, encoding and decoding, by segment trees over byte positions.

A tree's leaf holds the rank of the pair that starts at its byte, an inner node the leftmost
minimum below it. A merge reads the root, joins the pair and updates three leaves: the pair's
own, the swallowed neighbour's and that of the live neighbour before. Each update climbs one
path. Many words are merged at once, one numpy row each, so a step serves all words that still
have a pair to merge.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.llm.chunks import ChunkCache, pieces_of
from clinflat.llm.common import in_small_batches, text_of

#: Bytes of words that are merged at once.
BATCH_BYTES = 1 << 18
NONE = np.int64(1) << 62


class PairRanks:
    """The ranks of a vocabulary: ids by bytes, and the rank of joining two ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ids = ranks
        self.bytes = {i: b for b, i in ranks.items()}
        self.start = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 31 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.int64(-1))
        self.keys[-1] = np.iinfo(np.int64).max
        self.values = np.append(np.array(values, np.int64)[order], NONE)

    @classmethod
    def from_file(cls, path: str) -> PairRanks:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NONE where they do not join or one of them is no id (-1)."""
        key = (left << 31) | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], NONE)


def merge_words(words: list[bytes], pairs: PairRanks) -> list[bytes]:
    """Ids of each word, four bytes each, merged from its bytes: lowest rank first, leftmost among equals."""
    out = [b""] * len(words)
    by_width: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if word:
            by_width.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(i)
    for width, members in by_width.items():
        step = max(1, BATCH_BYTES // width)
        for k in range(0, len(members), step):
            part = members[k : k + step]
            for i, ids in zip(part, _merge([words[i] for i in part], width, pairs)):
                out[i] = ids
    return out


def _merge(words: list[bytes], width: int, pairs: PairRanks) -> list[bytes]:
    n, bits = len(words), width.bit_length() - 1
    sizes = np.array([len(w) for w in words])
    inside = np.arange(width) < sizes[:, None]
    # ids and links have one more column: the place after the last byte, which has no id
    ids = np.full((n, width + 1), -1, np.int64)
    ids[:, :width][inside] = pairs.start[np.frombuffer(b"".join(words), np.uint8)]
    after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
    after[:, :width] = np.where(np.arange(1, width + 1) < sizes[:, None], after[:, :width], width)
    before = np.tile(np.arange(-1, width), (n, 1))
    places = np.arange(width, dtype=np.int64)

    tree = np.full((n, 2 * width), NONE, np.int64)
    first = pairs.of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width)
    tree[:, width:] = np.where(first < NONE, first << bits | places, NONE)
    level = width
    while level > 1:
        level //= 2
        np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2], out=tree[:, level : 2 * level])

    flat_tree, flat_ids, flat_after, flat_before = tree.ravel(), ids.ravel(), after.ravel(), before.ravel()

    def update(rows: np.ndarray, place: np.ndarray, value: np.ndarray | np.int64) -> None:
        node = rows * (2 * width) + width + place
        root = rows * (2 * width)
        flat_tree[node] = value
        at = place + width
        while True:
            at = at >> 1
            if not at[0]:
                return
            flat_tree[root + at] = np.minimum(flat_tree[root + 2 * at], flat_tree[root + 2 * at + 1])

    live = np.arange(n)
    while len(live):
        top = tree[live, 1]
        going = top < NONE
        live, top = live[going], top[going]
        if not len(live):
            break
        place, rank = top & (width - 1), top >> bits
        row = live * (width + 1)
        swallowed = flat_after[row + place]
        following = flat_after[row + swallowed]
        flat_ids[row + place] = rank
        flat_ids[row + swallowed] = -1
        flat_after[row + place] = following
        flat_before[row + following] = place
        update(live, swallowed, NONE)
        own = pairs.of(rank, flat_ids[row + following])
        update(live, place, np.where(own < NONE, own << bits | place, NONE))
        left = flat_before[row + place]
        has = left >= 0
        if has.any():
            rows, left = live[has], left[has]
            joined = pairs.of(flat_ids[row[has] + left], rank[has])
            update(rows, left, np.where(joined < NONE, joined << bits | left, NONE))
    kept = ids[:, :width] >= 0
    packed = ids[:, :width][kept].astype("<u4").tobytes()
    ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
    return [packed[a:b] for a, b in zip([0, *ends], ends)]


class ByteBpe:
    """Encodes texts as ids packed in four bytes each, and decodes ids."""

    def __init__(self, path: str, pattern: str) -> None:
        self.pairs = PairRanks.from_file(path)
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.cache = ChunkCache(self._chunks)
        self.encode = self.cache.texts

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if len(self.pieces) > self.cache.size:
            self.pieces.clear()
        known, whole = self.pieces, self.pairs.ids
        found = [pieces_of(chunk, self.find) for chunk in chunks]
        new = list({p for pieces in found for p in pieces if p not in known})
        content = [p.encode() for p in new]
        # a piece that is a token itself is that token
        merged = iter(merge_words([c for c in content if c not in whole], self.pairs))
        for piece, c in zip(new, content):
            known[piece] = whole[c].to_bytes(4, "little") if c in whole else next(merged)
        out = [b"".join([known[p] for p in pieces]) for pieces in found]
        for piece in new:
            if len(piece) > self.cache.longest:
                del known[piece]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pairs.bytes.__getitem__, ids))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(path: str, pattern: str) -> ByteBpe:
    """The coder of this worker, loaded once."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document doc_id and ids (array of int). A null text counts as empty and has no ids.

    ranks is a file of base64 tokens and ranks that every executor can open; pattern cuts texts
    into pieces that are merged alone. Text that the pattern does not match has no ids. Rows keep
    their number, whatever their ids; other columns are ignored.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(ranks, pattern)
        for batch in batches:
            packed = coder.encode(batch.column(1).to_pylist())
            lists = pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in packed], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["doc_id", "ids"])

    in_small_batches(docs.sparkSession, 500)
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return source.mapInArrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row of encode() doc_id and content (binary), the bytes of its ids; null ids have none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(ranks, pattern)
        for batch in batches:
            content = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary())], ["doc_id", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, f"doc_id {dict(encoded.dtypes)['doc_id']}, content binary")


def round_trip(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Per document doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array of int).

    Texts are encoded, then decoded, in one pass.

    The digests are those of the decimal ids joined by commas and of the decoded bytes. Nulls and
    rows are treated as in encode().
    """
    texts = [str(i) for i in range(1 << 17)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = loaded(ranks, pattern)
        for batch in batches:
            counts, id_sums, content_sums, lists = [], [], [], []
            for packed in coder.encode(batch.column(1).to_pylist()):
                ids = np.frombuffer(packed, "<u4").tolist()
                counts.append(len(ids))
                decimal = ",".join([texts[i] if i < len(texts) else str(i) for i in ids])
                id_sums.append(hashlib.sha256(decimal.encode()).hexdigest())
                content_sums.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                if with_ids:
                    lists.append(np.array(ids, np.int32))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string())]
            columns.append(pa.array(content_sums, pa.string()))
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    in_small_batches(docs.sparkSession, 500)
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids
    return source.mapInArrow(rows, schema)
