"""Token ids in files: ids ranked by frequency, in a variable number of whole bytes.

An id is stored as its rank, so that frequent ids take one byte. Two bits in a separate stream
of control bytes say how many bytes a rank takes; a table lookup on the control bytes gives the
lengths of four ranks at a time, and numpy gathers the data bytes. A file is a folder of two
Parquet tables: ranks, and blocks of whole documents in ascending order of their ids.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.llm.chunks import ChunkCache, pieces_of
from clinflat.llm.common import in_small_batches, shared_folder, staged, text_of

#: Ids after which a block is closed; a longer document is a block of its own.
BLOCK_IDS = 1 << 18
#: Lengths of the four ranks of each control byte.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ranks below 2^32."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-len(ranks) % 4 + len(ranks), np.uint8)
    codes[: len(ranks)] = size - 1
    one, two, three, four = codes.reshape(-1, 4).T
    control = one | two << 2 | three << 4 | four << 6
    at = np.cumsum(size, dtype=np.int64) - size
    data = np.empty(int(size.sum(dtype=np.int64)), np.uint8)
    data[at] = ranks.astype(np.uint8)
    for k in range(1, 4):
        longer = np.flatnonzero(size > k)
        data[at[longer] + k] = (ranks[longer] >> np.uint32(8 * k)).astype(np.uint8)
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n ranks of pack()."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    content = np.frombuffer(data, np.uint8)
    at = np.cumsum(size, dtype=np.int64) - size
    out = content[at].astype(np.uint32)
    for k in range(1, 4):
        longer = np.flatnonzero(size > k)
        out[longer] |= content[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def byte_letters() -> dict[int, str]:
    """Letters that byte-level vocabularies write for bytes: itself if printable, else one from 256 on."""
    letters, more = {}, 256
    for byte in range(256):
        printable = 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174
        letters[byte] = chr(byte if printable else more)
        more += not printable
    return letters


def narrow(ids: np.ndarray) -> bytes:
    """Ids in two bytes each after a zero byte, or in four after a one, if one of them needs that."""
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return bytes([wide]) + ids.astype("<u4" if wide else "<u2").tobytes()


def widened(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, "<u4" if packed[0] else "<u2", offset=1)


class Library:
    """A tokenizer file of the tokenizers library, encoding texts as packed ids.

    The library's model is asked once for each distinct piece of text. Texts with one of the
    added tokens go through the library whole, as do all texts of a tokenizer that is not plain
    byte-level.
    """

    #: Fixed value: the pattern by which byte-level tokenizers of this kind cut texts.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.find = regex.compile(self.PATTERN).findall
        self.letters = byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.cache = ChunkCache(self._chunks)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        cut = config.get("pre_tokenizer") or {}
        self.plain = (
            not config.get("normalizer")
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
        )
        self.packed_id = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.added = [t["content"] for t in config.get("added_tokens", [])]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.plain:
            return [self._whole(text) for text in texts]
        out = self.cache.texts(texts)
        for k, text in enumerate(texts):
            if any(token in text for token in self.added):
                out[k] = self._whole(text)
        return out

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if len(self.pieces) > self.cache.size:
            self.pieces.clear()
        known, letters, tokenize, packed_id = self.pieces, self.letters, self.model.tokenize, self.packed_id
        out, long = [], []
        for chunk in chunks:
            packed = []
            for piece in pieces_of(chunk, self.find):
                ids = known.get(piece)
                if ids is None:
                    # of printable ASCII, only the space has another letter
                    plain = piece.isascii() and piece.isprintable()
                    spelt = piece.replace(" ", letters[32]) if plain else piece.encode().decode("latin-1").translate(letters)
                    tokens = tokenize(spelt)
                    known[piece] = ids = b"".join([packed_id[t.id] for t in tokens])
                    if len(piece) > self.cache.longest:
                        long.append(piece)
                packed.append(ids)
            out.append(b"".join(packed))
        for piece in long:
            known.pop(piece, None)
        return out


_LOADED: dict[str, Library] = {}


def loaded(path: str) -> Library:
    if path not in _LOADED:
        _LOADED[path] = Library(path)
    return _LOADED[path]


def encode(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document doc_id and ids (narrow()), the end id last."""
    end = end_id.to_bytes(4, "little")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = loaded(tokenizer)
        for batch in batches:
            ids = [np.frombuffer(ids + end, "<u4") for ids in library.encode(batch.column(1).to_pylist())]
            packed = [narrow(x) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "ids"])

    in_small_batches(docs.sparkSession, 500)
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return source.mapInArrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, ids binary")


def frequencies(encoded: DataFrame) -> DataFrame:
    """Rows (id, n): how often each id occurs."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.concatenate([widened(packed) for packed in batch.column(0).to_pylist()])
            n = np.bincount(ids, minlength=len(total))
            n[: len(total)] += total
            total = n
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    parts = encoded.select("ids").mapInArrow(counted, "id long, n long")
    return parts.groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every document and write path/ranks and path/blocks.

    A null text counts as empty: its ids are the end id alone. Documents are ordered by id, nulls
    first, and by their ids where two have the same. Ranks go by frequency, then by id; the
    driver holds one number for each id of the vocabulary that occurs. Other columns of docs are
    ignored; of no documents, both tables are empty.
    """
    spark = docs.sparkSession
    encoded = staged(encode(docs, tokenizer, end_id, id_col, text_col), "ids")
    counts = [(int(r.id), int(r.n)) for r in frequencies(encoded).collect()]  # as many as the vocabulary has ids
    by_rank = np.array([i for i, _ in sorted(counts, key=lambda x: (-x[1], x[0]))], np.int64)
    ranks = [(int(rank), int(i)) for rank, i in enumerate(by_rank)]
    spark.createDataFrame(ranks, "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, number = TaskContext.get().partitionId(), 0, 0
        names: list = []
        held: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            nonlocal before, number, names, held
            lengths = [len(h) for h in held]
            control, data = pack(rank_of[np.concatenate(held)])
            values = [part, number, before, sum(lengths), names, lengths, control, data]
            row = [pa.array([v], t) for v, t in zip(values, types)]
            before, number, names, held = before + sum(lengths), number + 1, [], []
            return pa.RecordBatch.from_arrays(row, fields)

        for batch in batches:
            types = [pa.int64()] * 4 + [pa.list_(batch.column(0).type), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            waiting = 0
            for name, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                held.append(widened(packed))
                waiting = sum(map(len, held)) if len(held) == 1 else waiting + len(held[-1])
                if waiting >= BLOCK_IDS:
                    yield closed()
            if held:
                yield closed()

    kind = dict(docs.dtypes)[id_col]
    schema = f"part long, block long, before long, n_ids long, doc_ids array<{kind}>, lengths array<long>, control binary, data binary"
    fields = ["part", "block", "before", "n_ids", "doc_ids", "lengths", "control", "data"]
    ordered = encoded.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(blocks, schema).write.parquet(f"{path}/blocks")


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document of the files doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (array of int).

    start counts the ids of all documents before it. ids_crc32 is that of the ids as little-endian
    unsigned 32-bit integers. The driver adds up one number for each part of the file.
    """
    table = spark.read.parquet(f"{path}/blocks")
    ranks = spark.read.parquet(f"{path}/ranks").collect()  # as many as the vocabulary has ids
    id_of = np.zeros(len(ranks), np.uint32)
    for row in ranks:
        id_of[row.rank] = row.id
    sums = table.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # one for each file part
    starts, total = {}, 0
    for row in sums:
        starts[row.part], total = total, total + row.n

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                part, before, n, names, lengths, control, data = (batch.column(i)[k] for i in range(7))
                ids = id_of[unpack(control.as_py(), data.as_py(), n.as_py())].astype("<u4")
                sizes = np.array(lengths.as_py(), np.int64)
                ends = np.cumsum(sizes)
                first = starts[part.as_py()] + before.as_py() + ends - sizes
                sums = [zlib.crc32(ids[e - s : e].tobytes()) for s, e in zip(sizes, ends)]
                columns = [names.values, pa.array(first), pa.array(sizes), pa.array(sums, pa.int64())]
                if with_ids:
                    offsets = pa.array(np.append(0, ends), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names_out)

    in_small_batches(spark, 4)
    kind = table.schema["doc_ids"].dataType.elementType.simpleString()
    names_out = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    schema = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return table.select("part", "before", "n_ids", "doc_ids", "lengths", "control", "data").mapInArrow(rows, schema)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
