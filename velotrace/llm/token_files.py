"""Token ids of all documents as one array in binary files, with Elias-Fano document boundaries.

Texts are range partitioned by doc_id, encoded there and packed into files of bounded size:

    magic ``EFIDS2`` and the bytes per id, 2 or 4 (7 bytes)
    partition, file of the partition, documents, documents without a doc_id, ids (8 bytes each,
    little-endian)
    ids (little-endian), Elias-Fano code of the boundaries, Elias-Fano code of the doc_ids
    one line feed

Files are written by the text sink, whose commit keeps the output of repeated tasks out. An index
beside them, with one row per file, gives each file's place in the whole array: running totals over
the heads of the files.

Defined results: a null text is empty; every document, an empty one too, ends with the end id;
documents without a doc_id come first; rows that share a doc_id follow one another; no rows give no
files. Other columns are ignored.
"""

from __future__ import annotations

import json
import math
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velotrace.llm.common import running_totals
from velotrace.llm.elias_fano import EliasFano
from velotrace.operators.joins import lookup
from velotrace.session import new_path, written

#: Bytes of ids that a file holds, about; one longer document has a file of its own.
FILE_BYTES = 8 << 20
#: Documents that a file holds at most.
FILE_DOCS = 1 << 17
#: Distinct words whose ids a worker remembers before it forgets them all, and their bytes at most.
MEMO, MEMO_WORD = 400_000, 64
MAGIC, HEAD = b"EFIDS2", struct.Struct("<6sBQQQQQ")
INDEX = "_index"
_loaded: dict[str, Callable[[str], bytes]] = {}

# Letters below this need no composing and have one lower-case letter each, but for one of them.
SIMPLE, NO_SIMPLE_LOWER = "\u0250", "\u0130"

# The steps before the merges for which texts may be encoded word by word.
WORD_STEPS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}


def by_words(described: dict) -> bool:
    """Whether the tokenizer drops white space and never lets a token span it."""
    normalizer, splitter = described.get("normalizer") or {}, described.get("pre_tokenizer") or {}
    steps = [s.get("type") for s in normalizer.get("normalizers", [])]
    split = (splitter.get("pretokenizers") or [{}])[0]
    return (
        steps == WORD_STEPS["normalizer"]
        and normalizer["normalizers"][1].get("pattern") == {"Regex": r"\s+"}
        and split.get("pattern") == {"Regex": WORD_STEPS["pattern"]}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and not any(" " in t["content"] or t.get("lstrip") or t.get("rstrip") for t in described["added_tokens"])
    )


def encoder(path: str) -> Callable[[str], bytes]:
    """Text to ids as bytes, in the width that ``id_width`` tells, for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = _encoder(path)
    return _loaded[path]


def id_width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the merges: itself if it prints, else one above 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def _encoder(path: str) -> Callable[[str], bytes]:
    from tokenizers import Tokenizer

    tokenizer, kind = Tokenizer.from_file(path), "H" if id_width(path) == 2 else "I"
    with open(path, encoding="utf-8") as file:
        described = json.load(file)

    def whole(text: str) -> bytes:
        return array(kind, tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    if not by_words(described):
        return whole

    model, memo, letters_of = tokenizer.model, {}, byte_letters()

    def piece(raw: bytes) -> bytes:
        """Ids of what the steps before the merges leave as it is."""
        if raw not in memo:
            letters = raw.decode("latin-1")
            letters = letters if raw.isascii() else letters.translate(letters_of)
            memo[raw] = array(kind, [t.id for t in model.tokenize(letters)]).tobytes()
        return memo[raw]

    def word(raw: bytes) -> bytes:
        """Ids of a run without ASCII white space. Letters, with stops or commas after them, are
        one or two pieces for the merges; anything else takes all steps."""
        letters = raw.rstrip(b".,")
        if raw.isascii():
            known, lower = letters.isalpha(), letters.lower()
        else:
            text = letters.decode()
            known, lower = text.isalpha() and max(text) < SIMPLE and NO_SIMPLE_LOWER not in text, text.lower().encode()
            # After a letter beyond ASCII, too, a stop or comma starts a piece.
        if known:
            return piece(lower) + (piece(raw[len(letters) :]) if len(letters) < len(raw) else b"")
        return whole(raw.decode())

    def encode(text: str) -> bytes:
        # Added tokens hold no white space, so they too lie within a run.
        runs = text.encode().split()
        if len(memo) > MEMO:
            memo.clear()
        long = {}
        for raw in set(runs).difference(memo):
            (memo if len(raw) <= MEMO_WORD else long)[raw] = word(raw) if len(raw) <= MEMO_WORD else whole(raw.decode())
        if not long:
            return b"".join(map(memo.__getitem__, runs))
        return b"".join([memo[raw] if raw in memo else long[raw] for raw in runs])

    return encode


def _packed(part: int, file: int, doc_ids: list[int | None], ids: list[bytes], width: int) -> bytes:
    """A file without its line feed."""
    ends = np.cumsum([len(x) // width for x in ids], dtype=np.int64)
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    head = HEAD.pack(MAGIC, width, part, file, len(doc_ids), len(doc_ids) - len(known), int(ends[-1]))
    return b"".join([head, *ids, EliasFano.of(ends).to_bytes(), EliasFano.of(known).to_bytes()])


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int, file_bytes: int = FILE_BYTES) -> None:
    """Encode all texts with the tokenizer file and write the token files to the folder ``path``."""
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Rows that share a doc_id, and exact copies among them, may lie in several partitions.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = ["doc_id", F.xxhash64("text"), "row"]
    placed = rows.repartitionByRange(max(1, math.ceil(total / (4 * file_bytes))), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids, width, part = encoder(tokenizer), id_width(tokenizer), 0
        held, doc_ids, size, file = [], [], 0, 0

        def full() -> pa.RecordBatch:
            content = _packed(part, file, doc_ids, held, width)
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in batches:
            for part, doc_id, text in zip(*(batch.column(i) for i in range(3))):
                part, ids = part.as_py(), to_ids(text.as_py()) + end_id.to_bytes(width, "little")
                if held and (size + len(ids) > file_bytes or len(held) == FILE_DOCS):
                    yield full()
                    held, doc_ids, size, file = [], [], 0, file + 1
                held.append(ids)
                doc_ids.append(doc_id.as_py())
                size += len(ids)
        if held:
            yield full()

    packed = placed.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")
    packed = packed.mapInArrow(pack, "content binary").select(F.col("content").cast("string").alias("value"))
    packed.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)
    heads = token_files(documents.sparkSession, path).select(F.substring("content", 1, HEAD.size).alias("head"))
    heads = written(heads.mapInArrow(_read_heads, "part long, file long, docs long, ids long"), "token-heads")
    starts = running_totals(heads, ["part", "file"], "ids", "start")
    heads.join(starts, ["part", "file"]).write.parquet(f"{path}/{INDEX}")


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "file", "docs", "ids"]
    for batch in batches:
        heads = [HEAD.unpack(x) for x in batch.column(0).to_pylist()]
        columns = [[h[i] for h in heads] for i in (2, 3, 4, 6)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*.txt").load(path)


def parse(data: bytes) -> tuple[tuple[int, int], list[int | None], EliasFano, np.ndarray]:
    """Partition and file, doc_ids, boundaries (where each document ends), ids."""
    magic, width, part, file, docs, nameless, n = HEAD.unpack_from(data)
    if magic != MAGIC or data[-1:] != b"\n":
        raise ValueError("not a token file")
    ids = np.frombuffer(data, f"<u{width}", n, HEAD.size)
    ends, at = EliasFano.read(data, HEAD.size + n * width)
    known, at = EliasFano.read(data, at)
    if at + 1 != len(data) or ends.size != docs:
        raise ValueError("a token file must end where its parts say")
    return (part, file), [None] * nameless + known.values().tolist(), ends, ids


def document(data: bytes, i: int) -> np.ndarray:
    """The ids of document ``i`` of a file, found by its boundaries alone."""
    _, _, ends, ids = parse(data)
    return ids[ends.select(i - 1) if i else 0 : ends.select(i)]


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document; ``with_ids`` adds its ids as an array."""
    schema = "part long, file long, doc_id long, start long, n_tokens long, ids_crc32 long"
    schema += ", ids array<long>" if with_ids else ""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                of, doc_ids, ends, ids = parse(content.as_py())
                bounds = np.concatenate(([0], ends.values()))
                own = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                columns = [
                    *[pa.array(np.full(len(own), x), pa.int64()) for x in of],
                    pa.array(doc_ids, pa.int64()),
                    pa.array(bounds[:-1], pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in schema.split(", ")])

    index = spark.read.schema("part long, file long, start long").parquet(f"{path}/{INDEX}")
    found = token_files(spark, path).select("content").mapInArrow(rows, schema)
    placed = lookup(found, index.withColumnRenamed("start", "first"), ["part", "file"])
    return placed.withColumn("start", F.col("start") + F.col("first")).drop("part", "file", "first")


def new_token_folder(spark: SparkSession) -> str:
    return new_path(spark, f"tokens-{uuid.uuid4().hex[:8]}")
