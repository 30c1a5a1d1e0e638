"""SentencePiece encoding and decoding through a table of distinct chunks.

A piece of the model holds whitespace markers only at its front, so no merge crosses from one marked word
to the next: a text is cut before each run of markers, every distinct chunk is segmented once, and the
ids are joined back by position.

Texts travel as blocks: a task cuts its rows into chunks, numbers the distinct ones and stores the rows as
compressed numbers. The chunks go to owners by hash, one compressed message per block and owner; an
owner segments each chunk it has received once and answers every message with the ids; a block with
its answers gives the ids of its rows. A frequent chunk is in each message once, so no owner is crowded.

Defined results: a null or empty text has no ids and decodes to the empty text; rows are neither merged
nor dropped; an empty table gives an empty result. Input columns stay (those named in ``carry``), a
result column replaces one of its name.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from geoingest.llm.common import staged_by
from geoingest.llm.registry import query, table

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: A block ends with the row that takes it past one of these; its chunks go to owners in messages.
BLOCK_BYTES, BLOCK_ROWS = 32 << 20, 40_000
#: Text per owner of a hash range, and the bounds of the number of owners.
TEXT_PER_OWNER, LEAST_OWNERS, MOST_OWNERS = 16 << 20, 12, 1 << 14
#: An owner starts its table anew beyond so many chunks, and reads so many messages at a time.
OWNER_CHUNKS, MESSAGES_AT_ONCE = 1_000_000, 64
#: Rows of a block whose ids are in hand at once.
IDS_AT_ONCE = 2_000_000

_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_MODELS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    """The worker's model. It must keep markers at the front of pieces and spaces as they are."""
    if path not in _MODELS:
        found = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (found.id_to_piece(i) for i in range(found.vocab_size()))
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("the model has pieces that cross whitespace markers")
        _MODELS[path] = found
    return _MODELS[path]


def chunks_of(text: str | None) -> list[str]:
    """The marked words of a text as the model sees it: spaces are markers, and one marker goes in front."""
    return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


def segment(path: str, chunks: list[str]) -> list[list[int]]:
    """Ids of each chunk. The library puts a marker in front of what it encodes; a lone marker is a piece."""
    processor = model(path)
    bare = processor.piece_to_id(MARK)
    return [ids or [bare] for ids in processor.encode([c[1:] for c in chunks], num_threads=1)]


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers below 2^31, byte plane by byte plane, compressed together."""
    head = struct.pack(f"<{len(arrays) + 1}q", len(arrays), *map(len, arrays))
    planes = (a.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays)
    return zstandard.compress(head + b"".join(planes), 3)


def _unpack(code: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(code)
    n = struct.unpack_from("<q", raw)[0]
    at, out = 8 * (n + 1), []
    for length in struct.unpack_from(f"<{n}q", raw, 8):
        planes = np.frombuffer(raw, dtype=np.uint8, count=4 * length, offset=at).reshape(4, length)
        out.append(np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64))
        at += 4 * length
    return out


class _Block:
    """Rows whose texts became chunk numbers."""

    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.rows: list[pa.Array] = []
        self.numbers: list[np.ndarray] = []
        self.size = 0

    def add(self, row: pa.Array, text: str | None) -> None:
        chunks = chunks_of(text)
        ids = self.ids
        self.numbers.append(np.fromiter((ids.setdefault(c, len(ids)) for c in chunks), np.int32, len(chunks)))
        self.rows.append(row)
        self.size += len(text or "")

    def full(self) -> bool:
        return self.size >= BLOCK_BYTES or len(self.rows) >= BLOCK_ROWS


def _blocks(owners: int, schema: pa.Schema):
    """Batches of ``row, text`` to block rows (kind 0) and chunk messages (kind 1)."""

    def given(block: _Block, number: int) -> Iterator[pa.RecordBatch]:
        # Each owner's chunks in order: the text compresses well, and places need not travel.
        dealt: list[list[str]] = [[] for _ in range(owners)]
        for chunk in sorted(block.ids):
            dealt[xxhash.xxh32_intdigest(chunk.encode()) % owners].append(chunk)
        places = np.fromiter((block.ids[c] for words in dealt for c in words), np.int64, len(block.ids))
        sizes = np.array([len(words) for words in dealt])
        lengths = np.array([len(n) for n in block.numbers])
        of = pa.concat_arrays(block.rows).cast(schema.field("rows").type.value_type)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([-1], pa.int32()),
                pa.array([_pack(lengths, np.concatenate(block.numbers), sizes, places)], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(of)], pa.int32()), of).cast(schema.field("rows").type),
                pa.array([0], pa.int32()),
            ],
            schema=schema,
        )
        for owner, words in enumerate(dealt):
            if words:
                head = _pack(np.fromiter(map(len, words), np.int64, len(words)))
                code = struct.pack("<q", len(head)) + head + zstandard.compress("".join(words).encode(), 6)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([owner], pa.int32()),
                        pa.array([code], pa.binary()),
                        pa.nulls(1, schema.field("rows").type),
                        pa.array([1], pa.int32()),
                    ],
                    schema=schema,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            rows, texts = batch.column("row"), batch.column("text")
            for i in range(batch.num_rows):
                block.add(rows.slice(i, 1), texts[i].as_py())
                if block.full():
                    yield from given(block, number)
                    number, block = number + 1, _Block()
        if block.rows:
            yield from given(block, number)

    return run


def _read_message(code: bytes) -> list[str]:
    size = struct.unpack_from("<q", code)[0]
    ends = np.cumsum(_unpack(code[8 : 8 + size])[0]).tolist()
    text = zstandard.decompress(code[8 + size :]).decode()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


class _Table:
    """An owner's table of distinct chunks: place by chunk, and their ids one after the other."""

    def __init__(self, path: str) -> None:
        self.path, self.known = path, {}
        self.counts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, words: list[str]) -> None:
        if len(self.known) > OWNER_CHUNKS:
            self.__init__(self.path)
        new = list({w: None for w in words if w not in self.known})
        ids = segment(self.path, new)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.counts = np.concatenate([self.counts, np.fromiter(map(len, ids), np.int64, len(ids))])
        self.flat = np.concatenate([self.flat, np.fromiter((x for one in ids for x in one), np.int32)])

    def answer(self, words: list[str]) -> bytes:
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        starts = np.cumsum(self.counts) - self.counts
        return _pack(self.counts[index], _gather(self.flat, starts, self.counts, index))


def _answers(path: str):
    """Messages, those of an owner together, to answers: the chunks' counts of ids, and the ids, in the message's order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, owner = _Table(path), None
        for batch in batches:
            of = batch.column("owner").to_pylist()
            for at in range(0, len(of), MESSAGES_AT_ONCE):
                read = [_read_message(c.as_py()) for c in batch.column("code")[at : at + MESSAGES_AT_ONCE]]
                if of[at] != owner:
                    table, owner = _Table(path), of[at]  # the rest of the former owner's may join it
                table.add([w for words in read for w in words])
                answers = [table.answer(words) for words in read]
                asked = [batch.column(c)[at : at + MESSAGES_AT_ONCE] for c in ("block", "owner")]
                yield pa.RecordBatch.from_arrays([*asked, pa.array(answers, pa.binary())], ["block", "owner", "answer"])

    return run


def _gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Concatenated slices of ``flat``: the ``index``-th of those given by start and count."""
    n = counts[index].astype(np.int64)
    ends = np.cumsum(n)
    if not len(ends):
        return flat[:0]
    return flat[np.repeat(starts[index] - (ends - n), n) + np.arange(ends[-1])]


def _decoded(path: str, result: pa.Schema):
    """Blocks with their answers to ``row, ids, decoded``."""

    def one(body: bytes, rows: pa.Array, answers: list[dict]) -> Iterator[pa.RecordBatch]:
        lengths, numbers, sizes, places = _unpack(body)
        of_owner = np.split(places, np.cumsum(sizes)[:-1])
        counts = np.zeros(len(places), np.int64)
        starts = np.zeros_like(counts)
        parts, before = [], 0
        for answer in answers:
            n, ids = _unpack(answer["answer"])
            at = of_owner[answer["owner"]]
            counts[at], starts[at] = n, before + np.cumsum(n) - n
            parts.append(ids.astype(np.int32))
            before += len(ids)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        at = 0
        while at < len(lengths):
            # As many rows as the bound admits, one at least.
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + IDS_AT_ONCE // 4, "right")) - 1)
            index = numbers[bounds[at] : bounds[to]]
            ids = _gather(flat, starts, counts, index)
            chunk_ends = np.concatenate([[0], np.cumsum(counts[index])])
            ends = chunk_ends[bounds[at : to + 1] - bounds[at]]
            listed = ids.tolist()
            texts = model(path).decode([listed[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.slice(at, to - at).cast(result.field(0).type),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())).cast(result.field(1).type),
                    pa.array(texts, pa.string()),
                ],
                schema=result,
            )
            at = to

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("rows").slice(i, 1).flatten()
                yield from one(batch.column("body")[i].as_py(), rows, batch.column("answers")[i].as_py() or [])

    return run


def encode_and_decode(df: DataFrame, model_path: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns in ``carry`` (default all) with ``ids`` (array of int) and ``decoded`` (their text again)."""
    columns = df.columns if carry is None else carry
    spark = df.sparkSession
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    owners = min(max(size // TEXT_PER_OWNER, LEAST_OWNERS), MOST_OWNERS)
    schema = T.StructType([
        T.StructField("block", T.LongType()),
        T.StructField("owner", T.IntegerType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("rows", T.ArrayType(rows.schema["row"].dataType)),
        T.StructField("kind", T.IntegerType()),
    ])
    # Bodies are large: they stay in the buckets of their blocks, and only chunks and answers are shuffled.
    cut = staged_by(rows.mapInArrow(_blocks(int(owners), to_arrow_schema(schema)), schema), "chunk-blocks", "block", "kind")
    messages = cut.where("kind = 1").select("owner", "block", F.col("body").alias("code"))
    dealt = messages.repartition("owner").sortWithinPartitions("owner")
    answers = dealt.mapInArrow(_answers(model_path), "block long, owner int, answer binary")
    # One answer per owner and block: as much as the block's own chunks.
    answered = answers.groupBy("block").agg(F.collect_list(F.struct("owner", "answer")).alias("answers"))
    blocks = cut.where("kind = 0").select("block", "body", "rows").join(answered, "block", "left")
    result = T.StructType([
        T.StructField("row", rows.schema["row"].dataType),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ])
    out = blocks.select("body", "rows", "answers").mapInArrow(_decoded(model_path, to_arrow_schema(result)), result)
    kept = [F.col("row").getField(c).alias(c) for c in columns if c not in ("ids", "decoded")]
    return out.select(*kept, "ids", "decoded")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def digests(encoded: DataFrame) -> DataFrame:
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(encode_and_decode(docs, default_model(), carry=["doc_id"]))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline, last stage: the token ids of every document, with its language, source and digests."""
    encoded = encode_and_decode(docs, default_model(), carry=["doc_id", "lang", "source"])
    return encoded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
