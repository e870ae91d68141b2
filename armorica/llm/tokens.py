"""Token ids as flat binary files with 64-bit document offsets.

Documents are dealt by range of their id; each task writes one shard:

* ``<name>.tokens``: ids, little-endian unsigned integers of 16 or 32 bits,
* ``<name>.offsets``: unsigned 64-bit positions in the shard, one more than documents,
* ``<name>.ids``: signed 64-bit document ids (those without an id come first, see the manifest).

The manifest (Parquet, one row per shard) names the files of the attempts that
succeeded, so a lost executor leaves nothing but unnamed files. Positions in the whole
corpus are a shard's base, the prefix sum of the tokens of the shards before it.
"""

from __future__ import annotations

import gc
import json
import re
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from armorica.llm.common import give_back_memory, named, octets, slices, text_key
from armorica.workspace import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CACHED_SEGMENTS = 500_000
# How byte-level vocabularies write the byte 32, and letters of two bytes.
BYTE_SPACE = "\u0120"
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
MARKS = ",.;:!?"
# Bytes without a visible character of their own are numbered from 256 on.
_UNSEEN = [byte for byte in range(256) if not (33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174)]
_BYTE = {byte: chr(256 + _UNSEEN.index(byte)) if byte in _UNSEEN else chr(byte) for byte in range(256)}
_WRITTEN = {code: "".join(_BYTE[byte] for byte in chr(code).encode()) for code in range(0xC0, 0x100)}
_PLAIN = re.compile(f"([{LETTERS}]+)([{MARKS}]?)(?:\n([{LETTERS}]+)([{MARKS}]?))?")
_WHITE_AFTER_SPACE = re.compile(r" \s")
_SPACE_PAIRS = [" " + white for white in " \t\n\v\f\r\x1c\x1d\x1e\x1f"]
READ_BYTES = 8 << 20
# Of a shard, in bytes of text and of what each row adds.
SHARD_BYTES = 256 << 20
ROW_BYTES = 16
_MANIFEST = "shard int, name string, documents bigint, null_ids bigint, tokens bigint, width int"
_READ = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


class _Segments(dict):
    """Ids of segments after a space, as bytes; what is asked for is learnt.

    A key that begins with a line end stands for the word after it, without a space.
    """

    def __init__(self, tokenizer, width: int) -> None:
        self._tokenizer, self._tokenize = tokenizer, tokenizer.model.tokenize
        self._dtype = np.dtype(f"<u{width}")
        self._bytes = [number.to_bytes(width, "little") for number in range(tokenizer.get_vocab_size(with_added_tokens=True))]
        self._marks = {mark: self.whole(mark) for mark in MARKS} | {"": b""}
        self._line_end = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, self._dtype).tobytes()

    def _word(self, written: str) -> bytes:
        """Ids of a word as byte-level vocabularies write it."""
        each = self._bytes
        return b"".join([each[token.id] for token in self._tokenize(written)])

    def __missing__(self, segment: str) -> bytes:
        if segment.isascii() and segment.isalpha():
            ids = self._word(BYTE_SPACE + segment)
        elif segment[:1] == "\n":
            ids = self._word(segment[1:].translate(_WRITTEN))
        elif match := _PLAIN.fullmatch(segment):
            word, mark, next_word, next_mark = match.groups()
            if next_word:
                return self[word] + self._marks[mark] + self._line_end + self["\n" + next_word] + self._marks[next_mark]
            ids = self[word] + self._marks[mark] if mark else self._word(BYTE_SPACE + word.translate(_WRITTEN))
        else:
            ids = self.whole(" " + segment)
        self[segment] = ids
        return ids


class Encoder:
    """Texts to ids as bytes.

    A byte-level pre-tokenizer begins a token at every single space before a character
    that is no white space, and keeps letters, punctuation and line ends apart. Texts are
    cut there: a segment is a word of Latin letters with at most one mark after it, perhaps
    a line end and one more such word, or anything else, which is encoded as it is. The
    ids of segments are remembered, up to ``cached_segments``; new words go straight to the
    tokenizer's model. Texts with other white space after a space, and all texts for other
    tokenizers, are encoded whole.

    Sent as a broadcast, it is built once in a worker and keeps what it has learnt.
    """

    def __init__(self, spec: str, width: int, cached_segments: int = CACHED_SEGMENTS) -> None:
        self._spec, self._width, self._most = spec, width, cached_segments
        self._segments = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_segments": None}

    def _load(self) -> None:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(self._spec)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._segments = _Segments(tokenizer, self._width)
        model = json.loads(self._spec)
        cut = model.get("pre_tokenizer") or {}
        self._cuts = (
            cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space")
            and model.get("normalizer") is None
            and not model["model"].get("dropout")
            and all(token.get("special") for token in model.get("added_tokens") or [])
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        if self._segments is None:
            self._load()
        segments = self._segments
        collecting = gc.isenabled()
        gc.disable()  # nothing here refers to itself
        try:
            out = []
            for text in texts:
                if not self._cuts or _has_white_space_after_space(text):
                    out.append(segments.whole(text))
                    continue
                if len(segments) > self._most:
                    segments.clear()
                parts = text.split(" ")
                parts[0] = segments.whole(parts[0])
                parts[1:] = map(segments.__getitem__, parts[1:])
                out.append(b"".join(parts))
            return out
        finally:
            if collecting:
                gc.enable()


def _has_white_space_after_space(text: str) -> bool:
    if text.isascii():
        return any(pair in text for pair in _SPACE_PAIRS)
    return _WHITE_AFTER_SPACE.search(text) is not None


def _writer(sent: Broadcast, folder: str, width: int, end_id: int | None) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = sent.value
        end = b"" if end_id is None else end_id.to_bytes(width, "little")
        store, path = fs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:07d}-{uuid.uuid4().hex}"
        out, documents, null_ids, position = None, 0, 0, 0
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if out is None:
                    out = {kind: store.open_output_stream(f"{path}/{name}.{kind}") for kind in ("tokens", "offsets", "ids")}
                    out["offsets"].write(np.zeros(1, "<u8").tobytes())
                ids = batch.column(0)
                out["ids"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                null_ids += ids.null_count
                documents += batch.num_rows
                for texts in slices(batch.column(1), 1 << 20):
                    packed = [x + end for x in encoder.encode([text.decode("utf-8", "replace") for text in texts])]
                    stops = position + np.cumsum([len(x) // width for x in packed])
                    position = int(stops[-1])
                    out["tokens"].write(b"".join(packed))
                    out["offsets"].write(stops.astype("<u8").tobytes())
        finally:
            for stream in (out or {}).values():
                stream.close()
        give_back_memory()
        if out is not None:
            row = [[shard], [name], [documents], [null_ids], [position], [width]]
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            names = ["shard", "name", "documents", "null_ids", "tokens", "width"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=names)

    return write


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    cached_segments: int = CACHED_SEGMENTS,
    shard_bytes: int = SHARD_BYTES,
) -> str:
    """Encode whole texts in ascending order of the id and write the files; the folder is returned.

    ``tokenizer``: path of a ``tokenizers`` file, read on the driver. ``folder``: a new
    folder all executors share, given as a URI or a path; by default one below
    ``spark.checkpoint.dir``. ``end_id`` is appended to each document. ``cached_segments``
    bounds what a worker remembers; it changes no result. Shards hold about
    ``shard_bytes`` of text at the most.

    Null texts are empty. Rows without an id come first; rows of one id are ordered by
    a hash of their text. Other columns are not read. An empty table gives a manifest
    without rows.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "tokens")
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    vocabulary = _vocabulary_size(spec)
    width = 2 if max(vocabulary, (end_id or 0) + 1) <= 1 << 16 else 4
    # More shards than there are shuffle partitions, where these would hold too much.
    held = docs.agg(F.sum(F.coalesce(F.octet_length(named(text_col)), F.lit(0)) + F.lit(ROW_BYTES))).first()[0] or 0
    shards = -(-held // shard_bytes)
    number = [shards] if shards > int(spark.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = (
        docs.select(named(id_col).cast("bigint").alias("doc_id"), named(text_col).alias("text"))
        .withColumn("key", text_key(F.col("text")))
        .withColumn("row", F.monotonically_increasing_id())  # splits many rows of one id and text
        .repartitionByRange(*number, "doc_id", "key", "row")
        .sortWithinPartitions("doc_id", "key", "row")
        .select("doc_id", octets(F.col("text")).alias("text"))
    )
    sent = spark.sparkContext.broadcast(Encoder(spec, width, cached_segments))
    manifest = ordered.mapInArrow(_writer(sent, folder, width, end_id), _MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return folder


def _vocabulary_size(spec: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec).get_vocab_size(with_added_tokens=True)


def _items(store: fs.FileSystem, path: str, dtype: str) -> Callable[[int, int], np.ndarray]:
    """Items ``first`` to ``last`` of a file: memory-mapped where the file system is local, else a ranged read."""
    if isinstance(store, fs.LocalFileSystem):
        mapped = np.memmap(path, dtype, "r") if store.get_file_info(path).size else np.zeros(0, dtype)
        return lambda first, last: mapped[first:last]
    width = np.dtype(dtype).itemsize

    def read(first: int, last: int) -> np.ndarray:
        with store.open_input_file(path) as file:
            return np.frombuffer(file.read_at((last - first) * width, first * width), dtype)

    return read


def _reader(folder: str) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                files = f"{path}/{row['name']}"
                at, total = 0, row["documents"]
                tokens = _items(store, f"{files}.tokens", f"<u{row['width']}")
                offsets = _items(store, f"{files}.offsets", "<u8")(0, total + 1).astype(np.int64)
                ids = _items(store, f"{files}.ids", "<i8")(0, total)
                while at < total:
                    stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + READ_BYTES // 4, "right")) - 1)
                    stop = min(stop, total)
                    part = tokens(int(offsets[at]), int(offsets[stop])).astype("<u4").tobytes()
                    local = (offsets[at : stop + 1] - offsets[at]) * 4
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(ids[at:stop]), pa.int64(), mask=np.arange(at, stop) < row["null_ids"]),
                            pa.array(offsets[at:stop] + row["base"], pa.int64()),
                            pa.array(offsets[at + 1 : stop + 1] - offsets[at:stop], pa.int64()),
                            pa.Array.from_buffers(
                                pa.binary(), stop - at, [None, pa.py_buffer(local.astype(np.int32)), pa.py_buffer(part)]
                            ),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    at = stop

    return read


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of written files: ``doc_id``, ``start`` (in the corpus), ``n_tokens``, ``ids``.

    ``ids`` holds little-endian unsigned 32-bit integers, whatever the width in the file.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    return based.repartition(max(1, manifest.count()), "shard").mapInArrow(_reader(folder), _READ)
