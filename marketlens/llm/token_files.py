"""Token-ID output: binary files of one compressed frame a document, a shared dictionary, and an index into them.

Folder layout: `dictionary` (zstandard dictionary), then `shard-NNNNN.ids` and `shard-NNNNN.idx` in ascending order of
documents. A shard's `.ids` is the magic `TOKIDS01`, the SHA-256 of the dictionary, and the frames; each frame is one
document's ids as little-endian unsigned 32-bit integers. Its `.idx` is the magic `TOKIDX01`, the same SHA-256, the
number of documents, and for each document five little-endian signed 64-bit integers: id, ids of all documents before
it, number of its ids, first byte and length of its frame. So one document costs one short read of each file. Documents
without an id come first; their id is the smallest integer and their length is negative, which no other length is.
"""

import hashlib
import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import map_rows, shuffle_partitions, written
from marketlens.llm.unit_ids import PLAIN, Known, ids_of, packed_parts

IDS, INDEX, HEAD = b"TOKIDS01", b"TOKIDX01", 8 + 32
#: What stands for the id of a document that has none.
_NO_ID = -(1 << 63)
FIELDS = ("doc_id", "start", "n_tokens", "offset", "length")


class Tokens:
    """Whole texts to ids by a vocabulary file of the tokenizers library; built once per Python worker.

    The library encodes each different piece of many texts once; a text's ids are those of its pieces in a row. Words
    are handed over many in a row, and the ids parted again by the number of bytes they stand for. Texts with an added
    token (like <|endoftext|>) are handed over whole, so the library finds it as in a plain call.
    """

    #: Pieces handed to the library in one call, words in a row, and pieces of a generation that are remembered.
    CALL, ROW, KEPT = 4096, 256, 250_000

    def __init__(self, vocabulary: str, end: int):
        self.vocabulary, self.end, self._library = vocabulary, end, None

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary, "end": self.end, "_library": None}

    def _prepare(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(self.vocabulary)
        added = [token.content for token in self._library.get_added_tokens_decoder().values() if token.content]
        self._added = re.compile("|".join(map(re.escape, added))).search if added else None
        every = self._library.get_vocab()
        self._bytes = np.zeros(max(every.values(), default=0) + 1, np.int64)
        for token, number in every.items():  # written with one character a byte
            self._bytes[number] = len(token)
        self._known = Known(self.KEPT)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        found = []
        for start in range(0, len(texts), self.CALL):
            part = [text.decode("utf-8", "surrogatepass") for text in texts[start : start + self.CALL]]
            encoded = self._library.encode_batch_fast(part, add_special_tokens=False)
            found += [np.array(own.ids, np.uint32) for own in encoded]
        return found

    def _look_up(self, wanted: list[bytes]) -> list[bytes]:
        found = self._known.find(wanted)
        missing = [piece for piece, ids in zip(wanted, found) if ids is None]
        words = [piece for piece in missing if piece[0] == 32 and PLAIN(piece)]
        rows = [words[start : start + self.ROW] for start in range(0, len(words), self.ROW)]
        new: dict[bytes, bytes] = {}
        for row, ids in zip(rows, self._encode([b"".join(row) for row in rows])):
            ends = np.cumsum(self._bytes[ids])
            wanted_ends = np.cumsum([len(word) for word in row])
            bounds = np.searchsorted(ends, wanted_ends) + 1
            if bounds[-1] == len(ends) and (ends[bounds - 1] == wanted_ends).all():
                new.update(zip(row, packed_parts(ids, np.append(0, bounds))))
        left = [piece for piece in missing if piece not in new]
        new.update((piece, ids.astype("<u4").tobytes()) for piece, ids in zip(left, self._encode(left)))
        self._known.keep(new)
        return [new[piece] if ids is None else ids for piece, ids in zip(wanted, found)]

    def encode_all(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text and the end id; a null or empty text has the end id alone."""
        if self._library is None:
            self._prepare()
        texts, end = list(texts), np.array([self.end], np.uint32)
        whole = [k for k, text in enumerate(texts) if text and self._added and self._added(text)]
        alone = self._encode([texts[k].encode("utf-8", "surrogatepass") for k in whole])
        for k in whole:
            texts[k] = None
        found = ids_of(texts, self._look_up)
        for k, ids in zip(whole, alone):
            found[k] = ids
        return [np.concatenate((ids, end)) for ids in found]


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system that a folder's address names, and the path in it."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def _put(store: fs.FileSystem, path: str, data: bytes, attempt: str) -> None:
    """Write a file under a name of its own, then move it into place: a task that is run again leaves the same file."""
    own = f"{path}.{attempt}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, path)


def _trained(sample: list[bytes], size: int) -> bytes:
    """A dictionary from a sample of serialized id arrays; with too little to learn from, the sample's last bytes."""
    try:
        return zstandard.train_dictionary(size, sample).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[-size:] or b"\0" * 8


def write_tokens(
    docs: DataFrame,
    folder: str,
    vocabulary: str,
    end: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = 2_000,
    dictionary_bytes: int = 65_536,
    level: int = 3,
) -> int:
    """Encode every whole text and write the files; returns the number of shards.

    Ids are those of Tokenizer.encode(text, add_special_tokens=False): an added token in a text is one id.
    `vocabulary` is the content of a tokenizers file, `end` the id after each document, `folder` an address that the
    executors can write to. The dictionary is trained on `sample` documents, those with the smallest hash of their id, of
    which long ones are cut for that.
    Documents are dealt into shards by ranges of `doc_id` and sorted there, so shards in a row are in ascending order.
    Every shard is written once under its final name; a task that is run again writes the same bytes.

    Ids of documents are whole numbers; what cannot be cast to one is an error. A null or empty text is one end id. Rows
    without an id come first; they, and rows that repeat an id, are all written, in the order of their texts. An empty table
    may give no shard at all. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    known = rows.filter("doc_id IS NOT NULL")
    tokens = spark.sparkContext.broadcast(Tokens(vocabulary, end))

    def encode(batch: pa.RecordBatch) -> dict[str, list]:
        found = tokens.value.encode_all(batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), "ids": [own.tobytes() for own in found]}

    chosen = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    first = map_rows(known.join(F.broadcast(chosen), "doc_id"), encode, "doc_id long, ids binary")  # at most `sample` ids
    ordered = first.repartition(1).sortWithinPartitions("doc_id", "ids")
    store, root = _store(folder)
    store.create_dir(root, recursive=True)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # No longer than zstandard makes use of: a hundred times the dictionary.
        parts, held = [], 0
        for batch in batches:
            for ids in batch.column("ids").to_pylist():
                if held < 100 * dictionary_bytes:
                    parts.append(ids[: dictionary_bytes])
                    held += len(parts[-1])
        yield pa.RecordBatch.from_pydict({"dictionary": [_trained(parts, dictionary_bytes)]})

    row = ordered.mapInArrow(train, "dictionary binary").first()
    dictionary = bytes(row["dictionary"]) if row else b"\0" * 8
    _put(store, f"{root}/dictionary", dictionary, "new")

    # Ranges are dealt from the ids alone; each shard's own numbers are known once all before it are counted.
    shards = shuffle_partitions(spark)
    dealt = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    shared = spark.sparkContext.broadcast(dictionary)
    mark = hashlib.sha256(dictionary).digest()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        shard, attempt = context.partitionId(), f"{context.taskAttemptId()}"
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(shared.value))
        target, base = _store(folder)
        entries, before, at = [], 0, HEAD
        name = f"{base}/shard-{shard:05d}.ids"
        with target.open_output_stream(f"{name}.{attempt}") as out:
            out.write(IDS + mark)
            for batch in batches:
                for k in range(0, batch.num_rows, 1024):
                    part = batch.slice(k, 1024)
                    found = tokens.value.encode_all(part.column("text").to_pylist())
                    for own_id, ids in zip(part.column("doc_id").to_pylist(), found):
                        frame = packer.compress(ids.astype("<u4").tobytes())
                        out.write(frame)
                        entry = (_NO_ID, before, len(ids), at, -len(frame)) if own_id is None else (own_id, before, len(ids), at, len(frame))
                        entries.append(entry)
                        before, at = before + len(ids), at + len(frame)
        target.move(f"{name}.{attempt}", name)
        index = np.array(entries, "<i8").reshape(-1, 5)
        head = INDEX + mark + struct.pack("<q", len(entries))
        _put(target, f"{base}/shard-{shard:05d}.part", head + index.tobytes(), attempt)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "documents": [len(entries)], "tokens": [before]})

    counts = written(dealt.mapInArrow(write, "shard long, documents long, tokens long"), "shards")
    return _number(spark, folder, counts)


def _number(spark: SparkSession, folder: str, counts: DataFrame) -> int:
    """Add to each shard's index the ids of the shards before it. One row a shard is what this works on."""
    totals = sorted((row["shard"], row["tokens"]) for row in counts.select("shard", "tokens").toLocalIterator())
    before = 0
    offsets = []
    for shard, own in totals:
        offsets.append((shard, before))
        before += own

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = _store(folder)
        for batch in batches:
            for shard, offset in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist()):
                with store.open_input_stream(f"{root}/shard-{shard:05d}.part") as part:
                    data = part.read()
                index = np.frombuffer(data, "<i8", offset=HEAD + 8).reshape(-1, 5).copy()
                index[:, 1] += offset
                attempt = f"{TaskContext.get().taskAttemptId()}"
                _put(store, f"{root}/shard-{shard:05d}.idx", data[: HEAD + 8] + index.tobytes(), attempt)
                yield pa.RecordBatch.from_pydict({"shard": [shard]})

    if offsets:
        rows = spark.createDataFrame(offsets, "shard long, before long").repartition(min(len(offsets), 64))
        rows.mapInArrow(shift, "shard long").count()
    return len(offsets)


class Reader:
    """Documents of one shard by id, each with one read of its frame."""

    def __init__(self, folder: str, shard: int):
        self.store, self.root = _store(folder)
        with self.store.open_input_stream(f"{self.root}/dictionary") as part:
            dictionary = part.read()
        with self.store.open_input_stream(f"{self.root}/shard-{shard:05d}.idx") as part:
            data = part.read()
        mark = hashlib.sha256(dictionary).digest()
        if data[:HEAD] != INDEX + mark:
            raise ValueError(f"the index of shard {shard} is not of this dictionary")
        self.index = np.frombuffer(data, "<i8", offset=HEAD + 8).reshape(-1, 5)
        if len(self.index) != struct.unpack_from("<q", data, HEAD)[0]:
            raise ValueError(f"the index of shard {shard} is cut short")
        self.file = self.store.open_input_file(f"{self.root}/shard-{shard:05d}.ids")
        if self.file.read_at(HEAD, 0) != IDS + mark:
            raise ValueError(f"shard {shard} is not of this dictionary")
        self.unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))

    def ids(self, place: int) -> np.ndarray:
        """Ids of the document at a place of the index."""
        _, _, n, offset, length = self.index[place].tolist()
        return np.frombuffer(self.unpacker.decompress(self.file.read_at(abs(length), offset), max_output_size=4 * n), "<u4")

    def find(self, doc_id: int) -> list[np.ndarray]:
        """Ids of each document with this id; none if the shard has none."""
        first, last = (int(np.searchsorted(self.index[:, 0], doc_id, side)) for side in ("left", "right"))
        return [self.ids(place) for place in range(first, last) if self.index[place, 4] >= 0]


def read_tokens(spark: SparkSession, folder: str, shards: int) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, frame by frame; dictionaries are checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                reader = Reader(folder, shard)
                sums = [zlib.crc32(reader.ids(place).tobytes()) for place in range(len(reader.index))]
                columns = {name: reader.index[:, k] for k, name in enumerate(FIELDS[:3])}
                found = {name: pa.array(own, pa.int64()) for name, own in (columns | {"ids_crc32": sums}).items()}
                found["doc_id"] = pa.array(columns["doc_id"], pa.int64(), mask=reader.index[:, 4] < 0)
                yield pa.RecordBatch.from_pydict(found)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return spark.range(0, shards, 1, numPartitions=max(shards, 1)).mapInArrow(read, schema)
