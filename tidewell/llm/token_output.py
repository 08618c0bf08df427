"""Token ids in a file format: a frame of zstandard for each document, under one shared dictionary.

A file set is a folder of two tables, written by Spark's own writers, so that it lies in any store
and half-written parts of lost executors are never seen:

* ``dictionary``: one row ``(dictionary, sha256)``, trained on serialized id arrays of a bounded sample.
* ``shards``: a row for each shard of documents in ascending order of ``doc_id``:
  ``task`` and ``part`` (the order), ``n_ids`` (ids in the shard), ``width`` (bytes of an id, 2 or 4),
  ``dict_sha256``, ``doc_ids``, ``ends`` (where each document's frame ends in ``payload``), ``counts``
  (ids of each document) and ``payload`` (the frames).

``document`` reads one document by its frame alone: its bounds come from ``ends``.

Nulls: a null text is empty and holds the end id alone; rows with a null ``doc_id`` come first.
Repeated rows and ids stay, each a document of its own, those of one id in an order by their texts' hashes.
Other columns are ignored. An empty table has an empty dictionary and no shards.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mapped, shared_dir, small_batches
from .textnp import column, kept, mix, pieces, span_sums, spans

#: Documents for the dictionary, and bytes of it.
SAMPLE_DOCS, DICT_BYTES = 1000, 64 << 10
#: Bytes of ids that one document gives to the sample: a longer one gives a block of them at a place by its hash, so that
#: the driver holds 64 MB at most.
SAMPLE_BYTES = 64 << 10
#: Bytes of text in a shard.
SHARD_BYTES = 8 << 20
#: Of zstandard.
LEVEL = 1
#: Bytes of the table of words whose ids a worker remembers, and bytes of text encoded at a time.
CACHE_BYTES, PIECE = 24 << 20, 1 << 19
#: Marks that are a part of their own after letters.
MARKS = ".,;:!?"
#: In place of the blank before a word: the word begins its text.
FIRST = 0

SHARDS = pa.schema([("task", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()), ("width", pa.int32()), ("dict_sha256", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("payload", pa.binary())])
SHARDS_DDL = "task int, part int, n_ids long, width int, dict_sha256 string, doc_ids array<long>, ends array<long>, counts array<long>, payload binary"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts by the tokenizers library, which sees each distinct word once while there is room to remember it.

    The pre-tokenizer never joins what a single space or line end between two other characters parts, nor a word of
    letters and the one mark after it. So a text is a row of such parts, found for a whole batch at once, and a part's
    ids are looked up by its 64-bit hash: with 10**10 different words and a full table, a wrong match comes once in 200
    runs of that size. A text with any other use of blanks, or with the name of a special token, goes to the library whole.
    """

    def __init__(self, path: str, room: int = CACHE_BYTES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.line_end = self.library(["\n"])[0]
        vocabulary = self.tokenizer.get_vocab()
        #: Bytes of an id in files.
        self.width = 2 if max(vocabulary.values(), default=0) < 1 << 16 else 4
        #: Whether an id's bytes begin with a space or a line end, as no id within a part does.
        self.begins = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        for token, i in vocabulary.items():
            self.begins[i] = token[:1] in ("Ġ", "Ċ")
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: The id of each mark that is one.
        self.marks = np.full(256, -1, np.int64)
        for mark, ids in zip(MARKS, self.library(list(MARKS))):
            if len(ids) == 1:
                self.marks[ord(mark)] = ids[0]
        #: Sorted hashes of the parts, where the ids of each start, how many they are, and the ids.
        self.table = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, f"<u{self.width}")
        self.room = room

    def library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts that begin with a blank and hold no other, and where each part's start: many are one text."""
        out, starts, n = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)], 0
        for at in range(0, len(parts), 500):
            own = parts[at : at + 500]
            ids = self.library(["".join(own)])[0]
            begin = np.flatnonzero(self.begins[ids])
            if len(begin) != len(own):
                each = self.library(own)
                ids, begin = np.concatenate(each), np.cumsum([0, *map(len, each[:-1])])
            out.append(ids)
            starts.append(begin + n)
            n += len(ids)
        return np.concatenate(out), np.concatenate(starts)

    def learn(self, keys: np.ndarray, words: list[bytes], before: np.ndarray) -> tuple:
        """The table with the ids of new ``words`` of the sorted ``keys``; ``before``: FIRST, or the blank before each."""
        found, begin = self.parts([(" " if b == 32 else "\n") + w.decode() for w, b in zip(words, before.tolist())])
        end = np.r_[begin[1:], len(found)]
        begin = begin + len(self.line_end) * (before == FIRST)
        old_keys, start, count, ids = self.table
        at = np.searchsorted(old_keys, keys)
        return np.insert(old_keys, at, keys), np.insert(start, at, (begin + len(ids)).astype(np.int32)), np.insert(count, at, (end - begin).astype(np.int32)), np.concatenate([ids, found.astype(ids.dtype)])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray] = []
        for _, _, data, offsets in pieces(texts, PIECE):
            out += self._piece(data, offsets)
        return out

    def _piece(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        whole = odd_texts(data, offsets, self.special)
        blank = (data == 32) | (data == 10)
        starts, ends, first = spans(~blank, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        plain = ~whole[row]
        starts, ends, row = starts[plain], ends[plain], row[plain]
        before = np.where(starts == offsets[row], FIRST, data[starts - 1])
        # A mark after nothing but letters is a part of its own.
        mark = self.marks[data[ends - 1]] if len(ends) else np.zeros(0, np.int64)
        others = np.zeros(len(data) + 1, np.int32)
        np.cumsum(~letters(data), out=others[1:])
        mark[(ends - starts < 2) | (others[ends - 1] != others[starts])] = -1
        ends = ends - (mark >= 0)
        keys = span_sums(data, starts, ends)
        keys ^= mix(before.astype(np.uint64) + np.uint64(1))
        mix(keys)

        some, at, of = np.unique(keys, return_index=True, return_inverse=True)
        table, new = self.table, self._find(self.table, some)[1]
        if new.any():
            at = at[new]
            table = self.learn(some[new], [data[s:e].tobytes() for s, e in zip(starts[at].tolist(), ends[at].tolist())], before[at])
            if 16 * len(table[0]) + table[3].nbytes <= self.room:
                self.table = table
        where = self._find(table, some)[0][of]
        _, start, count, known = table
        size = count[where] + (mark >= 0)
        upto = np.cumsum(size)
        ids = known[np.minimum(np.arange(upto[-1] if len(upto) else 0) + np.repeat(start[where] - upto + size, size), max(0, len(known) - 1))].astype("<u4")
        marked = np.flatnonzero(mark >= 0)
        ids[upto[marked] - 1] = mark[marked]
        edges = np.r_[0, upto][np.searchsorted(row, np.arange(len(offsets)))].tolist()
        out = [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]
        odd = np.flatnonzero(whole).tolist()
        for i, own in zip(odd, self.library([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in odd])):
            out[i] = own
        return out

    @staticmethod
    def _find(table: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the table the sorted keys are, and which aren't there."""
        if not len(table[0]):
            return np.zeros(len(keys), np.int64), np.ones(len(keys), bool)
        where = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return where, table[0][where] != keys

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.encode(pa.array([t or "" for t in texts], pa.large_string()))]


def letters(data: np.ndarray) -> np.ndarray:
    """Which bytes are letters of ASCII or of the letters from U+00C0 to U+00FF."""
    out = ((data | 32) >= 97) & ((data | 32) <= 122)
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    lead = lead[(data[lead + 1] >= 0x80) & (data[lead + 1] <= 0xBF) & (data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    out[lead] = out[lead + 1] = True
    return out


# In UTF-8, the blanks of Unicode of several bytes; those of one byte besides the space and line end.
LONG_BLANKS = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
IS_OTHER_BLANK = np.zeros(256, bool)
IS_OTHER_BLANK[[9, 11, 12, 13, 28, 29, 30, 31]] = True
IS_BLANK_LEAD = np.zeros(256, bool)
IS_BLANK_LEAD[[b[0] for b in LONG_BLANKS]] = True


def odd_texts(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> np.ndarray:
    """Which texts have blanks together, at an end, or other than space and line end, or hold a ``special`` string."""
    out = np.zeros(len(offsets) - 1, bool)
    if not len(data):
        return out
    blank = (data == 32) | (data == 10)
    full = np.flatnonzero(np.diff(offsets))
    out[full] = blank[offsets[full]] | blank[offsets[full + 1] - 1]
    found = [np.flatnonzero((blank[1:] & blank[:-1]) | IS_OTHER_BLANK[data[1:]]), np.flatnonzero(IS_OTHER_BLANK[data[:1]])]
    lead = np.flatnonzero(IS_BLANK_LEAD[data])
    if len(lead):
        next_ = [data[np.minimum(lead + k, len(data) - 1)] for k in (1, 2)]
        for b in LONG_BLANKS:
            same = (data[lead] == b[0]) & (next_[0] == b[1]) & ((next_[1] == b[2]) if len(b) > 2 else True)
            found.append(lead[same])
    raw = data.tobytes()
    for b in filter(None, special):
        at = raw.find(b)
        while at >= 0:
            found.append(np.array([at]))
            at = raw.find(b, at + 1)
    out[np.searchsorted(offsets, np.concatenate(found), "right") - 1] = True
    return out


def serialize(ids: np.ndarray, width: int) -> bytes:
    return ids.astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, path: str, end_id: int) -> bytes:
    """A dictionary from the SAMPLE_DOCS documents whose ids have the smallest hashes: a bounded sample of all."""
    import zstandard

    hashed = docs.withColumn("h", F.xxhash64("doc_id"))
    least = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).collect()]
    chosen = hashed.where(F.col("h") <= F.lit(max(least, default=0))).select("h", "text", F.xxhash64("text").alias("place"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept(f"encoder {path}", lambda: Encoder(path))
        for batch in batches:
            out = []
            for ids, place in zip(encode.encode(column(batch, "text")), column(batch, "place").to_pylist()):
                own = serialize(np.append(ids, np.uint32(end_id)), encode.width)
                at = max(0, (place or 0) % max(1, len(own) - SAMPLE_BYTES + 1)) // encode.width * encode.width
                out.append(own[at : at + SAMPLE_BYTES])
            yield pa.RecordBatch.from_arrays([column(batch, "h"), column(batch, "place"), pa.array(out, pa.binary())], ["h", "place", "block"])

    # Of rows with one id, the one whose text's hash is least.
    rows = chosen.transform(mapped, blocks, "h long, place long, block binary").groupBy("h").agg(F.min_by("block", F.coalesce("place", F.lit(0))).alias("block"))
    samples = [bytes(r.block) for r in rows.orderBy("h").limit(SAMPLE_DOCS).collect()]
    if len(samples) >= 8:
        try:
            return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
        except zstandard.ZstdError:  # samples too short to train on
            pass
    return b"".join(samples)[:DICT_BYTES]


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, partitions: int | None = None) -> None:
    """Write the ids of all documents to the folder ``path``."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokenizer_path()
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, tokenizer, end_id)
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(bytearray(dictionary), sha)], "dictionary binary, sha256 string").coalesce(1).write.parquet(f"{path}/dictionary")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        encode, task, part = kept(f"encoder {tokenizer}", lambda: Encoder(tokenizer)), TaskContext.get().partitionId(), 0
        if dictionary:
            compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)).compress
        else:
            compress = zstandard.ZstdCompressor(level=LEVEL).compress
        ids, frames, counts, size = [], [], [], 0
        end = np.array([end_id], "<u4")

        def shard() -> pa.RecordBatch:
            ends = np.cumsum([len(f) for f in frames]).tolist()
            return pa.RecordBatch.from_pylist([{"task": task, "part": part, "n_ids": sum(counts), "width": encode.width, "dict_sha256": sha, "doc_ids": ids, "ends": ends, "counts": counts, "payload": b"".join(frames)}], SHARDS)

        for batch in batches:
            doc_ids = column(batch, "doc_id")
            for at, to, data, offsets in pieces(column(batch, "text"), PIECE):
                texts = column(batch, "text").slice(at, to - at)
                for i, own, n in zip(doc_ids.slice(at, to - at).to_pylist(), encode.encode(texts), np.diff(offsets).tolist()):
                    ids.append(i)
                    frames.append(compress(serialize(np.concatenate([own, end]), encode.width)))
                    counts.append(len(own) + 1)
                    size += n
                    if size >= SHARD_BYTES:
                        yield shard()
                        ids, frames, counts, size, part = [], [], [], 0, part + 1
        if ids:
            yield shard()

    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A repeated id is dealt out by its texts; tasks and their parts are in the order of the ids.
    order = F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    docs.repartitionByRange(n, *order).sortWithinPartitions(*order).transform(mapped, shards, SHARDS_DDL).write.parquet(f"{path}/shards")


def open_dictionary(spark: SparkSession, path: str) -> tuple[bytes, str]:
    """The dictionary of a file set and its hash."""
    row = spark.read.parquet(f"{path}/dictionary").head()
    if hashlib.sha256(row.dictionary).hexdigest() != row.sha256:
        raise ValueError(f"the dictionary of {path} is damaged")
    return bytes(row.dictionary), row.sha256


def decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()


def opened(frame: bytes, decompress, count: int, width: int, doc_id: int | None) -> np.ndarray:
    """The ids of a frame."""
    own = np.frombuffer(decompress.decompress(frame, max_output_size=count * width), f"<u{width}").astype("<u4")
    if len(own) != count:
        raise ValueError(f"document {doc_id} has {len(own)} ids, the index says {count}")
    return own


def document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents ``doc_id``, several if it is repeated: no other frame leaves the files' reader."""
    dictionary, sha = open_dictionary(spark, path)
    place = F.explode(F.filter(F.sequence(F.lit(0), F.size("doc_ids") - 1), lambda i: F.get("doc_ids", i) == doc_id))
    found = spark.read.schema(SHARDS_DDL).parquet(f"{path}/shards").where(F.array_contains("doc_ids", F.lit(doc_id))).select("*", place.alias("i"))
    begin = F.coalesce(F.get("ends", F.col("i") - 1), F.lit(0))
    frame = F.substring("payload", (begin + 1).cast("int"), (F.get("ends", "i") - begin).cast("int"))
    rows = found.select("task", "part", "i", "width", "dict_sha256", F.get("counts", "i").alias("n"), frame.alias("frame")).orderBy("task", "part", "i").collect()
    if any(r.dict_sha256 != sha for r in rows):
        raise ValueError("a shard was written under another dictionary")
    decompress = decompressor(dictionary)
    return [opened(bytes(r.frame), decompress, r.n, r.width, doc_id).tolist() for r in rows]


def read(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """A row for each document: doc_id, start, n_tokens, ids_crc32, and with ``ids`` the ids themselves."""
    dictionary, sha = open_dictionary(spark, path)
    names = ["task", "part", "doc_id", "inside", "n_tokens", "ids_crc32", *(["ids"] if ids else [])]
    schema = pa.schema([(n, pa.list_(pa.int64()) if n == "ids" else pa.int64()) for n in names])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = decompressor(dictionary)
        for batch in batches:
            for k in range(batch.num_rows):
                r = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names)}
                if r["dict_sha256"] != sha:
                    raise ValueError("a shard was written under another dictionary")
                inside, at, out = 0, 0, {n: [] for n in names}
                for doc_id, end, count in zip(r["doc_ids"], r["ends"], r["counts"]):
                    own = opened(r["payload"][at:end], decompress, count, r["width"], doc_id)
                    for n, v in zip(names, (r["task"], r["part"], doc_id, inside, count, zlib.crc32(own.tobytes()), own.tolist() if ids else None)):
                        out[n].append(v)
                    inside, at = inside + count, end
                yield pa.RecordBatch.from_pydict(out, schema)

    shards = spark.read.schema(SHARDS_DDL).parquet(f"{path}/shards")
    # Shards are summed within their task, and tasks by themselves, so that one task sums a row for each task alone.
    tasks = shards.groupBy("task").agg(F.sum("n_ids").alias("n"))
    tasks = tasks.select("task", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    within = F.sum("n_ids").over(Window.partitionBy("task").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = shards.select("task", "part", F.coalesce(within, F.lit(0)).alias("before")).join(tasks, "task").select("task", "part", (F.col("first") + F.col("before")).alias("before"))
    rows = shards.transform(mapped, documents, "task long, part long, doc_id long, inside long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)
    return rows.join(starts, ["task", "part"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark)
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read(spark, path)
