"""Token ids in length-delimited binary files, with an offset index.

A shard holds the documents of one range of ids, in ascending order, as framed
records: the length (8 bytes, little-endian), its masked CRC-32C (4), the
payload, and the payload's masked CRC-32C (4), the framing of TFRecord files.
A payload is a null flag (1), the document id (8), the bytes per token (1) and
the tokens, little-endian. Beside each shard lies an index with the offset,
length and number of tokens of every record, for reads in any order.

Texts are sorted into shards, encoded and written by one task per shard. White
space separates tokens in this vocabulary, so a text's ids are those of its
words: the distinct words of some megabytes of text are encoded by the library,
and put in place for every text. Texts that hold the name of an added token are
encoded whole.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.llm.common import shuffle_partitions, text_of
from kerbside.session import shared_dir

END_ID = 1
# Bytes of text that a shard is meant for.
SHARD_BYTES = 256 << 20
RECORD_HEAD = struct.Struct("<BqB")
FRAME = struct.Struct("<QI")
INDEX = np.dtype([("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")])
LANE = 512


# --- masked CRC-32C ----------------------------------------------------------


def _tables() -> np.ndarray:
    """Tables of the reflected Castagnoli polynomial for four bytes at a time."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1)
    out = [table]
    for _ in range(3):
        out.append((out[-1] >> 8) ^ table[out[-1] & 0xFF])
    return np.stack(out)


_T = _tables()


def _raw(words: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """CRC registers after each row of 32-bit words, without the final inversion."""
    for k in range(words.shape[1]):
        x = crc ^ words[:, k]
        crc = _T[3][x & 0xFF] ^ _T[2][(x >> 8) & 0xFF] ^ _T[1][(x >> 16) & 0xFF] ^ _T[0][x >> 24]
    return crc


def _shift_tables() -> np.ndarray:
    """What LANE zero bytes do to a register, by each of its four bytes."""
    zeros = np.zeros((256, LANE // 4), np.uint32)
    return np.stack([_raw(zeros, np.arange(256, dtype=np.uint32) << np.uint32(8 * k)) for k in range(4)])


_SHIFT = _shift_tables()


def crc32c(chunks: list[bytes]) -> np.ndarray:
    """CRC-32C of each byte string; lanes of all strings advance together.

    Zero bytes in front of a message do not change a register that starts at
    zero, so each string is padded in front to whole lanes, with the register's
    start folded into its first four bytes.
    """
    padded, lanes = [], []
    for raw in chunks:
        # Three bytes or fewer do not hold the whole start value: let it run in zeros first.
        lead = bytes(b ^ 0xFF for b in raw[:4])
        if len(raw) < 4:
            tail = 0xFFFFFFFF
            for b in raw:
                tail = int(_T[0][(tail ^ b) & 0xFF]) ^ (tail >> 8)
            padded.append(None)
            lanes.append(tail)
            continue
        body = lead + raw[4:]
        padded.append(b"\0" * (-len(body) % LANE) + body)
        lanes.append(len(padded[-1]) // LANE)
    out = np.zeros(len(chunks), np.uint32)
    whole = [k for k, p in enumerate(padded) if p is not None]
    for k, p in enumerate(padded):
        if p is None:
            out[k] = lanes[k]
    if whole:
        words = np.frombuffer(b"".join(padded[k] for k in whole), "<u4").reshape(-1, LANE // 4)
        each = _raw(words, np.zeros(len(words), np.uint32))
        counts = np.array([lanes[k] for k in whole])
        ends = np.cumsum(counts)
        crc = np.zeros(len(whole), np.uint32)
        for step in range(int(counts.max())):
            on = step < counts
            c = crc[on]
            moved = _SHIFT[0][c & 0xFF] ^ _SHIFT[1][(c >> 8) & 0xFF] ^ _SHIFT[2][(c >> 16) & 0xFF] ^ _SHIFT[3][c >> 24]
            crc[on] = moved ^ each[(ends - counts)[on] + step]
        out[whole] = crc
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Each payload with its length and masked checksums."""
    sizes = [struct.pack("<Q", len(p)) for p in payloads]
    sums = masked(crc32c(sizes + payloads))
    half = len(payloads)
    return [
        s + struct.pack("<I", a) + p + struct.pack("<I", b)
        for s, p, a, b in zip(sizes, payloads, sums[:half].tolist(), sums[half:].tolist(), strict=True)
    ]


def unframe(data: memoryview | bytes, offsets: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Payloads of framed records at the given places; raises where a checksum is wrong."""
    sizes, payloads, sums = [], [], []
    for at, length in zip(offsets.tolist(), lengths.tolist(), strict=True):
        sizes.append(bytes(data[at : at + 8]))
        size, first = FRAME.unpack_from(data, at)
        if size + 16 != length:
            raise ValueError(f"record at {at} has {size} bytes, its index {length - 16}")
        payloads.append(bytes(data[at + 12 : at + 12 + size]))
        sums.append((first, struct.unpack_from("<I", data, at + 12 + size)[0]))
    want = np.array([s[0] for s in sums] + [s[1] for s in sums], np.uint32)
    if (masked(crc32c(sizes + payloads)) != want).any():
        raise ValueError("a record's checksum does not match its bytes")
    return payloads


# --- encoding ----------------------------------------------------------------

_library: dict = {}
# Bytes of text whose distinct words are encoded together.
CHUNK_BYTES = 32 << 20
# Words that the library encodes as one text, and how many such texts at a time.
JOINED, TEXTS = 1_000, 50
# How the last token of a piece ends in this vocabulary.
END_MARK = "</w>"
# A word of ASCII letters with marks after them: two pieces.
MARKED = r"^[A-Za-z]+[!-/:-@\[-`{-~]+$"


def _tokenizer(path: str):
    """The library's tokenizer, the type of its ids, and which ids end a piece."""
    if path not in _library:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        _library.clear()
        made = Tokenizer.from_file(path)
        vocab = made.get_vocab()
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for token, i in vocab.items() if token.endswith(END_MARK)]] = True
        _library[path] = made, "<u2" if len(ends) <= 1 << 16 else "<u4", ends
    return _library[path]


def holds_name(texts: pa.Array, path: str) -> np.ndarray:
    """Which texts hold the name of an added token, such as that of the end of a text.

    The library finds these names before it splits a text into words, and not only
    between white space, so such texts are left to it whole.
    """
    found = np.zeros(len(texts), bool)
    for token in _tokenizer(path)[0].get_added_tokens_decoder().values():
        here = pc.match_substring(texts, token.content, ignore_case=True)
        found |= here.to_numpy(zero_copy_only=False)
    return found


def _joined_ids(words: pa.Array, pieces: int, path: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ids of runs of words encoded as one text: first word, one past the last, ids, ids per word.

    Each of the words has at least ``pieces`` pieces. A text whose pieces are
    exactly as many as that is cut apart by them; others are left out.
    """
    made, kind, ends = _tokenizer(path)
    cuts = [*range(0, len(words), JOINED), len(words)]
    lists = pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), words)
    texts = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).to_pylist()
    for first in range(0, len(texts), TEXTS):
        coded = made.encode_batch_fast(texts[first : first + TEXTS], add_special_tokens=False)
        for k, got in enumerate(coded, first):
            ids = np.array(got.ids, kind)
            stops = np.flatnonzero(ends[ids]) + 1
            if len(stops) == pieces * (cuts[k + 1] - cuts[k]):
                yield cuts[k], cuts[k + 1], ids, np.diff(stops[pieces - 1 :: pieces], prepend=0)


def word_ids(words: pa.Array, path: str) -> pa.Array:
    """Ids of each word, as little-endian bytes.

    Words of letters, and of ASCII letters with marks after them, are encoded
    many at a time; the rest, and what could not be cut apart, one by one.
    """
    made, kind, _ = _tokenizer(path)
    letters = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
    marked = pc.match_substring_regex(words, MARKED).to_numpy(zero_copy_only=False)
    left = np.ones(len(words), bool)
    places, found, sizes = [], [], []
    for pieces, chosen in ((1, letters), (2, marked & ~letters)):
        at = np.flatnonzero(chosen)
        for a, b, ids, lengths in _joined_ids(words.take(pa.array(at)), pieces, path):
            places.append(at[a:b])
            found.append(ids)
            sizes.append(lengths)
            left[at[a:b]] = False
    rest = np.flatnonzero(left)
    for start in range(0, len(rest), JOINED):
        at = rest[start : start + JOINED]
        coded = made.encode_batch_fast(words.take(pa.array(at)).to_pylist(), add_special_tokens=False)
        each = [np.array(got.ids, kind) for got in coded]
        places.append(at)
        found.extend(each)
        sizes.append(np.array([len(ids) for ids in each], np.int64))
    if not places:
        return pa.array([], pa.large_binary())
    stops = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int64) * np.dtype(kind).itemsize
    buffers = [None, pa.py_buffer(stops.tobytes()), pa.py_buffer(np.concatenate(found).tobytes())]
    made_ids = pa.Array.from_buffers(pa.large_binary(), len(words), buffers)
    return made_ids.take(pa.array(np.argsort(np.concatenate(places))))


def encode_array(texts: pa.Array, path: str, end_id: int = END_ID) -> tuple[list[bytes], int]:
    """Ids of each text with the end id, as little-endian bytes, and bytes per id.

    Arrow splits the texts and numbers their distinct words; the ids of all words
    then lie one after another in one buffer, which is cut at the texts' ends.
    """
    made, kind, _ = _tokenizer(path)
    named = holds_name(texts, path)
    split = pc.ascii_split_whitespace(pc.if_else(pa.array(named), "", texts) if named.any() else texts)
    numbered = split.flatten().dictionary_encode()
    placed = word_ids(numbered.dictionary, path).take(numbered.indices)
    sizes = pc.binary_length(placed).to_numpy(zero_copy_only=False)
    stops = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    cuts = stops[split.offsets.to_numpy()].tolist()
    data = memoryview(placed.buffers()[2] or b"")
    end = np.array([end_id], kind).tobytes()
    out = [bytes(data[a:b]) + end for a, b in zip(cuts, cuts[1:], strict=False)]
    for k in np.flatnonzero(named).tolist():
        ids = made.encode(texts[k].as_py(), add_special_tokens=False).ids
        out[k] = np.array(ids, kind).tobytes() + end
    return out, np.dtype(kind).itemsize


def encode_texts(texts: list[str], path: str, end_id: int = END_ID) -> tuple[list[bytes], int]:
    return encode_array(pa.array(texts, pa.large_string()), path, end_id)


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list, int, list[bytes]]]:
    """Ids of documents, bytes per token and tokens, a bounded number of bytes at a time."""

    def coded(held: list[pa.RecordBatch]) -> tuple[list, int, list[bytes]]:
        rows = pa.Table.from_batches(held)
        ids, width = encode_array(rows["text"].cast(pa.large_string()).combine_chunks(), path)
        return rows["doc_id"].to_pylist(), width, ids

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= CHUNK_BYTES:
            yield coded(held)
            held, size = [], 0
    if held:
        yield coded(held)


# --- files -------------------------------------------------------------------


def pack(doc_ids: list, width: int, ids: list[bytes]) -> list[bytes]:
    """Payloads of records."""
    return [RECORD_HEAD.pack(i is None, i or 0, width) + raw for i, raw in zip(doc_ids, ids, strict=True)]


# Schemes of Hadoop's file systems that Arrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder by its address; plain paths and ``dbfs:`` are local."""
    scheme, colon, rest = folder.partition(":/")
    if not colon:
        return fs.LocalFileSystem(), folder
    if scheme == "dbfs":
        return fs.LocalFileSystem(), f"/dbfs/{rest.lstrip('/')}"
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:/{rest}")


_TOTALS = "shard long, n_records long, n_tokens long"


def _writer(folder: str, path: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Encodes a sorted partition and writes it as one shard, numbered as the partition."""
        store, root = _open(folder)
        shard, index, at, out = TaskContext.get().partitionId(), [], 0, None
        temp = f"{root}/.{uuid.uuid4().hex}"
        for doc_ids, width, ids in _encoded(batches, path):
            out = out or store.open_output_stream(temp)
            for raw, record in zip(ids, frame(pack(doc_ids, width, ids)), strict=True):
                out.write(record)
                index.append((at, len(record), len(raw) // width))
                at += len(record)
        if out is None:
            return
        # Written aside under a name of its own and moved in one step: a task that runs
        # twice leaves one whole file, and both attempts hold the same bytes. An object
        # store copies instead; there too a file appears whole.
        out.close()
        found = np.array(index, INDEX)
        side = f"{temp}.index"
        with store.open_output_stream(side) as f:
            f.write(found.tobytes())
        for src, end in ((temp, "records"), (side, "index")):
            store.move(src, f"{root}/shard-{shard:06d}.{end}")
        columns = [pa.array([n], pa.int64()) for n in (shard, len(index), int(found["n_tokens"].sum()))]
        yield pa.RecordBatch.from_arrays(columns, ["shard", "n_records", "n_tokens"])

    return write


def write_tokens(
    docs: DataFrame, folder: str, *, tokenizer: str, shards: int | None = None
) -> DataFrame:
    """Write all documents to a new folder; returns ``shard, n_records, n_tokens``.

    Shard numbers follow the document ids. Rows without an id come first; rows
    that share an id lie side by side, in order of a hash of their texts, and may
    fill several shards; null text has only the end id; other columns are not
    written. Without ``shards`` there are as many as make about ``SHARD_BYTES`` of
    text each. ``folder`` must be seen by all executors.
    """
    spark = docs.sparkSession
    store, root = _open(folder)
    store.create_dir(root, recursive=True)
    if shards is None:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(2 * shuffle_partitions(spark), -(-size // SHARD_BYTES))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_of().alias("text"),
        F.xxhash64(text_of()).alias("hash"),
        # Lets equal rows be dealt to several shards.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["doc_id", "hash", "row"]
    dealt = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("doc_id", "text")
    written = dealt.mapInArrow(_writer(folder, tokenizer), _TOTALS)
    # One row per shard. Counted once, so that no later plan writes the files again.
    return spark.createDataFrame(written.collect(), _TOTALS)


READ_BYTES = 8 << 20


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for shard, start in zip(*batch.to_pydict().values(), strict=True):
                name = f"{root}/shard-{shard:06d}"
                with store.open_input_stream(f"{name}.index") as f:
                    index = np.frombuffer(f.read(), INDEX)
                starts = start + np.cumsum(index["n_tokens"], dtype=np.int64) - index["n_tokens"].astype(np.int64)
                # A run of records at a time, so a shard is never held whole.
                blocks = (index["offset"] // READ_BYTES).astype(np.int64)
                cuts = [0, *(np.nonzero(np.diff(blocks))[0] + 1), len(index)]
                with store.open_input_file(f"{name}.records") as f:
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        if a == b:
                            continue
                        part = index[a:b]
                        base = int(part["offset"][0])
                        f.seek(base)
                        data = f.read(int(part["offset"][-1] + part["length"][-1]) - base)
                        payloads = unframe(data, part["offset"] - base, part["length"])
                        yield _decoded(payloads, starts[a:b])

    return read


def _decoded(payloads: list[bytes], starts: np.ndarray) -> pa.RecordBatch:
    ids, tokens = [], []
    for raw in payloads:
        null, doc, width = RECORD_HEAD.unpack_from(raw)
        ids.append(None if null else doc)
        tokens.append(np.frombuffer(raw, f"<u{width}", offset=RECORD_HEAD.size).astype("<u4").tobytes())
    return pa.RecordBatch.from_pydict(
        {"doc_id": pa.array(ids, pa.int64()), "start": pa.array(starts, pa.int64()), "ids": pa.array(tokens, pa.binary())}
    )


def read_tokens(spark: SparkSession, folder: str, totals: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every record; ``ids`` as little-endian 32-bit integers.

    ``start`` is the number of ids in all records before. Every checksum is
    verified. The shards' totals are one row per shard, and only they are
    summed across shards.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    spread = placed.repartition(shuffle_partitions(spark), "shard")
    return spread.mapInArrow(_reader(folder), "doc_id long, start long, ids binary")


def read_record(folder: str, shard: int, position: int) -> tuple[int | None, np.ndarray]:
    """Document id and token ids of one record, found through the index alone."""
    store, root = _open(folder)
    name = f"{root}/shard-{shard:06d}"
    with store.open_input_file(f"{name}.index") as f:
        f.seek(position * INDEX.itemsize)
        entry = np.frombuffer(f.read(INDEX.itemsize), INDEX)
    with store.open_input_file(f"{name}.records") as f:
        f.seek(int(entry["offset"][0]))
        data = f.read(int(entry["length"][0]))
    got = _decoded(unframe(data, np.array([0]), entry["length"]), np.array([0])).to_pydict()
    return got["doc_id"][0], np.frombuffer(got["ids"][0], "<u4")


def token_digests(docs: DataFrame, *, tokenizer: str) -> DataFrame:
    """Write the documents, read the files back: ``doc_id, start, n_tokens, ids_crc32``."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "tokens")
    back = read_tokens(spark, folder, write_tokens(docs, folder, tokenizer=tokenizer))
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return back.select("doc_id", "start", n_tokens, F.crc32("ids").alias("ids_crc32"))
