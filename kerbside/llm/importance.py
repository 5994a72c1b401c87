"""Target-distribution importance resampling over hashed n-grams.

The features of a text are its runs of one to three words; each falls into one
of ``BUCKETS`` buckets by its CRC-32. A bucket's gain is the log of how much
more often the target texts hit it than the documents do. A document weighs the
sum of its features' gains; with Gumbel noise of its own, drawing the highest
scores draws without replacement in proportion to the weights' exponentials.

Within a batch, n-grams are interned in an open-addressed NumPy table. Its keys
are 64-bit xxHashes; what has an equal key is compared byte by byte, so two
n-grams never share a slot. A longer n-gram is the eight bytes of two slots:
that of the n-gram without its last word, and that of this word. A slot stores
bucket and count, so CRCs are found once per distinct n-gram, for longer ones
from those of their parts; occurrences keep slot ids, by which gains are gathered.

Two passes read the texts, and neither shuffles any: the first leaves at most
``BUCKETS`` partial counts per task, the second one row of numbers per document.
The draw sorts these rows and ranks them by their place in the sorted partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import materialize, text_of

BUCKETS = 10_000
MAX_WORDS = 3
PERCENT = 5
MIN_WORDS = 20
SEED = 42
# Bytes of one text, and words of one batch, that are looked at together.
PART_BYTES = 1 << 22
BLOCK_WORDS = 1 << 18

# Lower case; whatever is no letter, digit or byte above ASCII becomes a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32
    for c in range(256)
)


def word_parts(raw: bytes) -> Iterator[list[bytes]]:
    """Words of a text, some megabytes of it at a time."""
    at = 0
    while at < len(raw):
        end = at + PART_BYTES
        if end < len(raw):
            found = raw[at:end].translate(_FOLD).rfind(b" ")
            if found >= 0:
                end = at + found + 1
            else:  # inside a word longer than a part
                while end < len(raw) and _FOLD[raw[end]] != 32:
                    end += 1
        yield raw[at:end].translate(_FOLD).split()
        at = end


# --- the table ---------------------------------------------------------------

_P = [np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
)]


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def hash_records(records: np.ndarray) -> np.ndarray:
    """XXH64 with seed 0 of each eight-byte record."""
    p1, p2, p3, p4, p5 = _P
    h = (p5 + np.uint64(8)) ^ (_turned(records * p2, 31) * p1)
    h = _turned(h, 27) * p1 + p4
    h ^= h >> np.uint64(33)
    h *= p2
    h ^= h >> np.uint64(29)
    h *= p3
    return h ^ (h >> np.uint64(32))


def intern(keys: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each item, and for each slot an item that it stands for, or -1.

    Slots are probed one after another from the key's own. All items step at
    once: those at a free slot claim it, one of them gets it, and who finds an
    equal item there stays.
    """
    size = 1 << max(4, (2 * len(keys)).bit_length())
    owner = np.full(size, -1, np.int32)
    slots = np.empty(len(keys), np.int64)
    left, place = np.arange(len(keys), dtype=np.int32), (keys & np.uint64(size - 1)).astype(np.int64)
    while len(left):
        free = owner[place] < 0
        owner[place[free]] = left[free]
        held = owner[place]
        same = keys[left] == keys[held]
        same[same] = items[left[same]] == items[held[same]]
        slots[left[same]] = place[same]
        left, place = left[~same], (place[~same] + 1) & (size - 1)
    return slots, owner


# --- CRC-32 of joined words --------------------------------------------------

_LENGTHS = 64


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """By length and place of a byte: what the byte becomes after so many zero bytes."""
    step = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    step ^= step[0]
    out = np.empty((_LENGTHS + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for k in range(_LENGTHS):
        out[k + 1] = (out[k] >> np.uint32(8)) ^ step[out[k] & np.uint32(255)]
    return out


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings in a row, from theirs and the second one's length."""
    tables, crc, left = _shifts(), first, length
    while True:
        now = np.minimum(left, _LENGTHS)
        crc = (
            tables[now, 0, crc & np.uint32(255)]
            ^ tables[now, 1, (crc >> np.uint32(8)) & np.uint32(255)]
            ^ tables[now, 2, (crc >> np.uint32(16)) & np.uint32(255)]
            ^ tables[now, 3, crc >> np.uint32(24)]
        )
        left = left - now
        if not left.any():
            return crc ^ second


# --- features ----------------------------------------------------------------


def _gathered(slots: np.ndarray, n_slots: int, owner: np.ndarray, crcs: np.ndarray, buckets: int):
    """Bucket and count of every slot."""
    used = np.nonzero(owner >= 0)[0]
    bucket = np.zeros(n_slots, np.int64)
    bucket[used] = crcs[used] % np.uint32(buckets)
    return bucket, np.bincount(slots, minlength=n_slots)


def features(words: list[bytes], rows: np.ndarray, context: int, max_words: int, buckets: int):
    """Per length of n-gram: (row, slot) of each occurrence, and (bucket, count) of each slot.

    ``rows`` says which text a word is in. N-grams that end in one of the first
    ``context`` words are left out: they were seen with the words before.
    """
    items = np.empty(len(words), object)
    items[:] = words
    keys = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    word, owner = intern(keys, items)
    used = np.nonzero(owner >= 0)[0]
    crc, spaced = np.zeros(len(owner), np.uint32), np.zeros(len(owner), np.uint32)
    length = np.zeros(len(owner), np.int64)
    held = [words[i] for i in owner[used]]
    crc[used] = [zlib.crc32(w) for w in held]
    spaced[used] = [zlib.crc32(w, _SPACE_CRC) for w in held]
    length[used] = [len(w) + 1 for w in held]
    ends, slots, crcs = np.arange(len(words)), word, crc
    new = ends >= context
    yield rows[new], slots[new], *_gathered(slots[new], len(owner), owner, crcs, buckets)
    for n in range(2, max_words + 1):
        inside = (ends + 1 < len(words)) & (rows[np.minimum(ends + 1, len(rows) - 1)] == rows[ends])
        before, ends = slots[inside], ends[inside] + 1
        records = (before.astype(np.uint64) << np.uint64(32)) | word[ends].astype(np.uint64)
        slots, owner = intern(hash_records(records), records)
        used = np.nonzero(owner >= 0)[0]
        first, last = before[owner[used]], word[ends[owner[used]]]
        longer = np.zeros(len(owner), np.uint32)
        longer[used] = joined_crc(crcs[first], spaced[last], length[last])
        crcs, new = longer, ends >= context
        yield rows[ends[new]], slots[new], *_gathered(slots[new], len(owner), owner, crcs, buckets)


_SPACE_CRC = zlib.crc32(b" ")


def _blocks(texts: list[bytes | None], max_words: int) -> Iterator[tuple[list[bytes], np.ndarray, int]]:
    """Words of a batch of texts with the number of their text, some at a time.

    A block that goes on in a text begins with this text's last words, as context.
    """
    words: list[bytes] = []
    rows: list[np.ndarray] = []
    context = 0
    for row, raw in enumerate(texts):
        for part in word_parts(raw or b""):
            for at in range(0, len(part), BLOCK_WORDS):
                some = part[at : at + BLOCK_WORDS]
                words += some
                rows.append(np.full(len(some), row, np.int64))
                if len(words) >= BLOCK_WORDS:
                    every = np.concatenate(rows)
                    yield words, every, context
                    keep = min(max_words - 1, int((every == row).sum()))
                    words = words[len(words) - keep :]
                    rows, context = [np.full(keep, row, np.int64)], keep
    if len(words) > context:
        yield words, np.concatenate(rows), context


def _raw_texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def bucket_counts(docs: DataFrame, *, buckets: int = BUCKETS, max_words: int = MAX_WORDS) -> np.ndarray:
    """How many features of all texts fall into each bucket.

    Each task adds up its own; ``buckets`` sums reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for words, rows, context in _blocks(_raw_texts(batch), max_words):
                for _, _, bucket, found in features(words, rows, context, max_words, buckets):
                    total += np.bincount(bucket, weights=found, minlength=buckets).astype(np.int64)
        hit = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["bucket", "n"])

    parts = docs.select(text_of().alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Gain of each bucket, in thousandths of a natural logarithm, floors going down."""
    n = len(target)
    t, s = target + 1.0, corpus + 1.0
    return np.floor(1000 * np.log(t * float(corpus.sum() + n) / (s * float(target.sum() + n)))).astype(np.int64)


def weigh(
    docs: DataFrame,
    target: DataFrame,
    *,
    keep: tuple[str, ...] = ("doc_id",),
    buckets: int = BUCKETS,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """The columns ``keep`` with ``n_words, n_features, weight`` of every row of ``docs``.

    ``target`` has the texts whose distribution is wanted, in a column ``text``.
    Null text has no words; a text without words weighs 0.
    """
    gain = gains(
        bucket_counts(target, buckets=buckets, max_words=max_words),
        bucket_counts(docs, buckets=buckets, max_words=max_words),
    )
    numbers = ["n_words", "n_features", "weight"]
    kept = [F.col(c).alias(f"keep__{i}") for i, c in enumerate(keep)]
    rows = docs.select(*kept, text_of().alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            sizes, weight = np.zeros((max_words, n), np.int64), np.zeros(n, np.int64)
            for words, owners, context in _blocks(_raw_texts(batch), max_words):
                found = features(words, owners, context, max_words, buckets)
                for k, (row, slots, bucket, _) in enumerate(found):
                    sizes[k] += np.bincount(row, minlength=n)
                    of_slot = gain[bucket]
                    weight += np.bincount(row, weights=of_slot[slots], minlength=n).astype(np.int64)
            out = [batch.column(i) for i in range(len(keep))]
            out += [pa.array(a) for a in (sizes[0], sizes.sum(axis=0), weight)]
            yield pa.RecordBatch.from_arrays(out, [*batch.schema.names[: len(keep)], *numbers])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]
    made = rows.mapInArrow(score, ", ".join([*kinds, *[f"{c} long" for c in numbers]]))
    return made.select(*[F.col(f"keep__{i}").alias(c) for i, c in enumerate(keep)], *numbers)


def noise(doc_id: str = "doc_id", seed: int = SEED):
    """Gumbel noise in thousandths, from a hash of the seed and the id (null: empty)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(
    weighed: DataFrame, *, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """``weighed`` with ``score`` and ``rank``, the place among the drawn rows from 1, else null.

    Of the rows with at least ``min_words`` words, ``percent`` in a hundred are
    drawn, rounded down: the highest scores, ties to the smaller ``doc_id`` (rows
    without an id last; of equal rows that tie, any). The sort leaves ranges of
    scores in partitions; a row's rank is the size of all partitions before and
    its place in its own. One count per partition reaches the driver.
    """
    spark = weighed.sparkSession
    scored = weighed.withColumn("score", F.col("weight") + noise(seed=seed))
    scored = materialize(scored, "importance-scores")
    can = F.col("n_words") >= min_words
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.xxhash64(*weighed.columns)]
    placed = scored.where(can).orderBy(*order).withColumn("draw__at", F.monotonically_increasing_id())
    placed = materialize(placed, "importance-order")
    part = F.shiftright("draw__at", 33)
    sizes = sorted(map(tuple, placed.groupBy(part).count().collect()))
    total, before = 0, []
    for number, n in sizes:
        before.append((number, total))
        total += n
    want = total * percent // 100
    offsets = spark.createDataFrame(before, "draw__part long, draw__before long")
    offsets = offsets.where(F.col("draw__before") < want)
    placed = placed.withColumn("draw__part", part).join(offsets, "draw__part", "left")
    rank = F.col("draw__before") + F.col("draw__at").bitwiseAND((1 << 33) - 1) + 1
    placed = placed.withColumn("rank", F.when(rank <= want, rank))
    others = scored.where(~can).withColumn("rank", F.lit(None).cast("long"))
    columns = [*weighed.columns, "score", "rank"]
    return placed.select(*columns).unionByName(others.select(*columns))


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, all their columns; ``options`` are those of :func:`draw`.

    Other columns may have any name: they travel under names of their own. Rows
    with an equal id share their noise and are drawn each by its own weight.
    """
    named = docs.select("doc_id", F.struct("*").alias("draw__row"), text_of().alias("text"))
    weighed = weigh(named, target, keep=("doc_id", "draw__row"))
    drawn = draw(weighed, **options).where(F.col("rank").isNotNull())
    return drawn.select("draw__row.*")


def resampling_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``."""
    return draw(weigh(docs, target))
