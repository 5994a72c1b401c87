"""Phrase collocation mining: frequent phrases whose parts stand together oftener than chance.

Texts are split into pieces at punctuation and line ends; a phrase lies inside a
piece. Everything is counted per language.

1. Texts become blocks of word numbers, each with a word list of its own, and
   the lists are added up to the counts of all words. Words with at least
   ``min_count`` occurrences get ids; a block gets those of its own words by a
   join, so no task holds the vocabulary of the corpus.
2. A phrase cannot be more frequent than its parts. Pairs of frequent words are
   counted first; longer phrases only where all their pairs are frequent, as far
   as a bitmap of fixed size tells. It never misses one, so the counts of all
   frequent phrases are exact and a full bitmap costs work, not results.
3. A task's n-grams are counted in counting quotient filters, one per shard
   (:mod:`kerbside.llm.counting_filter`). The shuffle carries these; a shard's
   filters are merged, and its phrases with ``min_count`` are kept.

Scores, cuts and the dropping of parts of longer phrases are joins and
aggregations over the frequent phrases.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm import counting_filter as cf
from kerbside.llm.common import bitmap_of, materialize, shuffle_partitions, text_of

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
# A phrase is dropped if a longer one around it has this many per cent of its count.
COVER = 100
NO_LANG = "und"
# Tokens of a block, and distinct n-grams that a task holds before it hands them on.
BLOCK_TOKENS = 1 << 21
HELD = 1 << 21
# N-grams of all tasks that one shard is meant for.
SHARD_ENTRIES = 1 << 23
# Most bits of the bitmap of frequent pairs: 16 MB.
MAP_BITS = 27
PART_BYTES = 1 << 22

_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9
)
_BREAK = b"."


# --- blocks ------------------------------------------------------------------


def token_parts(raw: bytes) -> Iterator[list[bytes]]:
    """Words and breaks of a text, some megabytes of it at a time."""
    at = 0
    while at < len(raw):
        part = raw[at : at + PART_BYTES].translate(_FOLD)
        end = at + len(part)
        if end < len(raw):
            found = max(part.rfind(c) for c in (b" ", b"\t", _BREAK))
            if found >= 0:
                part, end = part[: found + 1], at + found + 1
            else:  # inside a word longer than a part
                while end < len(raw) and _FOLD[raw[end]] not in b" \t.":
                    end += 1
                part = raw[at:end].translate(_FOLD)
        yield part.replace(_BREAK, b" . ").split()
        at = end


class Block:
    """Tokens of texts of one language as numbers into a list of words; 0 is a break."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[_BREAK]
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, tokens: list[bytes]) -> None:
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
        self.parts.append(ids)
        self.size += len(ids)

    def taken(self, whole: bool) -> tuple[np.ndarray, list[bytes], np.ndarray] | None:
        """Tokens, words and counts up to the last break (or all); the rest stays."""
        if not self.size:
            return None
        ids, words = np.concatenate(self.parts), list(self.numbers)
        end = len(ids) if whole else len(ids) - int(np.argmax(ids[::-1] == 0))
        if not whole and not (ids == 0).any():
            return None
        rest = [words[i] for i in ids[end:]]
        counts = np.bincount(ids[:end], minlength=len(words))
        self.clear()
        if rest:
            self.add(rest)
        return ids[:end], words, counts


_BLOCKS = "block long, lang string, n_words long, tokens binary, words array<string>, counts array<long>"


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block; a task's blocks are numbered after its partition."""
    number = TaskContext.get().partitionId() << 32
    held: defaultdict[str, Block] = defaultdict(Block)

    def row(lang: str, block: Block, whole: bool) -> Iterator[pa.RecordBatch]:
        nonlocal number
        if (found := block.taken(whole)) is None:
            return
        ids, words, counts = found
        columns = [
            pa.array([number], pa.int64()),
            pa.array([lang], pa.string()),
            pa.array([int((ids > 0).sum())], pa.int64()),
            pa.array([ids.tobytes()], pa.binary()),
            pa.array([[w.decode() for w in words[1:]]], pa.list_(pa.string())),
            pa.array([counts[1:]], pa.list_(pa.int64())),
        ]
        number += 1
        yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _BLOCKS.split(", ")])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for lang, raw in zip(langs, texts, strict=True):
            block = held[lang]
            for tokens in token_parts(raw):
                block.add(tokens)
                if block.size >= BLOCK_TOKENS:
                    yield from row(lang, block, False)
            block.add([_BREAK])
        if sum(block.size for block in held.values()) >= BLOCK_TOKENS:
            for lang in list(held):
                yield from row(lang, held.pop(lang), True)
    for lang, block in held.items():
        yield from row(lang, block, True)


_WORDS = "part int, number long, lang string, word string, f long, block long, place int"


def _number_words(min_count: int):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order of their word: the frequent words of this task are numbered, others get -1.

        Only a word's first row spells it.
        """
        part, last, count = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, bool)
            for column in (batch.column("lang"), batch.column("word")):
                new[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            ends = [(batch.column("lang")[k].as_py(), batch.column("word")[k].as_py()) for k in (0, n - 1)]
            new[0] = ends[0] != last
            often = batch.column("f").to_numpy() >= min_count
            new &= often
            numbers = count - 1 + np.cumsum(new)
            last, count = ends[1], int(numbers[-1]) + 1
            word = pc.if_else(pa.array(new), batch.column("word"), None)
            columns = [pa.array(np.full(n, part, np.int32)), pa.array(np.where(often, numbers, -1)), batch.column("lang"), word]
            columns += [batch.column(c) for c in ("f", "block", "place")]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _WORDS.split(", ")])

    return number


# --- counting ----------------------------------------------------------------


class Filters:
    """A task's n-grams by length, counted before they are handed on as filters."""

    def __init__(self, width: int, shard_bits: int):
        self.width, self.shard_bits = width, shard_bits
        self.held: dict[int, list] = {}
        self.size = 0

    def add(self, ids: cf.Limbs) -> None:
        if len(ids[0]):
            entry = cf.counted(cf.pack(ids, self.width))
            self.held.setdefault(len(ids), []).append(entry)
            self.size += len(entry[1])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for n, entries in self.held.items():
            limbs, counts = cf.merged(entries) if len(entries) > 1 else entries[0]
            for shard, body in cf.to_filters(limbs, counts, self.width, self.shard_bits):
                yield _row(n, shard, body)
        self.held, self.size = {}, 0


_FILTERS = "n int, shard long, body binary"


def _row(n: int, shard: int, body: bytes) -> pa.RecordBatch:
    columns = [pa.array([n], pa.int32()), pa.array([shard], pa.int64()), pa.array([body], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _FILTERS.split(", ")])


def _pairs(width: int, shard_bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with n = 0 hold the block in ids, rows with n = 2 filters of pairs."""
        filters = Filters(width, shard_bits)
        for batch in batches:
            for row in batch.to_pylist():
                local = np.frombuffer(row["tokens"], np.int32)
                found = np.array(row["ids"], np.int64)
                to = np.zeros(int(local.max(initial=0)) + 1, np.uint32)
                to[found >> 32] = (found & 0xFFFFFFFF) + 1
                ids = to[local]
                yield _row(0, row["block"], ids.tobytes())
                at = np.nonzero((ids[:-1] > 0) & (ids[1:] > 0))[0]
                wide = ids.astype(np.uint64)
                filters.add([wide[at], wide[at + 1]])
                if filters.size >= HELD:
                    yield from filters.rows()
        yield from filters.rows()

    return count


def _longer(width: int, shard_bits: int, max_words: int, bitmap, map_bits: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        filters = Filters(width, shard_bits)
        for batch in batches:
            for body in batch.column("body").to_pylist():
                ids = np.frombuffer(body, np.uint32).astype(np.uint64)
                at = np.nonzero((ids[:-1] > 0) & (ids[1:] > 0))[0]
                mark = cf.pack([ids[at], ids[at + 1]], width)[0] >> np.uint64(2 * width - map_bits)
                known = (bits[(mark >> np.uint64(3)).astype(np.int64)] >> (mark & np.uint64(7)).astype(np.uint8)) & 1
                good = np.zeros(len(ids) + 1, bool)
                good[at[known > 0]] = True
                at = np.nonzero(good)[0]
                for n in range(3, max_words + 1):
                    at = at[at + n - 1 < len(ids)]
                    at = at[good[at + n - 2]]
                    filters.add([ids[at + k] for k in range(n)])
                if filters.size >= HELD:
                    yield from filters.rows()
        yield from filters.rows()

    return count


def _merge(width: int, shard_bits: int, min_count: int):
    def merge(rows: pa.Table) -> pa.Table:
        n, shard = rows["n"][0].as_py(), rows["shard"][0].as_py()
        bodies = (body.as_py() for body in rows["body"])
        limbs, counts = cf.merged([cf.from_filter(b, shard, width, shard_bits) for b in bodies])
        often = counts >= min_count
        limbs = [limb[often] for limb in limbs]
        ids = np.stack(cf.unpack(limbs, n, width), axis=1).astype(np.int64)
        ends = pa.array(np.arange(0, ids.size + 1, n), pa.int32())
        key = pa.ListArray.from_arrays(ends, pa.array(ids.ravel()))
        columns = [key, pa.array(counts[often]), pa.array(limbs[0].view(np.int64))]
        return pa.table(columns, ["key", "f", "limb"])

    return merge


_FOUND = "key array<long>, f long, limb long"


def phrase_counts(
    docs: DataFrame, *, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words ``id, lang, word, f``; frequent phrases ``key, f`` (ids, words too); words per ``lang``.

    Null text is empty, null language is ``NO_LANG``; every row counts, equal
    rows as often as they stand there. Other columns are ignored.
    """
    spark = docs.sparkSession
    lang = F.coalesce("lang", F.lit(NO_LANG)).alias("lang")
    blocks = docs.select(lang, text_of().alias("text")).mapInArrow(_to_blocks, _BLOCKS)
    blocks = materialize(blocks, "phrases-blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    own = blocks.select(
        "block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")
    ).select("block", "lang", (F.col("place") + 1).alias("place"), F.col("entry.words").alias("word"), "entry.counts")
    # One shuffle both counts a word and gives its rows, one per block, the word's number.
    f = F.sum("counts").over(Window.partitionBy("lang", "word"))
    often = own.withColumn("f", f).select("lang", "word", "f", "block", "place")
    often = often.mapInArrow(_number_words(min_count), _WORDS).where("number >= 0")
    often = materialize(often, "phrases-words")
    numbered = dict(map(tuple, often.groupBy("part").agg(F.max("number") + 1).collect()))
    before = np.cumsum([0, *(numbered.get(part, 0) for part in range(max(numbered, default=0) + 1))]).tolist()
    n_words = before[-1]
    often = often.withColumn("id", F.get(F.lit(before), F.col("part")) + F.col("number"))
    words = often.where("word is not null").select("lang", "word", "f", (F.col("id") + 1).alias("id"))
    words = materialize(words, "phrases-ids")
    entry = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("id"))
    known = often.groupBy("block").agg(F.collect_list(entry).alias("ids"))

    width = max(2, n_words.bit_length())
    if width > 32:
        raise ValueError(f"{n_words} frequent words; ids have 32 bits")
    n_tokens = blocks.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    shards = max(2 * shuffle_partitions(spark), n_tokens // SHARD_ENTRIES)
    shard_bits = min((shards - 1).bit_length(), 2 * width)
    coded = blocks.select("block", "tokens").join(known, "block").select("block", "tokens", "ids")
    coded = coded.mapInArrow(_pairs(width, shard_bits), _FILTERS)
    coded = materialize(coded, "phrases-coded", partition_by=("n",))

    def merged(filters: DataFrame, name: str) -> DataFrame:
        made = filters.groupBy("n", "shard").applyInArrow(_merge(width, shard_bits, min_count), _FOUND)
        return materialize(made, name)

    pairs = merged(coded.where("n = 2"), "phrases-pairs")
    found = words.select(F.array("id").alias("key"), "f").unionByName(pairs.select("key", "f"))
    n_pairs = pairs.count()
    if n_pairs and max_words > 2:
        map_bits = min(max(15, (64 * n_pairs).bit_length()), MAP_BITS, 2 * width)
        mark = F.shiftrightunsigned("limb", 2 * width - map_bits).alias("mark")
        bitmap = spark.sparkContext.broadcast(bitmap_of(pairs.select(mark), map_bits))
        more = coded.where("n = 0").select("body")
        more = more.mapInArrow(_longer(width, shard_bits, max_words, bitmap, map_bits), _FILTERS)
        found = found.unionByName(merged(more, "phrases-longer").select("key", "f"))
    return words, found, totals


# --- phrases -----------------------------------------------------------------


def _with_words(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """``phrases`` with a column ``phrase``, the words of ``key`` joined by spaces."""
    each = phrases.select("key", F.posexplode("key").alias("place", "id"))
    each = each.join(words.select("id", "word"), "id").groupBy("key")
    spelled = each.agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w"))
    spelled = spelled.select("key", F.concat_ws(" ", "w.word").alias("phrase"))
    return phrases.join(spelled, "key")


def collocations(
    docs: DataFrame,
    *,
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    cover: int = COVER,
) -> DataFrame:
    """The first ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase of 2 to ``max_words`` words with a >= ``min_count`` occurrences is
    cut where it scores least (ties: the first cut) into parts with l and r; its
    score is floor(1000 a n / (l r)) in exact decimals. It is dropped if its words
    stand inside a longer frequent phrase with ``cover`` per cent of its count. Order: score, a (both descending), phrase by its UTF-8 bytes.
    """
    words, found, totals = phrase_counts(docs, min_count=min_count, max_words=max_words)
    found = materialize(found, "phrases-found")
    long = found.where(F.size("key") > 1)

    inside = long.where(F.size("key") > 2).select(
        F.col("f").alias("longer"), F.size("key").alias("m"), "key"
    )
    spans = F.expr(
        "flatten(transform(sequence(2, m - 1), w -> transform(sequence(1, m - w + 1), i -> slice(key, i, w))))"
    )
    inside = inside.select(F.explode(spans).alias("key"), "longer")
    inside = inside.groupBy("key").agg(F.max("longer").alias("longer"))
    kept = long.join(inside, "key", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("f"))
    )
    kept = kept.select("key", F.col("f").alias("a"))

    cut = F.explode(F.sequence(F.lit(1), F.size("key") - 1)).alias("k")
    cuts = kept.select("key", "a", cut)
    left, right = F.expr("slice(key, 1, k)"), F.expr("slice(key, k + 1, size(key) - k)")
    cuts = cuts.withColumn("left", left).withColumn("right", right)
    cuts = cuts.join(found.select(F.col("key").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(found.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    of_lang = words.select(F.col("id").alias("first"), "lang").join(totals, "lang")
    cuts = cuts.withColumn("first", F.col("key")[0]).join(of_lang, "first")
    wide = "cast({} as decimal(19, 0))".format
    score = F.expr(f"1000 * ({wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "key", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "key", "a", "cut.l", "cut.r", "n", "cut.score")

    by_score = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    first = best.withColumn("tied", F.rank().over(by_score)).where(F.col("tied") <= top)
    first = _with_words(materialize(first.drop("tied"), "phrases-first"), words)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = first.withColumn("rank", F.row_number().over(order).cast("long"))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
