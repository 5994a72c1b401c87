"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a word start is a cut where the
hash of the bytes before it is the least among the word starts around it. Cuts
depend on nearby bytes alone, not on earlier cuts, so a passage is cut alike
wherever it stands, and an insertion moves only the cuts beside it. Chunks are compared by a 128-bit digest. The first chunk
with a digest, by document and place, stays; later ones form runs. A run is
extended by the words beside it that also stand beside the first occurrence,
and goes from its text if it is long enough.

Chunks, not pairs, are shuffled. First, half a digest of every chunk is counted;
those that stand more than once are marked in a bitmap of fixed size. It
never misses one, so a full bitmap costs work, not results. What it lets pass is
written with the hashed words beside it: one aggregation finds the first
place of each repeated digest, one join brings it back. Hot digests are
combined before the shuffle and split as a skewed join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import has_mark, is_marked, marked, materialize, text_of

# A cut is the least of this many word starts on either side, so chunks have more words
# than this, and 2 * REACH + 1 on average. Where no cut comes, as among equal words,
# one is made after MAX_WORDS.
REACH = 5
MAX_WORDS = 32
# Words that a run of repeated chunks must have, with those beside it, to be removed. A
# repeated passage of over 50 words has as many, but for rare cases; the words of a chunk
# that the passage shares with no other are found only up to the next cut of either text.
RUN_WORDS = 40
# Most bits of the bitmaps of repeated digests and of rows that change: 16 MB.
MAP_BITS = 27
# Bytes that a gear hash looks back on.
WINDOW = 16
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _gear() -> np.ndarray:
    """256 fixed pseudo-random values, the hashes of the byte values."""
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 11) for b in range(256)], np.uint32)


_GEAR = _gear()


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: sum of the last 16 gears, each shifted by twice its age.

    The sum over 16 bytes is built by doubling its window four times.
    """
    h = _GEAR[raw]
    for k in (1, 2, 4, 8):
        later = h.copy()
        later[k:] += h[:-k] << np.uint32(2 * k)
        h = later
    return h


def chunk_bounds(raw: bytes) -> tuple[list[int], list[int]]:
    """Byte positions where chunks start (and the end), and the words in each chunk.

    A text is one chunk where it has no word.
    """
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    word = ~space
    word[1:] &= space[:-1]
    starts = np.nonzero(word)[0]
    n = len(starts)
    if not n:
        return [0, len(raw)], [0]
    h = gear_hashes(data)[starts - 1].astype(np.int64)  # the first word has no say below
    high = np.full(REACH, 1 << 40)
    around = np.concatenate([high, [1 << 40], h[1:], high])
    least = np.ones(n, bool)
    for k in range(1, REACH + 1):
        least &= around[REACH : REACH + n] < around[REACH - k : REACH - k + n]
        least &= around[REACH : REACH + n] <= around[REACH + k : REACH + k + n]
    least[: REACH + 1] = False
    cuts = np.nonzero(least)[0]
    edges = np.concatenate([[0], cuts, [n]])
    if np.diff(edges).max() > MAX_WORDS:
        steps = [np.arange(a, b, MAX_WORDS) for a, b in zip(edges, edges[1:], strict=False)]
        cuts = np.concatenate(steps)[1:]
    bounds = [0, *starts[cuts].tolist(), len(raw)]
    return bounds, np.diff(np.concatenate([[0], cuts, [n]])).tolist()


def _digest(part: bytes) -> bytes:
    """Digest of a chunk, white space at its end left out."""
    return xxhash.xxh3_128_digest(part.rstrip(b" \t\n\r\v\f"))


def chunk_digests(raw: bytes) -> tuple[np.ndarray, list[bytes], list[int]]:
    """Digests of the chunks as two signed halves, the chunks, and their words."""
    edges, counts = chunk_bounds(raw)
    parts = [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return np.frombuffer(b"".join(map(_digest, parts)), ">i8").reshape(-1, 2), parts, counts


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _halves():
    @F.pandas_udf("array<long>")
    def halves(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            found, _, counts = chunk_digests(_raw(text))
            out.append(found[np.array(counts) > 0, 0].astype(np.int64))
        return pd.Series(out)

    return halves


def _hashed_words(part: bytes) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(w) for w in part.split()], np.uint32)


def _repeated(bitmap, map_bits: int):
    """Chunks that the bitmap lets pass, with the hashed words of the chunks beside them."""
    kind = "array<struct<place:int, hi:long, lo:long, words:int, left:binary, right:binary>>"

    @F.pandas_udf(kind)
    def repeated(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            found, parts, counts = chunk_digests(_raw(text))
            known = has_mark(found[:, 0], bitmap, map_bits)
            words: dict[int, bytes] = {}

            def beside(k: int, parts=parts, words=words) -> bytes:
                if not 0 <= k < len(parts):
                    return b""
                if k not in words:
                    words[k] = _hashed_words(parts[k]).tobytes()
                return words[k]

            places = [k for k in np.flatnonzero(known).tolist() if counts[k]]
            out.append([
                {"place": k, "hi": int(found[k, 0]), "lo": int(found[k, 1]), "words": counts[k],
                 "left": beside(k - 1), "right": beside(k + 1)}
                for k in places
            ])
        return pd.Series(out)

    return repeated


def _row_key() -> Column:
    """What stands for a row: rows that are equal in id and text are one document."""
    return F.xxhash64("doc_id", text_of())


def repeated_runs(docs: DataFrame, *, run_words: int = RUN_WORDS) -> DataFrame:
    """``row`` and ``spans``: what to remove from the rows that :func:`_row_key` gives.

    A span is four numbers: first chunk, one past the last, and the words to
    remove before and after them. A chunk is repeated if an equal one stands
    earlier: in a row with a smaller id (rows that share an id in order of a hash
    of their texts, rows without an id after all others), or before it in its own.
    """
    text = text_of()
    half = docs.select(F.explode(_halves()(text)).alias("hi"))
    often = half.groupBy("hi").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hi")
    often = materialize(often, "chunks-often")
    bitmap, map_bits = marked(often, "hi", MAP_BITS)
    made = docs.select("doc_id", _row_key().alias("row"), F.explode(_repeated(bitmap, map_bits)(text)).alias("c"))
    chunks = materialize(made.select("doc_id", "row", "c.*"), "chunks-repeated")
    spot = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "place")
    whole = F.struct(spot.alias("spot"), F.col("left").alias("l"), F.col("right").alias("r"))
    first = chunks.groupBy("hi", "lo").agg(F.min(whole).alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.where("n > 1").select("hi", "lo", "first"), "chunks-first")
    later = chunks.join(first, ["hi", "lo"]).where(~spot.eqNullSafe(F.col("first.spot")))
    entry = F.struct("place", "words", "left", "right", F.col("first.l").alias("l"), F.col("first.r").alias("r"))
    found = later.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("found"))
    return found.select("row", _runs(run_words)("found").alias("spans")).where("size(spans) > 0")


def _shared(own: bytes, other: bytes, at_end: bool) -> int:
    """How many hashed words two chunks share at their ends (or starts)."""
    a, b = np.frombuffer(own, np.uint32), np.frombuffer(other, np.uint32)
    n = min(len(a), len(b))
    same = a[len(a) - n :][::-1] == b[len(b) - n :][::-1] if at_end else a[:n] == b[:n]
    return n if same.all() else int(np.argmin(same))


def runs_of(found: list[dict], run_words: int) -> list[int]:
    """Spans of one row from its repeated chunks, in order of their places."""
    spans, run = [], []

    def close() -> None:
        if not run:
            return
        before = _shared(run[0]["left"], run[0]["l"], True)
        after = _shared(run[-1]["right"], run[-1]["r"], False)
        if spans and spans[-3] == run[0]["place"] - 1:
            # One chunk lies between two runs: its words go to the first one's end, then here.
            before = min(before, len(run[0]["left"]) // 4 - spans[-1])
        if before + after + sum(c["words"] for c in run) >= run_words:
            spans.extend([run[0]["place"], run[-1]["place"] + 1, before, after])

    for chunk in found:
        if run and chunk["place"] == run[-1]["place"]:
            continue
        if run and chunk["place"] != run[-1]["place"] + 1:
            close()
            run = []
        run.append(chunk)
    close()
    return spans


def _runs(run_words: int):
    @F.pandas_udf("array<int>")
    def runs(found: pd.Series) -> pd.Series:
        return pd.Series([runs_of(chunks, run_words) for chunks in found])

    return runs


def without_spans(raw: bytes, spans: list[int]) -> bytes:
    """The text without its spans."""
    edges, _ = chunk_bounds(raw)
    data = np.frombuffer(raw, np.uint8)
    word = ~_SPACE[data]
    word[1:] &= _SPACE[data][:-1]
    starts = np.append(np.flatnonzero(word), len(raw))
    kept, at = [], 0
    for first, end, before, after in zip(*[iter(spans)] * 4, strict=True):
        a, b = edges[first], edges[end]
        if before:
            a = int(starts[np.searchsorted(starts, a) - before])
        if after:
            b = int(starts[np.searchsorted(starts, b) + after])
        kept.append(raw[at:a])
        at = b
    kept.append(raw[at:])
    return b"".join(kept)


def _cut():
    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, spans, strict=True):
            if gone is None or not len(gone):
                out.append(text)
            else:
                out.append(without_spans(_raw(text), list(gone)).decode("utf-8", "surrogatepass"))
        return pd.Series(out, dtype=object)

    return cut


def remove_repeats(docs: DataFrame, *, run_words: int = RUN_WORDS) -> DataFrame:
    """All rows and columns of ``docs``, with repeated passages cut from ``text``.

    No row is dropped: a text that is repeated as a whole becomes empty. Texts
    without a repeated passage are unchanged, null stays null; ``n_chars``, where
    it is a column, is that of the new text in changed rows. Every row is judged by
    its own text: rows that share an id (or have none) may be repeats of one
    another, the later by a hash of the text being cut. Rows equal in id and text
    are one document and are treated alike. Only rows without an id, which come
    last, or with the same one could be confused by a collision of 64-bit hashes.
    """
    spans = repeated_runs(docs, run_words=run_words)
    spans = spans.select(F.col("row").alias("chunks__row"), F.col("spans").alias("chunks__spans"))
    spans = materialize(spans, "chunks-spans")
    # Rows without spans, but for a few that the bitmap lets pass, are not shuffled.
    bitmap, map_bits = marked(spans, "chunks__row", MAP_BITS)
    rows = docs.select("*", _row_key().alias("chunks__row"))
    may_have = is_marked(bitmap, map_bits)(F.col("chunks__row"))
    others = rows.where(~may_have).withColumn("chunks__spans", F.lit(None).cast("array<int>"))
    rows = rows.where(may_have).join(spans, "chunks__row", "left").unionByName(others)
    changed = F.col("chunks__spans").isNotNull()
    # Only texts that change travel through Python.
    new = _cut()(F.when(changed, text_of()), F.col("chunks__spans"))
    rows = rows.withColumn("text", F.when(changed, new).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(changed, size).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def repeat_report(docs: DataFrame, *, run_words: int = RUN_WORDS) -> DataFrame:
    """Per document: ``doc_id, n_chars`` before, ``n_kept`` after, and the kept text's digest.

    ``removed_chars`` is their difference and ``changed`` tells whether any was cut.
    """
    own = docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("before"), text_of().alias("text"))
    after = remove_repeats(own, run_words=run_words)
    kept = F.char_length("text").cast("long")
    return after.select(
        "doc_id",
        F.col("before").alias("n_chars"),
        kept.alias("n_kept"),
        (F.col("before") - kept).alias("removed_chars"),
        (F.col("before") != kept).alias("changed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )
