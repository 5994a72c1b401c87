"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often they occur. For every
sample k a term with weight S draws, from hashes of the term and k alone,
r and c from Gamma(2, 1) and b from the uniform distribution, and sets

    t = floor(ln S / r + b)        ln a = ln c - r (t - b + 1)

The term with the least a, together with its t, is the sample. Two texts have
the same sample with a probability equal to the generalised Jaccard similarity
of their weights, sum of minima over sum of maxima (Ioffe, 2010).

Terms are counted inside their row (sort, then run lengths), so no term is
ever shuffled; what is shuffled once is the text, to put each document beside
its neighbour.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import id_splits, materialize, range_of, shuffle_partitions, text_of, words

SAMPLES = 32
NO_SAMPLE = 0


def sorted_terms(text: Column) -> Column:
    """64-bit hashes of all words, sorted."""
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.sort_array(hashes)


def _runs(ordered: Column) -> Column:
    """Start of each run of equal values in a sorted array, and one past its end."""
    n = F.size(ordered)
    inner = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
    )
    return F.when(n > 0, inner).otherwise(F.array().cast("array<int>"))


def _weighted(ordered: Column, starts: Column) -> Column:
    ends = F.size(ordered) + 1
    return F.transform(
        starts,
        lambda s, j: F.struct(
            F.get(ordered, s - 1).alias("term"),
            (F.coalesce(F.get(starts, j + 1), ends) - s).alias("weight"),
        ),
    )


def _part(bits: Column, shift: int, width: int) -> Column:
    """``width`` bits of a hash as a number strictly between 0 and 1."""
    mask = (1 << width) - 1
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit(mask)) + 0.5) / float(1 << width)


def _sample(k: int) -> tuple[Column, Column]:
    """Key that is least for the chosen term, and the value that the sample takes."""
    first = F.xxhash64("term", F.lit(2 * k))
    second = F.xxhash64("term", F.lit(2 * k + 1))
    r = -F.ln(_part(first, 0, 32) * _part(first, 32, 32))
    c = -F.ln(_part(second, 0, 21) * _part(second, 21, 21))
    b = _part(second, 42, 22)
    t = F.floor(F.col("log_weight") / r + b)
    return F.ln(c) - r * (t - b + 1.0), F.xxhash64("term", t)


def _terms(texts: DataFrame, keys: list[str]) -> DataFrame:
    """One row per distinct word of a text, with the logarithm of its count; one of nulls without any."""
    ordered = texts.select(*keys, sorted_terms(F.col("text")).alias("ordered"))
    starts = ordered.select(*keys, "ordered", _runs(F.col("ordered")).alias("starts"))
    terms = starts.select(*keys, F.inline_outer(_weighted(F.col("ordered"), F.col("starts"))))
    return terms.select(*keys, "term", F.ln("weight").alias("log_weight"))


def _drawn(terms: DataFrame, keys: list[str], samples: int) -> DataFrame:
    drawn = [_sample(k) for k in range(samples)]
    best = terms.groupBy(*keys).agg(
        *[F.min_by(value, key).alias(f"s{k}") for k, (key, value) in enumerate(drawn)]
    )
    found = [F.coalesce(f"s{k}", F.lit(NO_SAMPLE).cast("long")) for k in range(samples)]
    return best.select(*keys, F.array(*found).alias("signature"))


def signatures(texts: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``signature``: one array of samples per row with a word in ``text``.

    ``keys`` must tell the rows apart. Rows without a word are left out.
    """
    return _drawn(_terms(texts, keys).where("term is not null"), keys, samples)


def fingerprint_text(signature: Column) -> Column:
    """Eight hexadecimal digits per sample."""
    low = F.lit(0xFFFFFFFF)
    digits = F.transform(
        signature, lambda s: F.lower(F.lpad(F.hex(s.bitwiseAND(low)), 8, "0"))
    )
    return F.array_join(digits, "")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples, the estimate of generalised Jaccard similarity."""
    same = sum(
        ((F.get(a, k) == F.get(b, k)).cast("int") for k in range(samples)), start=F.lit(0)
    )
    return same / float(samples)


def with_next(docs: DataFrame, ranges: int) -> DataFrame:
    """Each document with the text of the next one, by descending id, in a ring.

    Ids are cut into ranges; a range is ordered in one task, and its last row
    takes the first row of the next range that has any. Adds ``block, place``
    (of the row) and ``next_block, next_place``.
    """
    splits = id_splits(docs, "doc_id", ranges)
    rows = docs.select("doc_id", text_of().alias("text")).withColumn(
        "block", range_of(F.col("doc_id"), splits)
    )
    found = rows.groupBy("block").agg(F.max("doc_id").alias("head")).collect()
    heads = {r.block: r.head for r in found}  # no more rows than ranges
    if not heads:
        empty = rows.withColumn("place", F.lit(1)).withColumn("next_text", F.col("text"))
        return empty.withColumn("next_block", F.col("block")).withColumn("next_place", F.lit(1))
    order = sorted(heads)
    follows = {b: order[bisect.bisect_left(order, b) - 1] for b in order}
    pairs = F.inline(
        F.array(*[
            F.struct(F.lit(b).alias("block"), F.lit(n).alias("next_block"))
            for b, n in follows.items()
        ])
    )
    ids = [h for h in heads.values() if h is not None]
    is_head = F.col("doc_id").isin(ids) | F.col("doc_id").isNull()
    firsts = rows.where(is_head).groupBy("block").agg(F.min("text").alias("head_text"))
    firsts = firsts.withColumnRenamed("block", "next_block")
    links = docs.sparkSession.range(1).select(pairs).join(firsts, "next_block")

    inside = Window.partitionBy("block").orderBy(F.col("doc_id").desc(), "text")
    ranked = rows.select(
        "*",
        F.row_number().over(inside).alias("place"),
        F.lead("text").over(inside).alias("lead_text"),
    )
    joined = ranked.join(links, "block")
    last = F.col("lead_text").isNull()
    return joined.select(
        "doc_id", "text", "block", "place",
        F.coalesce("lead_text", "head_text").alias("next_text"),
        F.when(last, F.col("next_block")).otherwise(F.col("block")).alias("next_block"),
        F.when(last, 1).otherwise(F.col("place") + 1).alias("next_place"),
    )


def edited_text() -> Column:
    """The text with its last half replaced by as much of the next text's start."""
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.char_length("text") - half)
    return F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half))


def fingerprint_documents(
    docs: DataFrame, *, samples: int = SAMPLES, ranges: int | None = None
) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, one row per input row. Null text is empty; a text
    without words has the all-zero fingerprint, and two such are alike; rows
    that share an id follow each other by text; rows without an id come last;
    other columns are ignored.
    """
    spark = docs.sparkSession
    rows = with_next(docs, ranges or 4 * shuffle_partitions(spark))
    edited = rows.withColumn("edited", edited_text())
    both = F.inline(
        F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text").alias("text")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")),
        )
    )
    # Everything about a row is taken from its text in one pass, so texts are shuffled once.
    facts = ["block", "place", "doc_id", "next_block", "next_place", "n_chars", "sha256"]
    texts = edited.withColumns(
        {
            "n_chars": F.char_length("text").cast("long"),
            "sha256": F.unhex(F.sha2(F.col("edited").cast("binary"), 256)),
        }
    ).select(*facts, both)
    found = _drawn(_terms(texts, [*facts, "kind"]), [*facts, "kind"], samples)
    rows = found.groupBy(*facts).agg(
        *[F.max(F.when(F.col("kind") == k, F.col("signature"))).alias(f"sig{k}") for k in (0, 1)]
    )
    # Few bytes a row, and read twice below: for the row itself and for the one before it.
    rows = materialize(rows, "fingerprints")
    after = rows.select(
        F.col("block").alias("next_block"),
        F.col("place").alias("next_place"),
        F.col("sig0").alias("next_sig"),
    )
    rows = rows.join(after, ["next_block", "next_place"], "left")
    return rows.select(
        "doc_id", "n_chars", F.lower(F.hex("sha256")).alias("edited_sha256"),
        fingerprint_text(F.col("sig0")).alias("fingerprint"),
        fingerprint_text(F.col("sig1")).alias("edited_fingerprint"),
        likeness(F.col("sig0"), F.col("sig1"), samples).alias("near_edited"),
        likeness(F.col("sig0"), F.col("next_sig"), samples).alias("near_next"),
    )
