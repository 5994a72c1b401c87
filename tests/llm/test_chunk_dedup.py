"""Substring deduplication against plain Python: cuts, first places, runs, rows that share an id."""

import numpy as np
import pytest

from kerbside.llm import chunk_dedup
from kerbside.llm.chunk_dedup import REACH, RUN_WORDS
from pyspark.sql import functions as F

SPACE = " \t\n\r\v\f"


def plain_chunks(text):
    """Chunks as lists of words: a word start is a cut if its hash is the least within REACH."""
    raw = text.encode()
    starts = [i for i, c in enumerate(raw) if chr(c) not in SPACE and (i == 0 or chr(raw[i - 1]) in SPACE)]

    def gear(end):
        back = [raw[end - 1 - i] for i in range(min(16, end))]
        return sum(int(chunk_dedup._GEAR[c]) << (2 * i) for i, c in enumerate(back)) & 0xFFFFFFFF

    hashes = [None] + [gear(s) for s in starts[1:]]
    cuts = []
    for k in range(REACH + 1, len(starts)):
        before = hashes[max(1, k - REACH) : k]
        after = hashes[k + 1 : k + 1 + REACH]
        if all(hashes[k] < h for h in before) and all(hashes[k] <= h for h in after):
            cuts.append(k)
    words, out = text.split(), []
    for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True):
        out += [words[i : min(i + 32, b)] for i in range(a, b, 32)] if np.diff([0, *cuts, len(words)]).max() > 32 else [words[a:b]]
    return out


def plain_kept(rows, run_words=RUN_WORDS):
    """Words that stay in each row, rows given as (order, text)."""
    split = [(order, plain_chunks(text or "") if (text or "").split() else []) for order, text in rows]
    first = {}
    for order, chunks in sorted(split, key=lambda r: r[0]):
        for k, chunk in enumerate(chunks):
            place = (order, k)
            if tuple(chunk) not in first or place < first[tuple(chunk)][0]:
                first[tuple(chunk)] = (place, chunks)

    def same(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    kept = []
    for order, chunks in split:
        again = [first[tuple(c)][0] != (order, k) for k, c in enumerate(chunks)]
        gone, k, taken = set(), 0, {}
        flat = [(i, j) for i, c in enumerate(chunks) for j in range(len(c))]
        while k < len(chunks):
            end = k
            while end < len(chunks) and again[end]:
                end += 1
            if end > k:
                (_, p), there = first[tuple(chunks[k])]
                (_, q), here = first[tuple(chunks[end - 1])]
                left = same(chunks[k - 1][::-1], there[p - 1][::-1]) if k and p else 0
                right = same(chunks[end], here[q + 1]) if end < len(chunks) and q + 1 < len(here) else 0
                if k and k - 1 in taken:
                    left = min(left, len(chunks[k - 1]) - taken[k - 1])
                if left + right + sum(map(len, chunks[k:end])) >= run_words:
                    gone.update((i, j) for i, j in flat if k <= i < end)
                    gone.update((k - 1, len(chunks[k - 1]) - 1 - j) for j in range(left))
                    gone.update((end, j) for j in range(right))
                    taken[end] = right
            k = max(end, k + 1)
        kept.append([chunks[i][j] for i, j in flat if (i, j) not in gone])
    return kept


def check(spark, rows, run_words=RUN_WORDS):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keyed = docs.distinct().select("doc_id", "text", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h"))
    key = {(r.doc_id, r.text): (r.doc_id is None, r.doc_id or 0, r.h) for r in keyed.collect()}
    want = plain_kept([(key[r], r[1]) for r in rows], run_words)
    got = chunk_dedup.remove_repeats(docs, run_words=run_words).collect()
    whole = {(k[0], " ".join(w)) for k, w in zip(rows, want, strict=True)}
    assert {(r.doc_id, " ".join((r.text or "").split())) for r in got} == whole
    assert len(got) == len(rows)
    return got


def noise(rng, n):
    return " ".join(f"n{k}" for k in rng.integers(1 << 40, size=n))


def test_cuts_equal_plain_python(prose):
    rng = np.random.default_rng(1)
    for text in [prose, noise(rng, 400), "a " * 100, "x", f"  {prose}\n\t é ü", "the end " * 60 + noise(rng, 50)]:
        raw = text.encode()
        edges, _ = chunk_dedup.chunk_bounds(raw)
        assert [raw[a:b].decode().split() for a, b in zip(edges, edges[1:], strict=False)] == plain_chunks(text)


def test_runs_equal_plain_python(spark):
    rng = np.random.default_rng(4)
    passages = [noise(rng, int(n)) for n in rng.integers(30, 90, 12)]
    rows = []
    for k in range(80):
        parts = [noise(rng, int(rng.integers(1, 40)))]
        for p in rng.integers(0, 12, int(rng.integers(0, 4))):
            words = passages[p].split()
            a = int(rng.integers(0, 12))
            parts += [" ".join(words[a:]) if k % 2 else passages[p], noise(rng, int(rng.integers(0, 4)))]
        rows.append((None if k % 9 == 0 else int(rng.integers(0, 50)), "\n".join(parts)))
    rows += [rows[3], (None, None), (5, ""), (None, rows[7][1])]
    got = check(spark, rows)
    assert len({r.doc_id for r in got}) < len(rows) - 10
    check(spark, rows, run_words=12)


def test_passages_go_whole_and_short_lines_stay(spark):
    rng = np.random.default_rng(8)
    passage, line = noise(rng, 55), noise(rng, 25)
    rows = [(k, f"{noise(rng, 30)} {passage} {noise(rng, 30)}\n{line}\n{noise(rng, 20)}") for k in range(20)]
    got = {r.doc_id: r.text.split() for r in check(spark, rows)}
    left = [len(set(got[k]) & set(passage.split())) for k in range(1, 20)]
    assert len(set(got[0]) & set(passage.split())) == 55
    assert sum(left) <= 6 and all(set(line.split()) <= set(got[k]) for k in range(20))


def test_rows_that_share_an_id(spark, prose):
    rng = np.random.default_rng(2)
    long = " ".join([prose, noise(rng, 300)])
    rows = [(1, long), (8, f"{noise(rng, 80)} {long}"), (8, "short text here"), (8, noise(rng, 4000)), (None, long)]
    got = {(r.doc_id, len(r.text.split())) for r in check(spark, rows)}
    assert (1, len(long.split())) in got and (8, 3) in got and (8, 4000) in got and (None, 0) in got


@pytest.mark.parametrize("bits", [15])
def test_a_full_bitmap_changes_nothing(spark, bits, monkeypatch, prose):
    monkeypatch.setattr(chunk_dedup, "MAP_BITS", 1)
    rng = np.random.default_rng(bits)
    check(spark, [(k, f"{noise(rng, 30)} {prose}") for k in range(6)])
