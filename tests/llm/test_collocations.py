"""Phrase mining against plain Python; the counting filters by themselves."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import collocations
from kerbside.llm import counting_filter as cf

LOWER = {c: c + 32 for c in range(65, 91)}


def pieces_of(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, min_count, top, max_words=5):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            totals[lang] += len(words)
            for n in range(1, max_words + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, c in counts.items():
        often = {p: a for p, a in c.items() if a >= min_count and len(p) > 1}
        around = Counter()
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    around[p[i : i + m]] = max(around[p[i : i + m]], a)
        found = []
        for p, a in often.items():
            if around[p] < a:
                cut = min((1000 * a * totals[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-cut[0], -a, " ".join(p).encode(), c[p[: cut[1]]], c[p[cut[1] :]]))
        for k, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, k, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def mined(docs, **options):
    rows = collocations.collocations(docs, **options).collect()
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in rows)


def test_phrases_equal_plain_python(spark, prose):
    rng = np.random.default_rng(5)
    words = prose.split()[:14] + ["Straße", "日本", "a b", "x\x00y"]
    rows = []
    for k in range(260):
        picked = list(rng.choice(words, int(rng.integers(0, 40))))
        at = int(rng.integers(0, len(picked) + 1))
        picked[at:at] = ["New", "york", "City", "Council", "hall"][: int(rng.integers(0, 6))]
        ends = rng.choice([" ", "\t", "  ", ". ", ",", "\n", "\r\n", "? "], len(picked), p=[0.6, 0.1, 0.1, *[0.04] * 5])
        rows.append((["en", "de", None, "und"][k % 4], "".join(w + e for w, e in zip(picked, ends, strict=True))))
    docs = spark.createDataFrame([(l, t, k) for k, (l, t) in enumerate(rows)], "lang string, text string, word long")
    want = plain(rows, 6, 15)
    assert mined(docs, min_count=6, top=15) == want
    assert {len(p.split()) for _, _, p, *_ in want} >= {2, 3} and max(r[1] for r in want) == 15


def test_a_full_bitmap_changes_nothing(spark, prose, monkeypatch):
    rows = [("en", f"{prose}. {prose.replace('the', str(k % 3))}") for k in range(12)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(collocations, "MAP_BITS", 2)
    assert mined(docs, min_count=5, top=500) == plain(rows, 5, 500)


def test_blocks_are_cut_at_breaks(monkeypatch):
    monkeypatch.setattr(collocations, "PART_BYTES", 40)
    text = "one two three four. five six, " * 30 + "seven " * 40 + "w" * 200
    tokens = [t for part in collocations.token_parts(text.encode()) for t in part]
    assert [b" ".join(g.split()) for g in b" ".join(tokens).split(b".")] == [
        " ".join(w).encode() for w in pieces_of(text)
    ]
    block = collocations.Block()
    block.add(tokens)
    ids, words, counts = block.taken(False)
    assert ids[-1] == 0 and counts.sum() == len(ids) and block.size == len(tokens) - len(ids)
    rest, more, _ = block.taken(True)
    both = [words[i] for i in ids] + [more[i] for i in rest]
    assert both == tokens and block.taken(True) is None


@settings(max_examples=40, deadline=None)
@given(st.data(), st.integers(2, 5), st.sampled_from([2, 7, 20, 32]))
def test_filters_lose_nothing(data, n, width):
    grams = data.draw(st.lists(st.tuples(*[st.integers(0, min(2**width - 1, 50))] * n), max_size=60))
    shard_bits = min(3, width)
    want = Counter(grams * 2)
    filters = defaultdict(list)
    for part in (grams[: len(grams) // 2], grams[len(grams) // 2 :], grams):
        if part:
            ids = [np.array(column, np.uint64) for column in zip(*part, strict=True)]
            assert [i.tolist() for i in cf.unpermute(cf.permute(ids, width), width)] == [i.tolist() for i in ids]
            for shard, body in cf.to_filters(*cf.counted(cf.pack(ids, width)), width, shard_bits):
                filters[shard].append(cf.from_filter(body, shard, width, shard_bits))
    got = Counter()
    for some in filters.values():
        limbs, counts = cf.merged(some)
        keys = list(zip(*(i.tolist() for i in cf.unpack(limbs, n, width)), strict=True))
        assert len(set(keys)) == len(keys) and limbs[0].tolist() == sorted(limbs[0].tolist())
        got.update(dict(zip(keys, counts.tolist(), strict=True)))
    assert got == want


def test_counts_beyond_a_byte():
    limbs, counts = [np.array([5, 9], np.uint64)], np.array([254, 70_000])
    [(shard, body)] = cf.to_filters(limbs, counts, 4, 0)
    back, again = cf.from_filter(body, shard, 4, 0)
    assert back[0].tolist() == [5, 9] and again.tolist() == [254, 70_000]


def test_phrases_of_awkward_tables(spark, documents, nothing):
    rows = [(r.lang, r.text) for r in documents.collect()]
    assert mined(documents, min_count=2, top=50) == plain(rows, 2, 50)
    assert mined(nothing) == []


@pytest.mark.parametrize("max_words", [2, 3])
def test_shorter_phrases(spark, prose, max_words):
    rows = [("en", prose)] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert mined(docs, min_count=3, max_words=max_words) == plain(rows, 3, 2000, max_words)
