"""Importance resampling against plain Python; the table and the joined checksums by themselves."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def found_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return [zlib.crc32(r.encode()) % 10_000 for r in runs], len(words)


def plain_report(docs, target):
    """Rows of (doc_id, n_features, weight, score, words), and the gains of buckets."""
    made = [(i, *found_features(t)) for i, t in docs]
    s = Counter(b for _, f, _ in made for b in f)
    t = Counter(b for text in target for b in found_features(text)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (S + 10_000) / ((s[b] + 1) * (T + 10_000)))) for b in range(10_000)
    ]
    rows = []
    for i, f, n in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n))
    return rows


def drawn(rows, percent=5):
    can = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return [r[0] for r in can[: len(can) * percent // 100]]


def as_rows(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string")


def test_report_equals_plain_python(spark, prose, monkeypatch):
    rng = np.random.default_rng(3)
    pool = prose.split() + ["Straße", "日本", "x9", "ein" * 40]
    texts = [(i, " ".join(rng.choice(pool, int(rng.integers(0, 60))))) for i in range(300)]
    texts += [(300, "ab-cd_ef" * 2000), (301, None), (302, "..."), (303, "Ⅷ é́" * 9)]
    target = [prose, None, "", "the bridge across the river"]
    got = importance.resampling_report(as_rows(spark, texts), as_rows(spark, list(enumerate(target)))).collect()
    want = plain_report(texts, target)
    assert sorted((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in got) == sorted(want)
    order = drawn(want)
    assert len(order) > 5 and {r.doc_id: r.rank for r in got if r.rank} == {d: k for k, d in enumerate(order, 1)}


def test_long_texts_go_part_by_part(monkeypatch, prose):
    raw = (prose + " ").encode() * 30 + b"z" * 900 + b" end"
    whole = [(len(r), Counter(b[s].tolist())) for r, s, b, _ in importance.features(
        raw.translate(importance._FOLD).split(), np.zeros(len(raw.split()), np.int64), 0, 3, 10_000)]
    monkeypatch.setattr(importance, "PART_BYTES", 300)
    monkeypatch.setattr(importance, "BLOCK_WORDS", 50)
    texts = [b"a b", raw, None, raw[:100]]
    got = [[0, Counter()] for _ in range(3)]
    for words, rows, context in importance._blocks(texts, 3):
        assert len(words) < 150
        for k, (row, slots, bucket, _) in enumerate(importance.features(words, rows, context, 3, 10_000)):
            mine = row == 1
            got[k][0] += int(mine.sum())
            got[k][1].update(bucket[slots[mine]].tolist())
    assert [tuple(g) for g in got] == whole


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=200), st.integers(0, 3))
def test_equal_keys_of_different_items_get_slots_of_their_own(items, bits):
    items = np.array(items, np.uint64)
    slots, owner = importance.intern(items & np.uint64((1 << bits) - 1), items)
    assert all(items[owner[s]] == i for s, i in zip(slots, items, strict=True))
    assert len(set(slots.tolist())) == len(set(items.tolist())) == int((owner >= 0).sum())


@settings(max_examples=30, deadline=None)
@given(st.binary(max_size=50), st.binary(max_size=300))
def test_joined_checksum(a, b):
    first, second = (np.array([zlib.crc32(x)], np.uint32) for x in (a, b))
    assert importance.joined_crc(first, second, np.array([len(b)]))[0] == zlib.crc32(a + b)


def test_record_hash_is_xxh64():
    xxhash = pytest.importorskip("xxhash")
    values = np.array([0, 1, 1 << 40, (1 << 64) - 1], np.uint64)
    assert importance.hash_records(values).tolist() == [xxhash.xxh64_intdigest(v.tobytes()) for v in values]


def test_resampling_of_awkward_tables(spark, documents, nothing):
    target = documents.where("doc_id = 3")
    got = importance.resampling_report(documents, target).collect()
    assert len(got) == documents.count() and all(r["rank"] is None for r in got if r.n_words < 20)
    want = plain_report([(r.doc_id, r.text) for r in documents.collect()], [r.text for r in target.collect()])
    key = lambda row: str(row)
    assert sorted(((r.doc_id, r.n_features, r.weight, r.score, r.n_words) for r in got), key=key) == sorted(want, key=key)
    kept = importance.resample(documents, target, percent=60)
    assert kept.columns == documents.columns
    assert [r.doc_id for r in kept.collect()] == drawn(want, 60)[:2]
    assert importance.resampling_report(nothing, nothing).count() == 0
    assert importance.resample(nothing, documents).count() == 0
