"""Each operator against a brute-force version, on rows that are hard to get right."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.llm import (
    chunk_dedup,
    mixing,
    pieces,
    quality_classifier,
    quality_rules,
    simhash_links,
    token_files,
    toxicity,
    url_filter,
    weighted_sampling,
)
from kerbside.llm.queries import URL_RULES, tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# --- 1 mixing ----------------------------------------------------------------


def test_mix_sizes_targets_and_copies(spark, documents):
    rows = mixing.mix(documents).collect()
    assert len(rows) == documents.count()
    want = Counter(len(WORD.findall(t)) for _, t in texts_of(documents))
    assert Counter(r.size for r in rows) == want
    per = {r.source: r for r in rows}
    assert set(per) == {"", "a", "b", "c", None}
    total = sum(r.size for r in rows)
    assert sum(r.target for r in per.values()) == pytest.approx(total)
    assert all(r.target <= 3 * r.source_size for r in rows)
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    again = mixing.mix(documents.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_is_near_its_targets(spark):
    rows = [(i, "w " * (1 + i * 7 % 90), "s%d" % (i % 3 if i % 2 else 0)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block_rows=500).toPandas()
    for _, part in got.groupby("source"):
        assert part["taken"].sum() == pytest.approx(part["target"].iloc[0], rel=0.02)
    sizes = got.groupby("source")["size"].sum().sort_index()
    caps, weights, level = 3 * sizes, np.array([1, 2, 3]), 0.0
    for _ in range(5):
        over = weights * level > caps
        level = (sizes.sum() - caps[over].sum()) / weights[~over].sum()
    want = np.minimum(weights * level, caps)
    assert got.groupby("source")["target"].first().sort_index().to_numpy() == pytest.approx(want)


def test_mix_of_nothing_and_of_empty_texts(spark, documents, nothing):
    assert mixing.mix(nothing).count() == 0
    empty = mixing.mix(documents.where("doc_id in (4, 5, 6)")).collect()
    assert [r.taken for r in empty] == [0, 0, 0] and {r.target for r in empty} == {0.0}


def test_applied_mix_repeats_rows(spark, documents):
    copies = mixing.mix(documents)
    out = mixing.apply_mix(documents, copies)
    assert out.columns == documents.columns
    got = Counter(r.doc_id for r in out.collect())
    want = Counter()
    for r in copies.collect():
        want[r.doc_id] += r.copies
    assert got == Counter({k: v for k, v in want.items() if v})


# --- 2 weighted sampling -----------------------------------------------------


def test_fingerprints_of_edited_texts(spark, documents):
    unique = documents.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in weighted_sampling.fingerprint_documents(unique).collect()}
    texts = dict(texts_of(unique))
    order = sorted(texts, reverse=True)
    for k, doc in enumerate(order):
        text, after = texts[doc], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert rows[doc].n_chars == len(text)
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert rows[1].fingerprint == rows[2].fingerprint and rows[2].near_next == 1.0
    assert rows[4].fingerprint == rows[5].fingerprint == "0" * 8 * weighted_sampling.SAMPLES
    assert rows[6].near_next == 1.0 and 0.6 < rows[3].near_next


def test_fingerprints_of_awkward_tables(spark, documents, nothing):
    assert weighted_sampling.fingerprint_documents(nothing).count() == 0
    assert weighted_sampling.fingerprint_documents(documents).count() == documents.count()
    one = weighted_sampling.fingerprint_documents(documents.where("doc_id = 1")).collect()
    assert one[0].near_next == 1.0


def test_texts_are_shuffled_once(documents, capsys):
    """All that is read after the one written pass is that pass's table, not the documents again."""
    weighted_sampling.fingerprint_documents(documents).explain()
    plan = capsys.readouterr().out
    assert "FileScan parquet" in plan and "Scan ExistingRDD" not in plan


def test_collision_rate_is_generalised_jaccard(spark):
    a, b = Counter(x=9, y=4, z=1, v=6), Counter(x=3, y=8, w=5, v=6)
    rows = [(k, " ".join(f"{w}{n}" for w, c in t.items() for _ in range(c))) for n in range(40) for k, t in ((2 * n, a), (2 * n + 1, b))]
    docs = spark.createDataFrame(rows, "row long, text string")
    got = {r.row: r.signature for r in weighted_sampling.signatures(docs, ["row"], 32).collect()}
    same = np.mean([np.equal(got[2 * n], got[2 * n + 1]).mean() for n in range(40)])
    want = sum((a & b).values()) / sum((a | b).values())
    assert same == pytest.approx(want, abs=0.05)


# --- 3 URL filter ------------------------------------------------------------


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits, default=(0, None, "allow"))[1:])


@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_urls_against_rules(spark, ranges):
    hosts = ["org", "a.org", "example.org", "Blog.EXAMPLE.org", "xexample.org", "com", "b.com", "net", "", "ÄB.org"]
    tails = ["", "/", "/es/1", "/en/1", "/en/12?x=/es/", "/fr/#a", "/de/", "/ES/", "?q=/es/", "#/de/"]
    urls = [f"http://{h}{t}" for h in hosts for t in tails] + [None, "", "org/es/", "a://b://example.org/es/"]
    urls += ["https://example.org/en/1\n2"] * 30
    pages = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(urls)], "page_id long, url string, rule int, key string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(pages, url_filter.rules_frame(spark, URL_RULES), ranges=ranges).collect()}
    assert got == {i: judged(u, URL_RULES) for i, u in enumerate(urls)}


def test_urls_of_nothing(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = url_filter.rules_frame(spark, URL_RULES)
    assert url_filter.judge_urls(none, rules).count() == 0
    page = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_filter.judge_urls(page, url_filter.rules_frame(spark, [])).collect()[0].rule is None


# --- 4 toxicity and 6 quality ------------------------------------------------


@pytest.fixture(scope="module")
def marked(spark):
    rng = np.random.default_rng(3)
    common = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(900):
        found = list(rng.choice(common, 40))
        bad = i % 5 == 0
        if bad:
            found[3::9] = [f"nasty{rng.integers(30)}" for _ in found[3::9]]
        junk = i % 4 == 1
        text = " ".join(w + "$$$" if junk else w for w in found)
        rows.append((i, text, "en", f"s{i % 3}", len(text), int(not junk), int(bad)))
    kinds = "doc_id long, text string, lang string, source string, n_chars long, quality int, toxic int"
    return spark.createDataFrame(rows, kinds)


def test_toxicity_on_held_out_rows(spark, marked, documents, nothing):
    labels = marked.select("doc_id", "quality", "toxic")
    model = toxicity.train(marked.drop("toxic", "quality"), labels)
    got = toxicity.score(marked.drop("toxic", "quality"), model).join(labels, "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.95
    odd = toxicity.score(documents, model).collect()
    assert len(odd) == documents.count() and all(0 <= r.score <= 1 for r in odd)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    same = toxicity.train(marked.drop("toxic", "quality"), flipped)
    assert (same.weights == model.weights).all() and same.bias == model.bias
    empty = toxicity.train(nothing, labels.limit(0))
    assert {r.score for r in toxicity.score(documents, empty).collect()} == {0.5}


def test_negative_risk_is_not_overfitted():
    rng = np.random.default_rng(0)
    rows = [rng.integers(0, 50, 20) for _ in range(60)]
    model = toxicity.fit(rows[:20], rows[20:], prior=0.3)
    assert np.isfinite(model.weights).all() and np.isfinite(model.bias)


def test_quality_on_held_out_rows(spark, marked, documents, nothing):
    labels = marked.select("doc_id", "quality", "toxic")
    docs = marked.drop("toxic", "quality")
    model = quality_classifier.train(docs, labels)
    got = quality_classifier.score(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.98
    kept = quality_classifier.keep_good(docs, model)
    assert kept.columns == docs.columns and 600 < kept.count() < 720
    assert quality_classifier.score(documents, model).count() == documents.count()
    assert quality_classifier.train(nothing, labels) is None
    assert quality_classifier.keep_good(documents, None).count() == documents.count()


# --- 5 pieces ----------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return pieces.load(tokenizer("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))


def marks(text):
    return pieces.MARK + text.replace(" ", pieces.MARK) if text else text


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab e\nth.ing日🙂\t-=1", max_size=60))
def test_pieces_equal_the_library(model, library, text):
    ids = model.encode(marks(text))
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
    assert model.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab e\nthing=-", min_size=1, max_size=150), st.integers(16, 40))
def test_chunks_equal_the_whole(model, library, text, size):
    whole, reach = marks(text), model.longest
    windows = []
    for at in range(0, len(whole), size):
        low, end = max(at - reach, 0), min(at + size, len(whole))
        windows.append((whole[low : end + reach], at - low, end - low, end == len(whole)))
    made = [model.matrix(*w) for w in windows]
    states = pieces.path_states(made)
    ids = b"".join(model.chunk_ids(t, b, e, states[k], states[k + 1]) for k, (t, b, e, _) in enumerate(windows))
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text)
    left = list(accumulate(made, pieces.compose))[-1]
    right = made[-1]
    for m in made[-2::-1]:
        right = pieces.compose(m, right)
    assert left == right


def test_encoded_tables(spark, documents, library, nothing, monkeypatch):
    monkeypatch.setattr(pieces, "SPAN_CHUNKS", 5)
    path = tokenizer("piece_bpe_32k.model")
    for size in (64, pieces.CHUNK_CHARS):
        rows = pieces.decode(pieces.encode(documents, model=path, keep=["doc_id", "text"], chunk_chars=size), model=path)
        rows = rows.collect()
        assert len(rows) == documents.count()
        for r in rows:
            assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text or "")
            assert r.decoded == (r.text or "").replace(pieces.MARK, " ")
    digests = pieces.piece_digests(documents, model=path).collect()
    assert all(r.round_trip for r in digests)
    assert pieces.piece_digests(nothing, model=path).count() == 0


# --- 7 token files -----------------------------------------------------------


def crc32c_plain(raw):
    crc = 0xFFFFFFFF
    for byte in raw:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=1300), max_size=6))
def test_checksums(raws):
    assert token_files.crc32c(raws).tolist() == [crc32c_plain(r) for r in raws]


def test_known_checksum():
    assert token_files.crc32c([b"123456789"])[0] == 0xE3069283


def test_token_files_round_trip(spark, documents, nothing, tmp_path):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    made = Tokenizer.from_file(path)
    marked = [(11, "a <|endoftext|> b<|startoftext|>c", "en", "a", 9, *[None] * 6), (None, "<|ENDOFTEXT|>x", *[None] * 9)]
    documents = documents.where("doc_id is not null").unionByName(spark.createDataFrame(marked, documents.schema))
    ids = {d: made.encode(t, add_special_tokens=False).ids + [1] for d, t in texts_of(documents)}
    folder = str(tmp_path / "tokens")
    totals = token_files.write_tokens(documents, folder, tokenizer=path, shards=3)
    back = token_files.read_tokens(spark, folder, totals).orderBy("start").collect()
    order = [r.doc_id for r in back]
    assert order == [None, *sorted(x for x in order if x is not None)]
    start = 0
    for r in back:
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id] and r.start == start
        start += len(ids[r.doc_id])
    first = min(t.shard for t in totals.collect() if t.n_records)
    doc, got = token_files.read_record(folder, first, 0)
    assert doc is None and got.tolist() == ids[None]
    assert token_files.token_digests(nothing, tokenizer=path).count() == 0


def test_damaged_records_are_refused():
    record = bytearray(token_files.frame([b"payload of a record"])[0])
    at, size = np.array([0]), np.array([len(record)])
    assert token_files.unframe(bytes(record), at, size) == [b"payload of a record"]
    record[15] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        token_files.unframe(bytes(record), at, size)


@pytest.mark.parametrize("text", ["The END.", "don't, can't.", "a.b.,c,.", "Ünï. ÉTÉ, 3.5, İstanbul.", "x\x0b\x0cy\r\nz\u00a0q"])
def test_words_encode_as_their_text(text):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids + [1]
    got, width = token_files.encode_texts([text], path)
    assert np.frombuffer(got[0], f"<u{width}").tolist() == want


def test_texts_of_many_kinds_encode_as_the_library_does():
    """Letters, marks, letters that gain a mark in lower case, special names, white space."""
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    texts = [
        "İstanbul İ, x", "don't 's dogs' ',' a<|endoftext|>b <|endoftext|>", "e\u0301a, H\u0331 h\u0331",
        "각 한글, ß. ſ", "x" * 5000 + "...'' y", "中文，字。 ab", "ª º ⅷ ² 9a a9,", " a  b\r\n\x0bc\x85d e",
        "", "  ", "\t\n", " ".join(f"w{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]} W{k}, é{k}" for k in range(3000)),
    ]
    made = Tokenizer.from_file(path)
    got, width = token_files.encode_texts(texts, path)
    for text, raw in zip(texts, got, strict=True):
        want = made.encode(text, add_special_tokens=False).ids + [token_files.END_ID]
        assert np.frombuffer(raw, f"<u{width}").tolist() == want, text[:40]
    assert token_files.encode_texts([], path)[0] == []



# --- 8 chunk dedup -----------------------------------------------------------


def test_gear_hash_is_a_rolling_sum():
    raw = np.frombuffer(b"content defined chunking of a text that is long enough", np.uint8)
    got = chunk_dedup.gear_hashes(raw)
    for k in range(len(raw)):
        want = sum(int(chunk_dedup._GEAR[raw[k - i]]) << (2 * i) for i in range(min(16, k + 1)))
        assert got[k] == want & 0xFFFFFFFF


def test_chunks_cover_the_text(prose):
    raw = f"  {prose}\n\n{prose.upper()} ".encode()
    edges, counts = chunk_dedup.chunk_bounds(raw)
    assert edges[0] == 0 and edges[-1] == len(raw) and edges == sorted(edges)
    assert counts == [len(raw[a:b].split()) for a, b in zip(edges, edges[1:], strict=False)]
    assert max(counts) <= chunk_dedup.MAX_WORDS


def test_repeated_passages_are_cut_once(spark, prose):
    rng = np.random.default_rng(5)
    noise = lambda: " ".join(f"n{rng.integers(1 << 40)}" for _ in range(60))
    rows = [(i, f"{noise()} {prose} {noise()}" if i % 3 == 0 else noise(), 7) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = {r.doc_id: r for r in chunk_dedup.remove_repeats(docs).collect()}
    for i, text, _ in rows:
        if i % 3 or i == 0:
            assert got[i].text == text and got[i].n_chars == 7
        else:
            assert got[i].n_chars == len(got[i].text) < len(text)
            assert prose[80:160] not in got[i].text
            assert got[i].text.split()[:40] == text.split()[:40]
            assert got[i].text.split()[-40:] == text.split()[-40:]


def test_dedup_of_awkward_tables(spark, documents, nothing):
    out = chunk_dedup.remove_repeats(documents)
    assert out.columns == documents.columns and out.count() == documents.count()
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[1] and got[2] == "" and got[4] is None and got[3].strip() != ""
    assert chunk_dedup.remove_repeats(nothing).count() == 0
    assert chunk_dedup.repeat_report(documents).where("changed").count() >= 1


# --- 9 quality rules ---------------------------------------------------------


def counted(text):
    found = WORD.findall(text)
    grams = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_statistics(spark, documents):
    got = quality_rules.base_statistics(documents).collect()
    key = lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    assert Counter((r.doc_id, *key(r)) for r in got) == Counter((d, *counted(t)) for d, t in texts_of(documents))


def test_outliers_are_rejected_and_clean_rows_kept(spark, prose):
    rng = np.random.default_rng(2)
    pool = prose.split()
    rows = []
    for i in range(400):
        text = " ".join(rng.choice(pool, 120)) + f" {i}"
        if i % 20 == 0:
            text = " ".join(f"{w}%%%##" for w in text.split())
        rows.append((i, text, "en", "big" if i < 380 else f"small{i}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert len(got) == 400
    assert not any(got[i].kept for i in range(0, 380, 20))
    assert sum(got[i].kept for i in range(400) if i % 20) >= 378
    assert all(r.kept or not r.base_failed or r.n_words < 10 or r.n_repeat_words for r in got.values())


def test_rules_on_awkward_tables(spark, documents, nothing):
    got = quality_rules.judge(documents).collect()
    assert len(got) == documents.count()
    assert all(r.kept == (not r.base_failed) for r in got)  # too few rows for an estimate
    assert quality_rules.judge(nothing).count() == 0


def test_a_third_of_a_group_may_be_off(spark, tmp_path):
    rng = np.random.default_rng(3)
    x = rng.normal([1.6, 0.2, 0.2, 0.2], [0.05, 0.05, 0.05, 0.05], (3000, 4))
    rows = []
    for name, share, shift in (("a", 0.28, 0.8), ("b", 0.34, 0.8), ("c", 0.40, 1.0), ("d", 0.0, 0.0)):
        off = rng.random(3000) < share
        z = np.round((x + np.outer(off, [0, shift, 0, 0])) * quality_rules.SCALE).astype(int)
        rows += [(f"{name}{int(o)}", name, *map(int, r)) for o, r in zip(off, z, strict=True)]
    path = f"{tmp_path}/rows"
    spark.createDataFrame(rows, ["kind", "grp", *quality_rules.FEATURES]).write.parquet(path)
    table = spark.read.parquet(path)
    est = quality_rules.fitted(table.drop("kind"))
    got = quality_rules._with_distance(table, est).selectExpr("kind", f"d2 > {quality_rules.CUTOFF} as far")
    share = {r.kind: r.share for r in got.groupBy("kind").agg(F.avg(F.col("far").cast("int")).alias("share")).collect()}
    assert all(share[k] > 0.99 for k in ("a1", "b1", "c1"))
    assert all(share[k] < 0.001 for k in ("a0", "b0", "c0", "d0"))


def test_estimate_is_a_concentrated_covariance(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal([2, 0.1, 0.1, 0.1], 0.3, (500, 4)) * quality_rules.SCALE).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], ["grp", *quality_rules.FEATURES])
    est = quality_rules._estimates(rows)
    got = {tuple(r[f] for f in quality_rules.FEATURES): r.d2 for r in quality_rules._with_distance(rows, est).collect()}
    z = x / quality_rules.SCALE
    cov = np.cov(z.T, bias=True) * quality_rules.CONSISTENCY + np.diag(np.square(quality_rules.FLOORS))
    d = z - z.mean(axis=0)
    want = (d * np.linalg.solve(cov, d.T).T).sum(axis=1)
    assert [got[tuple(map(int, r))] for r in x] == pytest.approx(want)


# --- 10 SimHash --------------------------------------------------------------


def simhash_plain(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    found = WORD.findall(lowered)
    grams = [" ".join(found[i : i + 4]) for i in range(len(found) - 3)] or [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values):
    """Smallest index reachable by links of four bits or fewer."""
    group = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 4 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def test_simhash_of_awkward_tables(spark, documents, nothing):
    for doc, text in texts_of(documents):
        assert simhash_links.simhash(text) == simhash_plain(text)
    got = simhash_links.near_duplicates(documents).collect()
    assert len(got) == documents.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].component_id == 1 and by_id[6].component_id == by_id[5].component_id == 4
    assert by_id[4].fingerprint == "0" * 16 and by_id[None].component_id is None
    assert simhash_links.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize(("blocks", "take"), [(6, 2), (3, 1), (5, 1), (1, 1)])
def test_links_find_all_components(spark, blocks, take):
    rng = np.random.default_rng(blocks)
    seeds = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = [int(s) ^ sum(1 << int(b) for b in rng.choice(64, k % 7, replace=False)) for k, s in enumerate(seeds)]
    dense = [int(seeds[0]) ^ (1 << int(a)) ^ (1 << int(b)) for a in range(30) for b in range(a)]
    values = sorted({*map(int, seeds), *near, *dense})
    want = linked(values)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    table = spark.createDataFrame([(v,) for v in signed], "fp long")
    pairs = simhash_links.links(table, blocks=blocks, take=take)
    rows = pairs.collect()
    assert len(rows) < 20 * len(values) * 4
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in rows)
    stars = {r.u: r.v for r in simhash_links.components(pairs).collect()}
    got = [stars.get(v, v) for v in signed]
    for i in range(len(values)):
        for j in range(i):
            assert (got[i] == got[j]) == (want[i] == want[j])


def test_long_chains_become_one_component(spark):
    table = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    stars = simhash_links.components(table).collect()
    assert {r.u for r in stars} == set(range(1, 201)) and {r.v for r in stars} == {0}


def test_one_of_each_is_judged_row_by_row(spark, documents, nothing, prose):
    kept = simhash_links.one_of_each(documents)
    assert kept.columns == documents.columns
    ids = [r.doc_id for r in kept.collect()]
    # 2 and 3 are copies of 1, 5 and 6 have no words, as 4; 8 stands there twice
    assert Counter(ids) == Counter([1, 4, 7, 8, 9, 10, None])
    assert simhash_links.one_of_each(nothing).count() == 0
    rows = [(1, prose), (2, prose), (2, "a text of its own, long enough to have shingles"), (None, prose)]
    kept = simhash_links.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, prose), rows[2]]


def test_points_of_one_bucket_are_split_by_all_bits():
    rng = np.random.default_rng(1)
    mask = np.uint64((1 << 21) - 1)
    points = np.unique(rng.integers(0, 1 << 43, 6000, dtype=np.uint64) << np.uint64(21))
    near = points[:300] ^ np.uint64((1 << 30) | (1 << 50))
    points = np.unique(np.concatenate([points, near]))
    links = []
    simhash_links._search(points, points, mask, 1, links)
    pairs = {frozenset(p) for a, b in links for p in zip(a.tolist(), b.tolist(), strict=True) if p[0] != p[1]}
    assert {frozenset((int(n), int(n) ^ (1 << 30) ^ (1 << 50))) for n in near} <= pairs
    assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
