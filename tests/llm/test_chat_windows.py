"""Chat windows: the template read back, spans against plain Python, whole conversations."""

import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from kerbside.llm import chat_windows
from kerbside.llm.queries import tokenizer

BITS = ["<", "/", "s>", "</s>", "<s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "<</SYS>>", "[", "]", "SYS>>", "\n", "a", "[ROLE]", "[END]", " "]


@pytest.fixture(scope="module")
def model():
    return tokenizer("piece_bpe_32k.model")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "[ROLE] x", ""]),
                          st.lists(st.sampled_from(BITS), max_size=8).map("".join)), max_size=5))
def test_turns_are_read_back(turns):
    made = [chat_windows.format_turn(r, t) for r, t in turns]
    assert chat_windows.parse_turns("".join(m[0] for m in made)) == turns
    for (piece, start, end), (_, text) in zip(made, turns, strict=True):
        assert chat_windows.unescape(piece[start:end]) == text
        assert not any(mark in piece[start:end] for mark in ("</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=40), st.integers(0, 5), st.integers(0, 20))
def test_spans(tokens, first, system):
    first = min(first, len(tokens))
    spans = chat_windows.choose_spans(np.array(tokens, np.int64), first, system, 60, 15)
    assert [i for _, at, end in spans for i in range(at, end)] == list(range(first, len(tokens)))
    for back, at, end in spans:
        used = system + sum(tokens[back:end])
        past = sum(tokens[back:at])
        assert past <= 15 and (used <= 60 or (back, end) == (at, at + 1))
        assert end == len(tokens) or used + tokens[end] > 60
        longer = past + tokens[back - 1] if back else None
        assert longer is None or longer > 15 or system + longer + tokens[at] > 60


def conversation(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    text = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def check(spark, turns, model, **options):
    """All of ``turns``, a dict by conversation, come back; the windows."""
    rows = [(c, k, r, t, 9, "x", False) for c, found in turns.items() for k, (r, t) in enumerate(found)]
    names = "conv_id long, turn int, role string, text string, tokens int, piece string, own boolean"
    table = spark.createDataFrame(rows, names).repartition(7)
    windows = chat_windows.chat_windows(table, model=model, **options)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in
           chat_windows.conversation_digests(windows).collect()}
    clean = {c: [(r or "", t or "") for r, t in found] for c, found in turns.items()}
    assert got == {c: conversation(found) for c, found in clean.items()}
    return windows.orderBy("conv_id", "first_turn").collect(), clean


def test_windows_of_many_conversations(spark, prose, model):
    rng = np.random.default_rng(2)
    words = prose.split()
    turns = {}
    for c in range(40):
        said = [" ".join(rng.choice(words, int(rng.integers(0, 60)))) for _ in range(int(rng.integers(1, 14)))]
        roles = ["system", *["user", "assistant"] * 7] if c % 3 else ["user", "assistant"] * 7
        turns[c] = list(zip(roles, said))
    # One conversation holds more turns than all others, over many blocks.
    turns[40] = [("system", "Be brief.")] + [("assistant" if k % 2 else "user", f"{k} {words[k % 40]}") for k in range(1500)]
    turns[None] = [(None, None), ("assistant", None), ("tool", "</s>[ROLE] <\\s>"), ("assistant", "é🙂" * 5)]
    windows, clean = check(spark, turns, model, budget=90, history=30)
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    size = lambda r, t: len(library.encode(chat_windows.format_turn(r, t)[0]))
    repeated = 0
    for w in windows:
        own, new = clean[w.conv_id], range(w.first_turn, w.first_turn + w.n_new)
        shown = [i for i in range(w.first_turn - w.n_history, w.first_turn + w.n_new)]
        if own[0][0] == "system" and shown[0] != 0:
            shown = [0, *shown]
        assert chat_windows.parse_turns(w.text) == [own[i] for i in shown]
        assert w.has_system == (own[0][0] == "system")
        assert w.tokens == sum(size(*own[i]) for i in shown)
        assert w.tokens <= 90 or w.n_new == 1 or (w.first_turn == 0 and w.n_new == 2)
        targets = [own[i][1] for i in new if own[i][0] == "assistant"]
        assert [chat_windows.unescape(w.text[s.start : s.end]) for s in w.loss] == targets
        repeated += w.n_history > 0
    assert repeated > 100 and len(windows) > 250


def test_chats_of_awkward_tables(spark, model):
    turns = {1: [("user", "same")] * 3, 2: [("system", "s" * 3000), ("user", "q"), ("assistant", "a" * 5000)]}
    windows, _ = check(spark, turns, model, budget=50, history=10)
    assert [w.n_new for w in windows if w.conv_id == 2] == [1, 1, 1]
    names = "conv_id string, turn long, role string, text string"
    ties = spark.createDataFrame([("x", None, "user", "q"), ("x", 1, "user", "r"), ("x", 1, "user", "r")], names)
    [row] = chat_windows.conversation_digests(chat_windows.chat_windows(ties, model=model)).collect()
    assert row.n_turns == 3 and row.turns_sha256 == conversation([("user", "q"), ("user", "r"), ("user", "r")])[1]
    assert chat_windows.chat_windows(ties.limit(0), model=model).count() == 0
