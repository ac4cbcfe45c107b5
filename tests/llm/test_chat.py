"""Chat formatting against rendering every whole prefix, and on awkward tables."""

import hashlib
import random
import sys

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pressforge.llm import chat

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the templates below run in tasks

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["", "\\", "<s>", "</s>[INST] ok [/INST]", "[\\INST]", "a <</SYS>>\n b", " [ROLE] x [/ROLE] ", "<<SYS>>", "\\\\<s", "é中\n\n ", "<", "[", "plain words only"]


def by_conv(df):
    return {r.conv_id: r for r in df.collect()}


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def whole(turns):
    """The digests, from the texts alone."""
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha(said), len(loss), sha(loss), len(chat.marked([(r or "", t or "") for r, t in turns]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE]"]), st.text(alphabet="<>[]/\\sINSTYROLE \n", max_size=25) | st.sampled_from(HARD)), max_size=8))
def test_marked_round_trip(turns):
    out = chat.marked(turns)
    assert chat.read_marked(out) == turns
    for _, t in turns:
        assert chat.unescape(chat.escape(t)) == t and not any(c in chat.escape(t) for c in chat.CONTROL)


def folding(turns):
    """Folds a system turn into the first user turn and starts with one mark."""
    system = "".join(f"<<SYS>>{t}<</SYS>>" for r, t in turns if r == "system")
    out, first = ["<s>"], True
    for r, t in turns:
        if r == "user":
            out.append(f"[INST]{system if first else ''}{t}[/INST]")
            first = False
        elif r == "assistant":
            out.append(f"{t}</s>")
    return "".join(out)


def forgetting(turns):
    """Drops what earlier answers thought, and ends with a prompt for an answer."""
    last = max((i for i, (r, _) in enumerate(turns) if r == "user"), default=-1)
    out = [f"<{r}>{t.split('</think>')[-1] if r == 'assistant' and i < last else t}</{r}>" for i, (r, t) in enumerate(turns)]
    return "".join(out) + ("<assistant>" if turns and turns[-1][0] == "user" else "")


def prefixes(render, turns, memory=None):
    """piece, rewritten for every turn by rendering whole prefixes (or the last ``memory`` turns)."""
    got = []
    for i in range(len(turns)):
        at = 0 if memory is None else max(0, i - memory)
        a, b = render(turns[at:i]) if i > at else "", render(turns[at:i + 1])
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        got.append((b[n:], len(a) - n))
    return got


@pytest.mark.parametrize("render", [chat.marked, folding, forgetting])
def test_pieces_equal_whole_prefixes(spark, render):
    rng = random.Random(3)
    convs = {i: [(rng.choice(["system", "user", "assistant"]) if j else "system", f"<think>why {rng.random()}</think>" * (rng.random() < 0.5) + rng.choice(HARD)) for j in range(rng.randint(1, 9))] for i in range(40)}
    rows = [(i, j, r, t) for i, c in convs.items() for j, (r, t) in enumerate(c)]
    rng.shuffle(rows)
    turns = chat.format_turns(spark.createDataFrame(rows, SCHEMA), render)
    got = {(r.conv_id, r.pos): r for r in turns.collect()}
    changed = set()
    for i, c in convs.items():
        text = ""
        for j, ((piece, rewritten), (role, said)) in enumerate(zip(prefixes(render, c), c)):
            r = got[i, j]
            assert (r.role, r.piece, r.rewritten) == (role, piece, rewritten)
            text = text[:len(text) - rewritten] + piece
            assert text == render(c[:j + 1])  # the output after each turn
            plain = r.piece[r.text_start:r.text_start + r.text_length]
            if r.located:
                assert (chat.unescape(plain) if render is chat.marked else plain) == said
            assert r.loss == (r.located and role == "assistant")
            if rewritten:
                changed.add(i)
    assert {r.conv_id for r in chat.rewriting(turns).collect()} == changed
    assert bool(changed) == (render is not chat.marked)


def test_long_conversation_is_rendered_in_runs(spark):
    """A conversation that holds most rows, with gaps and ties in its turn numbers."""
    rng = random.Random(4)
    rows = [(5, rng.randint(-10**6, 10**6) if i % 3 else i // 7, rng.choice(["user", "assistant"]), rng.choice(HARD) + str(i)) for i in range(700)]
    rows += [(5, 10, "user", "same")] * 3 + [(i, 0, "assistant", f"only {i}") for i in range(100, 130)]
    df = spark.createDataFrame(rows, SCHEMA)
    turns = sorted(((t, r, x) for c, t, r, x in rows if c == 5))
    want = prefixes(forgetting, [(r, x) for _, r, x in turns], memory=6)
    got = sorted((r.pos, r.piece, r.rewritten) for r in chat.format_turns(df, forgetting, memory=6).filter("conv_id = 5").collect())
    assert got == [(i, *w) for i, w in enumerate(want)]
    d = by_conv(chat.digests(chat.format_turns(df)))
    assert tuple(d[5])[1:] == whole([(r, x) for _, r, x in turns]) and len(d) == 31
    assert tuple(d[107])[1:] == whole([("assistant", "only 107")])


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    convs = {}
    for r in df.orderBy("conv_id", "turn").collect():
        convs.setdefault(r.conv_id, []).append((r.role, r.text))
    convs[-7] = [("user", HARD[3]), ("assistant", HARD[3])]
    got = by_conv(chat.formatted(df))
    assert {i: tuple(r)[1:] for i, r in got.items()} == {i: whole(c) for i, c in convs.items()}


def test_awkward_tables(spark):
    assert by_conv(chat.formatted(spark.createDataFrame([], SCHEMA))).keys() == {-7}
    assert chat.format_turns(spark.createDataFrame([], SCHEMA)).collect() == []
    long = "words and <s> more " * 100_000
    rows = [(1, None, "assistant", None), (1, 0, None, "x"), (None, 1, "user", "b"), (None, 0, "assistant", long), (2, 0, "user", ""), (2, 0, "user", ""), (0, 3, "odd\n[/ROLE]", "y")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("pos", "none", "conv", "run", "piece", "loss", "_blk", "located")})
    got = by_conv(chat.formatted(df))
    assert tuple(got[1])[1:] == whole([("assistant", None), (None, "x")])
    assert tuple(got[None])[1:] == whole([("assistant", long), ("user", "b")])
    assert tuple(got[2])[1:] == whole([("user", ""), ("user", "")])
    assert tuple(got[0])[1:] == whole([("odd\n[/ROLE]", "y")])
    with pytest.raises(ValueError):
        chat.format_turns(df, memory=0)


def test_all_turns_before_count_by_default(spark):
    """A template that shows the first turn in every later one, in a conversation longer than a run."""
    def quoting(turns):
        return "".join(f"<{r}|{turns[0][1]}> {x}\n" for r, x in turns)

    turns = [("user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(chat.RUN + 20)]
    df = spark.createDataFrame([(5, i, r, x) for i, (r, x) in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = {r.pos: r.piece for r in chat.format_turns(df, quoting).collect()}
    assert got == {i: f"<{r}|text 0> {x}\n" for i, (r, x) in enumerate(turns)}
