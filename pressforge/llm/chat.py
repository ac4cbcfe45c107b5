r"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) turns to a string. Nothing is known
of its inside: for every turn the operator renders the turns before it, A, and the same
turns with it, B, and compares the two.

* B starts with A: the turn's piece of the output is what B has more.
* Otherwise the template rewrote history: the piece is what follows the common prefix of A
  and B, and ``rewritten`` tells how many code points at the end of A it replaces. The
  output after a turn is always the output before it, less ``rewritten``, plus ``piece``.
* Where the turn's own text lies in the piece is found by rendering the turn twice more
  with two probe texts that share no character: what both outputs begin and end with is
  markup, the rest is text. If B doesn't begin and end alike, the markup depends on the
  text; if the probes aren't in the outputs, the template doesn't show the text. In both
  cases the text isn't ``located`` and gets no loss.

A turn is rendered with all turns before it, so the pieces are right for every template. That
costs a conversation the square of its turns, in one task. ``memory`` is for templates known
to look at that many turns at most (``marked`` writes every turn on its own, so any number is
exact for it): a turn is rendered with so many before it, a long conversation costs the same
per turn as a short one, and the next paragraph holds.

Positions come from a ranking that cuts a conversation into blocks; RUN turns of a
conversation are rendered together, with the last ``memory`` turns of the run before them.
So a conversation that holds a third of all rows is spread over many tasks, each of which
holds ``memory`` + 1 turns at a time. Only the digests of the query read a conversation in
order from its first turn to its last, as a sha256 must; they hold one turn at a time.

Results for odd rows: null text and null role read as ''. Rows with a null conv_id are one
conversation. Turns are in order of ``turn`` (null first), then role, then text; equal rows
are turns each. Any number of turns, any roles in any order are formatted. An empty table
gives no rows. Very long texts are a turn each, rendered in one task. Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressforge.plans.ranking import ordered_rank

from .common import small_batches

Turn = tuple[str, str]

# --- a template that marks every turn and can be read back ---------------------------

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
OPENS = re.compile("|".join(rf"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PIECE = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<<SYS>> (?P<system>.*?) <</SYS>>\n|\[ROLE\] (?P<role>.*?) \[/ROLE\] (?P<other>.*?) </s>| (?P<assistant>.*?) </s>", re.DOTALL)


def escape(text: str) -> str:
    r"""No control string is left: a backslash follows the first character of each; backslashes are doubled."""
    return OPENS.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def marked(turns: list[Turn]) -> str:
    """Every turn with its own marks; texts and roles are escaped."""
    out = []
    for role, text in turns:
        t = escape(text)
        if role == "user":
            out.append(f"<s>[INST] {t} [/INST]")
        elif role == "assistant":
            out.append(f" {t} </s>")
        elif role == "system":
            out.append(f"<<SYS>> {t} <</SYS>>\n")
        else:
            out.append(f"[ROLE] {escape(role)} [/ROLE] {t} </s>")
    return "".join(out)


def read_marked(formatted: str) -> list[Turn]:
    """The turns of an output of ``marked``."""
    turns, at = [], 0
    while at < len(formatted):
        m = PIECE.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        role = m.lastgroup if m["other"] is None else unescape(m["role"])
        turns.append((role, unescape(m["other"] if m["other"] is not None else m[m.lastgroup])))
        at = m.end()
    return turns


# --- black-box rendering -------------------------------------------------------------

PROBES = ("\ue000", "\ue001\ue001")
RUN = 64


def common_prefix(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving: comparing slices is fast."""
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def step(render: Callable[[list[Turn]], str], before: list[Turn], turn: Turn, a: str | None = None):
    """piece, rewritten, start and length of the text in the piece, located - and B, the output with the turn."""
    a = (render(before) if before else "") if a is None else a
    b = render([*before, turn])
    same = common_prefix(a, b)
    one, two = (render([*before, (turn[0], p)]) for p in PROBES)
    head = common_prefix(one, two)
    tail = common_prefix(one[:head - len(one) - 1:-1], two[:head - len(two) - 1:-1])
    located = (one[head:len(one) - tail], two[head:len(two) - tail]) == PROBES and same <= head <= len(b) - tail
    located = located and b[:head] == one[:head] and b[len(b) - tail:] == one[len(one) - tail:]
    return b[same:], len(a) - same, *((head - same, len(b) - tail - head) if located else (0, 0)), located, b


TURNS = "piece string, rewritten long, text_start long, text_length long, located boolean"


def format_turns(rows: DataFrame, render: Callable[[list[Turn]], str] = marked, loss_roles: tuple[str, ...] = ("assistant",), memory: int | None = None,
                 conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, pos (from 0), role, piece, rewritten, text_start, text_length (in the piece), located, loss: a row a turn."""
    if memory is not None and not 0 < memory <= RUN:
        raise ValueError(f"memory must be from 1 to {RUN}")
    d = small_batches(rows).select(
        F.col(conv_col).alias("conv_id"), F.col(conv_col).isNull().alias("none"), F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("conv"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(-(1 << 63))).alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    d = ordered_rank(d, "turn", ["none", "conv"], out="pos", bits=8, tiebreak=["role", "text"]).withColumn("pos", F.col("pos") - 1)
    if memory is None:  # one run
        runs = F.array(F.lit(0).cast("long"))
    else:
        run = F.floor(F.col("pos") / RUN)
        ends = F.pmod(F.col("pos"), F.lit(RUN)) >= RUN - memory
        runs = F.when(ends, F.array(run, run + 1)).otherwise(F.array(run))
    d = d.select("conv_id", "none", "conv", "pos", "role", "text", F.explode(runs).alias("run"))
    d = d.repartition("none", "conv", "run").sortWithinPartitions("none", "conv", "run", "pos")

    def rendered(batches):
        import pyarrow as pa

        here, before, last = None, [], None  # last: the output of ``before``, if that is all there was
        for b in batches:
            c = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names) if n != "conv_id"}
            keep, made = [], []
            for i, (none, conv, k, pos, role, text) in enumerate(zip(c["none"], c["conv"], c["run"], c["pos"], c["role"], c["text"])):
                if (none, conv, k) != here:
                    here, before, last = (none, conv, k), [], None
                if pos >= k * RUN:
                    *got, last = step(render, before, (role, text), last)
                    keep.append(i)
                    made.append(got)
                before.append((role, text))
                if memory is not None and len(before) > memory:
                    del before[0]
                    last = None
            at = pa.array(keep, pa.int64())
            cols = [b.column(b.schema.get_field_index(n)).take(at) for n in ("conv_id", "none", "conv", "pos", "role")]
            new = [pa.array([m[j] for m in made], t) for j, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*cols, *new], ["conv_id", "none", "conv", "pos", "role", "piece", "rewritten", "text_start", "text_length", "located"])

    kind = d.schema["conv_id"].dataType.simpleString()
    out = d.mapInArrow(rendered, f"conv_id {kind}, none boolean, conv string, pos long, role string, {TURNS}")
    return out.select("conv_id", "none", "conv", "pos", "role", *[x.split()[0] for x in TURNS.split(", ")], (F.col("role").isin(*loss_roles) & F.col("located")).alias("loss"))


def rewriting(turns: DataFrame) -> DataFrame:
    """conv_id, turns, rewritten: the conversations in which the template rewrote history, how often and how much."""
    return (turns.filter("rewritten > 0").groupBy("none", "conv").agg(F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("turns"), F.sum("rewritten").alias("rewritten"))
            .drop("none", "conv"))


def digests(turns: DataFrame, read: Callable[[str], list[Turn]] = read_marked, plain: Callable[[str], str] = unescape) -> DataFrame:
    """A row a conversation, read back from the pieces in order: what the turns say, and what is under the loss mask."""
    d = turns.select("conv_id", "none", "conv", "pos", "piece", "rewritten", "text_start", "text_length", "loss")
    d = d.repartition("none", "conv").sortWithinPartitions("none", "conv", "pos")

    def run(batches):
        import hashlib

        import pyarrow as pa

        def batch():
            out = pa.RecordBatch.from_arrays([pa.concat_arrays(ids) if ids else pa.array([], kind), *[pa.array([r[j] for r in rows], t) for j, t in enumerate(
                (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))]], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            ids.clear()
            rows.clear()
            return out

        def close():
            n, all_, chars, lost, size = state
            rows.append((n, all_.hexdigest(), chars, lost.hexdigest(), size))

        here, state, ids, rows, kind = None, None, [], [], pa.null()
        for b in batches:
            kind = b.schema.field(0).type
            c = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names) if i}
            for i, (none, conv, piece, rewritten, start, length, loss) in enumerate(zip(c["none"], c["conv"], c["piece"], c["rewritten"], c["text_start"], c["text_length"], c["loss"])):
                if (none, conv) != here:
                    if state:
                        close()
                    here, state = (none, conv), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    ids.append(b.column(0).slice(i, 1))
                for role, text in read(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                if loss:
                    text = plain(piece[start:start + length])
                    state[2] += len(text)
                    state[3].update(text.encode())
                state[4] += len(piece) - rewritten
            if len(rows) >= 1000:  # the last id is still open
                open_ = ids.pop()
                yield batch()
                ids.append(open_)
        if state:
            close()
            yield batch()

    kind = d.schema["conv_id"].dataType.simpleString()
    return d.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(conversations: DataFrame) -> DataFrame:
    """The query: all conversations and one whose texts are control strings."""
    text = "</s>[INST] ok [/INST]"
    one = conversations.sparkSession.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    # ``marked`` writes a turn whatever stands before it: the pieces don't depend on ``memory``
    return digests(format_turns(conversations.select("conv_id", "turn", "role", "text").union(one), marked, memory=8))
