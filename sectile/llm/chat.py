"""Chat formatting from an event log.

An event is (conv_id, turn, seq, kind, role, text). `message` starts a message at its turn, `delta` adds to the last
message of the turn (or starts one), `edit` replaces its text, `regenerate` empties it for new deltas and undoes what
was logged earlier for later turns. A null kind is a message; null texts and roles are empty.

The log is partitioned by conversation and sorted by turn and sequence, and folded as a stream: a turn needs only its
own events and the latest regeneration of an earlier turn, so a conversation of any length passes through a task in
bounded memory, one message at a time.

The template writes `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts a backslash is put between `<` and
`|` (and one more where backslashes stand there already), so no control string can be written from within and the
original comes back exactly; line ends and backslashes in roles are written as `\\n` and `\\\\`. The loss mask covers
the texts of assistant turns, without the marks around them.

Defined results: rows of one conversation with equal turn and sequence are told apart by role, then text, and each
repeated message is a turn; a null conv_id is a conversation of its own; null turns come first; extra columns, clashing
ones too, play no part; a very long text is one message, held in memory while it is folded; an empty log has no
conversations.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_fold, only

START, END = "<|im_start|>", "<|im_end|>"
LEARNT = "assistant"
_INNER, _OUTER = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_PIECE = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)
#: Messages of an output batch at most.
BATCH = 256


def escape(text: str) -> str:
    return _INNER.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _OUTER.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _turns(events):
    """(conv_id, turn, role, text) of the messages that stand, from events in order."""
    at, last, past, now, open_ = None, None, None, None, []
    for conv, turn, seq, kind, role, text in events:
        if (conv, turn) != at:
            yield from ((*at, r, "".join(t)) for r, t in open_)
            if at is None or at[0] != conv:
                past = None
            elif now is not None:
                past = now if past is None else max(past, now)
            at, now, open_ = (conv, turn), None, []
        last = -(1 << 63) if seq is None else seq
        if past is not None and last < past:
            continue
        kind, role, text = kind or "message", role or "", text or ""
        if kind == "message" or not open_:
            open_.append((role, [] if kind == "regenerate" else [text]))
        elif kind == "delta":
            open_[-1][1].append(text)
        elif kind == "edit":
            open_[-1] = (open_[-1][0], [text])
        elif kind == "regenerate":
            open_[-1] = (open_[-1][0], [])
        else:
            raise ValueError(f"unknown kind of event: {kind}")
        if kind == "regenerate":
            now = last
    if at is not None:
        yield from ((*at, r, "".join(t)) for r, t in open_)


_COLUMNS = ("conv_id", "turn", "seq", "kind", "role", "text")


def _sorted(events: DataFrame) -> DataFrame:
    return only(events, *_COLUMNS).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "seq", "role", "text")


def _stream(batches):
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(len(_COLUMNS))))


def _batched(rows, names):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == BATCH:
            yield dict(zip(names, zip(*held)))
            held = []
    if held:
        yield dict(zip(names, zip(*held)))


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): the final messages, in order within a partition."""
    kinds = events.schema
    schema = T.StructType([kinds["conv_id"], kinds["turn"], T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    return arrow_fold(_sorted(events), lambda batches: _batched(_turns(_stream(batches)), schema.names), schema)


def render(final: DataFrame) -> DataFrame:
    """messages() -> (conv_id, turn, piece, at, loss_from, loss_to). The pieces of a conversation in a row are its
    text; at, loss_from and loss_to count code points from its start; the last two are null outside the loss."""
    long = T.LongType()
    schema = T.StructType([final.schema["conv_id"], final.schema["turn"], T.StructField("piece", T.StringType()), *(T.StructField(x, long) for x in ("at", "loss_from", "loss_to"))])

    def run(batches):
        def rows():
            here, at = object(), 0
            for b in batches:
                for conv, turn, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                    if conv != here:
                        here, at = conv, 0
                    head = f"{START}{escape_role(role)}\n"
                    body = escape(text)
                    piece = f"{head}{body}{END}\n"
                    loss = (at + len(head), at + len(head) + len(body)) if role == LEARNT else (None, None)
                    yield conv, turn, piece, at, *loss
                    at += len(piece)

        yield from _batched(rows(), schema.names)

    return arrow_fold(final, run, schema)


def digests(rendered: DataFrame) -> DataFrame:
    """Read back from render(): one row for each conversation."""
    long, text = T.LongType(), T.StringType()
    schema = T.StructType([rendered.schema["conv_id"], T.StructField("n_turns", long), T.StructField("turns_sha256", text), T.StructField("loss_chars", long), T.StructField("loss_sha256", text), T.StructField("formatted_chars", long)])

    def run(batches):
        def rows():
            here, state = object(), None
            for b in batches:
                for conv, _, piece, at, lo, hi in zip(*(b.column(i).to_pylist() for i in range(6))):
                    if conv != here:
                        if state:
                            yield here, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]
                        here, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    role, body = _PIECE.fullmatch(piece).groups()
                    state[0] += 1
                    state[1].update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
                    if lo is not None:
                        learnt = unescape(piece[lo - at : hi - at])
                        state[2] += len(learnt)
                        state[3].update(learnt.encode())
                    state[4] += len(piece)
            if state:
                yield here, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        yield from _batched(rows(), schema.names)

    return arrow_fold(rendered, run, schema)


def from_turns(rows: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as an event log."""
    return only(rows, "conv_id", "turn", "role", "text").select("conv_id", "turn", F.col("turn").cast("long").alias("seq"), F.lit("message").alias("kind"), "role", "text")


