"""Chat formatting at token level: segments are encoded separately, reserved ids are spliced between them, the loss
mask comes from prefix sums of segment lengths, and control strings inside texts are escaped reversibly.

A conversation's output is one row per turn, in order: ids, loss mask and the rendered text of that turn; its ids are
the concatenation.  Rows are encoded where they lie, then dealt by conversation and sorted; a conversation is read as
a stream of turns, so one of any length needs no more memory than its longest turn.

Template of a turn: the role's reserved id, the text's ids, the end id; rendered as "### User:\\n", text, "\\n</turn>\\n".
A role without a reserved id of its own is "### Role:", the encoded role, the break id.

Escaping: in a text or a role every control string, with any backslashes right before it, gets one more backslash;
unescaping takes one away.  A template's own control string always follows a line break or stands first, so the
rendered text can be told apart too.

Defined results: a null text or role is empty; a null conv_id is a conversation of its own; turns come by turn (null
first), then role, then text; repeated rows are turns like any other; no rows give no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Control strings and their reserved ids, which follow the vocabulary's own; fixed values of the template.
ROLE_MARKS = {"system": "### System:", "user": "### User:", "assistant": "### Assistant:"}
OTHER_ROLE = "### Role:"
BREAK = "\n"
TURN_END = "</turn>"
FIRST_RESERVED = 50257
RESERVED = {mark: FIRST_RESERVED + i for i, mark in enumerate([*ROLE_MARKS.values(), OTHER_ROLE, TURN_END, BREAK])}
TRAINED_ROLE = "assistant"
CONTROLS = [*ROLE_MARKS.values(), OTHER_ROLE, TURN_END, "<|endoftext|>"]
_CONTROL = "|".join(map(re.escape, CONTROLS))
_ESCAPE = re.compile(rf"(\\*)({_CONTROL})")
_UNESCAPE = re.compile(rf"\\(\\*)({_CONTROL})")
TURN_SCHEMA = "ids array<int>, loss_mask array<boolean>, formatted string"


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


_TOKENIZERS: dict = {}


def tokenizer(path: str):
    """This process's byte-level tokenizer; special strings in a text are ordinary text."""
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.encode_special_tokens = True
        _TOKENIZERS[path] = made
    return _TOKENIZERS[path]


def assemble(roles: list[str], texts: list[str], path: str) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """(ids, loss mask, rendered text) of each turn."""
    segments = [escape(t) for t in texts]
    named = [escape(r) for r in roles]
    encoded = [e.ids for e in tokenizer(path).encode_batch([*segments, *named], add_special_tokens=False)]
    out = []
    for role, name, segment, ids, name_ids in zip(roles, named, segments, encoded, encoded[len(texts):]):
        if role in ROLE_MARKS:
            head, shown = [RESERVED[ROLE_MARKS[role]]], ROLE_MARKS[role]
        else:
            head, shown = [RESERVED[OTHER_ROLE], *name_ids, RESERVED[BREAK]], f"{OTHER_ROLE} {name}"
        parts = [head, ids, [RESERVED[TURN_END]]]
        bounds = np.cumsum([0, *map(len, parts)])
        edge = np.zeros(bounds[-1] + 1, np.int8)
        if role == TRAINED_ROLE:
            edge[bounds[1]] += 1
            edge[bounds[2]] -= 1
        mask = np.cumsum(edge[:-1]) > 0
        out.append((np.concatenate([np.asarray(p, np.int32) for p in parts]), mask,
                    f"{shown}\n{segment}\n{TURN_END}\n"))
    return out


def read_back(ids: np.ndarray, mask: np.ndarray, path: str) -> tuple[str, str, str]:
    """(role, text, text under the mask) of a turn, from its ids and mask alone."""
    decode = lambda part: unescape(tokenizer(path).decode(part.tolist(), skip_special_tokens=False))
    marks = {RESERVED[m]: r for r, m in ROLE_MARKS.items()}
    end = int(np.flatnonzero(ids == RESERVED[TURN_END])[-1])
    if int(ids[0]) in marks:
        role, begin = marks[int(ids[0])], 1
    else:
        begin = int(np.flatnonzero(ids == RESERVED[BREAK])[0]) + 1
        role = decode(ids[1: begin - 1])
    return role, decode(ids[begin:end]), decode(ids[mask])


def format_turns(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """``conv_id, turn`` and the turn's ``ids, loss_mask, formatted``, dealt by conversation and sorted."""
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    kinds = rows.schema
    schema = (f"conv_id {kinds['conv_id'].dataType.simpleString()}, turn {kinds['turn'].dataType.simpleString()}, "
              f"role string, text string, {TURN_SCHEMA}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                made = assemble(part.column(2).to_pylist(), part.column(3).to_pylist(), vocabulary)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([m[0] for m in made], pa.list_(pa.int32())),
                     pa.array([m[1] for m in made], pa.list_(pa.bool_())), pa.array([m[2] for m in made])],
                    names=["conv_id", "turn", "role", "text", "ids", "loss_mask", "formatted"])

    made = rows.mapInArrow(run, schema)
    return made.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("role", "text")


def digests(turns: DataFrame, vocabulary: str) -> DataFrame:
    """One row per conversation, read back from its formatted turns as they stream by."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens",
                 "n_loss_tokens"]
        now, state, done, arrow = None, None, [], None

        def flush():
            out = pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], arrow), *[pa.array([d[i] for d in done]) for i in range(1, 8)]],
                names=names)
            done.clear()
            return out

        def close():
            if state:
                done.append((now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:]))

        for batch in batches:
            arrow = batch.column(0).type
            conv = batch.column(0).to_pylist()
            for i in range(batch.num_rows):
                if state is None or conv[i] != now:
                    close()
                    now, state = conv[i], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                ids = batch.column(1)[i].values.to_numpy()
                mask = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
                role, text, learned = read_back(ids, mask, vocabulary)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(batch.column(3)[i].as_py())
                state[5] += len(ids)
                state[6] += int(mask.sum())
            if len(done) >= 1000:
                yield flush()
        close()
        if done:
            yield flush()

    return turns.select("conv_id", "ids", "loss_mask", "formatted").mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long, n_tokens long, n_loss_tokens long")
