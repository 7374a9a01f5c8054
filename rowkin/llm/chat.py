"""Chat formatting at the level of tokens.

The segments of a turn (role, text) are encoded apart, and reserved ids, which no text can
make, are spliced between them. The loss mask is a prefix sum over +1 where a segment
under loss begins and -1 where it ends. Control strings inside a text are escaped before
they are encoded, so they never stand in the rendered form but where the template puts them.

Turns are encoded where they lie, before any shuffle. A conversation's turns then stream by
in order; a task holds one batch of turns, however long a conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import modest, small

#: Rendered forms of the reserved ids, which follow the vocabulary in this order.
CONTROL = ("<turn>", "</role>", "</turn>")
OPEN, SAID, CLOSE = range(3)
UNDER_LOSS = "assistant"
_CONTROL = re.compile(r"\\|<(?=turn>|/role>|/turn>)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    r"""``\`` doubled, and a ``\`` after the ``<`` of each control string."""
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def assemble(role: str, text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """ids (int32) and loss mask (bool) of one turn."""
    t = tokenizer(path)
    first = t.get_vocab_size()
    said, body = (t.encode(escape(x), add_special_tokens=False).ids for x in (role, text))
    ids = np.array([first + OPEN, *said, first + SAID, *body, first + CLOSE], np.int32)
    edges = np.zeros(len(ids) + 1, np.int32)
    if role == UNDER_LOSS:
        edges[len(said) + 2] += 1
        edges[len(said) + 2 + len(body)] -= 1
    return ids, np.cumsum(edges)[:-1] > 0


def render(ids: np.ndarray, path: str) -> list[str]:
    """The rendered segments of ``ids``: control strings and the escaped texts between them, in turn."""
    t, out, at = tokenizer(path), [], 0
    first = t.get_vocab_size()
    for i in [*np.flatnonzero(ids >= first), len(ids)]:
        out.append(t.decode(ids[at:i].tolist(), skip_special_tokens=False) if i > at else "")
        if i < len(ids):
            out.append(CONTROL[ids[i] - first])
        at = i + 1
    return out


def formatted(turns: DataFrame, path: str, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, ids, loss_mask of each row. Null role or text: empty. Works row by row, without a shuffle."""
    plain = modest(turns).select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            made = [assemble(x, y, path) for x, y in zip(b.column("role").to_pylist(), b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), pa.array([x.tolist() for x, _ in made], pa.list_(pa.int32())), pa.array([y.tolist() for _, y in made], pa.list_(pa.bool_()))], ["conv_id", "turn", "ids", "loss_mask"])

    return plain.mapInArrow(encode, "conv_id long, turn long, ids array<int>, loss_mask array<boolean>")


def read_back(made: DataFrame, path: str) -> DataFrame:
    """What the tokens of ``formatted`` say, a row a conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest over a whole conversation is sequential, so its turns meet in one task, in order
    (by turn, nulls first, then by ids); they are read as a stream and never held together.
    """
    placed = made.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        now, open_ = None, False
        done: list[dict] = []

        def close() -> None:
            done.append({"conv_id": now, "n_turns": n, "turns_sha256": all_.hexdigest(), "loss_chars": chars, "loss_sha256": loss.hexdigest(), "formatted_chars": shown})

        for b in batches:
            for conv, ids, mask in zip(b.column("conv_id").to_pylist(), b.column("ids"), b.column("loss_mask")):
                if not open_ or conv != now:
                    if open_:
                        close()
                    now, open_, n, chars, shown = conv, True, 0, 0, 0
                    all_, loss = hashlib.sha256(), hashlib.sha256()
                ids, mask = ids.values.to_numpy(), mask.values.to_numpy(zero_copy_only=False)
                parts = render(ids, path)
                said, body = unescape(parts[2]), unescape(parts[4])
                if [parts[i] for i in (1, 3, 5)] != list(CONTROL):
                    raise ValueError(f"damaged turn in conversation {conv}")
                under = unescape(tokenizer(path).decode(ids[mask].tolist(), skip_special_tokens=False)) if mask.any() else ""
                n, chars, shown = n + 1, chars + len(under), shown + sum(map(len, parts))
                all_.update(f"{said}\n{body}\n".encode())
                loss.update(under.encode())
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
        if open_:
            close()
        yield pa.RecordBatch.from_pylist(done, schema)

    return placed.mapInArrow(digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
