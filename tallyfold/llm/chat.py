"""Chat formatting at token level.

The text of each turn is encoded on its own, where its row lies; reserved ids, which no text can
produce, are set around it. A conversation is the run of its turns; prefix sums over their lengths
give the places of the loss mask. Control strings that occur in a text get a backslash inside, so
that the rendered string can be read back as well as the ids.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import whole_groups

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"

# FIXED VALUES: the published split pattern of the vocabulary, and the control strings.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CONTROLS = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[END]")

SYS, SYS_END, USER, USER_END, ANSWER, ANSWER_END, ROLE, ROLE_END, END = range(len(CONTROLS))
_MARKS = {"system": (SYS, SYS_END), "user": (USER, USER_END), "assistant": (ANSWER, ANSWER_END)}
_ROLES = {start: role for role, (start, _) in _MARKS.items()}
_PLAIN = re.compile("|".join(f"{re.escape(c[0])}\\\\*{re.escape(c[1:])}" for c in CONTROLS))
_ESCAPED = re.compile("|".join(f"{re.escape(c[0])}\\\\+{re.escape(c[1:])}" for c in CONTROLS))


def escape(text: str) -> str:
    """A backslash after the first character of every control string, escaped ones included."""
    return _PLAIN.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][0] + m[0][2:], text)


class Codec:
    """Byte-level BPE whose ids after the vocabulary's last are the control strings."""

    def __init__(self, folder: str) -> None:
        with open(os.path.join(folder, VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.first = max(ranks.values()) + 1
        self._encoding = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self._encoding.encode_ordinary(escape(text))

    def decode(self, ids: np.ndarray) -> str:
        return self._encoding.decode_bytes(ids.tolist()).decode()

    def turn(self, role: str, text: str) -> tuple[list[int], int]:
        """Ids of one turn, and where its text begins among them."""
        if role in _MARKS:
            start, end = _MARKS[role]
            return [self.first + start, *self.encode(text), self.first + end], 1
        head = [self.first + ROLE, *self.encode(role), self.first + ROLE_END]
        return [*head, *self.encode(text), self.first + END], len(head)

    def rendered(self, ids: np.ndarray) -> str:
        return "".join(CONTROLS[a] if a is not None else self.decode(b) for a, b in self._parts(ids))

    def _parts(self, ids: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
        at = 0
        for place in np.flatnonzero(ids >= self.first):
            yield None, ids[at:place]
            yield int(ids[place]) - self.first, ids[place : place + 1]
            at = place + 1
        yield None, ids[at:]

    def turns(self, ids: np.ndarray) -> list[tuple[str, str]]:
        """(role, text) of every turn, read from the ids."""
        found: list[tuple[str, str]] = []
        role, text = "", ""
        for control, part in self._parts(ids):
            if control is None:
                text = unescape(self.decode(part))
            elif control in _ROLES:
                role = _ROLES[control]
            elif control == ROLE_END:
                role = text
            elif control != ROLE:
                found.append((role, text))
        return found


@lru_cache(maxsize=2)
def codec(folder: str) -> Codec:
    return Codec(folder)


def format_conversations(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokenizers: str = TOKENIZERS,
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``ids`` and ``loss_mask`` (1 on the ids of assistant texts).

    Turns follow ``turn`` (null last), then role and text, so that ties and repeated rows, which stay,
    have one order. A null text is empty, a null role an empty one; null is a conversation of its own.
    Any role is kept by name. An empty table gives an empty one; other columns are ignored.
    ``tokenizers`` is a folder that every executor has. A conversation is one row, hence one record in
    memory; its texts are encoded before they meet.
    """
    schema = "known boolean, conv long, turn long, role string, ids binary, start int, loss boolean, tie long"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(tokenizers)
        for batch in batches:
            columns = batch.to_pydict()
            turns = [made.turn(r, t) for r, t in zip(columns["role"], columns["text"])]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in ("known", "conv", "turn", "role")),
                    pa.array([np.array(ids, dtype=np.int32).tobytes() for ids, _ in turns], pa.binary()),
                    pa.array([start for _, start in turns], pa.int32()),
                    pa.array([r == "assistant" for r in columns["role"]], pa.bool_()),
                    batch.column("tie"),
                ],
                names=["known", "conv", "turn", "role", "ids", "start", "loss", "tie"],
            )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["known", "conv"]):
            ids = [np.frombuffer(b, dtype=np.int32) for b in table["ids"].to_pylist()]
            ends = np.cumsum([len(i) for i in ids])
            begins = np.concatenate([[0], ends[:-1]])
            loss = table["loss"].to_numpy(zero_copy_only=False)
            steps = np.zeros(int(ends[-1]) + 1, dtype=np.int32)
            np.add.at(steps, (begins + table["start"].to_numpy())[loss], 1)
            np.add.at(steps, (ends - 1)[loss], -1)
            mask = np.cumsum(steps)[:-1].astype(np.int8)
            known, conv = table["known"].to_numpy(zero_copy_only=False), table["conv"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], (conv[1:] != conv[:-1]) | (known[1:] != known[:-1])]))
            offsets = pa.array(np.append(begins[first], ends[-1]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(conv[i]) if known[i] else None for i in first], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
                    pa.ListArray.from_arrays(offsets, pa.array(mask)),
                ],
                names=["conv_id", "ids", "loss_mask"],
            )

    narrow = rows.select(
        F.col(conv_id).isNotNull().alias("known"),
        F.coalesce(F.col(conv_id).cast("long"), F.lit(0)).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.xxhash64(text).alias("tie"),
    )
    turns = narrow.mapInArrow(encode, schema)
    ordered = turns.repartition("known", "conv").sortWithinPartitions("known", "conv", F.asc_nulls_last("turn"), "role", "tie")
    return ordered.mapInArrow(assemble, "conv_id long, ids array<int>, loss_mask array<tinyint>")


def read_back(formatted: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """Digests of formatted conversations, from their ids and masks alone."""
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long"
    )

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = codec(tokenizers)
        for frame in frames:
            out = []
            for conv, ids, mask in zip(frame["conv_id"], frame["ids"], frame["loss_mask"]):
                ids, mask = np.asarray(ids), np.asarray(mask)
                turns = made.turns(ids)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
                loss = "".join(unescape(made.decode(ids[a:b])) for a, b in zip(edges[::2], edges[1::2]))
                out.append(
                    (
                        conv,
                        len(turns),
                        hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                        len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(),
                        len(made.rendered(ids)),
                        len(ids),
                    )
                )
            frame_out = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            frame_out["conv_id"] = frame_out["conv_id"].astype("Int64")
            yield frame_out

    return formatted.mapInPandas(scan, schema)
