import hashlib
import random

import numpy as np
import pytest

from tallyfold.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, ids string, known int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows():
    rng = random.Random(2)
    pieces = [*chat.CONTROLS, "\\", "<", "[", "/INST]", "s>", " ", "\n", "é", "漢", "🙂", "word ", "12345"]
    out = []
    for conv in range(30):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "assistant", "tool", "</s>", ""])
            out.append((conv, turn, role, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))))
    out += [(50, 1, "assistant", None), (50, None, "user", "last"), (50, 0, None, "no role"), (None, 0, "user", "null conversation")]
    out += [(51, 0, "assistant", "tie b"), (51, 0, "assistant", "tie a"), (51, 0, "assistant", "tie a")]
    out += [(52, 0, "assistant", "long " * 30_000), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    return [(*r, "x", 1) for r in out]


def test_conversations_read_back(spark):
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    formatted = chat.format_conversations(frame)
    found = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    conversations = {}
    for conv, turn, role, text, *_ in rows():
        conversations.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    assert set(found) == set(conversations)
    for conv, turns in conversations.items():
        if conv == 51:
            continue
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        got = found[conv]
        assert (got.n_turns, got.turns_sha256) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got.loss_chars, got.loss_sha256) == (len(loss), sha(loss))
    assert found[51].n_turns == 3 and found[51].loss_chars == 15
    again = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame.repartition(3))).collect()}
    assert again == found


def test_mask_covers_the_answers_only(spark):
    frame = spark.createDataFrame([(1, 0, "user", "question"), (1, 1, "assistant", "answer"), (1, 2, "assistant", "")], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(frame).first()
    made = chat.codec(chat.TOKENIZERS)
    ids, mask = np.array(row.ids), np.array(row.loss_mask)
    assert len(ids) == len(mask) and made.decode(ids[mask == 1]) == "answer"
    assert made.rendered(ids) == "[INST]question[/INST]<s>answer</s><s></s>"


@pytest.mark.parametrize("seed", range(20))
def test_escapes_are_reversible(seed):
    rng = random.Random(seed)
    pieces = [*chat.CONTROLS, "\\", "<", "[", "/", "s>", "INST]", "SYS>>"]
    for _ in range(200):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROLS)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.format_conversations(frame)).collect() == []
