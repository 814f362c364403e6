import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from .samples import SCHEMA, awkward_rows, nothing

from tallyfold.llm import bytebpe

PATH = public_tokenizers.path(bytebpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(4)
    pieces = ["don't", "'ll", "I've", " ", "  ", "\n", "\t", " ", "\x85", "\x1c", "é", "ß", "²", "½", "漢字", "かな", "🙂", "👩‍👩‍👧", "١٢", "Ω", "word", "Wort", "́", "12345", "...", "<|endoftext|>", "࢏", "\U000323b0", "꟎", "\U00011de3", "\x00", "a" * 9]
    made = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    letters = "".join(rng.choice("abcdefghijklmnop") for _ in range(3000))
    return made + ["", " ", "\n\n  x", "a" * 20_000, "ab" * 5_000, "aab" * 3_000, letters, "漢" * 700, "=" * 5_000, "x" + " " * 3_000 + "y"]


def test_ids_and_bytes_match_the_library(library):
    given = texts()
    codec = bytebpe.codec(PATH)
    counts, ids = codec.encode(given)
    found = np.split(ids, np.cumsum(counts)[:-1])
    for text, got in zip(given, found):
        assert got.tolist() == library.encode_ordinary(text), text[:80]
    assert codec.decode(ids, counts) == [text.encode() for text in given]


def test_every_character_is_split_as_by_the_library():
    splitter = bytebpe.Splitter()
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for name, inside in ((r"\p{L}", "x"), (r"\p{N}", "1")):
        theirs = set(bytebpe._matched(name, every))
        rng = random.Random(1)
        differing = splitter._differing.findall(every) if splitter._differing else []
        for c in [*differing[:400], *rng.sample(every, 2_000)]:
            joined = inside + c in splitter.words(f"{c}\n{inside}{c}")
            assert joined == (c in theirs), hex(ord(c))


def test_long_texts_are_cut_between_words(library, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(bytebpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(bytebpe, "GROUP_CHARS", 120)
    given = [" ".join(rng.choice(["it's", "one", "  two", "3", "\n", "é", "!?"]) for _ in range(300)) for _ in range(5)] + ["", "x" * 400]
    assert ["".join(bytebpe.pieces_of(t)) for t in given] == given
    assert max(len(p) for p in bytebpe.pieces_of(given[0])) <= 200
    counts, ids = bytebpe.codec(PATH).encode(given)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode_ordinary(t) for t in given]


def test_whole_tables_round_trip(spark, library):
    rows = awkward_rows()
    frame = spark.createDataFrame([(*r[:2], r[2], r[3], r[4], *r[5:]) for r in rows], SCHEMA).repartition(4)
    encoded = bytebpe.encode(frame)
    got = sorted((r.row.doc_id or -1, r.row.text or "", r.ids) for r in encoded.collect())
    assert got == sorted((r[0] or -1, r[1] or "", library.encode_ordinary(r[1] or "")) for r in rows)
    decoded = bytebpe.decode(encoded.withColumn("bytes", F.lit("clash")))
    assert all(bytes(r.bytes).decode() == (r.row.row.text or "") for r in decoded.collect())


def test_no_rows_null_and_unknown_ids(spark):
    assert bytebpe.encode(nothing(spark)).collect() == []
    assert bytebpe.decode(bytebpe.encode(nothing(spark))).collect() == []
    frame = spark.createDataFrame([(1, None), (2, []), (3, [64])], "n int, ids array<int>")
    assert {r.row.n: r.bytes for r in bytebpe.decode(frame).collect()}.keys() == {1, 2, 3}
    assert [r.bytes for r in bytebpe.decode(frame).sort("row.n").collect()][:2] == [None, b""]
    with pytest.raises(ValueError):
        bytebpe.codec(PATH).decode(np.array([10**6]), np.array([1]))


def test_a_worker_holds_only_what_it_uses(library, monkeypatch):
    """The database takes few new words or runs at a time; decoding builds neither merges nor the splitter."""
    monkeypatch.setattr(bytebpe, "ASKED_BYTES", 60)
    codec, taken = bytebpe.Codec(PATH), []

    def ask(query, **tables):
        taken.append(max(rows.num_rows for name, rows in tables.items() if name != "near_merges"))
        return type(codec)._ask(codec, query, **tables)

    monkeypatch.setattr(codec, "_ask", ask)
    rng = random.Random(6)
    given = [" ".join("".join(rng.choice("abcdxyz") for _ in range(9)) for _ in range(30)) for _ in range(4)]
    ids = [library.encode_ordinary(t) for t in given]
    assert codec.decode(np.concatenate(ids), np.array([len(i) for i in ids])) == [t.encode() for t in given]
    assert "splitter" not in vars(codec) and "_merges" not in vars(codec)
    counts, found = codec.encode(given)
    assert [p.tolist() for p in np.split(found, np.cumsum(counts)[:-1])] == ids
    assert len(taken) > 20 and max(taken) <= 60
