"""Byte-level BPE, encoding and decoding, by recursive queries of DuckDB inside each partition.

A task splits its texts into words, numbers the distinct ones and lays them out as rows of (word,
position, token). A recursive query joins neighbouring tokens with the merge table and contracts each
word's leftmost pair of least rank, until no word has a pair left; the words' ids then go back to
their places. Decoding cuts ids into runs, joins the distinct runs with the vocabulary and puts their
bytes together by an ordered aggregation. Nothing is shuffled: rows stay where they are.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property, lru_cache

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from tallyfold.llm.common import packed, stretches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECE_CHARS = 1_000_000  # a longer text is cut between words
GROUP_CHARS = 1_000_000  # texts that are encoded together
GROUP_IDS = 500_000  # ids that are decoded together
KNOWN = 500_000  # words, or runs of ids, that a worker remembers before it starts anew
ASKED_BYTES = 250_000  # of new words, or runs of ids, that one query of the database takes
SHORT_WORD = 128  # bytes; longer words contract all repeats of a pair at once where that is the same

# FIXED VALUES: the letters, numbers and white space below U+0100.
_LETTERS, _NUMBERS, _SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"

_BEYOND = re.compile("[^\x00-\xff]")
_CUT = re.compile(r"(?<=[!-~]) (?=[!-~])")

_RECURSION = """
WITH RECURSIVE state AS (
  SELECT word, pos, tok, next_tok, next_pos, false AS done FROM start_rows
  UNION ALL
  (WITH pairs AS (
     SELECT s.*, m.made FROM state s LEFT JOIN {merges} m ON m.pair = s.tok * {base} + s.next_tok WHERE NOT s.done),
   {chosen}
   SELECT p.word, p.pos, {tok}, {next_tok}, {next_pos}, best.word IS NULL FROM pairs p LEFT JOIN best ON best.word = p.word {joins})
)
SELECT word, tok FROM state WHERE done ORDER BY word, pos
"""

# A contracted pair keeps its second row, whose next token stands; the first row goes.
_LEFTMOST = _RECURSION.format(
    merges="merges",
    base=1 << 32,
    chosen="""best AS (
     SELECT word, min(made * 4294967296 + pos) AS key, arg_min(next_pos, made * 4294967296 + pos) AS last
     FROM pairs WHERE made IS NOT NULL GROUP BY word)""",
    tok="CASE WHEN p.pos = best.last THEN best.key >> 32 ELSE p.tok END",
    next_tok="CASE WHEN p.next_pos = (best.key & 4294967295) THEN best.key >> 32 ELSE p.next_tok END",
    next_pos="CASE WHEN p.next_pos = (best.key & 4294967295) THEN best.last ELSE p.next_pos END",
    joins="WHERE best.word IS NULL OR p.pos <> (best.key & 4294967295)",
)
# All occurrences of a word's least pair, every second one where they overlap, contract in one step, up to
# the first whose new token makes a pair of lower rank with a token beside it.
_REPEATS = _RECURSION.format(
    merges="near_merges",
    base=1 << 32,
    chosen="""best AS (SELECT word, min(made) AS made FROM pairs WHERE made IS NOT NULL GROUP BY word),
   heads AS (
     SELECT p.*, lag(next_pos) OVER along IS DISTINCT FROM pos AS begins, row_number() OVER along AS n
     FROM pairs p JOIN best USING (word, made) WINDOW along AS (PARTITION BY word ORDER BY pos)),
   numbered AS (
     SELECT *, n - max(CASE WHEN begins THEN n END) OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING) AS nth FROM heads),
   lowering AS (
     SELECT h.word, min(h.n) AS n FROM numbered h
       LEFT JOIN pairs a ON a.word = h.word AND a.next_pos = h.pos LEFT JOIN pairs z ON z.word = h.word AND z.pos = h.next_pos
       LEFT JOIN near_merges la ON la.pair = a.tok * 4294967296 + h.made LEFT JOIN near_merges lz ON lz.pair = h.made * 4294967296 + z.next_tok
       LEFT JOIN near_merges lt ON lt.pair = h.made * 4294967296 + h.made
     WHERE h.nth % 2 = 0 AND least(la.made, lz.made, lt.made) < h.made GROUP BY h.word),
   taken AS (
     SELECT h.word, h.pos, h.next_pos, h.made FROM numbered h LEFT JOIN lowering l ON l.word = h.word
     WHERE h.nth % 2 = 0 AND (l.n IS NULL OR h.n <= l.n))""",
    tok="coalesce(ending.made, p.tok)",
    next_tok="coalesce(following.made, p.next_tok)",
    next_pos="coalesce(following.next_pos, p.next_pos)",
    joins="""LEFT JOIN taken ending ON ending.word = p.word AND ending.next_pos = p.pos
     LEFT JOIN taken following ON following.word = p.word AND following.pos = p.next_pos
   WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.word = p.word AND t.pos = p.pos)""",
)
_DECODE = """
SELECT unhex(string_agg(hex, '' ORDER BY pos)) AS bytes, count(hex) AS known
FROM run_rows LEFT JOIN {pieces} USING (tok) GROUP BY run ORDER BY run
"""


class Splitter:
    """The words of a text under the published pattern, as the encoder's library cuts them."""

    def __init__(self) -> None:
        self._narrow = re.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
            rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
        )
        self._wide = regex.compile(public_tokenizers.PATTERN)
        # The two regular expression engines know different editions of Unicode.
        pattern, differing = public_tokenizers.PATTERN, set()
        for name in (r"\p{L}", r"\p{N}"):
            more, less = set(), set()
            for first in range(0, 0x110000, 0x4000):  # a few characters at a time, to hold little
                some = "".join(chr(c) for c in range(first, first + 0x4000) if not 0xD800 <= c < 0xE000)
                theirs, ours = set(_matched(name, some)), set(regex.findall(name, some))
                more |= theirs - ours
                less |= ours - theirs
            differing |= more | less
            pattern = pattern.replace(name, f"[{name}{_ranges(more)}{f'--[{_ranges(less)}]' if less else ''}]")
        self._exact = regex.compile(pattern, flags=regex.V1)
        self._differing = regex.compile(f"[{_ranges(differing)}]") if differing else None

    def words(self, text: str) -> list[str]:
        if not _BEYOND.search(text):
            return self._narrow.findall(text)
        if self._differing is not None and self._differing.search(text):
            return self._exact.findall(text)
        return self._wide.findall(text)


def _ranges(characters: set[str]) -> str:
    """The characters as the inside of a set of a regular expression."""
    codes = np.array(sorted(map(ord, characters)), dtype=np.int64)
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1) if len(codes) else []
    return "".join(f"\\U{run[0]:08x}-\\U{run[-1]:08x}" for run in runs)


def _matched(pattern: str, text: str) -> str:
    """What ``pattern`` matches of ``text`` in the regular expressions of the encoder's library."""
    alone = {bytes([b]): b for b in range(256)}
    return bytes(tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=alone, special_tokens={}).encode_ordinary(text)).decode()


def pieces_of(text: str) -> Iterator[str]:
    """The text in parts of about ``PIECE_CHARS``, cut before single spaces between words."""
    start = 0
    while len(text) - start > 2 * PIECE_CHARS:
        cut = _CUT.search(text, start + PIECE_CHARS)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class _Known:
    """Distinct keys with the values that each stands for; it starts anew when it is full."""

    def __init__(self, kind: type) -> None:
        self._kind = kind
        self._clear()

    def _clear(self) -> None:
        self._keys = pa.array([], pa.binary())
        self._sizes = np.zeros(0, dtype=np.int64)
        self._values = np.zeros(0, dtype=self._kind)

    def of(self, keys: pa.Array, make: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """How many values the keys stand for, and the values; ``make`` gives those of keys not met before."""
        if len(self._keys) > KNOWN:
            self._clear()
        found = pc.index_in(keys, value_set=self._keys)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        new = keys.filter(found.is_null()).dictionary_encode()
        if len(new):
            at[found.is_null().to_numpy(zero_copy_only=False)] = len(self._keys) + new.indices.to_numpy()
            slices = stretches(pc.binary_length(new.dictionary).to_numpy().astype(np.int64), ASKED_BYTES)
            made = [make(new.dictionary.slice(part.start, part.stop - part.start)) for part in slices]
            sizes, values = (np.concatenate(parts) for parts in zip(*made))
            self._keys = pa.concat_arrays([self._keys, new.dictionary])
            self._sizes = np.concatenate([self._sizes, sizes])
            self._values = np.concatenate([self._values, values])
        begins = (np.cumsum(self._sizes) - self._sizes)[at]
        sizes = self._sizes[at]
        ends = np.cumsum(sizes)
        return sizes, self._values[np.arange(sizes.sum()) + np.repeat(begins - (ends - sizes), sizes)]


class Codec:
    """The merge table and the vocabulary in a DuckDB database of this worker's memory, each when it is first needed."""

    def __init__(self, path: str) -> None:
        self._path = path
        ranks = self._ranks()
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.tokens = pa.array(list(ranks), pa.binary())
        self.token_ids = np.array(list(ranks.values()), dtype=np.int32)
        self.opens = np.zeros(max(ranks.values()) + 1, dtype=bool)
        self.opens[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self._words = _Known(np.int32)
        self._runs = _Known(np.uint8)
        self._db = duckdb.connect(config={"threads": 1})

    def _ranks(self) -> dict[bytes, int]:
        with open(self._path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}

    @cached_property
    def splitter(self) -> Splitter:
        return Splitter()

    @cached_property
    def _merges(self) -> str:
        ranks = self._ranks()
        merges = (
            part
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
            for part in (ranks[token[:i]], ranks[token[i:]], rank)
        )
        left, right, made = np.fromiter(merges, dtype=np.int64).reshape(-1, 3).T
        return self._stored("merges", pa.table({"pair": left * (1 << 32) + right, "made": np.ascontiguousarray(made)}))

    @cached_property
    def _pieces(self) -> str:
        return self._stored("pieces", pa.table({"tok": self.token_ids, "hex": [token.as_py().hex() for token in self.tokens]}))

    def _stored(self, name: str, rows: pa.Table) -> str:
        self._db.register("given", rows)
        self._db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self._db.unregister("given")
        return name

    def _ask(self, query: str, **tables: pa.Table) -> pa.Table:
        for name, rows in tables.items():
            self._db.register(name, rows)
        try:
            return self._db.sql(query).to_arrow_table()
        finally:
            for name in tables:
                self._db.unregister(name)

    def _near_merges(self, letters: np.ndarray) -> pa.Table:
        """The merges of tokens that consist of the given bytes: a small table for rare long words, which take many steps."""
        present = np.zeros(256, dtype=bool)
        present[letters] = True
        starts = np.array(self.tokens.buffers()[1]).view(np.int32)[: len(self.tokens)]
        within = np.logical_and.reduceat(present[np.frombuffer(self.tokens.buffers()[2], dtype=np.uint8)], starts)
        usable = pa.table({"made": self.token_ids[within].astype(np.int64)})
        return self._ask(f"SELECT * FROM {self._merges} SEMI JOIN usable USING (made)", usable=usable)

    def _encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of distinct words, and their tokens one word after the other."""
        found = pc.index_in(words, value_set=self.tokens)
        whole = found.is_valid().to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(words).to_numpy().astype(np.int64)
        letters = np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8)
        word = np.repeat(np.arange(len(words)), sizes)
        pos = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        tok = self.bytes[letters]
        within = pos + 1 < sizes[word]
        columns = {
            "word": word,
            "pos": pos,
            "tok": tok,
            "next_tok": np.where(within, np.append(tok[1:], -1), -1),
            "next_pos": np.where(within, pos + 1, -1),
        }
        done = [(np.flatnonzero(whole), self.token_ids[found.drop_null().to_numpy()])]
        short = sizes <= SHORT_WORD
        for chosen, query in ((short & ~whole, _LEFTMOST), (~short & ~whole, _REPEATS)):
            if chosen.any() and self._merges:
                rows = chosen[word]
                tables = {"start_rows": pa.table({k: v[rows] for k, v in columns.items()})}
                if query is _REPEATS:
                    tables["near_merges"] = self._near_merges(letters[rows])
                result = self._ask(query, **tables)
                done.append((result["word"].to_numpy(), result["tok"].to_numpy()))
        word = np.concatenate([w for w, _ in done])
        ids = np.concatenate([t for _, t in done])[np.argsort(word, kind="stable")].astype(np.int32)
        return np.bincount(word, minlength=len(words)), ids

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of the texts, and their tokens one text after the other."""
        counts = np.zeros(len(texts), dtype=np.int64)
        parts = [np.zeros(0, dtype=np.int32)]
        group: list[str] = []
        owners: list[tuple[int, int]] = []
        chars = 0

        def close() -> None:
            sizes, ids = self._words.of(pa.array(group, pa.string()).cast(pa.binary()), self._encoded)
            parts.append(ids)
            np.add.at(counts, np.repeat([i for i, _ in owners], [n for _, n in owners]), sizes)

        for i, text in enumerate(texts):
            for piece in pieces_of(text):
                words = self.splitter.words(piece)
                group += words
                owners.append((i, len(words)))
                chars += len(piece)
                if chars >= GROUP_CHARS:
                    close()
                    group, owners, chars = [], [], 0
        if group:
            close()
        return counts, np.concatenate(parts)

    def _decoded(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Byte counts of distinct runs of ids, and their bytes one run after the other."""
        sizes = pc.binary_length(runs).to_numpy() // 4
        rows = {
            "run": np.repeat(np.arange(len(sizes)), sizes),
            "pos": np.arange(sizes.sum()),
            "tok": np.frombuffer(b"".join(runs.to_pylist()), dtype=np.int32),
        }
        made = self._ask(_DECODE.format(pieces=self._pieces), run_rows=pa.table(rows))
        if (made["known"].to_numpy() != sizes).any():
            raise ValueError("an id is not in the vocabulary")
        data = np.frombuffer(b"".join(made["bytes"].to_pylist()), dtype=np.uint8)
        return pc.binary_length(made["bytes"]).to_numpy().astype(np.int64), data

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of id sequences of the given lengths that follow one another."""
        if len(ids) == 0:
            return [b""] * len(counts)
        if ids.min() < 0 or ids.max() >= len(self.opens):
            raise ValueError("an id is not in the vocabulary")
        begins = np.concatenate([[0], np.cumsum(counts)])
        cut = self.opens[ids]
        cut[begins[:-1][counts > 0]] = True
        starts = np.append(np.flatnonzero(cut), len(ids))
        sizes, parts, first = [], [], 0
        while first < len(starts) - 1:
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + GROUP_IDS, "right")) - 1)
            held = ids[starts[first] : starts[last]].astype(np.int32)
            offsets = ((starts[first : last + 1] - starts[first]) * 4).astype(np.int32)
            runs = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(offsets), pa.py_buffer(held)])
            size, data = self._runs.of(runs, self._decoded)
            sizes.append(size)
            parts.append(data.tobytes())
            first = last
        data = b"".join(parts)
        edges = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])[np.searchsorted(starts, begins)]
        return [data[a:b] for a, b in zip(edges[:-1], edges[1:])]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None, vocabulary: str | None = None) -> DataFrame:
    """Every row as ``row`` (a struct of the columns in ``carry``, all by default) with ``ids``, its text's tokens.

    No special tokens; their strings are ordinary text. A null or empty text has no ids. Repeated rows
    stay, equal texts have equal ids, an empty table gives an empty one and no column name can clash.
    A text of any length is cut between words, so that only a word without spaces has to be one piece.
    ``vocabulary`` is a rank file that every executor has, by default the public one.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in stretches(pc.binary_length(batch.column("text")).to_numpy(), GROUP_CHARS):
                part = batch.slice(rows.start, rows.stop - rows.start)
                counts, ids = codec(path).encode(part.column("text").to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("row"), lists], names=["row", "ids"])

    kept = F.struct("*") if carry is None else F.struct(*carry)
    narrow = docs.select(kept.alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return narrow.mapInArrow(encoded, StructType([narrow.schema["row"], StructField("ids", ArrayType(IntegerType()))]))


def decode(rows: DataFrame, ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """Every row as ``row`` (a struct of all its columns) with ``bytes``, what its ids stand for.

    Null ids give null, no ids empty bytes; an id outside the vocabulary fails the job. Repeated rows
    stay, an empty table gives an empty one and no column name can clash.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy().astype(np.int64)
            for rows in stretches(lengths, GROUP_IDS):
                part = batch.slice(rows.start, rows.stop - rows.start)
                given = part.column("ids")
                found = codec(path).decode(given.flatten().to_numpy(zero_copy_only=False), lengths[rows])
                values = pa.array([b if k else None for b, k in zip(found, given.is_valid().to_pylist())], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("row"), values], names=["row", "bytes"])

    narrow = packed(rows, ids=F.col(ids).cast("array<int>"))
    return narrow.mapInArrow(decoded, StructType([narrow.schema["row"], StructField("bytes", BinaryType())]))
