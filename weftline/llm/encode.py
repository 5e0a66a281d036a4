"""Encoding of a corpus with a public byte-level BPE tokenizer (problem 8).

Per partition, texts are cut into the tokenizer's words and words into pieces, at places no vocabulary entry can
reach across, so no merge can either. Pieces not seen before go to DuckDB as (piece, position, token) rows; a
recursive query joins them with the merge table and contracts each piece's pair of least rank, leftmost first, until
no pair is left, and an ordered aggregation gives each piece its ids. There is no shuffle, but where a scan has fewer partitions than cores.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from weftline.runtime import spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the word pattern of this tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 300_000  # words and pieces kept by a Python worker
DUCK_MEMORY = "256MB"

#: Equal pairs of least rank are contracted together: a merge makes only pairs of a later rank. Where they overlap, as
#: in a run of one token, every other one counts from the left.
CONTRACT = """
with recursive state(piece, pos, tok, done) as (
  select piece, pos, tok, false from fresh
  union all
  select piece, pos, case when taken then merged else tok end, done
  from (
    select *, coalesce(lag(taken) over (partition by piece order by pos), false) as eaten
    from (
      select *, rank is not null and rank = least_rank
        and (row_number() over (partition by piece, rank is not distinct from least_rank, island order by pos)) % 2 = 1 as taken
      from (
        select *, n - row_number() over (partition by piece, rank is not distinct from least_rank order by pos) as island
        from (
          select *, min(rank) over (partition by piece) as least_rank, min(rank) over (partition by piece) is null as done
          from (
            select s.piece, s.pos, s.tok, s.n, m.rank, m.merged
            from (
              select piece, pos, tok, lead(tok) over (partition by piece order by pos) as next,
                row_number() over (partition by piece order by pos) as n
              from state where not done
            ) s left join merges m on m.a = s.tok and m.b = s.next
          )
        )
      )
    )
  ) where not eaten
)
select piece, list(tok order by pos) as ids from state where done group by piece
"""


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(0x100 + i)
    return out


class Merges:
    """A vocabulary file as tables: byte -> id, (a, b) -> (rank, merged) and the entries' bytes."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = byte_alphabet()
        vocab = model["vocab"]
        back = {c: b for b, c in letters.items()}
        self.first = [vocab[letters[b]] for b in range(256)]
        self.rows = []
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rows.append((vocab[a], vocab[b], rank, vocab[a + b]))
        self.entries = [bytes(back[c] for c in token) for token in vocab if all(c in back for c in token)]
        self.bytes_of = {i: bytes(back[c] for c in token) for token, i in vocab.items() if all(c in back for c in token)}

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


class Encoder:
    """Encodes words with a cache; DuckDB contracts what the cache doesn't hold."""

    def __init__(self, path: str = VOCABULARY):
        merges = Merges(path)
        self.first = merges.first
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": DUCK_MEMORY})
        a, b, rank, merged = (pa.array(c, pa.int32()) for c in zip(*merges.rows))
        self.con.register("merge_rows", pa.table({"a": a, "b": b, "rank": rank, "merged": merged}))
        self.con.execute("create table merges as select * from merge_rows")
        self.word = regex.compile(PATTERN)
        self.across: dict[tuple[int, int], list[tuple[bytes, bytes]]] = {}
        for entry in merges.entries:
            for i in range(1, len(entry)):
                if entry[i] & 0xC0 != 0x80:  # a character may begin here
                    self.across.setdefault((entry[i - 1], entry[i]), []).append((entry[:i], entry[i:]))
        self.joint: dict[str, bool] = {}
        self.pieces: dict[str, list[int]] = {}

    def joins(self, two: str) -> bool:
        """Whether some vocabulary entry can hold the end of the first character and the begin of the second."""
        known = self.joint.get(two)
        if known is None:
            x, y = (c.encode("utf-8", "surrogatepass") for c in two)
            known = self.joint[two] = any(
                (x.endswith(left) or left.endswith(x)) and (y.startswith(right) or right.startswith(y))
                for left, right in self.across.get((x[-1], y[0]), ())
            )
        return known

    def cut(self, word: str) -> list[str]:
        out, start = [], 0
        for i in range(1, len(word)):
            if not self.joins(word[i - 1 : i + 1]):
                out.append(word[start:i])
                start = i
        out.append(word[start:])
        return out

    def contract(self, pieces: list[str]) -> None:
        number, pos, tok = [], [], []
        for k, piece in enumerate(pieces):
            raw = piece.encode("utf-8", "surrogatepass")
            number += [k] * len(raw)
            pos += range(len(raw))
            tok += [self.first[b] for b in raw]
        fresh = pa.table({"piece": pa.array(number, pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": pa.array(tok, pa.int32())})
        self.con.register("fresh", fresh)
        for k, ids in self.con.execute(CONTRACT).fetchall():
            self.pieces[pieces[k]] = ids
        self.con.unregister("fresh")

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        if len(self.pieces) > CACHE:
            self.pieces.clear()
        if len(self.joint) > 10 * CACHE:
            self.joint.clear()
        cuts: dict[str, list[str]] = {}
        words = [self.word.findall(text) if text else [] for text in texts]
        for row in words:
            for word in row:
                if word not in cuts:
                    cuts[word] = self.cut(word)
        fresh = list({piece for parts in cuts.values() for piece in parts if piece not in self.pieces})
        size, group = 0, []
        for piece in fresh:
            group.append(piece)
            size += len(piece)
            if size > 200_000:
                self.contract(group)
                size, group = 0, []
        if group:
            self.contract(group)
        whole = {word: [i for part in parts for i in self.pieces[part]] for word, parts in cuts.items()}
        return [[i for word in row for i in whole[word]] for row in words]


@lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY) -> Encoder:
    return Encoder(path)


ROWS = 500  # texts encoded together


def _encode(path: str, counts_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            text = batch.schema.get_field_index("text")
            for low in range(0, batch.num_rows, ROWS):
                part = batch.slice(low, ROWS)
                ids = coder.encode(part.column(text).to_pylist())
                kept = [part.column(i) for i in range(part.num_columns) if i != text]
                made = pa.array([len(x) for x in ids], pa.int64()) if counts_only else pa.array(ids, pa.list_(pa.int32()))
                names = [n for i, n in enumerate(part.schema.names) if i != text]
                yield pa.record_batch([*kept, made], [*names, "tokens" if counts_only else "ids"])

    return run


def token_ids(documents: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row of documents; null and empty texts both give an empty list.

    Spellings of special tokens are ordinary text. A lone surrogate can't occur in Spark's strings.
    """
    return spread(documents.select("doc_id", "text"), "doc_id").mapInArrow(_encode(path, False), "doc_id bigint, ids array<int>")


def token_counts(documents: DataFrame, columns: list[str], path: str = VOCABULARY) -> DataFrame:
    """The named columns and tokens, the number of ids; the ids themselves never leave the Python worker."""
    named = documents.select(*columns, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema if f.name != "text")
    return spread(named, columns[0]).mapInArrow(_encode(path, True), f"{schema}, tokens bigint")
