"""Byte-level BPE ids of whole texts and the bytes behind ids, with the tiktoken library and a local rank file.

Null text is empty text and has no ids. A long text is cut before the library sees it, but only where the
pre-splitting pattern ends a match whatever follows: between a character that is not white space and one that
is, and before the last character of a long run of white space. Such a run is one match of the pattern up to
its last character; it goes to the merges directly, as the library's pattern engine overflows on it.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from hazegrid.llm.columns import added

#: Characters given to the library at once.
PIECE = 1 << 16
#: A longer run of white space is encoded apart.
RUN = 1000

#: The white space of Unicode, as the pattern's \s has it.
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_END = re.compile(f"(?<=[^{_WHITE}])[{_WHITE}]")
_LONG = re.compile(f"[{_WHITE}]{{{RUN},}}")


@functools.lru_cache(4)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        cut = _END.search(text, at + PIECE)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode_text(encoding, text: str | None) -> list[int]:
    """Ids of one text: each match of the pattern apart, no special tokens."""
    if not text:
        return []
    if len(text) <= RUN:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    at = 0
    for run in _LONG.finditer(text):
        # The last character may belong to the next match.
        end = run.end() if run.end() == len(text) else run.end() - 1
        for piece in _pieces(text[at:run.start()]):
            ids += encoding.encode_ordinary(piece)
        ids += encoding._core_bpe.encode_single_piece(text[run.start():end].encode())
        at = end
    for piece in _pieces(text[at:]):
        ids += encoding.encode_ordinary(piece)
    return ids


def read_ranks(path: str) -> bytes:
    """The rank file: one base64 token and its rank a line. It has a fixed size, under 2 MB for 50,000 tokens, and travels with the task."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the column `ids`, array<int>, of its column `text`; a column of that name is replaced."""
    ranks = read_ranks(path)

    def make(column: pa.Array) -> list:
        encoding = _encoding(ranks, pattern)
        return [pa.array((encode_text(encoding, t) for t in column.to_pylist()), pa.list_(pa.int32()))]

    return added(df, f"`{ids}` array<int>", text, make)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", data: str = "bytes") -> DataFrame:
    """`df` with the raw bytes of `ids` as the binary column `data`. Null ids are none; an id without a token fails the job."""
    ranks = read_ranks(path)

    def make(column: pa.Array) -> list:
        encoding = _encoding(ranks, pattern)
        return [pa.array((encoding.decode_bytes(x) if x else b"" for x in column.to_pylist()), pa.binary())]

    return added(df, f"`{data}` binary", ids, make)
