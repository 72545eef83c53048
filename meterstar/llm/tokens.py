"""Token ids from a public tokenizer, as little-endian unsigned 32-bit bytes.

Both kinds of tokenizer used here split a text at white space before anything
else, so a text is encoded piece by piece and each distinct piece only once
per worker; the ids are those of the whole text. They also keep a run of
letters apart from the punctuation after it, so a piece that is such a word is
looked up as word and punctuation, and a new word goes to the tokenizer's model at once. A text that holds
the string of an added token, such as an end mark, is encoded as a whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from meterstar.llm.held import Held, bounded, pieces

ID_BYTES = 4

# The code points of the Unicode property White_Space.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Latin-1 letters, which no normaliser joins with others, then punctuation without an apostrophe, which would take letters,
# up to white space: the letters and the punctuation are pieces of their own.
_MARKS = "[!-&(-/:-@[-`{-~]"
_ENDS = f"(?=[{_SPACE}]|\\Z)"
_WORD = f"[A-Za-zÀ-ÖØ-öø-ÿ]+(?={_MARKS}*(?:[{_SPACE}]|\\Z))|{_MARKS}+{_ENDS}"
# With byte-level BPE a space belongs to the word after it, and other white space stands alone.
_SPACED_PIECE = re.compile(f" ?(?:{_WORD})| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_BARE_PIECE = re.compile(f"{_WORD}|[^{_SPACE}]+")
_PLAIN = re.compile(f" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|{_MARKS}+)")

_encoders: dict[tuple[str, bool], PieceEncoder] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if it is visible, else the next from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class _Pieces(Held):
    """The ids of pieces; those of words and of runs of punctuation come straight from the tokenizer's model."""

    def __init__(self, tokenizer, lower: bool):
        super().__init__()
        self.tokenizer, self.model, self.lower, self.letters = tokenizer, tokenizer.model, lower, _byte_letters()

    def make(self, piece: str) -> bytes:
        if _PLAIN.fullmatch(piece) is None:
            return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()
        seen = (piece.lower() if self.lower else piece).encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(seen)]).tobytes()


class PieceEncoder:
    """Encodes texts with a tokenizer file; its pieces count against the worker's budget."""

    def __init__(self, path: str, spaces_count: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already fill the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.split = (_SPACED_PIECE if spaces_count else _BARE_PIECE).findall
        normalizer = tokenizer.normalizer
        self.pieces = _Pieces(tokenizer, lower=normalizer is not None and normalizer.normalize_str("A") == "a")
        self.tokenizer = tokenizer
        # The strings of added tokens (in any case, should the tokenizer fold it) are found before a text is split.
        added = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile("|".join(added), re.IGNORECASE).search if added else lambda text: None

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._ids(text) for text in texts]

    def _ids(self, text: str) -> bytes:
        bounded()
        if self.added(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.pieces.__getitem__, self.split(text)))


def encoder(path: str, spaces_count: bool) -> PieceEncoder:
    """This worker's encoder for a tokenizer file."""
    if (path, spaces_count) not in _encoders:
        _encoders[path, spaces_count] = PieceEncoder(path, spaces_count)
    return _encoders[path, spaces_count]


def tokenized(rows: DataFrame, path: str, spaces_count: bool, end_id: int | None) -> DataFrame:
    """``doc_id, ids`` of rows ``doc_id, text``; a NULL text is empty. ``end_id`` ends each document."""
    end = b"" if end_id is None else end_id.to_bytes(ID_BYTES, "little")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, spaces_count)
        for batch in batches:
            for part in pieces(batch, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [b + end for b in own.encode(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return rows.select("doc_id", "text").mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")
