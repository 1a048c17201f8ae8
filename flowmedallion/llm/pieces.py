"""SentencePiece encoding and decoding for merge-type (BPE) models.

Encoding keeps an agenda of adjacent symbol pairs, best score first and leftmost first
among equal scores; the best pair is merged until no pair is a piece.  Symbols that are
no piece fall back to their UTF-8 bytes, where the model has byte pieces.

A text falls apart into parts that no merge can cross: where the vocabulary has no piece
with a word mark behind another character, before each run of word marks; where no longer
piece holds a line feed, around line feeds.  Both facts are read from the vocabulary.
Parts recur, so each worker keeps their ids in a table of bounded size.  Every part that
enters the table is checked against the sentencepiece library, one call for each Arrow
batch; a difference raises.

A null text counts as empty: begin and end ids only, decoded as "".  Texts of any length
are taken whole.
"""

from __future__ import annotations

import heapq
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowmedallion.llm.batches import append_columns

MARK = "▁"
PARTS_KEPT = 600_000
"""Parts that a worker remembers before it starts anew (about 150 MB)."""
LONG_PART = 80
"""Parts with more characters are encoded each time they occur."""


class Pieces(dict):
    """A model's vocabulary and its encoder: part of a text -> packed ids."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        super().__init__()
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != 2:
            raise ValueError("not a merge-type model")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep the text as it is")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.prefix = " " if rules.add_dummy_prefix else ""
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        kinds = model.SentencePiece
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        normal = [(i, p) for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL]
        self.ids = {p.piece: i for i, p in normal}
        order = {score: i for i, score in enumerate(sorted({p.score for _, p in normal}, reverse=True))}
        self.ranks = {p.piece: order[p.score] for _, p in normal}
        """0 for the pieces with the best score; equal scores, equal ranks."""
        self.unknown = self.library.unk_id()
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.surface = [p.piece.replace(MARK, " ").encode() if p.type == kinds.NORMAL else b"" for p in model.pieces]
        self.marked = {i for piece, i in self.ids.items() if piece.startswith(MARK)}
        for value, i in self.bytes.items():
            self.surface[i] = bytes([value])
        self.surface[self.unknown] = model.trainer_spec.unk_surface.encode()
        longer = [p.piece for _, p in normal if len(p.piece) > 1]
        own_line = not any("\n" in piece for piece in longer) and "\n" not in self.ids
        own_word = not any(MARK in piece.lstrip(MARK) for piece in longer)
        # parts have spaces for word marks, so that most take one byte a character
        word = "[^ \n]" if own_line else "[^ ]"
        pattern = f" *{word}+| +" + ("|\n" if own_line else "")
        self.split = re.compile(pattern).findall if own_word else lambda text: [text] if text else []
        self.fresh: list[str] = []

    def merged(self, part: str) -> list[int]:
        """The ids of a part, its spaces being word marks, by the agenda.

        An entry is the rank of a pair's score and the place of its left symbol in one number,
        so that the least number is the best pair, leftmost among equals.  ``open_`` has the
        rank of the pair that stands at each place now; other entries have gone stale.
        """
        rank, symbols = self.ranks.get, list(part.replace(" ", MARK))
        n = len(symbols)
        shift = 16 if n < 1 << 16 else 48
        places = (1 << shift) - 1
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        open_ = [rank(a + b, -1) for a, b in zip(symbols, symbols[1:])]
        open_.append(-1)
        agenda = [r << shift | i for i, r in enumerate(open_) if r >= 0]
        heapq.heapify(agenda)
        while agenda:
            entry = heapq.heappop(agenda)
            left = entry & places
            if open_[left] != entry >> shift:
                continue
            right = after[left]
            merged = symbols[left] = symbols[left] + symbols[right]
            symbols[right], open_[right] = "", -1
            right = after[left] = after[right]
            if right < n:
                before[right] = left
                found = open_[left] = rank(merged + symbols[right], -1)
                if found >= 0:
                    heapq.heappush(agenda, found << shift | left)
            else:
                open_[left] = -1
            left = before[left]
            if left >= 0:
                found = open_[left] = rank(symbols[left] + merged, -1)
                if found >= 0:
                    heapq.heappush(agenda, found << shift | left)
        ids = []
        for symbol in filter(None, symbols):
            own = self.ids.get(symbol)
            if own is not None:
                ids.append(own)
            elif self.bytes:
                ids.extend(self.bytes[value] for value in symbol.encode())
            elif not ids or ids[-1] != self.unknown:
                ids.append(self.unknown)
        return ids

    def packed(self, part: str) -> bytes:
        return array("I", self.merged(part)).tobytes()

    def __missing__(self, part: str) -> bytes:
        packed = self.packed(part)
        self.fresh.append(part)
        if len(part) <= LONG_PART:
            self[part] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, packed as little-endian unsigned 32-bit integers."""
        parts = self.split(self.prefix + text.replace(MARK, " ")) if text else ()
        ids = b"".join(map(self.__getitem__, parts))
        return self.begin.to_bytes(4, "little") + ids + self.end.to_bytes(4, "little")

    def check(self) -> None:
        """Compare the parts met since the last call with the library, then forget if too many are kept."""
        if self.fresh:
            lead = len(self.library.encode("\n"))
            found = self.library.encode(["\n" + part for part in self.fresh], num_threads=1)
            for part, ids in zip(self.fresh, found, strict=True):
                own = self[part] if len(part) <= LONG_PART else self.packed(part)
                if np.array(ids[lead:], dtype="<u4").tobytes() != own:
                    raise AssertionError(f"other ids than the library's for {part!r}")
        self.fresh = []
        if len(self) > PARTS_KEPT:
            self.clear()

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; control ids are silent."""
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        data = b"".join(map(self.surface.__getitem__, ids))
        if self.prefix and data[:1] == b" ":
            first = next(i for i in ids if self.surface[i])
            if first in self.marked:  # only a piece's word mark is the prefix
                data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self.patched(data)

    @staticmethod
    def patched(data: bytes) -> str:
        """Text in which each byte that begins no character becomes U+FFFD."""
        out, i = [], 0
        while i < len(data):
            for n in (1, 2, 3, 4):
                try:
                    out.append(data[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


def pieces(path: str) -> Pieces:
    """The worker's own copy of a model, with the parts it has met in earlier tasks."""
    kept = sys.__dict__.setdefault("_flow_pieces", {})  # functions come by value, so modules keep nothing
    if path not in kept:
        kept[path] = Pieces(path)
    return kept[path]


def packed_strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


def encode_texts(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (binary: begin id, ids, end id as little-endian 32-bit integers) and ``decoded``
    (the text that these ids give back).  ``model_path`` must be readable on every executor.
    Columns called ids or decoded are replaced."""

    def make() -> Callable:
        model = pieces(model_path)

        def work(texts: list[bytes | None]) -> list[pa.Array]:
            ids = [model.encode((data or b"").decode(errors="replace")) for data in texts]
            model.check()
            return [packed_strings(ids), pa.array([model.decode(row) for row in ids], pa.string())]

        return work

    return append_columns(df, text, "ids binary, decoded string", make)
