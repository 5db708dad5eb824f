"""Encoding and decoding with the pieces of a SentencePiece model.

An Aho-Corasick automaton over all pieces reads a text once; at each position its
matches (the state's piece and those along its output links, longest first) relax the
best score of a segmentation that ends there.  The best path is the segmentation with
the largest sum of piece scores; on a tie the longer last piece stays.  A character that
no one-character piece covers may also be taken as unknown, at the lowest score less
``UNKNOWN_PENALTY``; unknown characters are written as byte pieces where the model has
them, else as the unknown id.

No piece of the usual models goes on after a word, and none joins certain punctuation to
a letter before it: a text may be cut there without changing the best path, and each
distinct part is segmented once (bounded table).  Which cuts are safe is read from the
model's pieces; a model with a piece across words is run over whole texts.

Defined results: null and empty texts have no ids; texts are taken as they are (models
with a normalization table are refused), but for the space mark U+2581, which means a
space, as in the model itself.  Decoding gives the text back with that mark as a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Piece types of the model format.
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
# Marks before which a text may be cut after a letter, where no piece of the model joins the two.
CUT_MARKS = ".,!?;:)"
_LETTER = re.compile(r"[^\W\d_]").match
LEAST = float("-inf")
_NONE = (1, 0.0, -1)


class PieceModel:
    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        from loadsmith.llm._tokens import PieceTable

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("models that rewrite the text are not supported")
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.bytes: dict[int, int] = {}
        self.unknown, self.automaton, self.single, lowest, crossing = 0, ahocorasick.Automaton(), set(), 0.0, False
        alphabet: set[str] = set()
        before: dict[str, set[str]] = {p: set() for p in CUT_MARKS}     # what stands before a mark in some piece
        for i, p in enumerate(proto.pieces):
            if p.type in (NORMAL, USER_DEFINED):
                self.automaton.add_word(p.piece, (len(p.piece), p.score, i))
                lowest = min(lowest, p.score)
                alphabet.update(p.piece)
                crossing |= MARK in p.piece.lstrip(MARK)
                for a, b in zip(p.piece, p.piece[1:], strict=False):
                    if b in before:
                        before[b].add(a)
                if len(p.piece) == 1:
                    self.single.add(p.piece)
            elif p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
            elif p.type == UNKNOWN:
                self.unknown = i
        self.automaton.make_automaton()
        self.spelled = [str(p).encode("utf-8") for p in self.pieces]
        self.value = {i: b for b, i in self.bytes.items()}
        for i, b in self.value.items():
            self.spelled[i] = bytes([b])
        self.unknown_score = lowest - UNKNOWN_PENALTY
        marks = "".join(re.escape(p) for p, found in before.items() if not any(map(_LETTER, found)))
        line = "" if "\n" in alphabet else "\n"
        self.words = None if crossing else re.compile(
            (f"{MARK}*[^\\W\\d_]+(?=[{marks}])|" if marks else "") + f"{MARK}*[^{MARK}{line}]+|{MARK}+"
            + ("|\n" if line else "")).findall
        self.table = PieceTable(self._segments)

    def clear(self) -> None:
        """Forget what was kept, and give the memory back."""
        from loadsmith.llm._tokens import release_memory

        self.table.forget()
        release_memory()

    def _segments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(self.segment, words))
        return (np.fromiter(chain.from_iterable(found), "<u4", sum(map(len, found))),
                np.fromiter(map(len, found), np.int64, len(found)))

    def _unknown_ids(self, char: str) -> list[int]:
        if len(self.bytes) < 256:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8")]

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation (the automaton's single pass)."""
        n = len(text)
        best = [0.0] + [LEAST] * n
        back: list[tuple] = [_NONE] * (n + 1)                       # (length, score, id) of the last piece
        lacks = () if self.single.issuperset(text) else [i for i, c in enumerate(text) if c not in self.single]
        at, unknown = 0, self.unknown_score
        for end, match in self.automaton.iter(text):
            while at < len(lacks) and lacks[at] < end:              # positions before this one are final
                self._skip(best, back, lacks[at], unknown)
                at += 1
            end += 1
            score = best[end - match[0]] + match[1]
            if score > best[end]:
                best[end], back[end] = score, match
        for i in lacks[at:]:
            self._skip(best, back, i, unknown)
        out: list[int] = []
        while n:
            size, _, piece = back[n]
            if piece >= 0:
                out.append(piece)
            else:
                out += self._unknown_ids(text[n - 1])[::-1]
            n -= size
        out.reverse()
        return out

    @staticmethod
    def _skip(best: list, back: list, i: int, unknown: float) -> None:
        if best[i] + unknown > best[i + 1]:
            best[i + 1], back[i + 1] = best[i] + unknown, _NONE

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        marked = [(MARK if self.prefix else "") + t.replace(" ", MARK) if t else "" for t in texts]
        if self.words is None:
            return [np.asarray(self.segment(t), "<u4").tobytes() for t in marked]
        return self.table.encode([self.words(t) for t in marked])

    def decode(self, rows: list[bytes]) -> list[str]:
        """Texts of ids: byte pieces are joined to characters, marks become spaces."""
        out = []
        for row in rows:
            text = b"".join(map(self.spelled.__getitem__, np.frombuffer(row, "<u4").tolist())).decode("utf-8", "replace")
            text = text.replace(MARK, " ")
            out.append(text[1:] if self.prefix and text[:1] == " " else text)
        return out


_MODELS: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _column_task(model: str, source: str, target: str, encode: bool):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from loadsmith.llm._tokens import text_batches

        m = _model(model)
        try:
            for batch in batches:
                values = batch.column(source).to_pylist()
                sized = [v or "" for v in values] if encode else [v or b"" for v in values]
                for a, b in text_batches(sized):
                    part = batch.slice(a, b - a)
                    made = pa.array(m.encode(sized[a:b]), pa.binary()) if encode else pa.array(m.decode(sized[a:b]), pa.string())
                    yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, target])
        finally:
            m.clear()

    return run


def _add(df: DataFrame, model: str, source: str, target: str, encode: bool) -> DataFrame:
    """Only the source column and a struct of all others go through the task."""
    kind = F.lit(None).cast("binary" if encode else "string").alias(target)
    schema = df.drop(target).select("*", kind).schema
    return df.drop(target).mapInArrow(_column_task(model, source, target, encode), schema)


def encode_pieces(docs: DataFrame, model: str, *, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """``docs`` with the ids of each whole text (a column of the same name is replaced)."""
    return _add(docs, model, text_col, ids_col, True)


def decode_pieces(rows: DataFrame, model: str, *, ids_col: str = "piece_ids",
                  text_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of each row's ids."""
    return _add(rows, model, ids_col, text_col, False)
