"""Exact encoding of whole texts with a ``tokenizers`` file, each distinct pre-token once.

Most of the library's time goes into normalizing and pre-tokenizing whole texts; merging is
cheap.  So a text of well-known characters is cut into pre-tokens by one regular expression,
and the distinct pre-tokens of a batch go through the library's own model in one call.  A
document's ids are its pre-tokens' ids, one after another.

Two families of files are known:

* ``drop``: the file throws white space away and may lower the case (word-level BPE);
* ``lead``: a pre-token may begin with one space (byte-level BPE).

Which one fits is read from the file.  A file of another kind, a text with a character
outside ``LETTERS``, ``MARKS``, digits and plain white space, and a text that holds an added
token's content go to the library whole.
"""

from __future__ import annotations

import ctypes
import json
import os
import re
from itertools import chain, islice

import numpy as np

# The pre-token pattern of the word-level family (it must equal the file's; the
# byte-level family's is the library's own).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Letters, and characters that are neither letter, number nor white space, which every Unicode
# version sees alike: no normalization form changes them, and their lower case needs no context
# (so without the Greek capital sigma and the dotted capital i).
LETTERS = ("A-Za-zÀ-ÖØ-öø-įı-ſȘ-țẠ-ỹΑ-ΡΤ-Ωα-ω"
           "Ѐ-ҁҊ-ӿぁ-ゖァ-ヺ一-龥가-힣")
MARKS = r"!-/:-@\[-`{-~" "¡-©«-±´¶-¸»¿×÷‐-‧‰-⁞"
_OTHER = re.compile(f"[^\\t\\n\\r 0-9{LETTERS}{MARKS}]").search
_SHORT = "'(?:s|t|re|ve|m|ll|d)"
_CUT = {"drop": re.compile(f"[{LETTERS}]+|{_SHORT}|[0-9]|[{MARKS}]+").findall,
        "lead": re.compile(f" ?[{LETTERS}]+|{_SHORT}| ?[0-9]+| ?[{MARKS}]+|\\s+(?!\\S)|\\s+").findall}

# Pre-tokens, and ids of theirs, that a task keeps from one batch to the next.
CACHE_PIECES = 200_000
CACHE_IDS = 2_000_000
# Pre-tokens in one input of a library call.
CALL_PIECES = 1_000


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others from U+0100 on in order; zero is left as the separator of pieces."""
    own = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    other = [b for b in range(256) if b not in own]
    return {b: chr(0x100 + i) for i, b in enumerate(other) if b} | {b: chr(b) for b in own}


_BYTE_CHARS = _byte_chars()


def _family(spec: dict) -> str:
    """The family of a tokenizer file; '' if it is none of the known ones."""
    pre = spec.get("pre_tokenizer") or {}
    norm = spec.get("normalizer")
    model = spec.get("model") or {}
    if model.get("type") != "BPE" or model.get("dropout") or model.get("byte_fallback"):
        return ""
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "lead"
    parts = pre.get("pretokenizers", [])
    steps = (norm or {}).get("normalizers", [])
    plain = {"NFC", "Lowercase"}
    known = all(s.get("type") in plain or s.get("type") == "Replace" and s.get("pattern") == {"Regex": "\\s+"}
                and s.get("content") == " " for s in steps)
    if (known and pre.get("type") == "Sequence" and len(parts) == 2 and parts[0].get("type") == "Split"
            and parts[0].get("invert") and parts[0].get("behavior") == "Removed"
            and (parts[0].get("pattern") or {}).get("Regex") == WORD_PATTERN and parts[1].get("type") == "ByteLevel"
            and not parts[1].get("use_regex") and not parts[1].get("add_prefix_space")):
        return "drop"
    return ""


class _Numbers(dict):
    """Pieces numbered in the order in which they are first asked for."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class PieceTable:
    """The ids of the distinct pieces seen so far; it starts anew when it has grown too large.

    ``look_up`` gives, for a list of new pieces, all their ids and how many each has.
    """

    def __init__(self, look_up, size: int = CACHE_PIECES):
        self.look_up, self.size = look_up, size
        self.forget()

    def forget(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.counts = np.empty(0, "<u4"), np.empty(0, np.int64)   # in order of number

    def encode(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts that are given as their pieces."""
        if len(self.numbers) > self.size or len(self.ids) > CACHE_IDS:
            self.forget()
        known = len(self.numbers)
        ends = np.cumsum([len(pieces) for pieces in texts], dtype=np.int64)
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(ends[-1]) if texts else 0)
        if len(self.numbers) > known:
            ids, counts = self.look_up(list(islice(self.numbers, known, None)))
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            if len(self.counts) != len(self.numbers) or self.counts.sum() != len(self.ids):
                raise RuntimeError("ids are missing for some pieces")
        # Each piece's ids are one stretch of ``ids``; the stretches are put one after another.
        begins, counts = (np.cumsum(self.counts) - self.counts)[numbers], self.counts[numbers]
        after = np.cumsum(counts)
        at = np.repeat(begins - (after - counts), counts) + np.arange(counts.sum())
        raw = self.ids[at].tobytes()
        edges = np.concatenate(([0], 4 * after))[np.concatenate(([0], ends)).astype(np.int64)].tolist()
        return [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]


class SegmentEncoder:
    """Encodes texts to little-endian unsigned 32-bit id bytes, as the library would."""

    def __init__(self, path: str, pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # tasks are the parallelism
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rule = _family(spec)
        self.lower = any(s.get("type") == "Lowercase" for s in (spec.get("normalizer") or {}).get("normalizers", []))
        self.tok = Tokenizer.from_file(path)
        self.merge = Tokenizer(self.tok.model)                      # the same model, nothing before it
        # Where the vocabulary marks the end of a pre-token, its ids tell how many it has.
        suffix = (spec.get("model") or {}).get("end_of_word_suffix")
        self.last = None
        if suffix:
            self.last = np.zeros(self.tok.get_vocab_size() + 1, bool)
            self.last[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        # The library takes these out of a text before anything else, inside a word too.
        added = [t["content"].lower() for t in spec.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)").search
        self.table = PieceTable(self._merged, pieces)

    def clear(self) -> None:
        """Forget what was kept, and give the memory back."""
        self.table.forget()
        release_memory()

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens by the library's model, and how many each has."""
        shown = "\0".join(pieces)
        if self.rule != "drop" or not shown.isascii():              # printable ASCII stands for itself
            shown = shown.encode("utf-8").decode("latin-1").translate(_BYTE_CHARS)
        shown = shown.split("\0")
        calls = [shown[at:at + CALL_PIECES] for at in range(0, len(shown), CALL_PIECES)]
        call = self.merge.encode_batch if self.last is None else self.merge.encode_batch_fast
        ids, counts = [], []
        for part, made in zip(calls, call(calls, is_pretokenized=True, add_special_tokens=False), strict=True):
            ids.append(np.asarray(made.ids, "<u4"))
            if self.last is None:
                counts.append(np.bincount(np.asarray(made.word_ids, np.int64), minlength=len(part)))
            else:
                counts.append(np.diff(np.flatnonzero(self.last[ids[-1]]), prepend=-1))
        return np.concatenate(ids), np.concatenate(counts)

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.rule:
            return self._library(texts)
        whole = [i for i, t in enumerate(texts) if _OTHER(t) or self.added(t.lower())]
        if not whole:
            return self._cut(texts)
        apart = dict(zip(whole, self._library([texts[i] for i in whole]), strict=True))
        rest = iter(self._cut([t for i, t in enumerate(texts) if i not in apart]))
        return [apart[i] if i in apart else next(rest) for i in range(len(texts))]

    def _cut(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of well-known characters, piece by piece."""
        find = _CUT[self.rule]
        return self.table.encode([find(t.lower()) for t in texts] if self.lower else [find(t) for t in texts])


_ENCODERS: dict[str, SegmentEncoder] = {}


def encoder(path: str) -> SegmentEncoder:
    """The worker's encoder for ``path``.  The file is read once a worker; a task calls
    ``clear`` at its end, so an idle worker holds no more than the vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = SegmentEncoder(path)
    return _ENCODERS[path]


def release_memory() -> None:
    """Return freed memory to the system: a worker that idles between tasks must not hold it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):               # not the GNU C library
        pass


def text_batches(texts: list[str], chars: int = 2_000_000):
    """Consecutive (start, end) ranges of ``texts`` of about ``chars`` characters."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer file lies on this machine (the same on every node)."""
    import public_tokenizers

    return public_tokenizers.path(name)
