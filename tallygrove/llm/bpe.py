"""Byte-pair encoding by a queue of merge ranks over a linked list, and decoding by the vocabulary."""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tallygrove.llm.shared import in_pieces, map_texts, text_of, type_of

# Bounds of the memory of encoded words in a Python worker.
MOST_WORDS, LONGEST_WORD = 1 << 19, 48
# Code points of a text that are worked on at once.
AT_ONCE = 1 << 20

_POSITION = 32
# What the tokenizer's pattern and normalizer take for white space.
_SPACE = regex.compile(r"[\x09-\x0D\x20\x85\xA0  -     　]")


def byte_symbols() -> list[str]:
    """A visible character for each byte: itself where it is one, the next free ones from 256 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    free = iter(range(256, 512))
    return [chr(b if b in visible else next(free)) for b in range(256)]


class _UnknownCharacter(Exception):
    """A word holds a code point that Python's Unicode tables leave unassigned."""


class Encoder(dict):
    """A tokenizer file of the kind "words with ends": its rules, and a memory of encoded words.

    As a mapping it gives a word's ids, as bytes of an int array; words that it
    does not hold yet are encoded when they are asked for.
    """

    def __init__(self, file: bytes):
        self.file, self.library = file, None
        spec = json.loads(file)
        model, suffix = spec["model"], spec["model"]["end_of_word_suffix"] or ""
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        plain = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        known = (
            model["type"] == "BPE" and plain and steps == ["NFC", "Replace", "Lowercase"]
            and split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"]
            and level["type"] == "ByteLevel" and not level["add_prefix_space"] and not level["use_regex"]
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and spec["decoder"] is None and spec["post_processor"] is None
        )
        if not known:
            raise ValueError("the tokenizer file has steps that this encoder does not do")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.specials = regex.compile(f"({'|'.join(names)})") if names else None
        self.words = regex.compile(split["pattern"]["Regex"])
        symbols = byte_symbols()
        self.inner = [vocab.get(s) for s in symbols]
        self.last = [vocab.get(s + suffix) for s in symbols]
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.strings = {i: s for s, i in (vocab | self.special).items()}

    def merged(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, lowest rank first and leftmost of equal rank.

        The queue holds one number per candidate, rank then place.  An entry
        whose pair has changed since, so that it would no longer give the same
        symbol, is skipped.
        """
        n, rank_of, made = len(symbols), self.ranks.get, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        gone, low = -1, (1 << _POSITION) - 1
        found = map(rank_of, zip(symbols, symbols[1:]))
        queue = [rank << _POSITION | place for place, rank in enumerate(found) if rank is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            place = entry & low
            right = after[place]
            if right >= n or symbols[place] == gone:
                continue
            new = made[entry >> _POSITION]
            now = rank_of((symbols[place], symbols[right]))
            if now is None or made[now] != new:
                continue
            symbols[place], symbols[right] = new, gone
            left, right = before[place], after[right]
            after[place] = right
            if right < n:
                before[right] = place
                rank = rank_of((new, symbols[right]))
                if rank is not None:
                    heappush(queue, rank << _POSITION | place)
            if left >= 0:
                rank = rank_of((symbols[left], new))
                if rank is not None:
                    heappush(queue, rank << _POSITION | left)
        return [s for s in symbols if s != gone]

    def __missing__(self, word: str) -> bytes:
        if not word.isascii() and any(unicodedata.category(c) == "Cn" for c in word):
            raise _UnknownCharacter
        raw = word.encode("utf-8")
        ids = self._of(raw)
        if len(raw) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def _of(self, word: bytes) -> bytes:
        symbols = [self.inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        return array("i", self.merged([s for s in symbols if s is not None])).tobytes()

    def _plain(self, text: str) -> bytes:
        """The ids of a text without special tokens, as bytes of an int array."""
        if text.isascii():
            plain = text.lower()
        else:
            # A sigma at the end of a word is lower-cased like any other.
            plain = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        try:
            return b"".join(map(self.__getitem__, self.words.findall(plain)))
        except _UnknownCharacter:
            return b"".join(map(self._of, self._words_by_library(text)))

    def _words_by_library(self, text: str) -> Iterator[bytes]:
        """Words of a text with characters that Python's Unicode tables do not know yet.

        The library that defines the file may have newer tables, so it is asked
        where the words begin and end.
        """
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_buffer(self.file)
        byte = {s: b for b, s in enumerate(byte_symbols())}
        plain = self.library.normalizer.normalize_str(text)
        for word, _ in self.library.pre_tokenizer.pre_tokenize_str(plain):
            yield bytes(byte[c] for c in word)

    def encode(self, text: str) -> array:
        """The ids of a text; special tokens in it count as such."""
        out = array("i")
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            start = 0
            while start < len(part):
                # No word, and no character of a normalized text, reaches across white space.
                cut = _SPACE.search(part, start + AT_ONCE) if len(part) - start > AT_ONCE else None
                end = cut.start() if cut else len(part)
                out.frombytes(self._plain(part[start:end]))
                start = end
        return out

    def decode(self, ids: array | list[int]) -> str:
        """The vocabulary's strings, joined as the file's missing decoder asks for: by spaces."""
        return " ".join(map(self.strings.__getitem__, ids))


def _sent(docs: DataFrame, path: str):
    """The tokenizer file for the workers; only the driver needs to reach the path."""
    with open(path, "rb") as file:
        return docs.sparkSession.sparkContext.broadcast([file.read()])


def _encoder(sent) -> Encoder:
    """The worker's encoder: kept beside the file for the tasks that follow in the same process."""
    held = sent.value
    if len(held) == 1:
        held.append(Encoder(held[0]))
    return held[1]


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, packed: bool, back: bool) -> DataFrame:
    sent = _sent(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        for piece in in_pieces(batches, 1):
            found = [encoder.encode(t) for t in piece.column(1).to_pylist()]
            counts = np.array([len(ids) for ids in found], dtype=np.int64)
            if packed:
                ids = pa.array([np.asarray(x, dtype="<u4").tobytes() for x in found], pa.binary())
            else:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                flat = np.concatenate([np.asarray(x, dtype=np.int32) for x in found])
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            columns = {"id": piece.column(0), "n_tokens": pa.array(counts), "ids": ids}
            if back:
                columns["decoded"] = pa.array([encoder.decode(x) for x in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(docs[id_col].alias("id"), text_of(docs, text_col).alias("text"))
    schema = f"id {type_of(docs, id_col)}, n_tokens bigint, ids {'binary' if packed else 'array<int>'}"
    return map_texts(rows, run, schema + (", decoded string" if back else ""))


def encode(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", packed: bool = False
) -> DataFrame:
    """One row per document: ``id``, ``n_tokens`` and ``ids``.

    ``ids`` is an array of int, or with ``packed`` the numbers as little-endian
    unsigned 32-bit, the form that files for training take.  Whole texts are
    encoded, without tokens added; special tokens spelt out in a text count as
    such.  Null texts count as empty and give no ids.  Rows equal to others are
    encoded like any other; further columns are ignored.  No shuffle, no state:
    a repeated task gives the same rows.  A worker remembers words up to a
    fixed number and length.
    """
    return _encoded(docs, path, id_col, text_col, packed, back=False)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``encode`` with ``packed``, and ``decoded``: the text that the ids spell."""
    return _encoded(docs, path, id_col, text_col, packed=True, back=True)


def decode(rows: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """``id`` and ``text`` of rows with ids, as arrays or packed; null ids spell the empty text.

    An id that the vocabulary does not have is an error.
    """
    sent = _sent(rows, path)
    packed = type_of(rows, ids_col) == "binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(sent)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            if packed:
                ids = [np.frombuffer(x or b"", dtype="<u4").tolist() for x in ids]
            texts = pa.array([encoder.decode(x or []) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["id", "text"])

    narrow = rows.select(rows[id_col].alias("id"), rows[ids_col].alias("ids"))
    return map_texts(narrow, run, f"id {type_of(rows, id_col)}, text string")
