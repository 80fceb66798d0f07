"""Byte-level BPE encoding by a priority queue of merge ranks over a doubly linked list, and decoding.

A pretoken's bytes form a doubly linked list of symbols. Every neighbouring pair that can merge is in a heap by (rank,
place). The least is popped; an entry is stale, and skipped, if its left symbol has gone or the pair there has another
rank by now; otherwise the right symbol is unlinked and the two new neighbours are pushed. A pretoken of n bytes costs
O(n log n) however long it is. Decoding joins the vocabulary's strings. Workers remember the ids of the text units that
they have met, up to a bound, so that frequent words are merged once.

Nulls count as empty texts and give no ids. Repeated rows give repeated rows, an empty table an empty one; columns
besides ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idloom.llm.batches import runs

#: Text units and pretokens that a Python worker remembers with their ids. Units are quickly put together again.
CACHE_UNITS = 300_000
CACHE_PRETOKENS = 700_000
#: White space as the tokenizer's pattern means it.
SPACE = "\t-\r\x20\x85\xa0  -     　"


class BytePairs(dict):
    """A byte-level BPE vocabulary; as a dict it holds the ids (array "I" as bytes) of words met so far, each with a
    blank before it.

    The pattern never looks across a blank that has no white space after it, so a text's ids are those of its parts
    between such blanks, in order. Texts with two blanks together or one at the end are cut into runs of white space,
    each with the run of other characters after it, further than which the pattern doesn't look either.
    """

    marks = ".,!?;:)\"#$%&*"

    def __init__(self, path: str) -> None:
        import regex

        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        other = [b for b in range(256) if b not in plain]
        letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        vocab = spec["model"]["vocab"]
        self.known: dict[str, bytes] = {}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.strings[i] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
        for token, i in self.special.items():
            self.strings[i] = token.encode()
        self.byte = [vocab[c] for _, c in sorted((b, c) for c, b in letter.items())]
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in spec["model"]["merges"]]
        self.rank = {vocab[a] << 20 | vocab[b]: i for i, (a, b) in enumerate(merges)}
        self.merged = [vocab[a + b] for a, b in merges]
        self.units = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.pretokens = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+").findall
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else lambda text: [text]

    def merge(self, pretoken: bytes) -> list[int]:
        """Ids of one pretoken."""
        symbols = [self.byte[b] for b in pretoken]
        n, rank, merged = len(symbols), self.rank.get, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [r * n + i for i in range(n - 1) if (r := rank(symbols[i] << 20 | symbols[i + 1])) is not None]
        heapify(queue)
        while queue:
            r, i = divmod(heappop(queue), n)
            j = after[i]
            if symbols[i] < 0 or j == n or rank(symbols[i] << 20 | symbols[j]) != r:
                continue  # stale
            new = symbols[i] = merged[r]
            symbols[j] = -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                if (r := rank(new << 20 | symbols[j])) is not None:
                    heappush(queue, r * n + i)
            j = before[i]
            if j >= 0 and (r := rank(symbols[j] << 20 | new)) is not None:
                heappush(queue, r * n + j)
        return [x for x in symbols if x >= 0]

    def _of(self, pretoken: str) -> bytes:
        if (ids := self.known.get(pretoken)) is None:
            ids = array("I", self.merge(pretoken.encode())).tobytes()
            if len(pretoken) < 64:
                self.known[pretoken] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        ids = self.unit(" " + word)
        if len(word) < 64:
            self[word] = ids
        return ids

    def unit(self, unit: str) -> bytes:
        head = unit.rstrip(self.marks)
        if (head[1:] if head[:1] == " " else head).isalpha():
            ids = self._of(head) + (self._of(unit[len(head) :]) if len(head) < len(unit) else b"")
        else:
            ids = b"".join(map(self._of, self.pretokens(unit)))
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens in it become those tokens, as in the library."""
        if len(self) > CACHE_UNITS:
            self.clear()
        if len(self.known) > CACHE_PRETOKENS:
            self.known.clear()
        parts = self.split(text) if any(x in text for x in self.special) else [text]
        found = []
        for part in parts:
            if part in self.special:
                found.append(array("I", [self.special[part]]).tobytes())
            elif "  " in part or part[-1:] == " ":
                found += map(self.unit, self.units(part))
            else:
                first, *rest = part.split(" ")
                found.append(self.unit(first))
                found += map(self.__getitem__, rest)
        return array("I", b"".join(found)).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids: their vocabulary strings, joined."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", errors="replace")


_loaded: dict[str, BytePairs] = {}


def vocabulary(path: str) -> BytePairs:
    """The worker's vocabulary for this file; what it remembers lives as long as the worker."""
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and ids (array of int) of every row."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(tokenizer)
        for batch, texts in runs(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(pairs.encode, texts), pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and text of every row of :func:`encode_documents`."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(tokenizer)
        for batch in batches:
            texts = pa.array([pairs.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, text string")


def round_trips(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded, decoded and digested in one pass.

    The ids are digested as decimals joined by commas, the decoded text in UTF-8.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = vocabulary(tokenizer)
        decimal = [str(i) for i in range(len(pairs.strings))].__getitem__
        for batch, texts in runs(batches):
            counts, ids_hex, text_hex = [], [], []
            for text in texts:
                ids = pairs.encode(text)
                counts.append(len(ids))
                ids_hex.append(hashlib.sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                text_hex.append(hashlib.sha256(pairs.decode(ids).encode()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(text_hex, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
