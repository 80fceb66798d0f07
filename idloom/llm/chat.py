"""Chat formatting by incremental black-box rendering.

A template is any function from (role, text) messages to a string. Nothing is assumed about how it works: the turns'
places come from rendering every prefix of a conversation from its first turn and comparing consecutive outputs. What the
new output adds is the turn's span; where it doesn't begin with the old output, the template rewrites history, which is
reported with the first turn concerned. The place of the text inside a span comes from renderings of the same prefix that
differ in that text alone. No prefix is left out however long a conversation gets, so time is quadratic in its turns, and
its messages and output are held in memory.

Two things more are told of each turn. Beyond ``FULL`` turns it is rendered after the first turn and the ``WINDOW`` turns
before it as well; where that adds something else, the template is reported as ``context_dependent``. And the spans that
were given out are put together and compared with a new rendering, up to ``FULL`` turns with each one, then whenever the
conversation has doubled and at its end; ``verified`` is up to which turn that has been done. A difference there without
rewritten history is that of a template which is no function of its messages; it is reported as ``context_dependent`` too.

Rows stream through in order of (conv_id, turn), a turn a row; nothing gathers a conversation. Rows that tie are
ordered by role and text. Null roles and texts count as empty. Rows with a null conv_id form one conversation. Repeated
rows are turns of their own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Render = Callable[[list[tuple[str, str]]], str]

FULL = 64
WINDOW = 8
LOSS_ROLE = "assistant"

BEGIN, TURN, END = "<s>", "<|im_start|>", "<|im_end|>"
#: Strings that steer models, here and in other formats; none of them stays intact inside a role or text.
CONTROL = (BEGIN, TURN, END, "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
_control = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
_escaped = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Double backslashes, and put one behind the first character of every control string."""
    return _control.sub(r"\g<0>\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _escaped.sub(r"\1", text) if "\\" in text else text


def _marked(role: str, text: str) -> str:
    return f"{TURN}{escape(role).replace(chr(10), chr(92) + chr(10))}\n{escape(text)}{END}\n"


#: A conversation's short turns are rendered again for each of its prefixes; so many are remembered.
_remembered = functools.lru_cache(65_536)(_marked)
SHORT = 1_000


def render(messages: list[tuple[str, str]]) -> str:
    """The template: marks around each turn, the role on a line of its own."""
    return BEGIN + "".join([_remembered(role, text) if len(role) + len(text) <= SHORT else _marked(role, text) for role, text in messages])


_turn = re.compile(rf"{re.escape(TURN)}((?:[^\\\n]|\\.)*)\n(.*?){re.escape(END)}\n", re.DOTALL)


def parse(formatted: str) -> Iterator[tuple[str, str]]:
    """The messages of a rendered conversation, or of the spans of some of its turns."""
    for found in _turn.finditer(formatted):
        yield unescape(found[1]), unescape(found[2])


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Locator:
    """Finds each turn's place in a conversation's output, from a template's outputs alone."""

    def __init__(self, template: Render) -> None:
        self.template = template
        self.messages: list[tuple[str, str]] = []
        self.output = template([])
        self.length = len(self.output)
        self.turns = 0
        self.rewrites = self.dependent = False
        self.assembled = hashlib.sha256()
        self.verified, self.due = 0, 1

    def _added(self, after: str) -> str:
        """What an output adds to the last one; it need not begin with it."""
        at = _common(self.output, after)
        self.rewrites |= at < len(self.output)
        return after[at:]

    def add(self, role: str, text: str) -> tuple[str, int, int, int]:
        """Take in the next turn: its span's string, the span's start, and where its text begins and ends in the whole."""
        opening = self.output if not self.turns else ""
        span = self._added(whole := self.template([*self.messages, (role, text)]))
        ends = [self._added(self.template([*self.messages, (role, probe)])) for probe in ("a", "b")]
        head = _common(*ends)
        tail = _common(ends[0][::-1], ends[1][::-1])
        start = self.length - len(opening)
        begin, end = self.length + head, self.length + len(span) - tail
        self.messages.append((role, text))
        self.output, self.length = whole, self.length + len(span)
        self.turns += 1
        self.assembled.update(_bytes(opening + span))
        if self.turns > FULL:
            kept = [self.messages[0], *self.messages[-WINDOW - 1 :]]
            before, after = self.template(kept[:-1]), self.template(kept)
            self.dependent |= after[_common(before, after) :] != span
        if self.turns >= self.due:
            self.due = self.turns + 1 if self.turns < FULL else 2 * self.turns
            self.verify()
        return opening + span, start, begin, end

    def verify(self) -> None:
        """Compare the spans, put together, with a new rendering of the conversation."""
        same = hashlib.sha256(_bytes(self.template(self.messages))).digest() == self.assembled.digest()
        self.dependent |= not same and not self.rewrites
        self.verified = self.turns


FORMATTED = "conv_id long, position long, role string, span string, start long, text_start long, text_end long, rewrites_history boolean, context_dependent boolean, verified long"


def format_turns(conversations: DataFrame, template: Render = render) -> DataFrame:
    """A row for each turn, in order of (conv_id, turn) inside each partition.

    ``span`` is what the turn adds to its conversation's output (the first also has what stands before all turns);
    start, text_start and text_end are places in that output, in code points. The flags hold for the turns so far, whose
    prefixes have all been rendered; the spans of the first ``verified`` have also been compared with a new rendering.
    The last row's hold for all.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, locator = object(), None
        names = [x.split()[0] for x in FORMATTED.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        def flags() -> tuple[bool, bool, int]:
            return locator.rewrites, locator.dependent, locator.verified

        def ended(row: tuple) -> tuple:
            if locator.verified < locator.turns:
                locator.verify()
            return (*row[:-3], *flags())

        last: list[tuple] = []  # the latest row waits until it is known whether its conversation goes on
        for batch in batches:
            out: list[tuple] = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if locator is None or conv_id != current:
                    last = [ended(x) for x in last]
                    current, locator = conv_id, Locator(template)
                span, start, begin, end = locator.add(role, text)
                out += last
                last = [(conv_id, locator.turns - 1, role, span, start, begin, end, *flags())]
            if out:
                yield made(out)
        if last:
            yield made([ended(x) for x in last])

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(located, FORMATTED)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites_history boolean, context_dependent boolean"


def digest(formatted: DataFrame) -> DataFrame:
    """Read conversations back from :func:`format_turns`: counts and digests, a row each.

    Turns are parsed from the formatted text, and the text under the loss mask is cut out of it by the places found.
    """

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        state: list | None = None

        def row(s: list) -> tuple:
            return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6], s[7])

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "role", "span", "start", "text_start", "text_end", "rewrites_history", "context_dependent"))
            for key, turns in groupby(zip(*columns, strict=True), key=lambda x: x[0]):
                if state is None or state[0] != key:
                    if state:
                        out.append(row(state))
                    state = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False, False]
                for _, role, span, start, begin, end, rewrites, dependent in turns:
                    for said, text in parse(span):
                        state[1] += 1
                        state[2].update(f"{said}\n{text}\n".encode())
                    if role == LOSS_ROLE:
                        text = unescape(span[begin - start : end - start])
                        state[3] += len(text)
                        state[4].update(text.encode())
                    state[5] += len(span)
                    state[6:] = rewrites, dependent
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row(state), kinds, strict=True)], names=names)

    return formatted.mapInArrow(folded, DIGESTS)
