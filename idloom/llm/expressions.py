"""SQL text for expressions that the native operators share."""

from __future__ import annotations


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` standing for ``value``.

    ``element_at`` keeps its type, where ``[0]`` works it out anew, through all that it holds, for every value.
    """
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def places(pattern: str) -> str:
    """SQL for the (start, end) of every match of a pattern in ``text``, in code points.

    The lengths of gaps and matches are summed up in blocks of about the square root of their number.
    """
    lit = literal(pattern)
    gaps = f"transform(split(text, {lit}, -1), g -> length(g))"
    matches = f"transform(regexp_extract_all(text, {lit}, 0), m -> length(m))"
    steps = "zip_with(slice(g, 1, size(m)), m, (y, z) -> named_struct('gap', y, 'both', y + z))"
    sums = "aggregate({0}, 0, (t, y) -> t + y.both)"
    block = "slice(s, i*b + 1, b)"
    blocks = f"transform(sequence(0, (size(s) - 1) div b), i -> {sums.format(block)})"
    inside = f"""flatten(transform(sequence(0, (size(s) - 1) div b), i -> {let('o', "aggregate(slice(f, 1, i), 0, (t, y) -> t + y)",
        f"transform({block}, (y, j) -> named_struct('at', o + {sums.format('slice(s, i*b + 1, j)')} + y.gap, 'to', o + {sums.format('slice(s, i*b + 1, j)')} + y.both))")}))"""
    found = let("g", gaps, let("m", matches, let("s", steps, let("b", "cast(ceil(sqrt(size(s))) as int)", let("f", blocks, inside)))))
    return f"if(text rlike {lit}, {found}, cast(array() as array<struct<at:int,to:int>>))"


def islands(spans: str, begin: str, end: str, apart: str) -> str:
    """SQL for the (at, to) of spans, in order of their field ``begin``, with those that overlap made one.

    A span opens a new island if its ``begin`` is ``apart`` (> or >=) from every ``end`` before it. The running
    maximum of the ends is taken in blocks of about the square root of their number.
    """
    part = "slice(e, i*b + 1, b)"
    tops = f"transform(sequence(0, (size(e) - 1) div b), i -> array_max({part}))"
    running = f"flatten(transform(sequence(0, (size(e) - 1) div b), i -> {let('o', 'array_max(slice(f, 1, i))', let('q', part, 'transform(q, (y, j) -> greatest(o, array_max(slice(q, 1, j + 1))))'))}))"
    opens = f"filter(sequence(0, size(s) - 1), i -> i = 0 or s[i].{begin} {apart} m[i - 1])"
    made = f"transform(n, (x, k) -> named_struct('at', s[x].{begin}, 'to', m[if(k + 1 < size(n), n[k + 1] - 1, size(s) - 1)]))"
    found = let("e", f"transform(s, x -> x.{end})", let("b", "cast(ceil(sqrt(size(e))) as int)", let("f", tops, let("m", running, let("n", opens, made)))))
    return let("s", spans, f"if(size(s) = 0, cast(array() as array<struct<at:int,to:int>>), {found})")


def literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
