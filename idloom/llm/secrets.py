"""Secret scans: base patterns, and a battery of randomness tests on every long token.

Everything runs as DataFrame functions. The base patterns give spans of kind assign, access and hex; a span's places
come from the code points of the gaps and matches before it. The battery adds spans of kind ``random``. A candidate is
a run of at least ``SHORTEST`` characters of ``[A-Za-z0-9+/_=-]``. Its encoding is the smallest alphabet that holds it
(digits, hex, base32, upper or lower alphanumerics, alphanumerics, base64); its padding is left out. Three tests ask
whether it can be random: the chi-squared test of a uniform alphabet, the runs test about the alphabet's middle and the
lag-1 serial correlation. Their p-values are joined by Bonferroni's rule and go through Benjamini and Hochberg's
procedure, one for each length class (powers of two), over all candidates of the table: so of the candidates that are
rejected as not random, at most ``FALSE_DISCOVERY_RATE`` are random on average, however many there are. Short strings
of ordinary text pass such tests by chance, so what isn't rejected must also be unlike text of its own length: z is the
distance of its number of equal character pairs (the chi-squared statistic, up to scale) and of its changes of
character class from what ordinary text would give, and its lower-tail p-values go through the same procedure. All that
needs the counts by class and rounded statistics only, at most 32 x 41 x 121 numbers, which is what reaches the driver;
the cutoffs go back as literals. So nothing is shuffled but those counts and no row is joined.

Nulls and empty texts have no spans. Repeated rows give repeated rows; an empty table an empty one. Other columns are
ignored by :func:`scan` and pass through :func:`redact`.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.llm.expressions import islands, let, literal, places

#: Base patterns, in the order in which spans that start together are listed. For assign, group 2 has 12+ characters.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LEAST_ASSIGNED = 12
KINDS = ("assign", "access", "hex", "random")

SHORTEST = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{SHORTEST},}}"
#: Share of neighbours in ordinary text of which one is a digit, capital, small letter or mark and the other another.
CLASS_CHANGES = 0.2
FALSE_DISCOVERY_RATE = 0.01
#: Statistics are counted in steps of these, up to these bounds.
STEP_WORST, HIGHEST = 0.2, 8.0
STEP_TEXT, DEEPEST = 0.1, 12.0

#: Usual frequencies of letters in English text, in percent.
LETTER_PERCENT = {
    "a": 8.2, "b": 1.5, "c": 2.8, "d": 4.3, "e": 12.7, "f": 2.2, "g": 2.0, "h": 6.1, "i": 7.0, "j": 0.15, "k": 0.77, "l": 4.0, "m": 2.4,
    "n": 6.7, "o": 7.5, "p": 1.9, "q": 0.095, "r": 6.0, "s": 6.3, "t": 9.1, "u": 2.8, "v": 0.98, "w": 2.4, "x": 0.15, "y": 2.0, "z": 0.074,
}

#: Alphabets from the smallest on, with the pattern of strings that they hold. A candidate has the first that fits.
ALPHABETS = {
    "digits": (string.digits, "[0-9]+"),
    "hex": (string.digits + "abcdef", "[0-9a-f]+"),
    "hex_upper": (string.digits + "ABCDEF", "[0-9A-F]+"),
    "base32": (string.ascii_uppercase + "234567", "[A-Z2-7]+"),
    "upper": (string.digits + string.ascii_uppercase, "[0-9A-Z]+"),
    "lower": (string.digits + string.ascii_lowercase, "[0-9a-z]+"),
    "alphanumeric": (string.digits + string.ascii_uppercase + string.ascii_lowercase, "[0-9A-Za-z]+"),
    "base64": (string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/", "[0-9A-Za-z+/]+"),
    "base64_url": (string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_", "[0-9A-Za-z_-]+"),
    "mixed": (string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/-_=", "[0-9A-Za-z+/_=-]+"),
}


def text_moments(alphabet: str) -> tuple[float, float]:
    """Sums of squared and cubed frequencies of an alphabet's characters in ordinary text.

    Letters count by their frequencies, capitals a twentieth of that where both cases are there; a digit or mark counts
    as much as the rarest letters. An alphabet without letters is uniform: digits can't be told from random ones.
    """
    both = any(c.islower() for c in alphabet) and any(c.isupper() for c in alphabet)
    weights = [LETTER_PERCENT[c.lower()] * (0.05 if both and c.isupper() else 1) if c.isalpha() else 0.1 for c in alphabet]
    if not any(c.isalpha() for c in alphabet):
        weights = [1.0] * len(alphabet)
    total = sum(weights)
    return sum((w / total) ** 2 for w in weights), sum((w / total) ** 3 for w in weights)



def _pick(value: str, of) -> str:
    whens = " ".join(f"when {value} rlike '^{pattern}$' then {of(letters)}" for letters, pattern in ALPHABETS.values())
    return f"case {whens} end"


def battery(token: str) -> str:
    """SQL for a struct of the tests' results for a candidate; null if it is too short without its padding.

    z_uniform, z_runs and z_serial are 0 on average for random strings, and ``z_text`` for ordinary text; z_text joins
    the number of equal character pairs with the number of changes of character class (text: ``CLASS_CHANGES`` of the
    neighbours), and is the lower the less the string looks like text. ``class`` is the length's power of two.
    """
    kind = "case when c between '0' and '9' then 0 when c between 'a' and 'z' then 1 when c between 'A' and 'Z' then 2 else 3 end"
    tests = f"""named_struct(
        'class', cast(floor(log2(n)) as int),
        'z_uniform', coalesce((e - n*(n-1)/k) / sqrt(2*n*(n-1)*(1/k - 1/k/k)), 99D),
        'z_runs', coalesce((r - 1 - 2*h*(n-h)/n) / nullif(sqrt(greatest(0D, 2*h*(n-h)*(2*h*(n-h)-n)/n/n/(n-1))), 0D), 99D),
        'z_serial', coalesce((q / nullif(d, 0D) + 1/n) * sqrt(n), 99D),
        'z_text', ((e - n*(n-1)*s2) / sqrt(2*n*(n-1)*(s2-s2*s2) + 4*n*(n-1)*(n-2)*greatest(s3-s2*s2, 0D))
                   - (w - {CLASS_CHANGES}*(n-1)) / sqrt({CLASS_CHANGES * (1 - CLASS_CHANGES)}*(n-1))) / sqrt(2D))"""
    pairs = "zip_with(slice(x, 1, size(x)-1), slice(x, 2, size(x)-1), (y, z) -> {0})"
    total = "aggregate({0}, 0D, (t, y) -> t + y)"
    for name, value in reversed(
        {
            "k": "cast(length(a) as double)",
            "n": "cast(length(v) as double)",
            "x": "transform(filter(split(v, ''), c -> c <> ''), c -> cast(locate(c, a) as double))",
            "e": total.format("transform(filter(split(a, ''), c -> c <> ''), c -> (n - length(replace(v, c, ''))) * (n - length(replace(v, c, '')) - 1))"),
            "h": total.format("transform(x, y -> if(y > k/2, 1D, 0D))"),
            "r": "1 + " + total.format(pairs.format("if((y > k/2) <> (z > k/2), 1D, 0D)")),
            "m": total.format("x") + " / n",
            "d": total.format("transform(x, y -> (y - m) * (y - m))"),
            "q": total.format(pairs.format("(y - m) * (z - m)")),
            "u": f"transform(filter(split(v, ''), c -> c <> ''), c -> {kind})",
            "w": total.format("zip_with(slice(u, 1, size(u)-1), slice(u, 2, size(u)-1), (y, z) -> if(y <> z, 1D, 0D))"),
            "s2": _pick("v", lambda a: f"{text_moments(a)[0]:.12f}D"),
            "s3": _pick("v", lambda a: f"{text_moments(a)[1]:.12f}D"),
        }.items()
    ):
        tests = let(name, value, tests)
    return let("v", f"regexp_replace({token}, '=+$', '')", f"if(length(v) < {SHORTEST} or v rlike '^[0-9]*$', null, {let('a', _pick('v', lambda a: repr(a)), tests)})")


def _worst(test: str) -> str:
    """SQL: the largest distance of the three tests from what random strings give, rounded down to a step."""
    return f"least({HIGHEST}D, floor(greatest(abs({test}.z_uniform), abs({test}.z_runs), abs({test}.z_serial)) / {STEP_WORST}D) * {STEP_WORST}D)"


def _depth(test: str) -> str:
    """SQL: z_text, rounded up to a step, and 0 where it is above."""
    return f"least(0D, greatest({-DEEPEST}D, ceil({test}.z_text / {STEP_TEXT}D) * {STEP_TEXT}D))"


def rejects(counts: dict[float, int], p_value) -> float | None:
    """The statistic from which on Benjamini and Hochberg's procedure rejects, if any; the extremest come first in ``counts``."""
    total, passed, found = sum(counts.values()), 0, None
    for value, n in counts.items():
        passed += n
        if p_value(value) <= FALSE_DISCOVERY_RATE * passed / total:
            found = value
    return found


def not_random(worst: float) -> float:
    """Bonferroni's p-value of three two-sided tests, the worst of them at this distance."""
    return min(1.0, 3 * math.erfc(worst / math.sqrt(2)))


def unlike_text(z: float) -> float:
    """The p-value of z_text; 1 for what counts as text."""
    return 0.5 * math.erfc(-z / math.sqrt(2)) if z < 0 else 1.0


def _candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_candidates``: array of struct of the token and its place in the order of matches."""
    lit = literal(CANDIDATE)
    return docs.withColumn("_tests", F.expr(f"if(text rlike {lit}, transform(regexp_extract_all(text, {lit}, 0), t -> {battery('t')}), cast(array() as array<struct<class:int,z_uniform:double,z_runs:double,z_serial:double,z_text:double>>))"))


#: For each length class: the worst distance at which a candidate is rejected, and the z_text at or below which the others are found.
Limits = dict[int, tuple[float, float]]


def cutoffs(docs: DataFrame) -> Limits:
    """The limits that all candidates of ``docs`` give; classes in which nothing is found are left out."""
    tested = _candidates(docs.select(F.coalesce("text", F.lit("")).alias("text"))).select(F.explode("_tests").alias("t")).where("t is not null")
    rounded = tested.select(F.col("t.class").alias("class"), F.expr(_worst("t")).alias("worst"), F.expr(_depth("t")).alias("z"))
    counted: dict[int, list[tuple[float, float, int]]] = {}
    for length, worst, z, n in rounded.groupBy("class", "worst", "z").count().collect():  # bounded by the steps
        counted.setdefault(length, []).append((worst, z, n))
    found = {}
    for length, rows in counted.items():
        by_worst: dict[float, int] = {}
        for worst, _, n in sorted(rows, reverse=True):
            by_worst[worst] = by_worst.get(worst, 0) + n
        limit = rejects(by_worst, not_random)
        limit = math.inf if limit is None else limit
        by_z: dict[float, int] = {}
        for z, n in sorted((0.0 if worst >= limit else z, n) for worst, z, n in rows):
            by_z[z] = by_z.get(z, 0) + n
        depth = rejects(by_z, unlike_text)
        if depth is not None:
            found[length] = (min(limit, 2 * HIGHEST), depth)
    return found


def find(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """``docs`` with ``spans``: array of struct<start, rank, end> in order; rank is the kind's place in ``KINDS``.

    ``limits`` come from :func:`cutoffs` over all of the rows unless given.
    """
    limits = cutoffs(docs) if limits is None else limits
    passes = " ".join(f"when {k} then {_worst('t')} < {worst - STEP_WORST / 2}D and {_depth('t')} <= {z + STEP_TEXT / 2}D" for k, (worst, z) in sorted(limits.items()))
    chosen = f"case t.class {passes} else false end" if limits else "false"
    kept = "transform({0}, p -> named_struct('start', p.at, 'rank', {1}, 'end', p.to))"
    assigned = literal(ASSIGN)
    base = f"""concat(
        transform(filter(zip_with({places(ASSIGN)}, if(text rlike {assigned}, regexp_extract_all(text, {assigned}, 2), cast(array() as array<string>)), (p, w) -> named_struct('p', p, 'n', length(w))), o -> o.n >= {LEAST_ASSIGNED}),
                  o -> named_struct('start', o.p.at, 'rank', 0, 'end', o.p.to)),
        {kept.format(places(ACCESS), 1)}, {kept.format(places(HEX), 2)})"""
    accepted = f"filter(zip_with({places(CANDIDATE)}, _tests, (p, t) -> if(t is not null and {chosen}, p, null)), p -> p is not null)"
    apart = "filter({0}, p -> not exists(_base, o -> o.start < p.to and p.at < o.end))"
    scanned = docs.withColumn("_text", F.col("text")).withColumn("text", F.coalesce("text", F.lit("")))
    scanned = _candidates(scanned).withColumn("_base", F.expr(base))
    found = f"if(size(_tests) = 0, _base, concat(_base, {kept.format(apart.format(accepted), 3)}))"
    return scanned.withColumn("spans", F.array_sort(F.expr(found))).withColumn("text", F.col("_text")).drop("_text", "_base", "_tests")


def _listed(spans: str) -> Column:
    names = "case s.rank " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(KINDS)) + " end"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {names}, s.start, s.end)), ',')")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (``kind:start:end``, comma-joined) of every row."""
    found = find(docs.select("doc_id", "text")).drop("text")
    count = [F.expr(f"cast(size(filter(spans, s -> s.rank = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return found.select("doc_id", *count, F.sha2(_listed("filter(spans, s -> s.rank < 3)"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span's text replaced by ``mark`` and n_chars, if it is there, set anew for such rows.

    Spans that overlap or touch share one mark.
    """
    # What lies between the islands, cut out of blocks of about the square root of their number.
    before = "if(i*b + j = 0, 0, t[i*b + j - 1].to)"
    piece = f"concat(substring(w, {before} - o + 1, x.at - {before}), '{mark}')"
    block = let("o", "if(i = 0, 0, t[i*b - 1].to)", let("w", "substring(text, o + 1, t[least(i*b + b, size(t)) - 1].at - o)", f"array_join(transform(slice(t, i*b + 1, b), (x, j) -> {piece}), '')"))
    pieces = let("b", "cast(ceil(sqrt(size(t))) as int)", f"array_join(transform(sequence(0, (size(t) - 1) div b), i -> {block}), '')")
    cut = let("t", islands("spans", "start", "end", ">"), f"concat({pieces}, substring(text, element_at(t, -1).to + 1, length(text)))")
    found = find(docs).withColumn("_cut", F.expr(f"if(size(spans) > 0, {cut}, text)"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("_cut")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return found.withColumn("text", F.col("_cut")).select(docs.columns)
