"""The randomness battery against a plain version of it, over whole tables."""

import math
import random
import re
import string
import time

from pyspark.sql import functions as F

from idloom.llm import licenses, secrets


def plain_battery(token):
    """(class, z_uniform, z_runs, z_serial, z_text) by their definitions; None for what is no candidate."""
    v = token.rstrip("=")
    if len(v) < secrets.SHORTEST or v.isdigit():
        return None
    alphabet = next(a for a, p in secrets.ALPHABETS.values() if re.fullmatch(p, v))
    n, k = len(v), len(alphabet)
    x = [alphabet.index(c) + 1 for c in v]
    pairs = sum(v.count(c) * (v.count(c) - 1) for c in set(v))
    z_uniform = (pairs - n * (n - 1) / k) / math.sqrt(2 * n * (n - 1) * (1 / k - 1 / k**2))
    upper = [y > k / 2 for y in x]
    high = sum(upper)
    runs = 1 + sum(a != b for a, b in zip(upper, upper[1:], strict=False))
    spread = 2 * high * (n - high) * (2 * high * (n - high) - n) / n / n / (n - 1)
    z_runs = (runs - 1 - 2 * high * (n - high) / n) / math.sqrt(spread) if spread > 0 else 99
    mean = sum(x) / n
    square = sum((y - mean) ** 2 for y in x)
    z_serial = (sum((a - mean) * (b - mean) for a, b in zip(x, x[1:], strict=False)) / square + 1 / n) * math.sqrt(n) if square else 99
    s2, s3 = (round(s, 12) for s in secrets.text_moments(alphabet))
    kind = ["d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "o" for c in v]
    changes = sum(a != b for a, b in zip(kind, kind[1:], strict=False))
    c = secrets.CLASS_CHANGES
    z_pairs = (pairs - n * (n - 1) * s2) / math.sqrt(2 * n * (n - 1) * (s2 - s2 * s2) + 4 * n * (n - 1) * (n - 2) * max(s3 - s2 * s2, 0))
    return int(math.log2(n)), z_uniform, z_runs, z_serial, (z_pairs - (changes - c * (n - 1)) / math.sqrt(c * (1 - c) * (n - 1))) / math.sqrt(2)


def benjamini_hochberg(p_values, rate):
    """The largest p-value that is rejected; below 0 for none."""
    ordered = sorted(p_values)
    return max([p for i, p in enumerate(ordered) if p <= rate * (i + 1) / len(ordered)], default=-1)


def plain_random(texts):
    """Accepted candidates (text's number, start, end) of all texts."""
    rows = []
    for number, text in enumerate(texts):
        for m in re.finditer(secrets.CANDIDATE, text or ""):
            if found := plain_battery(m[0]):
                size, *z, z_text = found
                worst = min(8, math.floor(max(map(abs, z)) / 0.2) * 0.2)
                depth = min(0, max(-12, math.ceil(z_text / 0.1) * 0.1))
                rows.append((number, m.start(), m.end(), size, min(1, 3 * math.erfc(worst / math.sqrt(2))), 0.5 * math.erfc(-depth / math.sqrt(2)) if depth < 0 else 1))
    out = set()
    for size in {r[3] for r in rows}:
        own = [r for r in rows if r[3] == size]
        cut = benjamini_hochberg([r[4] for r in own], secrets.FALSE_DISCOVERY_RATE)
        left = [(*r[:3], 1 if r[4] <= cut + 1e-15 else r[5]) for r in own]
        cut = benjamini_hochberg([r[3] for r in left], secrets.FALSE_DISCOVERY_RATE)
        out |= {r[:3] for r in left if r[3] <= cut + 1e-15}
    return out


def made_texts():
    rng = random.Random(8)
    words = "the quick brown fox over lazy dog international configuration available document number processing identifier language version security model value".split()
    texts = []
    for _ in range(500):
        parts = rng.choices(words, k=6)
        for letters, size in ((string.ascii_letters + string.digits, 40), (string.ascii_uppercase + "234567", 32), (string.ascii_letters + string.digits + "+/", 64), (string.digits + "ABCDEF", 28)):
            if rng.random() < 0.1:
                parts.append("".join(rng.choices(letters, k=size)) + rng.choice(["", "="]))
        parts += [rng.choice("-_/").join(rng.choices(words, k=rng.randrange(3, 7))), "ab" * rng.randrange(8, 20)]
        rng.shuffle(parts)
        texts.append("é " + " , ".join(parts))
    return [*texts, "", None, "1234567890" * 3, "A" * 30, "=" * 25]


def test_battery_equals_plain_version(spark):
    tokens = [m for t in made_texts() if t for m in re.findall(secrets.CANDIDATE, t)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i long, t string").select("i", F.expr(secrets.battery("t")).alias("b")).collect()
    for r in rows:
        want = plain_battery(tokens[r.i])
        assert (r.b is None) == (want is None)
        if want:
            assert r.b["class"] == want[0]
            for name, value in zip(("z_uniform", "z_runs", "z_serial", "z_text"), want[1:], strict=True):
                assert abs(r.b[name] - value) < 1e-6, (tokens[r.i], name)


def test_random_spans_equal_plain_version(spark):
    texts = made_texts()
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, s.start, s.end) for r in secrets.find(table).collect() for s in r.spans if s["rank"] == 3}
    base = {r.doc_id: [(s.start, s.end) for s in r.spans if s["rank"] < 3] for r in secrets.find(table).collect()}
    want = {(i, a, b) for i, a, b in plain_random(texts) if not any(x < b and a < y for x, y in base[i])}
    assert got == want and len(got) > 100


def test_many_matches_in_one_text_take_no_quadratic_time(spark):
    text = "token=abcdefghijklmnop " * 10_000
    began = time.perf_counter()
    row = secrets.redact(spark.createDataFrame([(1, text, 0)], "doc_id long, text string, n_chars long")).first()
    assert row.text == "[SECRET] " * 10_000 and row.n_chars == 9 * 10_000
    notice = "Released under the MIT License. something else follows here now " * 4_000
    assert licenses.scan(spark.createDataFrame([(1, notice)], "doc_id long, text string")).first().n_matches == 4_000
    assert time.perf_counter() - began < 60
