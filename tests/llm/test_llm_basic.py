"""Each operator of the subpackage against a plain version, and on awkward tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from idloom.llm import bpe, chat, embeddings, fingerprint, html, licenses, packing, quality, queries, secrets, simhash
from tests.compare import SMALL, database, same_rows

AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog. All rights reserved.", "x", "s", 64),
    (2, None, "x", "s", None), (3, "", None, "s", 0), (None, "no id here token=abcdefghijkl012", "x", None, 5),
    (4, "word " * 30_000, "x", "s", 150_000), (5, "z" * 200_000, "x", "s", 200_000), (6, "é　ß 中文 <|endoftext|> x́", "x", "s", 9),
    (7, "same text twice, with enough words to be hashed here", "x", "s", 1), (8, "same text twice, with enough words to be hashed here", "x", "s", 1),
    (8, "same text twice, with enough words to be hashed here", "x", "s", 1),
]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and very long texts, ties, a repeated row, and columns that clash with what operators add."""
    rows = spark.createDataFrame(AWKWARD, DOCS)
    return rows.withColumns({"fingerprint": F.lit("clash"), "score": F.lit("clash"), "spans": F.lit(1), "_stats": F.lit(2), "ids": F.lit(3), "matches": F.lit(4)})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def tokenizer(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path(name))


WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    same_rows(queries.QUERIES[name](spark, SMALL).toPandas(), database().execute(queries.ORACLES[name]).df())


def brute_components(keys, near):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if near(a, b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: find(k) for k in keys}


def test_embeddings_awkward(spark):
    e = [0.1, 0.2, 0.3]
    rows = [(1, e, 1), (2, e, 1), (2, e, 1), (3, [0.2, 0.4, 0.6], 1), (4, e, 2), (5, e, None), (6, None, 1), (7, [0.0, 0.0, 0.0], 1), (8, [0.1, None, 0.3], 1), (9, [float("nan"), 1.0, 1.0], 1), (10, [float("inf"), 1.0, 1.0], 1), (11, [0.1, 0.2], 1), (12, [-0.1, -0.2, -0.3], 1), (13, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect())
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)]
    assert got == [(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (3, 3, 1, False), *alone]
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def planted(rng, n, d, cosine):
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r = rng.normal(size=(n, d))
    r -= (r * x).sum(1)[:, None] * x
    r /= np.linalg.norm(r, axis=1)[:, None]
    return x, cosine * x + np.sqrt(1 - cosine**2) * r


@pytest.mark.parametrize("dim", [2, 3, 5, 16, 256, 512])
def test_embedding_recall_by_dimension(dim):
    x, y = planted(np.random.default_rng(dim), 1000, dim, 0.93)
    a, b = embeddings.buckets(x), embeddings.buckets(y)
    assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean() > 0.97


def test_embedding_recall_at_the_threshold():
    x, y = planted(np.random.default_rng(1), 2000, 64, 0.93)
    a, b = embeddings.buckets(x), embeddings.buckets(y)
    assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean() > 0.99


def test_embeddings_hot_bucket_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "HOT_BUCKET", 20)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1, 16)) + rng.normal(size=(150, 16)) * 0.18
    table = spark.createDataFrame([(i, [float(v) for v in np.float32(r)], 0) for i, r in enumerate(x)], "vec_id long, embedding array<float>, label int")
    unit = np.float32(x).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= 0.93
    want = brute_components(list(range(150)), lambda a, b: near[a, b])
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(table).collect()}
    assert {k: v[1] for k, v in got.items()} == want
    assert {k: v[0] for k, v in got.items()} == {i: int(near[i].sum() - 1) for i in range(150)}


def test_chat_round_trip_and_black_box():
    rng = random.Random(1)
    bits = ["\\", "<", "[", "s", ">", "/", "INST", "]", "|", "im_end", "|>", "\n", "</s>", "<|im_end|>", "é"]
    text = lambda n: "".join(rng.choices(bits, k=rng.randrange(n)))
    for turns in [1, 2, 3, 5] * 40 + [150]:
        messages = [(text(5), text(12)) for _ in range(turns)]
        whole, locator, out = chat.render(messages), chat.Locator(chat.render), ""
        for role, said in messages:
            span, start, begin, end = locator.add(role, said)
            assert start == len(out) and chat.unescape(whole[begin:end]) == said
            out += span
        assert out == whole and list(chat.parse(out)) == messages and not locator.rewrites and not locator.dependent
        assert not any(c in chat.escape(said) for _, said in messages for c in chat.CONTROL)


def test_chat_finds_templates_that_rewrite_or_depend():
    shortens = chat.Locator(lambda m: "".join(f"[{r}]{t if i == len(m) - 1 else t.replace('think', '')}\n" for i, (r, t) in enumerate(m)))
    shortens.add("user", "think x")
    assert not shortens.rewrites
    shortens.add("assistant", "y")
    assert shortens.rewrites
    counts = chat.Locator(lambda m: "".join(f"[{r}{i}]{t}\n" for i, (r, t) in enumerate(m)))
    for _ in range(2 * chat.FULL):
        counts.add("user", "x")
    assert counts.dependent


def test_chat_awkward(spark):
    rows = [(1, 0, None, "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (None, 0, "assistant", "b\\n</s>"), (2, None, "a\nb", "x" * 100_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("span", F.lit(0))
    got = {r.conv_id: r for r in chat.digest(chat.format_turns(table)).collect()}
    assert (got[1].n_turns, got[1].loss_chars, got[1].turns_sha256) == (3, 0, hashlib.sha256(b"\na\nassistant\n\nassistant\n\n").hexdigest())
    assert got[None].loss_sha256 == hashlib.sha256(b"b\\n</s>").hexdigest()
    assert got[2].turns_sha256 == hashlib.sha256(b"a\nb\n" + b"x" * 100_000 + b"\n").hexdigest()
    assert chat.digest(chat.format_turns(table.limit(0))).count() == 0


def test_plan_is_valid_and_tight():
    rng = random.Random(3)
    for _ in range(150):
        capacity = rng.choice([10, 64, 4096])
        counts = {rng.randint(1, capacity): rng.randint(1, rng.choice([3, 200])) for _ in range(rng.randrange(1, 50))}
        plan = packing.plan_bins(counts, capacity)
        length = np.array([n for n, c in counts.items() for _ in range(c)])
        rank = np.array([i for c in counts.values() for i in range(c)])
        bins, offset = plan.place(length, rank)
        held: dict = {}
        for b, o, n in zip(bins, offset, length, strict=True):
            held.setdefault(b, []).append((o, n))
        assert set(held) == set(range(plan.bins))
        for items in held.values():
            at = 0
            for o, n in sorted(items):
                assert o == at
                at += n
            assert at <= capacity
            assert sum(3 * n > capacity for _, n in items) <= 2
        assert plan.bins <= first_fit(sorted(length, reverse=True), capacity) * 1.02 + 1


def first_fit(lengths, capacity):
    gaps = []
    for n in lengths:
        at = next((i for i, g in enumerate(gaps) if g >= n), None)
        if at is None:
            gaps.append(capacity - n)
        else:
            gaps[at] -= n
    return len(gaps)


def test_packing(spark, docs, none):
    got = packing.pack_documents(docs, queries.tokenizer_path(WORDS)).toPandas()
    encode = tokenizer(WORDS)
    want = []
    for doc_id, text, *_ in AWKWARD:
        ids = [*encode.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        for piece, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            part = ids[at : at + packing.CAPACITY]
            want.append((doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = [(None if np.isnan(r[0]) else int(r[0]), *map(int, r[1:])) for r in got[columns].itertuples(index=False)]
    assert sorted(rows, key=str) == sorted(want, key=str)
    for _, bin_ in got.groupby("sequence_id"):
        ordered = bin_.sort_values("offset")
        assert list(ordered.offset) == [0, *np.cumsum(ordered.length)[:-1]] and ordered.length.sum() <= packing.CAPACITY
    assert packing.pack_documents(none, queries.tokenizer_path(WORDS)).count() == 0


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(i, "some words here " * (i * 97 % 700)) for i in range(40)], "doc_id long, text string")
    encode = tokenizer(WORDS)
    pieces = {r.doc_id: [*encode.encode(r.text, add_special_tokens=False).ids, 1] for r in docs.collect()}
    seen = 0
    for row in packing.sequences(docs, queries.tokenizer_path(WORDS)).collect():
        ids, at = np.frombuffer(row.ids, "<u4").tolist(), 0
        for doc_id, n in zip(row.doc_ids, row.lengths, strict=True):
            assert ids[at : at + n] == pieces[doc_id]
            at += n
        seen += at
        assert at == len(ids)
    assert seen == sum(map(len, pieces.values()))


def test_word_encoder_equals_the_library(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["<|endoftext|> a", "\x1cab c", "Ǆ İstanbul ΑΣ. ", "é x́,, foo's we'll 12.5% __a_b  y　z", "O'NEIL's!!\t\tά", "ﬁx É É 가각 Ⅷ ² ª", ""]
    encode = tokenizer(WORDS)
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.WordEncoder(queries.tokenizer_path(WORDS)).encode(texts)] == [x.ids for x in encode.encode_batch(texts, add_special_tokens=False)]


def test_bpe_equals_the_library(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rng = random.Random(4)
    texts += ["".join(rng.choices("ab <|endoftext|>\n\t\x1c\x85　é中'sll3½²Ⅷ_-", k=rng.randrange(60))) for _ in range(1500)]
    texts += ["".join(rng.choices(["<|endoftext|>", " ", "\n", "'s", "x", "12", "é"], k=20)) for _ in range(300)] + ["a  b", "z" * 5000, " lead", "trail ", "\n x\n "]
    pairs, library = bpe.BytePairs(queries.tokenizer_path(BYTES)), tokenizer(BYTES)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert pairs.encode(text) == want.ids
        assert pairs.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)


def test_bpe_tables(spark, docs, none):
    path, library = queries.tokenizer_path(BYTES), tokenizer(BYTES)
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trips(docs, path).collect())
    want = []
    for doc_id, text, *_ in AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((str(doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    few = docs.where("doc_id in (1, 2, 6)")
    back = {r.doc_id: r.text for r in bpe.decode_documents(bpe.encode_documents(few, path), path).collect()}
    assert back == {1: AWKWARD[0][1], 2: "", 6: AWKWARD[6][1]}
    assert bpe.round_trips(none, path).count() == 0


def test_fingerprints_of_neighbours(spark, docs, none):
    got = {(r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprint.fingerprints(docs).collect()}
    order = sorted(((x[0], x[1] or "") for x in AWKWARD), key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    want = set()
    for i, (doc_id, text) in enumerate(order):
        changed = fingerprint.edited(text, order[(i + 1) % len(order)][1])
        want.add((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    assert got == want and fingerprint.fingerprints(docs).count() == len(AWKWARD)
    assert fingerprint.fingerprints(none).count() == 0
    alone = fingerprint.fingerprints(docs.where("doc_id = 1")).first()
    assert alone.near_next == 1.0


def test_order_minhash_follows_edits():
    rng = random.Random(5)
    sketch = lambda t: fingerprint.sketch(fingerprint.kmers(fingerprint.points(t)))
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    text = " ".join(words)
    one = " ".join(words[:200] + ["changed"] + words[201:])
    moved = " ".join(words[200:] + words[:200])
    other = " ".join("".join(rng.choices("klmnopqrst", k=6)) for _ in range(400))
    near = lambda t: fingerprint.likeness(sketch(text), sketch(t))
    assert near(text) == 1.0 and near(one) > 0.8 and near(other) == 0.0
    assert near(moved) < near(one)  # the same words in another order
    for a, b in ((text, other), ("ab", "cdefghijklmnop"), ("", text), (text, "")):
        p, q = fingerprint.points(a), fingerprint.points(b)
        joined = fingerprint._joined(p, fingerprint.kmers(p), q, fingerprint.kmers(q))
        assert np.array_equal(joined, fingerprint.kmers(fingerprint.points(fingerprint.edited(a, b))))


def plain_sketch(grams):
    """Order MinHash slot by slot, with whole numbers and lists."""
    full = 2**64 - 1
    if not grams:
        return [0] * 64

    def mix(x):
        for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = ((x ^ x >> shift) * odd) & full
        return x ^ x >> 31

    seen, rank = {}, []
    for g in grams:
        k = seen[g] = seen.get(g, -1) + 1
        rank.append(g if not k else mix((g + k * 0x9E3779B97F4A7C15) & full))
    slots = []
    for slot in range(64):
        for level in range(7):
            bits = 6 - level
            salt = int(fingerprint.function(level, slot >> bits))
            hashes = [mix(r ^ salt) if level else r for r in rank]
            own = sorted((h, i) for i, h in enumerate(hashes) if h >> 64 - bits == slot % (1 << bits))
            if len(own) >= 2 or len(grams) == 1:
                break
        value = 0 if len(grams) == 1 else level
        for i, place in enumerate(sorted(i for _, i in own[:2]) if len(grams) > 1 else [0]):
            value = mix((value + grams[place] + (i + 1) * 0x9E3779B97F4A7C15) & full)
        slots.append(max(1, value >> 32))
    return slots


def test_order_minhash_selection_equals_plain_version():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 3, 5, 40, 130, 300, 900, 5000):
        for kinds in (max(1, n // 2), 2, 10**6):
            grams = rng.integers(0, 2**63, max(1, kinds), dtype=np.uint64)[rng.integers(0, max(1, kinds), n)]
            assert list(fingerprint.sketch(grams)) == plain_sketch([int(g) for g in grams])


def test_fingerprints_equal_plain_version(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = sorted(texts, reverse=True)
    shown = lambda slots: "".join(f"{x:08x}" for x in slots)
    plain = lambda t: plain_sketch([int(g) for g in fingerprint.kmers(fingerprint.points(t))])
    some = {i for i in ids if len(texts[i]) < 700}
    for r in fingerprint.fingerprints(spark.read.parquet(f"{SMALL}/documents.parquet")).collect():
        if r.doc_id in some:
            following = texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
            own, changed = plain(texts[r.doc_id]), plain(fingerprint.edited(texts[r.doc_id], following))
            assert r.fingerprint == shown(own) and r.edited_fingerprint == shown(changed)
            assert abs(r.near_edited - sum(x == y for x, y in zip(own, changed, strict=True)) / 64) < 1e-12
    assert len(some) > 20


def test_order_counts_in_short_texts():
    rng = random.Random(9)
    for size in (70, 100, 150):
        swapped = []
        for _ in range(40):
            text = "".join(rng.choices("abcdefghijklmnop", k=size))
            a, b = (fingerprint.sketch(fingerprint.kmers(fingerprint.points(t))) for t in (text, text[size // 2 :] + text[: size // 2]))
            swapped.append(fingerprint.likeness(a, b))
        assert np.mean(swapped) < 0.45  # plain MinHash is above 0.55 here


def spans_in(text):
    assign = re.compile(r"(?:%s)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)" % "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")))
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secrets_base_equals_python(spark, docs, none):
    rng = random.Random(7)
    bits = ["token", "api_key", "ApiKey", "PASSWORD", "secret", "=", ":", " ", "'", '"', "abcdefghijkl", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é", "ſecret=abcdefghijklmnop", ".", "short", "\n"]
    made = spark.createDataFrame([(100 + i, "".join(rng.choices(bits, k=rng.randrange(25)))) for i in range(400)], "doc_id long, text string")
    for table in (made, docs):
        for r in secrets.scan(table.withColumn("t", F.col("text")).select("doc_id", "text", "t")).join(table.dropDuplicates(["doc_id"]).select("doc_id", F.col("text").alias("t")), "doc_id").collect():
            base = spans_in(r.t or "")
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert ",".join(s for s in r.spans.split(",") if not s.startswith("random")) == base
    assert secrets.scan(docs).count() == len(AWKWARD) and secrets.scan(none).count() == 0


def test_randomness_battery_tells_keys_from_names(spark):
    import string

    rng = random.Random(8)
    words = "the quick brown fox over lazy dog international configuration available document number processing identifier language version security model value window public static".split()
    rows = [("key", "".join(rng.choices(string.ascii_letters + string.digits, k=40))) for _ in range(100)]
    rows += [("name", rng.choice("-_/").join(rng.choices(words, k=6))) for _ in range(500)] + [("name", "abcdefghijklmnopqrstuvwxyz0123456789"), ("name", "abc123" * 10)]
    table = spark.createDataFrame([(i, k, f"é {t}, x") for i, (k, t) in enumerate(rows)], "doc_id long, k string, text string")
    got = secrets.find(table).select("k", F.exists("spans", lambda s: s["rank"] == 3).alias("hit")).groupBy("k").agg(F.avg(F.col("hit").cast("int")).alias("share")).collect()
    share = {r.k: r.share for r in got}
    assert share["key"] > 0.95 and share["name"] < 0.02


def test_redaction(spark, docs):
    table = spark.createDataFrame([(3, "token=abcdefghijklmn x AKIA" + "B" * 16 + ' password: "0123456789abcdef0123" é0123456789abcdef', 9)], "doc_id long, text string, n_chars long")
    row = secrets.redact(table).first()
    assert (row.text, row.n_chars) == ('[SECRET] x [SECRET] [SECRET]" é[SECRET]', 39)
    same = secrets.redact(docs)
    assert same.columns == docs.columns and same.count() == len(AWKWARD) and same.where("doc_id = 2").first().text is None


def test_simhash_equals_brute_force(spark, docs, none):
    import xxhash

    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").unionByName(docs.where("doc_id is not null").select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    prints = {}
    for doc_id, text in small.collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
        hashes = np.array([xxhash.xxh64_intdigest(g.encode(), 42) for g in grams], np.uint64)
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))
    want = brute_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = {(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(small).collect()}
    assert got == {(i, p, want[i]) for i, p in prints.items()}
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_first(docs.select("doc_id", "text", "fingerprint"), 5)
    assert kept.columns == ["doc_id", "text", "fingerprint"] and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "5", "6", "7", "None"]


@pytest.mark.parametrize("hot", [10, 20_000])
def test_trie_join_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_GROUP", hot)
    rng = random.Random(9)
    keys = {rng.getrandbits(64) for _ in range(60)}
    for centre in list(keys)[:4]:  # clusters: copies at up to 5 bits
        for _ in range(40):
            keys.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(6))}))
    signed = [k - 2**64 if k >= 2**63 else k for k in keys]
    want = brute_components(sorted(keys), lambda a, b: (a ^ b).bit_count() <= 3)
    links = simhash.links(spark.createDataFrame([(k,) for k in signed], "fp long")).collect()
    pairs = {tuple(sorted((r.left % 2**64, r.right % 2**64))) for r in links}
    assert brute_components(sorted(keys), lambda a, b: (a, b) in pairs) == want
    assert len(links) <= 4 * len(keys) * (1 if hot > 1000 else 20)


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header><nav><a>m</a></nav><div id="cookie-banner">We use</div>
<main><article class="post has-sidebar"><header><h1>T &eacute;</h1><span>By</span></header><p>a<br>b <i>c</i>d &amp; e<p>open<ul><li>x<li>y</ul><aside>z</aside>
<div class="share-buttons">s</div><form>f</form><pre>  q
 r</pre><div>Follow {n}</div></article><section class="comments"><article class="comment"><p>nice</p></article></section></main><footer>f</footer></body></html>"""


def test_html_page():
    assert html.extract(PAGE) == "T é\n\na b cd & e\n\nopen\n\nx\n\ny\n\nq r\n\nFollow {n}"
    assert html.extract("") == "" and html.extract("plain < text") == "plain < text" and html.extract("<p>a<script>never closed") == "a"


def test_html_site_templates(spark):
    rows = [(i, f"https://a.example/{i}", PAGE.replace("Follow {n}", "Follow us daily").replace("open", f"own {i}")) for i in range(8)]
    rows += [(20, "https://b.example/1", PAGE), (21, None, None), (22, "not a url", ""), (23, "https://c.example/", "<p>x</p>"), (23, "https://c.example/", "<p>x</p>")]
    rows += [(30 + i, f"http://d.example/{i}", f"<body><div>Menu of all things</div><p>text {i}</p><div>Imprint</div></body>") for i in range(6)]
    rows += [(40 + i, f"http://e.example/{i}", "<body><p>the same</p></body>") for i in range(6)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {}
    for r in html.main_texts(table).collect():
        got[r.page_id] = r.text
        assert r.n_chars == len(r.text)
    assert got[3].endswith("own 3\n\nx\n\ny\n\nq r")  # the recurring box inside the article has gone
    assert got[20].endswith("Follow {n}") and got[21] == got[22] == "" and got[23] == "x"
    assert got[32] == "text 2" and got[41] == "the same"
    assert html.main_texts(table).count() == len(rows) and html.main_texts(table.limit(0)).count() == 0


def test_html_equals_plain_version_on_pages(spark):
    import html as std

    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in html.main_texts(spark.read.parquet(f"{SMALL}/pages.parquet")).collect():
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.DOTALL)[1]
        blocks = [" ".join(std.unescape(re.sub("<br>", " ", re.sub("</?b>", "", x))).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(x for x in blocks if x)


def test_quality_on_held_out_labels(spark, docs, none):
    rows, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.classify(rows, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(scored) > 30 and (scored.predicted == scored.quality).mean() > 0.95
    rules = quality.learn(rows, labels)
    table = quality.score(quality.statistics(rows.limit(50)).select("doc_id", "text", F.col("_stats").alias("s")), rules).select("s.*", "score").toPandas()
    assert np.allclose(rules.score(table[list(quality.STATISTICS)].to_numpy()), table.score, atol=1e-9)
    other = quality.classify(docs, labels)
    assert other.count() == len(AWKWARD) and other.where("score is null or score < 0 or score > 1").count() == 0
    twins = {r.score for r in other.where("doc_id in (7, 8)").collect()}
    assert len(twins) == 1
    assert quality.classify(none, labels).count() == 0 and quality.classify(docs, labels.limit(0)).count() == len(AWKWARD)
    assert quality.keep(docs, labels).columns == docs.columns
    bits = {r.doc_id: r.held_out for r in other.collect()}
    assert all(bits[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in (1, 2, 3, 4, 5, 6, 7, 8))


def test_quality_learns_from_no_held_out_label(spark):
    rows, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.learn(rows, flipped) == quality.learn(rows, labels)


def test_licenses_awkward(spark, docs, none):
    got = {str(r.doc_id): r.matches for r in licenses.scan(docs).collect()}
    assert got["1"] == "all-rights-reserved:45:64" and got["2"] == got["3"] == got["5"] == ""
    assert licenses.scan(docs).count() == len(AWKWARD) and licenses.scan(none).count() == 0
    apache = licenses.TEMPLATES["apache-2.0-disclaimer"]
    worn = apache.replace("applicable", "any").replace("express", "given")
    table = spark.createDataFrame([(1, f"é {apache} {'and so on ' * 20} {apache}"), (2, worn), (3, " ".join(apache.split()[:12])), (4, apache.upper().replace(" ", "\n"))], "doc_id long, text string")
    found = {r.doc_id: (r.n_matches, r.matches) for r in licenses.scan(table).collect()}
    assert found[1][0] == 2 and found[1][1].startswith(f"apache-2.0-disclaimer:2:{1 + len(apache)},")
    assert found[2][0] == 1 and found[3][0] == 0 and found[4][0] == 1


def test_license_retrieval_reaches_every_place(spark):
    rng = random.Random(10)
    rows = []
    for name, text in licenses.TEMPLATES.items():
        for _ in range(6):
            noise = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(rng.randrange(60)))
            rows.append((len(rows), name, f"{noise()} {text} {noise()}"))
    table = spark.createDataFrame(rows, "doc_id long, name string, text string")
    found = {r.doc_id: r.matches for r in licenses.scan(table).collect()}
    assert all(f"{name}:" in found[i] for i, name, _ in rows)


def test_native_operators_have_no_python(spark, docs):
    for table in (licenses.scan(docs), secrets.scan(docs)):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
