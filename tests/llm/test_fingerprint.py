"""Improbable-feature digests: entropy and pairing against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np

from adlake.llm import fingerprint as fp, queries


def test_entropy_classes():
    rnd = random.Random(2)
    for _ in range(40):
        data = bytes(rnd.choice(b"abcdefgh ") for _ in range(rnd.randint(0, 300)))
        got = fp.entropy_classes(np.frombuffer(data, np.uint8))
        assert len(got) == max(0, len(data) - 63)
        for i, c in enumerate(got.tolist()):
            bits = 16 * (6 - sum(n * math.log2(n) for n in Counter(data[i : i + 64]).values()) / 64)
            assert c == int(bits) or (abs(bits - round(bits)) < 1e-3 and abs(c - bits) < 1.01)


def test_features_do_not_depend_on_neighbours():
    rnd = random.Random(3)
    texts = [bytes(rnd.choice(b"abcdefghijklmnop   ") for _ in range(rnd.choice([0, 3, 63, 64, 200, 127, 128, 900, 5000]))) for _ in range(30)]
    rank = np.random.default_rng(1).permutation(fp.CLASSES)
    together = fp.features(texts, rank)
    for t, f in zip(texts, together, strict=True):
        assert (fp.features([t], rank)[0] == f).all() and (len(f) > 0) == bool(t)


def test_likeness():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    a = " ".join(word() for _ in range(900))
    near = a[:2000] + "XX" + a[2000:5000] + "yy" + a[5000:]
    other = " ".join(word() for _ in range(900))
    rank = np.arange(fp.CLASSES)
    d = [fp.digest(f) for f in fp.features([x.encode() for x in (a, near, other, "", "q")], rank)]
    assert fp.likeness_of(d[0], d[0]) == 1.0 and fp.likeness_of(d[0], d[1]) > 0.6 and fp.likeness_of(d[0], d[2]) < 0.1
    assert fp.likeness_of(d[3], d[3]) == 1.0 and fp.likeness_of(d[3], d[0]) == 0.0 and fp.likeness_of(d[0], d[1]) == fp.likeness_of(d[1], d[0])


def test_query(spark, sf_small):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect())
    out = {r.doc_id: r for r in queries.QUERIES["op9_improbable_features"](spark, sf_small).collect()}
    near_edited = near_next = 0
    for (d, t), (e, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        o = out[d]
        assert o.n_chars == len(t) and o.edited_sha256 == hashlib.sha256((t[: len(t) - half] + n[:half]).encode()).hexdigest()
        assert o.near_next == fp.likeness_of(o.fingerprint, out[e].fingerprint)
        assert o.near_edited == fp.likeness_of(o.fingerprint, o.edited_fingerprint)
        near_edited += o.near_edited
        near_next += o.near_next
    assert near_edited / len(rows) > 0.4 and near_next / len(rows) < 0.05
    by = {}
    for d, t in rows:
        by.setdefault(t, set()).add(out[d].fingerprint)
    assert all(len(x) == 1 for x in by.values())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "a", 2), (2, "x" * 90_000, 3), (2, "x" * 90_000, 3)], "doc_id long, text string, range int")
    rank = fp.ranks(fp.entropy_histogram(docs))
    out = sorted(((r.id, r.n_chars, r.near_next) for r in fp.edit_likeness(docs, rank).collect()), key=str)
    assert out == sorted([(None, 0, 1.0), (1, 0, 0.0), (1, 1, 0.0), (2, 90_000, 1.0), (2, 90_000, 0.0)], key=str)
    assert fp.edit_likeness(docs.limit(0), rank).count() == 0
    assert fp.edit_likeness(docs.where("text = 'a'"), rank).collect()[0].near_next == 1.0
    assert fp.fingerprint(docs, rank).count() == 5


def plain_features(text, rank):
    """By the definition, window by window; a set of the selected windows' bytes."""
    import math
    from collections import Counter

    def entropy_class(window):
        total = sum(round(c * math.log2(c) * (1 << 20)) for c in Counter(window).values())
        return min(max((6 * (1 << 20) - total // 64) * 16 // (1 << 20), 0), 96)

    windows = [text[i : i + 64] for i in range(len(text) - 63)]
    ranked = [(rank[entropy_class(w)], i) for i, w in enumerate(windows)]
    votes = Counter(min(ranked[i : i + 64])[1] for i in range(len(ranked) - 63))
    chosen = [windows[i] for i in sorted(votes) if votes[i] >= 16]
    short = sorted({text[i : i + 8] for i in range(len(text) - 7)}) if 8 <= len(text) < 256 else []
    return chosen, short


def plain_likeness(a, b):
    """Of two chains, as lists of sets of bits."""
    import math

    if not a or not b:
        return float(not a and not b)
    if a == b:
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    total = 0.0
    for x in a:
        best = 0.0
        for y in b:
            most = min(len(x), len(y))
            chance = len(x) * len(y) / 2048
            chance = min(chance + 3 * math.sqrt(chance * (1 - len(y) / 2048)), most - 1)
            best = max(best, min(max((len(x & y) - chance) / (most - chance), 0.0), 1.0))
        total += best
    return total / len(a)


def test_digests_and_likeness_against_brute_force():
    import random

    import numpy as np
    from adlake.llm import fingerprint as fp
    from adlake.llm.common import U64, mix64
    from adlake.llm.repeats import substring_hashes

    rnd = random.Random(11)
    words = ["lorem", "ipsum", "DOLOR", "sit!!", "amet", "éà", "0123456789", "aaaa", "zq|x"]
    make = lambda n: " ".join(rnd.choice(words) + str(rnd.randrange(99)) for _ in range(n)).encode()
    texts = [make(n) for n in (1, 3, 12, 20, 40, 120, 400, 4000)] + [b"", b"x", b"a" * 700, bytes(rnd.randrange(256) for _ in range(900)), b"ab" * 100]
    texts.append(texts[6][: len(texts[6]) // 2] + texts[5])
    rank = fp.ranks(np.array([(i * 37) % 101 for i in range(fp.CLASSES)], np.int64))
    chains = []
    for text, got in zip(texts, fp.features(texts, rank), strict=True):
        chosen, short = plain_features(text, rank.tolist())
        own = [int(mix64(substring_hashes(np.frombuffer(w, np.uint8), 64))[0]) for w in chosen]
        own += sorted({int(mix64(substring_hashes(np.frombuffer(w, np.uint8), 8) + U64(256))[0]) for w in short})
        if own or not text:
            assert got.tolist() == own, text[:40]
        else:
            assert len(got) == 1
        chain = [{(h >> 11 * i) & 2047 for h in got.tolist()[a : a + 160] for i in range(5)} for a in range(0, len(got), 160)]
        parsed = fp.parse(fp.digest(got)) if len(got) else np.zeros((0, 256), np.uint8)
        assert [set(np.flatnonzero(np.unpackbits(row)).tolist()) for row in parsed] == chain
        chains.append((parsed, chain))
    assert max(len(c) for _, c in chains) > 1
    for a, x in chains:
        for b, y in chains:
            assert abs(fp.likeness(a, b) - plain_likeness(x, y)) < 1e-9
