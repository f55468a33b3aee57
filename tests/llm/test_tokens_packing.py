"""Token pieces against the tokenizer itself, packing and the length histogram."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from adlake.llm import packing, queries, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = "byte_bpe_50k.json"


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(FILE))
    t.encode_special_tokens = True
    return t


def ids_of(texts):
    return [x.ids for x in tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = ["", "a", "  \n\t x  ", "<|endoftext|> it's 12 １２ ²", "é́ ß 漢字 \U0001f600 \x00​﻿", "x" * 5000, "\r\n   y", "ǅ ʰ ͅ ⅷ"]


def test_ids_are_the_tokenizers(spark, sf_small):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    encode = tokens.encoder(*tokens.ranks_of(FILE)).encode_ordinary
    assert [encode(t) for t in texts] == ids_of(texts)


def test_plan_holds_every_piece():
    rnd = random.Random(1)
    for _ in range(200):
        cap = rnd.choice([10, 64, 2048])
        histogram = {}
        for _ in range(rnd.randint(0, 40)):
            histogram[rnd.randint(1, cap)] = rnd.choice([1, 2, 3, 7, 1000, 10**6])
        planned = packing.plan(histogram, cap)
        held = Counter()
        for times, lengths in planned:
            assert times > 0 and 0 < sum(lengths) <= cap
            for n in lengths:
                held[n] += times
        assert held == Counter(histogram)
        ranks = defaultdict(list)
        for n, first, count, *_ in packing.slots(planned):
            ranks[n].append((first, count))
        for n, runs in ranks.items():
            assert sum(c for _, c in runs) == histogram[n]
            assert sorted(a for a, _ in runs) == list(np.cumsum([0] + [c for _, c in sorted(runs)])[:-1])
    with pytest.raises(ValueError):
        packing.plan({0: 1}, 10)


def test_packing_is_close_to_the_bound():
    assert sum(k for k, _ in packing.plan({1366: 10, 683: 10, 682: 10}, 2048)) <= 15
    planned = packing.plan({n: 50 for n in range(1, 2049)}, 2048)
    assert sum(k for k, _ in planned) <= 1.01 * 50 * sum(range(1, 2049)) / 2048 + 1


def test_packed_documents(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()] + [(-1, None), (-2, ""), (-3, "word " * 9000), (7, "again"), (7, "again"), (None, "x")]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, rank int, length string")
    out = packing.pack_documents(df, FILE, 2048).toPandas()
    expected = Counter()
    for (doc, _), ids in zip(rows, ids_of([t for _, t in rows]), strict=True):
        ids = [*ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        edges = [0, *range(first, len(ids) + 1, 2048)]
        for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            expected[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    got = Counter((None if d != d else int(d), *r) for d, *r in out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False))
    assert got == expected
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *np.cumsum(g.length).tolist()[:-1]] and g.length.sum() <= 2048
    assert out.sequence_id.nunique() <= 1.02 * out.length.sum() / 2048 + 1
    assert packing.pack_documents(df.limit(0), FILE, 2048).count() == 0


def test_length_histogram(spark, sf_small):
    rows = {r.context_limit: r for r in queries.QUERIES["op5_length_histogram"](spark, sf_small).collect()}
    lengths = np.array([len(x) for x in ids_of([r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()])])
    assert sorted(rows) == sorted(set(lengths.tolist()))
    for limit, r in rows.items():
        assert r.n_docs == (lengths == limit).sum() and r.n_longer == (lengths > limit).sum() and r.n_at_least == (lengths >= limit).sum()
        assert r.tokens_at_least == lengths[lengths >= limit].sum() and r.tokens_at_most == lengths[lengths <= limit].sum()
        assert r.truncated_total == np.minimum(lengths, limit).sum() and r.total_tokens == lengths.sum()
        assert abs(r.quantile - (lengths <= limit).mean()) < 1e-12
    docs = spark.createDataFrame([(1, None), (2, "a b c"), (2, "a b c"), (None, "x " * 9000)], "doc_id long, text string")
    made = tokens.length_histogram(tokens.token_lengths(docs, FILE))
    own = [len(x) for x in ids_of([r.text for r in docs.collect()])]
    for limit in (0, 1, 2, 5, 4096, 5000, 10**6):
        assert tokens.truncated_total(made, limit) == sum(min(x, limit) for x in own)
    assert tokens.quantile_length(made, 0.5) == sorted(own)[1]
    nothing = tokens.length_histogram(tokens.token_lengths(docs.limit(0), FILE))
    assert nothing.count() == 0 and tokens.quantile_length(nothing, 0.5) is None and tokens.truncated_total(nothing, 9) == 0
