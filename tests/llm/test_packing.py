"""Packing: every id in exactly one piece, windows without gaps, neighbours by BM25."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brakelight.llm import packing
from brakelight.llm.queries import tokenizer_path

FILE = "byte_bpe_50k.json"
SCHEMA = "doc_id long, text string, ids string, row string, term string, kind string"


def encoded(text):
    from tokenizers import Tokenizer

    encoded.tok = getattr(encoded, "tok", None) or Tokenizer.from_file(tokenizer_path(FILE))
    return [*encoded.tok.encode(text or "", add_special_tokens=False).ids, 1]


def rows():
    rng = np.random.default_rng(5)
    topics = [["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(60)] for _ in range(8)]
    out = [(i, " ".join(rng.choice(topics[i % 8], int(rng.integers(1, 500))))) for i in range(160)]
    out += [(1000, None), (1001, ""), (1002, " ".join(topics[0]) * 150), (None, "no id"), (3, "repeated id"), (3, "repeated id")]
    return out + [(2000 + i, "the same copy of a text " * 30) for i in range(80)]


@pytest.mark.parametrize("seq_len, shard", [(256, 4000), (256, 1), (2048, 1 << 19)])
def test_pieces_cover_every_id_once(spark, seq_len, shard):
    data = rows()
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in data], SCHEMA).repartition(4)
    got = packing.pack(df, tokenizer_path(FILE), seq_len=seq_len, shard_tokens=shard).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
        by_seq[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t in data:
        want[i].append(encoded(t))
    assert set(by_doc) == set(want)
    for i, docs in want.items():
        pieces = sorted(by_doc[i], key=lambda x: (x[0], len(x[1])))
        if len(docs) == 1:
            assert sum((x for _, x, _ in pieces), []) == docs[0] and {n for *_, n in pieces} == {len(docs[0])}
            assert [s for s, *_ in pieces] == np.cumsum([0] + [len(x) for _, x, _ in pieces[:-1]]).tolist()
        else:
            assert sorted(t for _, x, _ in pieces for t in x) == sorted(t for d in docs for t in d)
    for pieces in by_seq.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0] + [n for _, n in pieces[:-1]]).tolist()
        total = sum(n for _, n in pieces)
        assert total == seq_len or total < seq_len and total & (total - 1) == 0  # nothing to pad


def test_index_gives_bm25_scores():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50, int(rng.integers(1, 80))) for _ in range(30)]
    df = {t: sum(t in d for d in docs) for t in range(50)}
    stats = packing.Idf({-1: 30, -2: sum(map(len, docs)), **{t: n for t, n in df.items() if n}})
    index, mean = packing.Index(docs, stats), sum(map(len, docs)) / 30
    for q in docs[:5]:
        want = [sum(np.log(1 + (30 - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
                    for t in set(q.tolist()) for tf in [(d == t).sum()] if tf) for d in docs]
        assert np.allclose(index.scores(np.unique(q)), want, rtol=1e-5)


def test_windows_hold_neighbours(spark):
    """Two documents of one topic share a window far more often than chance."""
    rng = np.random.default_rng(9)
    topics = [["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(40)] for _ in range(10)]
    data = [(i, " ".join(rng.choice(topics[i % 10], 60))) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string").coalesce(1)
    got = packing.pack(df, tokenizer_path(FILE), seq_len=1024).collect()
    windows = defaultdict(set)
    for r in got:
        windows[r.sequence_id].add(r.doc_id % 10)
    sizes = [len(w) for w in windows.values()]
    assert np.mean(sizes) < 2.2


def test_empty_table_and_crc(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert packing.pack(none, tokenizer_path(FILE)).collect() == []
    one = packing.pack(spark.createDataFrame([(1, "a text")], "doc_id long, text string"), tokenizer_path(FILE))
    (r,) = one.select(F.crc32("ids").alias("c"), "length").filter("length >= 2").collect()[:1]
    ids = encoded("a text")
    assert r.c == zlib.crc32(np.array(ids[:r.length], "<u4").tobytes())
