"""Each operator against a brute-force version on rows with nulls, empties, ties, repeats and clashing columns."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brakelight.llm import contam, exact, idfiles, langid, mixing, neardup, pii, secrets, tokens, warc
from brakelight.llm.common import WORD_BYTES, byte_words, ordered_prefix, scratch_path
from brakelight.llm.queries import tokenizer_path

LONG = "lorem ipsum dolor sit amet " * 4000
BASE = " ".join(f"word{i}" for i in range(120))
ROWS = [
    (1, BASE, "en", "a"), (2, BASE.upper(), "en", "a"), (3, BASE.replace("word60", "other"), "en", "b"),
    (4, None, None, None), (5, "", "de", ""), (6, LONG, "en", "a"), (7, "Straße über Ärger", "de", "b"),
    (7, "Straße über Ärger", "de", "b"), (8, "!!! ...", "en", "a"), (None, "no id here at all", "en", None),
    (9, "x" * 3000, "en", "a"), (10, "STRASSE über ärger", "de", "b"),
    (11, "password = hunter2hunter2 AKIA" + "A1" * 9 + " deadbeef" * 1 + " " + "0123456789abcdef" * 2, "en", "c"),
    (12, "mail joe.doe@mail.example.com or +1 (555) 010-9999, card 4111 1111 1111 1111, host 10.0.0.255 v 1.2.3.999",
     "en", "c"),
    (13, "key 9fQ2zXw7LmP4vT8sYb1KdR6h and joe (at) example (dot) com, call 555-234-9876 ssn 123-45-6789", "en", "c"),
    (14, "  two  spaces\n\n and\tтекст 日本語 😀 <|endoftext|> ", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_tokens string, id string, row string, w string"


@pytest.fixture(scope="module")
def docs(spark):
    # further columns clash with names that the operators use themselves
    return spark.createDataFrame([(*r, "n", "i", "r", "w") for r in ROWS], SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(rows):
    return sorted(map(repr, rows))


def test_token_counts_match_the_library_at_every_prefix(docs, none):
    import sentencepiece

    file = tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=file)
    got = tokens.count_tokens(docs, file, limit=50).collect()
    assert counted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == counted(
        (i, len((t or "").encode()), n, n > 50) for i, t, *_ in ROWS for n in [len(sp.encode(t or ""))])
    for r in got:
        t = next(t or "" for i, t, *_ in ROWS if i == r.doc_id)[:400]
        steps = np.cumsum(np.frombuffer(r.prefix_steps, np.int8).astype(int))[:400]
        assert steps.tolist() == [len(sp.encode(t[:k + 1])) for k in range(len(t))]
    cut = tokens.count_tokens(docs, file).select(
        "doc_id", "n_chars", tokens.prefix_within(F.col("prefix_steps"), 5).alias("k"), "prefix_steps")
    for r in cut.withColumn("at", tokens.prefix_tokens(F.col("prefix_steps"), F.col("k"))).collect():
        assert r.at <= 5 and (r.k == r.n_chars or r.k < r.n_chars)
    assert tokens.count_tokens(none, file).count() == 0


def test_mix_meets_targets_and_reruns_agree(docs, none):
    def run():
        return mixing.taken_per_document(mixing.mix(docs, block_words=16, shard_words=256)).collect()

    got = run()
    assert counted(got) == counted(run()) and len(got) == len(ROWS)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    total = sum(r.size for r in got)
    by = {}
    for r in got:
        by.setdefault(r.source, [r.source_size, r.target, 0])[2] += r.taken
    assert abs(sum(t for _, t, _ in by.values()) - 1.5 * total) < 1e-6
    for size, target, taken in by.values():
        assert target <= 2 * size and abs(taken - target) <= 0.5
    draws = mixing.placed(mixing.mix(docs, block_words=16, shard_words=256)).collect()
    assert len({(r.shard, r.position) for r in draws}) == len(draws)
    assert mixing.mix(none).count() == 0


def test_splitting_tree_is_exact_and_disjoint():
    quotas = np.array([17, 0, 5, 1000])
    parts = [mixing.split_quotas(quotas, s, 7, 3) for s in range(7)]
    assert (sum(c for _, c in parts) == quotas).all()
    for (a, n), (b, _) in zip(parts, parts[1:]):
        assert (a + n == b).all()
    sizes = [int(c.sum()) for _, c in parts]
    assert max(sizes) - min(sizes) <= 3


def test_id_files_round_trip(spark, docs, none):
    from tokenizers import Tokenizer

    file = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(file)
    path = scratch_path(spark, "test-ids")
    manifest = idfiles.write_ids(docs, path, file, seq_len=64, batch_seqs=4)
    got = sorted(idfiles.read_documents(spark, path).collect(), key=lambda r: r.start)
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t, *_ in ROWS}
    assert [r.doc_id for r in got] == [None] + sorted(i for i, *_ in ROWS if i is not None)
    at = 0
    for r in got:
        x = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(x), zlib.crc32(np.asarray(x, "<u4").tobytes()))
        at += len(x)
    # random access to equal-length sequences
    stream = [k for r in got for k in ids[r.doc_id]]
    files = sorted(manifest.collect(), key=lambda m: m.part)
    reader = idfiles.open_ids(path, files[0].file)
    seq, mask = idfiles.sequence(reader, 0, 4)
    assert seq[mask].tolist() == stream[:min(64, files[0].n_ids)] and len(seq) == 64
    empty = scratch_path(spark, "test-ids")
    idfiles.write_ids(none, empty, file)
    assert idfiles.read_documents(spark, empty).count() == 0


def test_secrets(docs, none):
    got = {r.doc_id: r for r in secrets.scan_secrets(docs).withColumn("t", secrets.span_text(F.col("spans"))).collect()}
    text = dict((i, t) for i, t, *_ in ROWS)
    a = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for i, r in got.items():
        t = text[i] or ""
        base = ([(m.start(), 0, m.end()) for m in a.finditer(t) if len(m[1]) >= 6]
                + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
                + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])
        assert [tuple(x) for x in r.base] == sorted(base)
    assert (got[11].n_assign, got[11].n_access, got[11].n_hex) == (1, 1, 1)
    s = text[13].index("9fQ2")
    assert got[13].t == f"entropy:{s}:{s + 24}" and got[6].t == got[9].t == ""
    assert secrets.scan_secrets(none).count() == 0


def _flagged(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [[tuple(x) for x in r.spans] for r in secrets.scan_secrets(rows).orderBy("doc_id").collect()]


def test_random_keys_of_every_alphabet_are_found(spark):
    """As many uniformly random keys of 20 characters pass in each class as in base62."""
    rng = np.random.default_rng(4)
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    for chars in (low + num, up + num, up + "234567", low + "234567", low + up + num):
        keys = ["".join(rng.choice(list(chars), 20)) for _ in range(400)]
        keys = [k for k in keys if re.search("[0-9]", k) and re.search("[A-Za-z]", k)]
        found = _flagged(spark, [f"see {k} here" for k in keys] + [f"see conf/{k} here" for k in keys])
        assert sum(map(bool, found[:len(keys)])) > 0.83 * len(keys)
        assert sum(map(bool, found[len(keys):])) > 0.83 * len(keys)
    # neither digits alone nor words get a lower limit
    assert _flagged(spark, ["a/94378120563478120956", "a1_internationalizationservice"]) == [[], []]
    e = [-(p * np.log2(p)).sum() for p in (np.unique(x, return_counts=True)[1] / 20 for x in rng.integers(0, 36, (4000, 20)))]
    mean, sd = secrets.entropy_moments(36, 20)
    assert abs(np.mean(e) - mean) < 0.01 and abs(np.std(e) - sd) < 0.01


def test_allow_list_suppresses_only_what_overlaps_it(spark):
    key = "9fQ2zXw7LmP4vT8sYb1KdR6hWc3N"
    n = len(key)
    texts = [f"/sample/v1/{key}", f"example_{key}", key + "AAAAAAAA" + key, key + "0123456789",
             "sample_9fQ2zXw7LmP4vT8", "123e4567-e89b-12d3-a456-426614174000", "0123456789abcdefghij0123456789"]
    found = _flagged(spark, texts)
    assert [[k for _, k, _ in x] for x in found] == [[3], [3], [3], [3], [], [], []]
    # no part of the allow-list is in the span, all of the key is
    assert 7 <= found[0][0][0] <= 11 and found[0][0][2] == 11 + n
    assert 7 <= found[1][0][0] <= 8 and found[1][0][2] == 8 + n
    assert found[2][0] == (0, 3, 2 * n + 8) and found[3][0] == (0, 3, n)


def test_window_entropy_is_the_entropy_of_each_window(spark):
    word = "aab0cdefZZ9/+aaaa7bc"
    codes = F.lit([secrets.ALPHABET.index(c) + 1 for c in word])
    got = spark.range(1).select(secrets.window_entropy(codes, 8).alias("h")).first().h
    for k, h in enumerate(got):
        p = np.unique(list(word[k:k + 8]), return_counts=True)[1] / 8
        assert abs(h + (p * np.log2(p)).sum()) < 1e-9
    assert len(got) == len(word) - 7


def test_personal_data(docs, none):
    got = {r.doc_id: r for r in pii.find_pii(docs).withColumn("t", pii.span_text(F.col("spans"))).collect()}
    r, text = got[12], dict((i, t) for i, t, *_ in ROWS)[12]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert [text[x.s:x.e] for x in r.base] == ["joe.doe@mail.example.com", "10.0.0.255", "4111 1111 1111 1111",
                                                "+1 (555) 010-9999"]
    assert all(set(map(tuple, x.base)) <= set(map(tuple, x.spans)) for x in got.values())
    assert len(got[6].spans) == len(got[4].spans) == 0
    assert pii.find_pii(none).count() == 0


def test_voters_learn_who_to_trust():
    good, bad = "0,1,1,1,-1", "0,0,0,-1,0"
    post = pii.fit_voters([(good, 90), (bad, 60), ("0,1,0,-1,0", 5)])
    assert post[good] > 0.9 and post[bad] < 0.1


def test_language_id(spark, docs, none):
    en, de = "the cat and the dog went with them to that house", "der hund und die katze gehen nicht durch das haus"
    rows = [(i, en if i % 2 else de, "en" if i % 2 else "de") for i in range(60)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    ask = [(1, en), (2, de), (3, " ".join([en, de] * 1)), (4, None), (5, "123 ..."), (6, "текст без модели")]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(ask, "doc_id long, text string"), model, 6.0).collect()}
    assert (got[1].lang_pred, got[2].lang_pred, got[4].lang_pred, got[5].lang_pred) == ("en", "de", "und", "und")
    assert got[3].spans == "en:0:11,de:11:21" and 0.4 < got[3].score < 0.6
    assert got[6].lang_pred in ("en", "de") and got[6].score == 0.0
    assert [got[i].held_out for i in (1, 2, 3)] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 3)]
    assert langid.train(none) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    lens = np.array([3, 0, 5, 1])
    scores = rng.normal(size=(9, 3)).astype(np.float32) * 3
    labels, at = langid.viterbi(scores, lens, 2.0), 0
    import itertools

    for n in lens:
        s = scores[at:at + n]
        value = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        best = max((value(p) for p in itertools.product(range(3), repeat=int(n))), default=0)
        assert abs(value(labels[at:at + n].tolist()) - best) < 1e-4
        at += n


def test_decontamination_matches_brute_force(spark, docs, none):
    items = [(1, " ".join(f"word{i}" for i in range(50, 70))), (2, "word5 WORD6 word7"), (3, "amet"), (4, None), (5, ""),
             (None, BASE), (10, "word5 word6 word7"), (6, "never seen here")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contam.decontaminate(docs, bench).collect()
    want = []
    for i, t, *_ in ROWS:
        w, hit, found = byte_words(t), set(), set()
        for item, it in items:
            x = byte_words(it)
            if not x:
                continue
            for k in range(max(1, len(x) - 12)):
                win = x[k:k + 13]
                for s in range(len(w) - len(win) + 1):
                    if w[s:s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        found |= {str(item)} - {"None"}  # hits count, but there is no id to list
        want.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    assert counted(tuple(r) for r in got) == counted(want)
    assert sum(r[4] for r in want) >= 3
    assert contam.decontaminate(none, bench).count() == 0
    assert contam.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_decontamination_has_no_lambda_per_word(spark, docs):
    # a function per word of an array is not compiled: positions are rows of a generated loop instead
    seen, real = [], contam.scratch_table

    def keep(df, label, *rest):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label, *rest)

    contam.scratch_table = keep
    try:
        got = contam.decontaminate(docs, spark.createDataFrame([(1, "amet"), (2, "word5 word6 word7")], "item_id long, text string"))
    finally:
        contam.scratch_table = real
    assert got.filter("n_hit > 0").count() and any("xxhash64" in p for p in seen)
    assert not any("lambdafunction" in line and "xxhash64" in line for p in seen for line in p.splitlines())


def test_full_cache_keeps_the_words_at_hand():
    import pyarrow as pa

    enc = idfiles.Encoder(tokenizer_path("byte_bpe_50k.json"))
    enc.limit, asked, real = 4, [], enc._encode_joined
    enc._encode_joined = lambda chunks, tok: (asked.extend(chunks), real(chunks, tok))[1]
    texts = ["often seen often", "often other seen", "seen often", None, "often x often", "seen  y\noften seen"]
    for _ in range(3):
        for t in texts:
            ids, n = enc.encode(pa.array([t], pa.string()), 1)
            assert ids.tolist() == [*enc.tok.encode(t or "", add_special_tokens=False).ids, 1] and n.tolist() == [len(ids)]
    before = asked.count(" often")
    enc.encode(pa.array(["z often"]), 1)
    enc.encode(pa.array(["zz often"]), 1)
    enc.encode(pa.array(["zzz often"]), 1)
    assert asked.count(" often") - before <= 1


def test_near_duplicates(docs, none):
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {by[i][0].class_id for i in (1, 2, 3)} == {1} and by[1][0].class_size == 3
    assert [by[i][0].kept for i in (1, 2, 3)] == [True, False, False]
    assert all(r.kept and r.class_id == r.doc_id for i in (4, 5, 6, 8, 9, 11, 12) for r in by[i])
    assert {r.class_id for r in by[7]} == {7}
    assert neardup.near_duplicates(none).count() == 0


def test_weighted_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(5)
    h = np.sort(rng.integers(1, 1 << 63, 400, dtype=np.uint64))
    w = (1 + rng.random(400)).astype(np.float32)
    a, b = (h[:360], w[:360]), (h[40:], w[40:])
    sim = neardup.similarity(a, b)
    sig = neardup.Sampler(2000).sign(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([360, 360]))
    assert abs((sig[0] == sig[1]).mean() - sim) < 0.04


def _edited_copies():
    """A text, copies of it with one or two words changed, copies of copies, and other texts."""
    rng = np.random.default_rng(3)
    word = lambda: "w" + str(rng.integers(0, 100_000))
    base = [word() for _ in range(110)]
    texts = [base]
    for k in range(40):
        copy = list(texts[0] if k % 3 else texts[rng.integers(0, len(texts))])
        for at in rng.integers(0, len(copy), 1 + k % 4):
            copy[at] = word()
        texts.append(copy)
    texts += [[word() for _ in range(60)] for _ in range(5)]
    return [" ".join(t) for t in texts]


def _classes(sets, threshold=0.8):
    """The smallest member of the class of every set, from all pairs."""
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if neardup.similarity(sets[i], sets[j]) >= threshold and root[i] != root[j]:
                lo, hi = sorted((root[i], root[j]))
                root = [lo if r == hi else r for r in root]
    return root


@pytest.mark.parametrize("block", [2, 7, 256])
def test_links_across_components_of_a_bucket(spark, block):
    """All texts in two buckets, every one its own component: the links give the classes of all pairs."""
    texts = _edited_copies()
    freq = neardup.Frequencies(len(texts))
    node = [bytes([k]) for k in range(len(texts))]
    inside = spark.createDataFrame([(b, 5, len(node), x) for b in (0, 1) for x in node], "band int, key long, n long, node binary")
    signed = spark.createDataFrame([(x, bytes(56), [5, 5], len(t)) for x, t in zip(node, texts)],
                                   "node binary, sig binary, bands array<long>, size long")
    roots = spark.createDataFrame([(node[0], node[0])], "node binary, root binary")
    whole = spark.createDataFrame(list(zip(node, texts)), "node binary, text string")
    links = neardup._across(inside, roots, signed, whole, spark.sparkContext.broadcast(freq), 0.8, 0.55, block).collect()
    root = list(range(len(texts)))
    for r in links:
        lo, hi = sorted((root[r.a[0]], root[r.b[0]]))
        root = [lo if x == hi else x for x in root]
    want = _classes([neardup.weighted(t, freq) for t in texts])
    assert root == want and 6 < len(set(want)) < 40
    assert len(links) < len(texts) * (len(texts) - 1) // 2


@pytest.mark.parametrize("chunk", [3_000, 700_000])
def test_weights_follow_exact_document_frequencies(spark, monkeypatch, chunk):
    """The frequencies kept with the texts are exact, however the texts are cut into chunks."""
    monkeypatch.setattr(neardup, "CHUNK", chunk)
    rng = np.random.default_rng(9)
    shared = " ".join(f"s{k}" for k in range(40))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 500 if chunk < 10_000 else 2000)) + " " + shared * (k % 3 == 0)
             for k in range(60 if chunk < 10_000 else 400)]
    rows = spark.createDataFrame([(str(k).encode(), t) for k, t in enumerate(texts)], "node binary, text string")
    chunked = neardup._chunked(rows.repartition(4)).checkpoint()
    assert chunked.select("chunk").distinct().count() >= (20 if chunk < 10_000 else 4)
    answers = neardup._answers(neardup._asked(chunked, 7))
    freq = spark.sparkContext.broadcast(neardup.Frequencies(len(texts)))
    got = {int(r.node): np.frombuffer(r.df, np.int64) for r in neardup._signatures(chunked, answers, freq, 2, 2).collect()}
    sets = [np.unique(neardup.shingles(t)) for t in texts]
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    assert len(got) == len(texts)
    for k, h in enumerate(sets):
        assert (got[k] == counts[np.searchsorted(values, h)]).all()
    full = np.log1p(len(texts))
    h, w = neardup.weighted(texts[0], freq.value, got[0].tobytes())
    assert np.allclose(w, 1 + (full - np.log1p(got[0])) / full, atol=1e-6)
    assert got[0].max() == (len(texts) + 2) // 3 and (got[0] == 1).sum() > 400


def test_near_duplicates_match_all_pairs(spark):
    """Classes of edited copies, copies of copies and other texts, by brute force over all pairs."""
    texts = _edited_copies()
    sets = [np.unique(neardup.shingles(t)) for t in texts]
    values, counts = np.unique(np.concatenate(sets), return_counts=True)
    freq = neardup.Frequencies(len(texts))
    want = _classes([neardup.weighted(t, freq, counts[np.searchsorted(values, h)].astype(np.int64).tobytes())
                     for t, h in zip(texts, sets)])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()}
    assert [got[k] for k in range(len(texts))] == want


@pytest.mark.parametrize("digest", [exact.SHA256, "cast(length(norm) as string)"])
def test_exact_dedup(docs, none, digest):
    """A digest as weak as the length must give the same groups: texts decide."""
    got = exact.exact_dedup(docs, salts=2, digest=digest).collect()
    norm = lambda t: (t or "").encode().translate(bytes(c + 32 if 65 <= c < 91 else c for c in range(256)))
    groups = {}
    for i, t, *_ in ROWS:
        groups.setdefault(norm(t), []).append(i)
    want = [(i, k, len(g), i == k, hashlib.sha256(norm(t)).hexdigest())
            for i, t, *_ in ROWS for g in [groups[norm(t)]] for k in [max((x for x in g if x is not None), default=None)]]
    assert counted(tuple(r) for r in got) == counted(want)
    assert exact.exact_dedup(none, digest=digest).count() == 0


@pytest.fixture(scope="module")
def archive(spark):
    pages = [(1, "http://a/é x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://c", None), (4, "http://d", ""),
             (5, "http://e", "WARC/1.1\r\n\r\n" + LONG), (5, "http://e", "WARC/1.1\r\n\r\n" + LONG), (None, "http://f", "<p>one</p>")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, row string").repartition(2)
    path = scratch_path(spark, "test-warc")
    warc.write_warc(df.persist(), path, range_bytes=200)
    return pages, path


def test_warc_round_trip(spark, archive):
    pages, path = archive
    got = warc.read_warc(spark, path, verify=True).collect()
    assert len(got) == len(pages)
    by = {}
    for r in got:
        m = re.match(r"urn:page:(\d*):", r.record_id)
        by.setdefault(int(m[1]) if m[1] else None, []).append(r)
    for i, _, html in pages:
        data = (html or "").encode()
        for r in by[i]:
            assert r.payload_length == len(data)
            assert r.payload_digest == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
            assert r.record_type == "revisit" or bytes(r.payload) == data
    assert [by[i][0].record_type for i in (1, 2, 3, 4, None)] == ["revisit", "response", "revisit", "response", "revisit"]
    assert sorted(r.record_type for r in by[5]) == ["response", "revisit"]
    assert by[1][0].refers_to == by[2][0].record_id and by[2][0].target_uri is None


def test_warc_filters_are_pushed_and_payloads_skipped(spark, archive, monkeypatch):
    _, path = archive
    df = warc.read_warc(spark, path, ["record_id", "record_type"]).filter("record_type = 'revisit'")
    assert df.count() == 4
    assert not re.search(r"\bFilter\b", df._jdf.queryExecution().executedPlan().toString())
    reader = warc.WarcReader(warc.SCHEMA, {"path": path})
    reader.tests = [("record_type", "EqualTo", "revisit")]
    read = []
    monkeypatch.setattr(warc._Record, "_read_block", lambda self: read.append(1) or b"")
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(rows) == 4 and not read and len(reader.partitions()) > 2


def test_warc_small_payloads_and_plain_files(spark, archive, tmp_path):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    path = scratch_path(spark, "test-warc")
    warc.write_warc(df, path, min_bytes=10)
    assert {r.record_type for r in warc.read_warc(spark, path).collect()} == {"response"}
    plain = tmp_path / "x.warc"
    plain.write_bytes(warc._record("urn:page:1:0", "u", b"hello", None, "d") + warc._record("urn:page:2:1", "u", b"", "urn:page:1:0", "d"))
    got = warc.read_warc(spark, str(plain)).collect()
    assert [(r.record_type, r.payload_length) for r in got] == [("response", 5), ("revisit", 0)]


def test_prefix_sums_over_a_hot_group(spark):
    rows = [("hot", i % 5, i, 1 + i % 3) for i in range(500)] + [(None, 0, 1, 2), ("b", 0, 1, 5)]
    df = spark.createDataFrame(rows, "g string, u int, id int, v long")
    got = ordered_prefix(df, ["g", "u", "id"], "g", "v", "before", "test-prefix").collect()
    at = {}
    for r in sorted(got, key=lambda r: (r.g or "", r.u, r.id)):
        assert r.before == at.get(r.g, 0)
        at[r.g] = r.before + r.v
    assert len(got) == 502


def test_words_agree():
    assert byte_words("A-b_Éé 12") == ["a".encode(), "b".encode(), "Éé".encode(), b"12"] and len(WORD_BYTES) == 256


def test_mixture_stage_draws_alike_from_other_partitions(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, "word " * (1 + i * 37 % 90), "en", f"s{i % 3}", 1) for i in range(300)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = []
    for d in (docs.coalesce(1), docs.orderBy(F.col("doc_id").desc()).repartition(7)):
        path = scratch_path(spark, "mix-test")   # stages read written tables
        d.write.parquet(path)
        got.append(sorted(r["doc_id"] for r in corpus_pipeline.mixture(spark, spark.read.parquet(path), "").collect()))
    assert got[0] == got[1] and got[0]
