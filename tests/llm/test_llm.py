"""The ten operators against brute force, round trips and held-out accuracy, with the odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from folioforge.llm import gif, interpolation, licenses, minhash, naming, packing, pieces, seeds, sharding, toxicity  # noqa: E402
from folioforge.llm._words import NOT_ALNUM, SPACE, U64, buffer_of, span_hashes, spans, window_hashes  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "One"), (5, "oNE"), (6, "É é ü 日本語 😀"), (7, "x" * 5000), (7, "x" * 5000), (None, "no id here at all"), (9, "a b c d e f g h " * 40)]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="module")
def docs(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [random.choice(vocabulary) for _ in range(80)]
    rows = list(ODD)
    for i in range(20, 90):
        text = list(base) if i % 3 == 0 else [random.choice(vocabulary) for _ in range(random.randint(1, 120))]
        for _ in range(random.randint(0, 3)):
            text[random.randrange(len(text))] = random.choice(vocabulary)
        if i % 7 == 0:
            text += base[10:45]
        rows.append((i, " ".join(text)))
    rows += [(100 + i, rows[12][1].upper()) for i in range(25)]
    # columns that clash with names used inside
    return spark.createDataFrame([(a, b, 1, "k", 2.0) for a, b in rows], "doc_id long, text string, row int, chunk string, n double")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def unique(rows):
    return [(a, b) for a, b in dict.fromkeys(rows) if a is not None]


def test_words_and_windows():
    data, off = buffer_of(pa.array(["a bb\tc", None, "", " é ", "x" * 400]))
    s, e, b = spans(data, off, SPACE)
    assert [bytes(data[i:j]).decode()[:3] for i, j in zip(s, e)] == ["a", "bb", "c", "é", "xxx"] and b.tolist() == [0, 3, 3, 3, 4, 5]
    assert len(set(span_hashes(data, s, e).tolist())) == 5
    h = np.arange(1, 60, dtype=U64)
    for w in (1, 2, 5, 20):
        assert (window_hashes(np.concatenate([h, h]), w)[59 : 59 + 60 - w] == window_hashes(h, w)).all()
    s, e, _ = spans(*buffer_of(pa.array(["cc-by é"])), NOT_ALNUM)
    assert len(s) == 3


def test_op1_counts_and_gain(spark, docs, rows):
    got = interpolation.deleted_interpolation(docs).toPandas()
    assert len(got) == len(rows)
    tokens = [(d, words(t) + [None], zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1) for d, t in rows]
    c = Counter(x for _, w, held in tokens if not held for x in w)
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if d is None else d, held, len(w), sum(c[x] > 0 for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5)) for d, w, held in tokens)
    assert sorted((-1 if r.doc_id != r.doc_id else int(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got.itertuples()) == want
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert interpolation.deleted_interpolation(docs.limit(0)).count() == 0


def test_op1_weights_prefer_what_predicts():
    order = 2
    code = lambda b, s2, s1: (s1 * interpolation.BUCKETS + b) * interpolation.STEPS + s2
    w = interpolation.learn_weights(np.array([code(5, 1, 8), code(2, 0, 8)]), np.array([[100.0, 1.0, 90.0], [100.0, 1.0, 0.0]]), 50, order)
    assert w[1][5] > 0.9 and w[1][2] < 0.1 and w[1][0] == 0


def test_op2_segments_match_definition():
    def brute(x, a=0):
        if not len(x) or x.max() <= 0:
            return []
        s, _, i, j = max((x[i:j].sum(), i - j, i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1))
        return brute(x[:i], a) + [(a + i, a + j)] + brute(x[j:], a + j)

    rng = np.random.default_rng(0)
    for _ in range(200):
        x = rng.choice([-3, -2, -1, 1, 2, 4], rng.integers(0, 14)) + rng.random()
        assert [s[:2] for s in toxicity.maximal_segments(x)] == brute(x)


def test_op2_learns(spark):
    random.seed(1)
    rows, labels = [], []
    for i in range(1500):
        text, bad = [random.choice("abcdefghij") * random.randint(1, 3) for _ in range(60)], i % 5 == 0
        if bad:
            for k in range(4):
                text[random.randrange(60)] = random.choice(["vile", "rotten", "awful"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (5000, None)], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, marks).toPandas().set_index("doc_id")
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got.held_out[i] for i in held) and len(got) == 1501
    assert np.mean([got.predicted[i] == dict(labels)[i] for i in held]) > 0.95
    assert got.score.between(0, 1).all() and got.score[5000] < 0.5
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, marks).collect()}
    assert kept == set(got.index[got.score < 0.5])
    assert toxicity.toxicity_scores(docs.limit(0), marks.limit(0)).count() == 0
    assert toxicity.toxicity_scores(docs, marks.limit(0)).where("predicted = 1").count() == 0


def brute_components(rows, threshold=85):
    sets = {}
    for d, t in rows:
        w = words(t)
        sets[d] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def test_op3_components(spark, docs, rows):
    got = minhash.near_classes(docs).toPandas()
    assert len(got) == len(rows)
    want = brute_components(unique(rows))
    known = got[got.doc_id.notna()]
    assert all(want[int(r.doc_id)] == (r.n_shingles, int(r.component_id)) and r.kept == (r.doc_id == r.component_id) for r in known.itertuples())
    assert minhash.near_classes(docs.limit(0)).count() == 0


def test_op3_signature_is_a_minimum_over_shifts():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << 63, n).astype(U64) for n in (50_000, 70))
    together = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 20)
    assert (together[1] == minhash.signatures(b, np.array([0, len(b)]), 20)[0]).all()
    both = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a) + len(b)]), 20)[0]
    assert (both == together.min(axis=0)).all()


def brute_repeats(rows, window):
    first, own, out = {}, {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        own[d] = WORD.findall(t or "")
        for p in range(len(own[d]) - window + 1):
            first.setdefault(tuple(own[d][p : p + window]), (d, p))
    for d, w in own.items():
        covered = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p : p + window])] != (d, p):
                covered[p : p + window] = [True] * window
        out[d] = (len(w), sum(covered), hashlib.sha256(" ".join(x for x, c in zip(w, covered) if not c).encode()).hexdigest())
    return out


@pytest.mark.parametrize(("window", "anchor"), [(20, 8), (6, 3)])
def test_op4_windows(docs, rows, window, anchor):
    # rows without or with repeated ids are judged apart
    plain = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    want = brute_repeats(unique(rows), window)
    got = seeds.repeat_digest(plain, window=window, anchor=anchor).toPandas()
    assert len(got) == len(want) and all(want[r.doc_id] == (r.n_words, r.n_removed, r.kept_sha256) for r in got.itertuples())


def test_op4_odd_rows(docs, rows):
    assert seeds.repeat_digest(docs).count() == len(rows)
    assert seeds.repeat_digest(docs.limit(0)).count() == 0
    cut = seeds.cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    spans_ = seeds.repeats(docs).toPandas()
    assert ((spans_.last_word - spans_.first_word) >= 19).all()


@pytest.mark.parametrize(("block", "bits"), [(8192, 128), (16, 128), (16, 4)])
def test_op5_groups(docs, rows, block, bits):
    """Also with blocks so short that names go through many levels, and keys that collide."""
    got = naming.exact_groups(docs, block=block, key_bits=bits).toPandas()
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(d)
    by = {hashlib.sha256(t.encode()).hexdigest(): (max((d for d in ids if d is not None), default=None), len(ids)) for t, ids in groups.items()}
    assert len(got) == len(rows)
    for r in got.itertuples():
        keep, size = by[r.text_sha256]
        assert size == r.group_size and (keep == r.keep_id or keep is None)
        assert r.kept == (r.doc_id == keep or (keep is None and r.doc_id != r.doc_id))


def test_op5_empty(docs):
    assert naming.exact_groups(docs.limit(0)).count() == 0


def test_op6_pieces_and_places(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    got = packing.pack(docs, path, length=64).toPandas()
    left = Counter()
    for _, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for s in range(0, len(ids), 64):
            left[(s, len(ids[s : s + 64]), zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes()), len(ids))] += 1
    assert left == Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got.itertuples())
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == (g.length.cumsum() - g.length).tolist() and g.length.sum() <= 64
    assert got.sequence_id.nunique() <= 1.05 * got.length.sum() / 64 + 2
    assert packing.pack(docs.limit(0), path).count() == 0


def test_op6_white_space_of_all_kinds():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    texts = ["a  b", "a  b", "c　 d", "e\x85 f\x1c g \x1f h", "  lead", "trail   ", "x \n\n y's <|endoftext|>", "  a   b", " "]
    for ordinary in (False, True):
        tokenizer.encode_special_tokens = ordinary
        ids, bounds = packing.encode(*buffer_of(pa.array(texts)), path, ordinary=ordinary)
        for k, t in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 0], t


def test_op6_segments_are_told_apart_by_bytes(monkeypatch):
    """With a hash that gives every segment of one length the same key, the ids are still right."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "span_hashes", lambda data, starts, ends: (ends - starts).astype(U64))
    monkeypatch.setattr(packing, "_CACHES", {})
    for texts in (["one two", "six ten " + "long" * 99], ["ten six", ""]):
        ids, bounds = packing.encode(*buffer_of(pa.array(texts)), path)
        assert [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:])] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]


def one_piece_at_a_time(histogram, length):
    """Shortest pack first over single pieces: the lengths of each pack."""
    packs = []
    for size in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        least = min(packs, key=sum, default=None)
        if least is None or sum(least) + size > length:
            packs.append([size])
        else:
            least.append(size)
    return packs


def test_op6_is_shortest_pack_first():
    assert packing.shortest_pack_first({6: 2, 5: 1, 3: 1, 2: 1}, 10) == [((6, 2), 1), ((6,), 1), ((5, 3), 1)]
    rng = np.random.default_rng(4)
    for _ in range(200):
        h = Counter(np.minimum(40, rng.lognormal(2, 1, rng.integers(1, 120)).astype(int) + 1).tolist())
        # Of packs with equal room any may be taken, so what is compared are the packs' fills.
        got = sorted(sum(p) for p, n in packing.shortest_pack_first(dict(h), 40) for _ in range(n))
        assert got == sorted(map(sum, one_piece_at_a_time(h, 40)))


def test_op6_patterns_hold_the_histogram():
    rng = np.random.default_rng(2)
    h = Counter(np.minimum(100, rng.lognormal(3, 1, 5000).astype(int) + 1).tolist())
    patterns = packing.shortest_pack_first(dict(h), 100)
    seen = Counter()
    for p, n in patterns:
        assert sum(p) <= 100
        for x in p:
            seen[x] += n
    assert seen == h


def check_shards(got, rows, shards):
    assert len(got) == len(rows)
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert sorted(got["size"]) == sorted(len((t or "").encode()) + 16 for _, t in rows)
    assert sorted(got.text_crc32) == sorted(zlib.crc32((t or "").encode()) for _, t in rows)
    sizes = got.groupby("shard")["size"].sum().reindex(range(shards), fill_value=0)
    assert (sizes - got["size"].sum() / shards).abs().max() <= got["size"].max() + 0.02 * got["size"].sum() / shards


def test_op7_shards(spark, docs, rows):
    check_shards(sharding.histogram_shards(docs, shards=5).toPandas(), rows, 5)
    hot = [(i, "hot") for i in range(900)] + [(2000 + i, f"text {i}" * (i % 5)) for i in range(600)]
    check_shards(sharding.histogram_shards(spark.createDataFrame(hot, "doc_id long, text string"), shards=40).toPandas(), hot, 40)
    assert sharding.histogram_shards(docs.limit(0)).count() == 0


def test_op7_cuts_within_equal_rows(spark):
    """A thousand rows alike in text and (null) doc_id are dealt over the shards like any others."""
    alike = [(None, "one text")] * 1000 + [(i, f"other {i}") for i in range(500)] + [(7, "again")] * 300
    check_shards(sharding.histogram_shards(spark.createDataFrame(alike, "doc_id long, text string"), shards=10).toPandas(), alike, 10)
    same = [(3, None)] * 200
    got = sharding.histogram_shards(spark.createDataFrame(same, "doc_id long, text string"), shards=8, cells_per_shard=2).toPandas()
    check_shards(got, same, 8)
    assert got.groupby("shard").size().max() <= 27


def test_op8_base_and_spans(spark):
    texts = ["x", None, "", "GNU General Public License and the gnu general public license, Apache License", "MIT mit license", "Released under the MIT License.", "cc-by cc by", "This Source Code Form is subject to the terms of some Mozilla Public License, v. 2.0", "permission is hereby granted free of charge"]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(None, "cc by", "z")], "doc_id long, text string, row string")
    got = licenses.license_labels(docs).toPandas()
    assert len(got) == 10
    by = {r.doc_id: r for r in got.itertuples() if r.doc_id == r.doc_id}
    for i, t in enumerate(texts):
        w = licenses.words_of(t)
        places = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()]
        r = by[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        if places:
            assert (r.first_word, r.last_word) == (min(places)[0], max(places)[0])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert "mit-release" in by[5].labels and "mpl-2.0" in by[7].labels  # a word put in is bridged
    assert licenses.license_labels(docs.limit(0)).count() == 0


def brute_spans(words, template, slack, cover):
    """(first word, last word, score) of a template's spans, with all k-grams against all."""
    k, by = template.k, {}
    for pos in range(len(words) - k + 1):
        for at in range(len(template.words) - k + 1):
            if tuple(words[pos : pos + k]) == template.words[at : at + k]:
                by.setdefault(pos - at, []).append((pos, at))
    lines = [(d, min(p for p, _ in v), max(p for p, _ in v) + k - 1, {a + j for _, a in v for j in range(k)}) for d, v in sorted(by.items())]
    out = []
    for n, (d, low, high, held) in enumerate(lines):
        if n and not template.base and d - lines[n - 1][0] <= slack and low <= lines[n - 1][2] + slack + 1 and high >= lines[n - 1][1] - slack - 1:
            out[-1] = (min(out[-1][0], low), max(out[-1][1], high), out[-1][2] | held)
        else:
            out.append((low, high, held))
    return sorted((low, high, round(len(held) / len(template.words), 6)) for low, high, held in out if round(len(held) / len(template.words), 6) >= cover)


def test_op8_spans_against_all_kgrams(spark, monkeypatch):
    random.seed(12)
    notices = [t for _, t in licenses.NOTICES] + [t for t, _ in licenses.PHRASES]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(random.randint(0, 4)):
            own = random.choice(notices).split()
            for _ in range(random.randint(0, 3)):
                at = random.randrange(len(own) + 1)
                own[at:at + random.randint(0, 1)] = random.choice([[], ["new"], ["so", "on"]])
            words += own + ["between"] * random.choice([0, 0, 1, 9])
        texts.append(random.choice([" ", ", ", "\n-- "]).join(words))
    texts += [None, "", "Licensed " * 50, " ".join(["cc by"] * 300), "é " * 20]
    monkeypatch.setattr(licenses, "RUN", 7)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    hits = licenses.gram_hits(docs).cache()
    rows = {r.row: r.doc_id for r in hits.where("template_id = -1").collect()}
    assert sorted(rows.values()) == list(range(len(texts)))
    got = {}
    for r in licenses.license_spans(hits).collect():
        got.setdefault((rows[r.row], r.template_id), []).append((r.first_word, r.last_word, r.score))
    want = {(i, t.template_id): x for i, text in enumerate(texts) for t in licenses.templates() if (x := brute_spans(licenses.words_of(text), t, licenses.SLACK, licenses.COVER))}
    assert {k: sorted(v) for k, v in got.items()} == want
    for r in licenses.license_labels(docs).collect():
        own = [(t.label, x[2]) for t in licenses.templates() for x in want.get((r.doc_id, t.template_id), [])]
        assert r.labels == ",".join(sorted({a for a, _ in own})) and r.score == max([0.0, *(b for _, b in own)])
    hits.unpersist()


def test_op9_is_what_sentencepiece_gives(docs, rows):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    encoded = pieces.encode_pieces(docs, path)
    got = encoded.toPandas()
    assert got.exact.all() and len(got) == len(rows)
    assert sorted(map(tuple, got.ids)) == sorted(tuple(model.encode(t or "")) for _, t in rows)
    assert sorted(r.text for r in pieces.decode_pieces(encoded, path).collect()) == sorted(t or "" for _, t in rows)
    assert pieces.encode_pieces(docs.limit(0), path).count() == 0
    assert not pieces.encode_pieces(docs.sparkSession.createDataFrame([(1, "▁x")], "doc_id long, text string"), path).first().exact


def test_op9_on_all_kinds_of_texts(monkeypatch):
    import pyarrow.parquet as pq
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    random.seed(7)
    texts = ["", " ", "▁x ▁▁ y", "é é ﬁ Ａ 😀\x00y", "\n\t \x1c", "x" * 3000, "ab" * 999, "日本語の" * 700, "the" * 800 + "é" * 500]
    texts += ["a" + " " * k + "b" for k in range(70)] + [" " * k for k in range(40)]
    texts += ["".join(random.choice("etains xo") for _ in range(random.randint(1, 200))) for _ in range(400)]
    texts += ["".join(random.choice("日本語のtheとéß 한국어") for _ in range(random.randint(1, 200))) for _ in range(200)]
    try:
        texts += [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist()]
    except FileNotFoundError:
        pass

    def check():
        ids, bounds = pieces.encode(*buffer_of(pa.array(texts)), path)
        assert [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:])] == model.encode(texts)

    check()
    monkeypatch.setattr(pieces, "LONG", 3)  # nearly every word goes through the blocks of long ones
    monkeypatch.setattr(pieces, "BLOCK", 64)
    monkeypatch.setattr(pieces, "_CACHES", {})
    texts = texts[:300]
    check()
    monkeypatch.setattr(pieces, "span_hashes", lambda data, starts, ends: (ends - starts).astype(U64))  # words meet by chance
    monkeypatch.setattr(pieces, "_CACHES", {})
    texts = texts[100:200]
    check()


def test_op9_long_words_take_bounded_memory():
    import tracemalloc

    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces._cache(path)
    word = np.frombuffer(b"x" * 300_000, np.uint8)
    tracemalloc.start()
    pieces._cache(path).vocabulary.solve_long(word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 * len(word) + (64 << 20)


def test_op10_round_trip(docs, rows):
    got = gif.media_digest(docs).toPandas()
    want = []
    for _, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        want.append((len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])))
    assert sorted(want) == sorted((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got.itertuples())
    for r in got.itertuples():
        counts = [int(x) for x in r.feature.split(";")[1].split(",")]
        assert counts == list(r.histogram) and sum(counts) == r.payload_bytes == r.n_frames * 576 and r.duration_ms == 100 * r.n_frames
    assert gif.media_digest(docs.limit(0)).count() == 0


def test_op10_stored_frames():
    rng = np.random.default_rng(6)
    cases = [rng.integers(0, 256, 576 * 5).astype(np.uint8), np.tile(np.arange(256, dtype=np.uint8), 9), np.zeros(576 * 3, np.uint8), rng.integers(60, 90, 576 * 40).astype(np.uint8), np.full(576, 255, np.uint8)]
    cases.append(np.concatenate([np.resize(np.arange(256, dtype=np.uint8), 576)] * 2))  # no value is free to be transparent
    for x in cases:
        media = gif.store_payload(x)
        read = gif.read_gif(media)
        assert b"".join(c[:, :, 0].tobytes() for _, c in gif.shown(read)) == x.tobytes()
        assert [t for t, _ in gif.shown(read)] == [100 * k for k in range(len(x) // 576)]
        assert all(f.disposal == 1 for f in read.frames) and read.loops == 0
    assert any(f.transparent is not None for f in gif.read_gif(gif.store_payload(cases[3])).frames)
    assert len(gif.store_payload(np.full(576 * 50, 97, np.uint8))) < 768 + 50 * 70
    counts = np.bincount(cases[0] >> 5, minlength=8)
    assert counts.sum() == len(cases[0])


def test_op10_streams_that_advance_together():
    rng = np.random.default_rng(9)
    for bits in (2, 4, 8):
        texts = [rng.integers(0, int(rng.integers(1, 1 << bits)) + 1, 700).clip(0, (1 << bits) - 1).astype(np.uint8).tobytes() for _ in range(40)]
        texts += [bytes(700), bytes([1, 2] * 350), bytes(range(1 << bits)) * 3]
        streams = [gif.lzw_encode(x, bits) for x in texts]
        got = gif.lzw_decode_together(streams, bits, 700)
        assert [x if x is not None else gif.lzw_decode(s, bits, 700) for x, s in zip(got, streams)] == [x[:700] for x in texts]
        assert sum(x is not None for x in got) == len(got)
        # a stream that ends early, one with a clear code in its middle, one that starts without any, one of noise
        odd = [streams[0][:9], b"", rng.integers(0, 256, 300).astype(np.uint8).tobytes()]
        for x, s in zip(gif.lzw_decode_together(odd, bits, 700), odd):
            assert x is None or x == gif.lzw_decode(s, bits, 700)
    long = rng.integers(0, 256, 9000).astype(np.uint8).tobytes()  # the table fills up and is cleared
    assert gif.lzw_decode(gif.lzw_encode(long), 8, 9000) == long and gif.lzw_decode_together([gif.lzw_encode(long)], 8, 9000) == [None]


def test_op10_rows_are_encoded_together():
    rng = np.random.default_rng(10)
    for size in (1, 2, 255, 576, 900, gif.TOGETHER, gif.TOGETHER + 1):
        rows = np.stack([rng.integers(0, top, size) for top in (1, 2, 3, 26, 100, 256, 256)]).astype(np.uint8)
        assert gif.lzw_encode_together(rows) == [gif.lzw_encode(x.tobytes()) for x in rows]


def test_op10_huge_canvas_is_an_error(spark):
    import struct

    small = gif.write_gif(1, 1, gif.GREYS, [{"samples": [7]}])
    huge = small[:6] + struct.pack("<HH", 65535, 65535) + small[10:]
    rows = gif.frames_of(spark.createDataFrame([(1, bytearray(huge)), (2, bytearray(small)), (3, bytearray(small[:-30]))], "doc_id long, media binary")).collect()
    assert [(r.doc_id, r.error is None) for r in rows] == [(1, False), (2, True), (3, False)]


def test_op10_lzw_palettes_disposal_transparency(spark):
    rng = np.random.default_rng(3)
    for bits, n in ((2, 10), (8, 20_000), (4, 9_000)):
        x = rng.integers(0, 1 << bits, n).astype(np.uint8).tobytes()
        assert gif.lzw_decode(gif.lzw_encode(x, bits), bits, n) == x
        y = bytes(n)
        assert gif.lzw_decode(gif.lzw_encode(y, bits), bits, n) == y
    palette = np.array([[0, 0, 0], [255, 0, 0], [0, 255, 0], [0, 0, 255]], np.uint8)
    data = gif.write_gif(
        2, 2, palette,
        [
            {"samples": [1, 1, 1, 1], "delay": 5},
            {"samples": [2, 0], "width": 2, "height": 1, "transparent": 0, "disposal": 3, "delay": 7},
            {"samples": [3], "left": 1, "top": 1, "width": 1, "height": 1, "disposal": 2},
            {"samples": [0], "width": 1, "height": 1, "transparent": 0},
        ],
    )
    frames = list(gif.shown(gif.read_gif(data)))
    assert [t for t, _ in frames] == [0, 50, 120, 120]
    colours = [[tuple(p) for p in f.reshape(-1, 4).tolist()] for _, f in frames]
    red, green, blue, none = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255), (0, 0, 0, 0)
    assert colours == [[red] * 4, [green, red, red, red], [red, red, red, blue], [red, red, red, none]]
    rows = gif.frames_of(spark.createDataFrame([(1, bytearray(data)), (2, None), (3, bytearray(b"GIF89a"))], "doc_id long, media binary")).collect()
    assert [(r.doc_id, r.frame, r.error is None) for r in rows] == [(1, 0, True), (1, 1, True), (1, 2, True), (1, 3, True), (2, None, False), (3, None, False)]
    assert rows[0].red[7] == 4 and rows[3].shown_pixels == 3


def test_copies_go_by_row_not_by_id(spark):
    long = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(5)]
    rows = [(None, long[0]), (None, long[1]), (None, long[1]), (1, long[2]), (1, long[3]), (2, long[3]), (None, long[2]), (9, long[4]), (9, long[4].upper()), (5, None), (None, "")]
    df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, n int")
    got = [(r.doc_id, r.text) for r in naming.drop_copies(df).collect()]
    assert sorted((t or "").lower() for _, t in got) == sorted([*long, ""])
    assert {i for i, t in got if t == long[3]} == {2} and {i for i, t in got if t == long[2]} == {1}
    near = [(i, f"{t} last") if t else (i, t) for i, t in rows]
    both = spark.createDataFrame([*rows, *near], "doc_id long, text string")
    got = [(r.doc_id, (r.text or "").lower().removesuffix(" last")) for r in minhash.drop_near_copies(both).collect()]
    assert sorted(t for _, t in got if t) == sorted(long)
    assert {i for i, t in got if t in long[2:4]} == {1} and sum(not t for _, t in got) == 4


def test_op6_takes_the_open_pack_with_the_most_room():
    # 60 and 55 leave rooms of 40 and 45: the 30 goes to the shorter pack, and the 10 then to the other
    assert packing.shortest_pack_first({60: 1, 55: 1, 30: 1, 10: 1}, 100) == [((60, 10), 1), ((55, 30), 1)]
    assert packing.shortest_pack_first({10: 25}, 100) == [((10,) * 10, 2), ((10,) * 5, 1)]


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, last = docs.columns, docs.count()
    for k, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns and docs.count() <= last
        last = docs.count()
        if name == "exact_dedup":
            assert docs.select("text").distinct().count() == last
    packed = pipeline.STAGES[-1][1](spark, docs, sf).toPandas()
    assert packed.doc_id.nunique() == last


def test_many_near_copies_around_the_threshold(spark):
    """One text's copies with a few changed words each, the text itself left out: most pairs are just under the threshold."""
    random.seed(11)
    base = [f"w{random.randrange(5000)}" for _ in range(96)]
    rows = []
    for i in range(500):
        text = list(base)
        for _ in range(random.choice([1, 1, 2, 2, 3])):
            text[random.randrange(len(text))] = f"own{i}-{random.randrange(9)}"
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join(base[: 40 + i] + [f"end{j}" for j in range(45)])) for i in range(50)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words(t) for _, t in rows)]
    for threshold, bands in ((85, 24),):
        parent = list(range(len(rows)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for i in range(len(rows)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
        got = {r.doc_id: r.component_id for r in minhash.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold, bands=bands).collect()}
        assert got == {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}
        assert len(set(got.values())) > 20


def test_differences_offer_every_link():
    """The prefix filter on differences against all pairs, without Spark: no linked pair of two components is lost."""
    random.seed(3)
    for threshold in (70, 80, 85, 95):
        r = minhash._far(threshold)
        for _ in range(3000):
            anchor = set(range(random.randint(1, 60)))
            x, y = ({*random.sample(sorted(anchor), random.randint(0, len(anchor))), *random.sample(range(60, 90), random.randint(0, 12))} for _ in range(2))
            linked = lambda a, b: 100 * len(a & b) >= threshold * len(a | b)
            if x and y and linked(x, y) and not (linked(x, anchor) and linked(y, anchor)):
                dx, dy = x ^ anchor, y ^ anchor
                width = minhash._width(len(anchor), threshold)
                for a, b, da, db in ((x, y, dx, dy), (y, x, dy, dx)):
                    least = (len(da) - r * len(a) + minhash._class_of(len(db), len(b), len(anchor), threshold) * width) / 2
                    assert len(da & db) >= max(1, math.ceil(least - minhash.SLACK))
