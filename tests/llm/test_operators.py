"""Operators against brute force on small fixtures, with nulls, empty texts, repeats and clashing columns."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from campaign_spark.llm import ann, html_text, licences, mixing, mixing_lm, near_dup, packing, quality, quality_model, suffix_dedup

WORDS = "the of and to in is that for it with as on be at by this from or an".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.integers(0, 300)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    shared = sentence(rng, 70)
    rows = [(i, sentence(rng, int(rng.integers(5, 120)))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # exact copies
    rows += [(200 + i, rows[i][1] + " end") for i in range(8)]  # near copies
    rows += [(300 + i, sentence(rng, 30) + "\n" + shared + "\n" + sentence(rng, 30)) for i in range(6)]
    rows += [(400, None), (401, ""), (402, "one two"), (403, "One  TWO"), (404, "é" * 300 + " x"), (405, " \n ")]
    rows += [(406, "a b c d e f " * 40), (None, "no id"), (7, rows[7][1])]
    full = [(i, t, "xx", "s%d" % (k % 3), len(t or ""), 1.0) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, weight double").cache()


def texts(docs):
    return [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]


def test_near_groups(docs):
    rows = [(i, b.lower().split()) for i, b in texts(docs)]
    sets = {i: frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset() for i, w in rows}
    comp = {i: i for i in sets if i is not None}
    for _ in range(len(comp)):
        for a in comp:
            for b in comp:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
        if all(comp[comp[i]] == comp[i] for i in comp):
            break
    got = near_dup.near_groups(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), comp[r.doc_id], comp[r.doc_id] == r.doc_id)


def test_near_groups_of_one_id_with_two_texts(spark):
    rng = np.random.default_rng(8)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (9, c), (9, c), (7, b), (4, a), (9, None), (5, c + " end"), (6, "")]
    got = near_dup.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.n_shingles} == {(1, 1), (2, 1), (3, 1), (7, 1), (4, 1), (9, 5), (5, 5)}
    assert {(r.doc_id, r.component_id, r.kept) for r in got if not r.n_shingles} == {(9, 9, True), (6, 6, True)}
    # Ids are documents: 2 and 3 have nothing in common but the id 5.
    rows = [(5, a), (5, b), (2, a + " end"), (3, b + " end")]
    got = near_dup.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(2, 2, True), (3, 2, False), (5, 2, False)}


@pytest.mark.parametrize("hot", [256, 2])
def test_suffix_dedup(docs, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_SPANS", hot)
    rows = texts(docs)
    count = collections.Counter(b[k:k + 200] for _, b in rows for k in range(len(b) - 199))
    want = []
    for i, b in rows:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k:k + 200]] > 1:
                gone[k:k + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        want.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.remove_repeats(docs).select("document.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert suffix_dedup.drop_repeats(docs).columns == docs.columns


def test_packing(docs):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(packing.public_tokenizer())
    got = packing.pack(docs, capacity=64).collect()
    ids = collections.defaultdict(list)
    for i, b in texts(docs):
        ids[i].append(coder.encode(b.decode(), add_special_tokens=False).ids + [1])
    room = collections.defaultdict(list)
    for r in got:
        room[r.sequence_id].append((r.offset, r.length))
        part = ids[r.doc_id][0][r.start:r.start + 64]
        assert r.start == 64 * r.piece and len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    assert sum(r.length for r in got) == sum(len(x) for v in ids.values() for x in v)
    for places in room.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= 64
    assert len(room) <= 1.05 * sum(r.length for r in got) / 64 + 2


def test_quality(docs):
    def counts(t):
        w = (t or "").encode().split()
        g = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        hit = {k + z for k in range(len(w) - 4) if g[tuple(w[k:k + 5])] > 1 for z in range(5)}
        lines = [x for x in (t or "").split("\n") if x.split()]
        return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit)

    for r in quality.judge(docs).collect():
        want = counts(r.document.text)
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r.kept or r.failed_rule
        if want[0] < 10 or 100 * want[4] > 20 * want[0]:
            assert not r.kept
    orders = [list(quality.RULES), list(quality.RULES)[::-1]]
    kept = [sorted(map(str, quality.with_counts(docs).select("document.doc_id", quality.cascade(o).isNull().alias("k")).collect())) for o in orders]
    assert kept[0] == kept[1]


def test_quality_filter_over_long_texts(spark):
    """A filter on the verdict works each count out once: a text of 20,000 words ends, repeated or not."""
    rng = np.random.default_rng(5)
    long_text, loop = sentence(rng, 20_000), "one two three four five six " * 3_000
    rows = [(1, long_text), (2, loop), (3, None), (4, long_text), (4, long_text), (5, "a b")]
    df = spark.createDataFrame([(i, t, "kept", 1) for i, t in rows], "doc_id long, text string, kept string, words int")
    assert sorted(r.doc_id for r in quality.keep_good(df).collect()) == [1, 4, 4]
    assert quality.keep_good(df).columns == df.columns
    assert quality.keep_good(df.limit(0)).count() == 0
    for order in (list(quality.RULES), list(quality.RULES)[::-1]):
        got = quality.survivors(df, order).select("document.doc_id", "kept")
        assert sorted((r.doc_id, r.kept) for r in got.collect()) == [(1, True), (2, False), (3, False), (4, True), (4, True), (5, False)]


def test_mixing(docs, spark):
    out = mixing.mix(docs, block_tokens=200)
    assert set(out.columns) >= set(docs.columns) and out.filter("epoch = 0").count() == docs.count()
    big = [(k, "a", "w " * 10) for k in range(300)] + [(1000 + k, "b", "w " * 10) for k in range(30)] + [(2000, None, "w w")]
    skew = spark.createDataFrame(big, "doc_id long, source string, text string")
    mixed = mixing.mix(skew, target_entropy=1.0, max_epochs=3.0, block_tokens=50)
    tokens = {r.source: r.n for r in mixed.groupBy("source").agg({"n_tokens": "sum"}).toDF("source", "n").collect()}
    sources = spark.createDataFrame([("a", 3000), ("b", 300), (None, 2)], "source string, tokens long")
    a = mixing.exponent(sources, 1.0, 3.0)
    for s, n in (("a", 3000), ("b", 300), (None, 2)):
        budget = n * (3000 / n) ** (1 - a)
        assert budget <= 3 * n * 1.001 and budget - 1e-6 <= tokens[s] <= budget + 120
    assert mixed.filter("place < 0 or place >= 1").count() == 0


def test_licences(docs, spark):
    text = "Copyright (c) 2020 Someone\n" + licences.KNOWN["MIT"].replace(",", " ;").replace("hereby", "HEREBY")
    df = spark.createDataFrame([(1, text), (2, None), (3, "Some words.\nReleased under the MIT licence."), (1, text)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.licence_scan(df).collect()}
    assert got[1].license_id == "MIT" and got[2].text_digest is None and got[3].notice_ids == "MIT notice"
    assert licences.licence_scan(docs).count() == docs.count()


def test_licences_titled_wrapped_and_inside(spark):
    import textwrap

    wrap = lambda t, n: "\n\n".join("\n".join(textwrap.wrap(x, n)) for x in t.split("\n"))
    whole = dict(licences.whole_texts())
    head = "Copyright (c) 2020, Some One\nAll rights reserved.\n\n"
    isc = wrap(licences.KNOWN["ISC"], 72).replace("above copyright", "above\ncopyright")
    mit = "The MIT License (MIT)\n\n" + head + wrap(licences.KNOWN["MIT"], 78)
    cases = {1: (mit, "MIT", ""), 2: ("ISC License\n\n" + head + isc, "ISC", ""),
             3: ("BSD 3-Clause License\n\n" + head + wrap(whole["BSD-3-Clause"], 76), "BSD-3-Clause", ""),
             4: (whole["Apache-2.0"], "Apache-2.0", ""), 5: (whole["GPL-3"].replace("http:", "https:"), "GPL-3", ""),
             6: ("A manual.\nPermission is hereby granted, free of charge, to any person obtaining a copy of it.\n" + mit + "\nMore text.", None, "MIT"),
             7: ("Two.\n" + mit + "\n" + head + isc + "\nReleased under the MIT License.", None, "ISC,MIT,MIT notice"),
             8: ("x\n" + mit.replace("sublicense", "lend"), None, ""), 9: (whole["Unlicense"], "Unlicense", "Unlicense")}  # its form without the address is inside
    df = spark.createDataFrame([(k, t) for k, (t, _, _) in cases.items()], "doc_id long, text string")
    got = {r.doc_id: (r.license_id, r.notice_ids) for r in licences.licence_scan(df).collect()}
    assert got == {k: (a, b) for k, (_, a, b) in cases.items()}


def test_html():
    page = """<html><head><title>T</title></head><body><header><a href=/>Home</a></header><div id="cookie-banner">We use cookies.</div>
    <main><article><h1>Title &amp; more</h1><p>First   <b>bold</b>text.<div class="ad-slot">Buy!</div><p>Second.</p>
    <section id="comments"><p>Nice article, thanks.</p></section></article></main><form><label>Name</label></form>
    <footer>&copy; 2020</footer><script>var a="<p>x</p>"</script></body>"""
    assert html_text.main_text(page) == "Title & more\nFirst boldtext.\nSecond."
    assert [html_text.main_text(x) for x in (None, "", " ", "<p", "<!-- x")] == [""] * 5


def test_minimum_cut_against_all_labellings():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(2, 8))
        score = rng.normal(0, 2, n)
        links = [(i, j, float(rng.random())) for i in range(n) for j in range(i) if rng.random() < 0.5]
        graph = [[] for _ in range(n)]
        for i, j, w in links:
            graph[i].append([j, w, len(graph[j])])
            graph[j].append([i, w, len(graph[i]) - 1])
        cost = lambda keep: sum(s for s, k in zip(score, keep) if not k) + sum(w for i, j, w in links if keep[i] != keep[j])
        best = min(cost([(m >> i) & 1 == 1 for i in range(n)]) for m in range(1 << n))
        assert cost(html_text.content(list(score), graph)) == pytest.approx(best)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 8))
    x[50:80] = x[49]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(1000, None, 1), (1020, [0.0] * 8, 1), (1040, [float("nan")] * 8, 1), (1060, [1.0, None] + [0.0] * 6, 1), (1080, [1.0], 1)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).toPandas()
    hits = 0
    for q in range(0, 600, 20):
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        true = np.lexsort((np.arange(600), -s))[:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and np.allclose(mine.score, s[mine.vec_id], rtol=0, atol=1e-12)
        hits += len(set(true) & set(mine.vec_id))
    assert hits >= 0.9 * 600 and set(got.query_id) == set(range(0, 600, 20))
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("times", [2, 30])
def test_neighbours_of_repeated_rows(spark, times):
    """Each row ``times`` times, and every third id with a second vector: an id is one candidate, with its best score."""
    rng = np.random.default_rng(5)
    n = 300
    x = rng.normal(size=(n, 6))
    ids = np.concatenate([np.arange(n), np.arange(0, n, 3)])
    v = np.concatenate([x, rng.normal(size=(len(ids) - n, 6))])
    rows = [(int(i), y.tolist()) for i, y in zip(ids, v)] * times
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).toPandas()
    hits = 0
    for q in range(0, n, 20):
        s = np.full(n, -np.inf)
        for y in v[ids == q]:
            np.maximum.at(s, ids, (v * y).sum(1))
        s[q] = -np.inf
        true = np.lexsort((np.arange(n), -s))[:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and mine.vec_id.is_unique
        hits += len(set(true) & set(mine.vec_id))
    assert hits >= 0.9 * 20 * n / 20


def test_recall_is_that_of_the_walk():
    """Lists the walk does not reach count as missed, however near; at a wide ratio it reaches all."""
    rng = np.random.default_rng(9)
    c, q = rng.normal(size=(200, 5)), rng.normal(size=(20, 5))
    links = ann.graph(c)
    d = ann._distance(q, c)
    holds = {(k, j): [(k, j)] for k in range(20) for j in np.argsort(d[k])[:3]}
    for ratio, walk in ((1.0, 1.0), (1.5, 1.5), (1.5, 3.0), (3.0, 1e9), (1e9, 1e9)):
        seen = ann.search(q, c, links, walk)
        want = np.mean([np.isfinite(seen[k, j]) and seen[k, j] <= ratio * seen[k].min() + 1e-12 for k, j in holds])
        assert ann.walked(q, c, links, ratio, walk, holds) == want
    assert ann.walked(q, c, links, 1e9, 1e9, holds) == 1.0


def test_best_of_a_part_counts_ids():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(100, 4))
    ids = np.repeat(np.arange(100), 30)
    got = ann._best(ids, x[ids], np.array([-1]), x[:1], 20)
    assert list(got.vec_id) == list(np.argsort(-(x @ x[0]), kind="stable")[:20])


def test_lm(docs):
    got = mixing_lm.score_documents(docs).collect()
    rows = [(i, b.lower().split()) for i, b in texts(docs)]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = collections.Counter(w for i, ws in rows if not held(i) for w in [*ws, None])
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(w) + 1, sum(c[x] > 0 for x in [*w, None]), n,
                   round(sum(np.log10((c[x] + 1) / (n + v + 1)) for x in [*w, None]), 6)) for i, w in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(np.isfinite(r.score) and r.score <= 0 for r in got)


def test_lm_is_a_distribution():
    """The bits of all one-byte continuations share one unit of probability."""
    mixer = mixing_lm.Mixer([np.random.default_rng(1).random((2, 1 << s)).astype(np.float32) for s in mixing_lm.SIZES])
    first = [bytes([k]) for k in range(256) if k != 0x20]
    coder = mixing_lm.Coder(first)
    total = np.zeros(len(first))
    for k, bit, slots in coder.bits():
        x, ga, gb = mixer.inputs(coder, k, bit, slots, False)
        p = mixing_lm._squash(mixer.mixed(x, ga, gb))
        pick = coder.place == 0
        total += np.log(np.where(bit == 1, p, 1 - p))[pick]
    assert np.exp(total).sum() < 1.0 + 1e-9 and np.exp(total).sum() > 0.5


def test_quality_model(spark):
    rng = np.random.default_rng(6)
    rows = [(i, sentence(rng, 60) if i % 2 else sentence(rng, 60).replace(" ", " ## "), "l", "s") for i in range(300)]
    rows += [(500, None, "l", "s"), (501, "", "l", "s"), (None, "x", "l", "s"), (1, rows[1][1], "l", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = quality_model.score_quality(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    assert quality_model.score_quality(docs, labels.limit(0)).filter("score <> 0.5").count() == 0


def test_training_rows_are_the_lowest_hashes(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "TRAIN_ROWS", 40)
    pooled = spark.range(3_000).selectExpr("id as doc_id", "array(cast(id as float)) as x", "'other' as y2")
    known = spark.range(0, 6_000, 2).selectExpr("id as doc_id", "cast(id % 4 = 0 as double) as y")
    got = [(r.x[0], r.y) for r in quality_model.training_rows(pooled, known).collect()]
    want = pooled.join(known, "doc_id").orderBy(F.xxhash64("doc_id")).limit(40).select("x", "y").collect()
    assert got == [(r.x[0], r.y) for r in want] and len(got) == 40
    monkeypatch.setattr(quality_model, "TRAIN_ROWS", 5_000)
    assert quality_model.training_rows(pooled, known).count() == 1_500
    assert quality_model.training_rows(pooled.limit(0), known).count() == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for f in (near_dup.near_groups, suffix_dedup.remove_repeats, packing.pack, quality.judge, mixing.mix, licences.licence_scan,
              mixing_lm.score_documents):
        assert f(docs).count() == 0
    assert quality_model.score_quality(docs, spark.createDataFrame([], "doc_id long, quality int")).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(pages).count() == 0


def test_lm_updates_its_weights_with_every_bit(spark):
    """Read side by side, texts score as one bit after the other does with weights and table of the text's own."""
    rng = np.random.default_rng(2)
    mixer = mixing_lm.Mixer([(rng.random((2, 1 << s)) ** 8 * 30).astype(np.float32) for s in mixing_lm.SIZES])
    texts_ = [b"", b"abcabc d abcabc ", b"x ", "é€ word é€ ".encode(), b"d abcabc abcabc "]

    def plain(text):
        a, b, total = mixer.a.copy(), mixer.b.copy(), 0.0
        refine = mixer.refine[1] / mixer.refine.sum(0)
        for word in text.split():
            coder = mixing_lm.Coder([word])
            bits = [(*mixer.inputs(coder, k, bit, slots, False), bit) for k, bit, slots in coder.bits()]
            for i in range(len(word) + 1):
                for xs, gas, gbs, bs in bits:
                    x, ga, gb, bit = xs[i], gas[i], gbs[i], bs[i]
                    z = x @ (a[ga] + b[gb])
                    p, cell = mixing_lm._squash(z), int(np.clip(int(z + mixing_lm.BINS / 2), 0, mixing_lm.BINS - 1))
                    mixed = np.clip((3 * p + refine[gb, cell]) / 4, 1e-7, 1 - 1e-7)
                    total += np.log10(mixed if bit else 1 - mixed)
                    a[ga] += mixing_lm.ONLINE * (bit - p) * x
                    b[gb] += mixing_lm.ONLINE * (bit - p) * x
                    refine[gb, cell] += mixing_lm.ADAPT * (bit - refine[gb, cell])
        return total

    got = mixing_lm.Reader(mixer).log10(texts_)
    assert np.allclose(got, [plain(t) for t in texts_], rtol=1e-4)
    docs = spark.createDataFrame([(1, "some words to learn from, some other"), (2, "zq xv zq"), (3, "zq zq xv")], "doc_id long, text string")
    score = {r.doc_id: r.score for r in mixing_lm.score_documents(docs).collect()}
    assert score[2] != score[3]  # the same words in another order: the weights differ when they are read


def _lm_reader(seed=2):
    rng = np.random.default_rng(seed)
    return mixing_lm.Reader(mixing_lm.Mixer([(rng.random((2, 1 << s)) ** 8 * 30).astype(np.float32) for s in mixing_lm.SIZES]))


def test_lm_looks_contexts_up_once(monkeypatch):
    """A word's bytes are looked up once in a window of texts, however often it stands there; windows change no score."""
    reader, looked = _lm_reader(), []
    plain = reader._look_up
    monkeypatch.setattr(reader, "_look_up", lambda prefix, near: looked.append(len(prefix)) or plain(prefix, near))
    words = [b"one ", b"only ", "été ".encode(), b"on ", b"longerwords "]
    rng = np.random.default_rng(3)
    texts_ = [b"".join(words[j] for j in rng.integers(0, 5, n)) for n in (400, 3, 0, 90, 91, 1, 300)]
    want = reader.log10(texts_)
    assert sum(looked) == len({w[:i] for w in words for i in range(1, len(w) + 1)})
    assert want[2] == 0 and (want[[0, 1, 3, 4, 5, 6]] < 0).all()
    for name, value in (("WINDOW", 7), ("TEXTS", 2), ("MET", 2)):
        monkeypatch.setattr(mixing_lm, name, value)
        assert np.allclose(_lm_reader().log10(texts_), want, rtol=1e-12)


def test_lm_deals_texts_by_length(monkeypatch):
    """Each text goes whole to one part; a part has texts of about one length and no more than its bytes."""
    monkeypatch.setattr(mixing_lm, "PART", 20_000)
    rng = np.random.default_rng(4)
    chunks = []
    for chunk in (0, 1, 2 ** 32, 7 * 2 ** 32 + 5):
        bodies = [b"ab c\n " * int(n) for n in rng.pareto(1, 200) * 10] + [b"", b" ", b"x" * 999] + [b"same length" * 9] * 500
        chunks.append({"chunk": chunk, "sizes": [len(x) for x in bodies], "blob": mixing_lm.zstandard.compress(b"".join(bodies)), "bodies": bodies})
    schema = mixing_lm.pa.schema([("chunk", "int64"), ("sizes", mixing_lm.pa.list_(mixing_lm.pa.int64())), ("blob", mixing_lm.pa.binary())])
    batches = [mixing_lm.pa.RecordBatch.from_pylist([{k: c[k] for k in schema.names}], schema) for c in chunks]
    sizes = collections.Counter()
    for b in mixing_lm._lengths(b.select(["sizes"]) for b in batches):
        sizes.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
    starts, end = mixing_lm.dealt(sizes)
    assert end == sum(n + 1 for c in chunks for n in c["sizes"])
    got = []
    for r in (r for b in mixing_lm._deal(starts)(iter(batches)) for r in b.to_pylist()):
        data, ends = mixing_lm.zstandard.decompress(r["blob"], max_output_size=sum(r["sizes"]) + 1), np.cumsum(r["sizes"])
        got += [{"part": r["part"], "chunk": r["chunk"], "at": i, "body": data[e - n:e]} for i, n, e in zip(r["places"], r["sizes"], ends)]
    want = {(c["chunk"], i): x for c in chunks for i, x in enumerate(c["bodies"])}
    assert len(got) == len(want) and all(r["body"].split() == want[r["chunk"], r["at"]].split() for r in got)
    assert all(r["body"] == b"" or r["body"][-1:] == b" " for r in got)
    parts = collections.defaultdict(list)
    for r in got:
        parts[r["part"]].append(len(want[r["chunk"], r["at"]]))
    assert set(parts) <= set(range(-(-end // 20_000)))
    for a, b in zip(sorted(parts), sorted(parts)[1:]):
        assert max(parts[b]) + 1 < (min(parts[a]) + 1) * 2 ** (1 / mixing_lm.CLASSES) + 1
    assert all(sum(x) < 30_000 or len(x) < 10 for x in parts.values())
    assert sum(100 in x or 99 in x for x in parts.values()) > 5  # texts of one length are spread
