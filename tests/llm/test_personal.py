"""Base patterns against the plain expressions, the trees against separable data, and planted spans end to end."""

import hashlib
import random
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from campaign_spark.llm import boosting
from campaign_spark.llm import personal as pp

PLAIN = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]
PARTS = ["a", "@", ".", "1", "23", "4", "+", " ", "-", "(", ")", "é", "00", "b.c", "x@y.z", "4111111111111111", "255.1.2.3",
         "+1 (555) 555-0100", "\n", "256", "_%"]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (True, kind == 1 and all(int(x) <= 255 for x in m.group().split(".")),
                    14 <= len(digits) <= 19 and pp.luhn(digits), 10 <= len(digits) <= 15)[kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans(text):
    assert pp.base_spans(text) == plain_spans(text)
    assert {(s, k, e) for s, k, e, _ in pp.candidates(text)} >= {
        x for x in pp.base_spans(text) if x[1] == 1 and not re.search(r"0[0-9]{3}|[0-9]{4}", text[x[0]:x[2]])}


def test_long_texts_without_matches_take_linear_time():
    for part in ("1", "a", "a@", "1 ", "1.", "+1 ", "+1 (2) ", " at ", ". dot ", "12 ", "@", "%"):
        times = []
        for n in (20_000, 80_000):
            text = part * (n // len(part))
            began = time.perf_counter()
            pp.base_spans(text), pp.candidates(text)
            times.append(time.perf_counter() - began)
        assert times[1] < 12 * times[0] + 0.05, (part, times)


def test_trees_learn_and_calibrate():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4_000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.2)).astype(float)
    noisy = np.where(rng.random(4_000) < 0.1, 1 - y, y)
    trees = boosting.fit(x[:2_000], noisy[:2_000])
    trees.calibrate(x[2_000:3_000], noisy[2_000:3_000])
    p = trees.probability(x[3_000:])
    assert ((p > 0.5) == (y[3_000:] > 0.5)).mean() > 0.97
    assert abs(p[p > 0.5].mean() - noisy[3_000:][p > 0.5].mean()) < 0.04
    flat = boosting.fit(np.zeros((50, 2)), np.arange(50) % 2.0)
    assert np.allclose(flat.probability(np.zeros((1, 2))), 0.5, atol=0.02)


def card(rng):
    digits = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(digits + str(k) for k in range(10) if pp.luhn(digits + str(k)))


def test_spans(spark, tmp_path):
    rng = random.Random(5)
    phone = lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9)))
    rows, planted = [], {}
    for k in range(600):
        mine = [phone(), card(rng), ".".join(str(rng.randrange(1, 255)) for _ in range(4)), f"{'x' * rng.randrange(1, 9)}.{k}@mail{k % 9}.example.com"][k % 4]
        rows.append((k, f"{word()} {word()} {mine} {word()} token = \"{hashlib.sha1(str(k).encode()).hexdigest()}\" {word()}"))
    for k in range(700, 720):  # a phone and a card side by side: the patterns' longest matches fail on both
        p, c = phone(), card(rng)
        rows.append((k, f"{word()} {p} {c} {word()}"))
        planted[k] = f"phone:{rows[-1][1].index(p)}:{rows[-1][1].index(p) + len(p)},card:{rows[-1][1].index(c)}:{rows[-1][1].index(c) + 16}"
    rows += [(800, None), (801, ""), (802, "clean words only"), (None, rows[0][1]), rows[1], rows[1], (803, "1.2.3.4 " * 5_000 + "é" * 100_000)]
    full = [(i, t, "c", 1, "c") for i, t in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, kind string, start long, base string")
    got = pp.personal_spans(df.repartition(5)).select("doc_id", pp.spelled("base").alias("base"), pp.spelled("spans").alias("spans")).collect()
    want = [(i, ",".join(f"{pp.KINDS[k]}:{s}:{e}" for s, k, e in plain_spans(t or ""))) for i, t in rows]
    assert sorted(str((r.doc_id, r.base)) for r in got) == sorted(map(str, want))
    assert not any(plain_spans(t) for i, t in rows if i in planted)
    found = {r.doc_id: r.spans for r in got}
    assert sum(found[k] == want for k, want in planted.items()) >= 18
    assert all(r.spans == r.base for r in got if r.doc_id not in planted)
    assert pp.personal_spans(df.limit(0)).count() == 0
    folder = str(tmp_path)
    df.write.parquet(folder + "/documents.parquet")
    query = sorted(map(str, map(tuple, pp.op11_personal_data(spark, folder).collect())))
    line = lambda base: [sum(x.startswith(k) for x in base.split(",")) for k in pp.KINDS] + [hashlib.sha256(base.encode()).hexdigest()]
    assert query == sorted(str((r.doc_id, *line(r.base), r.spans)) for r in got)
    few = pp.personal_spans(df.filter("doc_id > 690")).select(pp.spelled("base").alias("b"), pp.spelled("spans").alias("s"))
    assert few.filter("b <> s").count() == 0  # too few examples: nothing is added


def test_learns_from_all_candidates(spark, monkeypatch):
    """120,000 candidates: trees, calibration and threshold are those of plain arrays of all of them."""
    monkeypatch.setattr(boosting, "ROUNDS", 10)
    rng = np.random.default_rng(3)
    x = np.zeros((2_000, 60, pp.N_FEATURES), np.float32)
    x[..., :3] = rng.integers(0, [200, 9, 3], (2_000, 60, 3))
    y = ((x[..., 0] > 70) ^ (x[..., 1] > 5) ^ (rng.random((2_000, 60)) < 0.02)).astype(int)
    rows = [(k, [(2, j, j + 1, False, int(y[k, j]), x[k, j].tobytes()) for j in range(60)]) for k in range(2_000)]
    found = spark.createDataFrame([(k, [], f) for k, f in rows], pp.FOUND)
    (kind, (trees, threshold)), = pp.learn(found.repartition(7)).items()
    held = np.array([r[0] for r in found.selectExpr(f"pmod(xxhash64('held', doc_id), {pp.HELD_OUT}) = 0").collect()])
    want = boosting.fit(x[~held].reshape(-1, pp.N_FEATURES).astype(float), y[~held].ravel().astype(float))
    assert kind == 2
    assert np.array_equal(trees.feature, want.feature) and np.array_equal(trees.threshold, want.threshold)
    assert np.array_equal(trees.leaf, want.leaf)
    xh, yh = x[held].reshape(-1, pp.N_FEATURES).astype(float), y[held].ravel().astype(float)
    want.calibrate(xh, yh)
    assert np.allclose([trees.slope, trees.shift], [want.slope, want.shift], atol=0.01)
    p = trees.probability(xh)
    assert yh[p >= threshold].mean() >= pp.PRECISION or threshold == pp.LIKELY
    again, = pp.learn(found.repartition(3)).values()
    assert np.array_equal(again[0].leaf, trees.leaf) and again[1] == threshold


def test_redact():
    spans = [{"kind": "card", "start": 2, "stop": 6}, {"kind": "phone", "start": 4, "stop": 8}, {"kind": "ip", "start": 9, "stop": 10}]
    assert pp.redact("ab12345678cd"[:12], spans) == "ab[card]7[ip]cd"
