"""The skip list against sums, the cut texts against a plain version, and the exact round trip."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from campaign_spark.llm import fill_middle as fm

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t 😀\x1f\xa0\x0b"))
def test_tokens_and_ranks(text):
    widths = fm.token_widths(text)
    assert list(widths) == [len(x) for x in TOKEN.findall(text)]
    units = fm.SkipList(widths)
    assert [units.locate(k) for k in range(len(widths) + 1)] == [0, *np.cumsum(widths)]


def test_lanes_hold_the_widths_of_the_lane_below():
    rng = np.random.default_rng(4)
    widths = rng.integers(1, 9, 50_000)
    units = fm.SkipList(widths)
    assert len(units.units) > 5
    for lane in range(1, len(units.units)):
        assert len(units.units[lane]) < len(units.units[lane - 1])
        nodes = np.cumsum(units.units[lane])
        assert list(np.cumsum(units.chars[lane])) == list(np.cumsum(widths)[nodes - 1])
    for rank in (0, 1, 24_999, 49_999, 50_000):
        assert units.locate(rank) == widths[:rank].sum()
    flat = fm.SkipList(widths, np.zeros(50_000, np.int8))  # no express lane at all
    assert flat.locate(1_000) == widths[:1_000].sum()


def expected(doc_id, text):
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    tokens = TOKEN.findall(text)
    n = len(tokens)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_documents(spark):
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice(["ab", "é", " ", "\n", "😀", "<", ">", "P", "S", "M", "zz "]) for _ in range(rng.choice([1, 3, 40, 200]))))
            for k in range(300)]
    rows += [(k, None) for k in range(400, 420)] + [(k, "") for k in range(420, 440)] + [(k, " \n ") for k in range(440, 460)]
    rows += [(k, "has a <S> mark") for k in range(460, 480)] + [rows[5], rows[5], (None, "no id at all"), (-7, "negative id"), (2 ** 62, "x y z")]
    rows += [(k, "long é text " * 30_000) for k in range(500, 506)]
    full = [(i, t, "clash", 9, "x") for i, t in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, output string, n long, form string")
    got = fm.fill_in_middle(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *expected(i, t or ""))) for i, t in rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    back = fm.fill_in_middle(df).select("doc_id", fm.restored(fm.F.col("output"), fm.F.col("form")).alias("t")).collect()
    assert sorted(map(str, map(tuple, back))) == sorted(str((i, t or "")) for i, t in rows)
    assert fm.fill_in_middle(df.limit(0)).count() == 0
