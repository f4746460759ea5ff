"""The audit against a plain dense version in whole numbers, and the skyband against all pairs."""

import collections
import random
import re

import numpy as np
import pytest

from campaign_spark.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def audit(rows, min_docs, top):
    count, docs, groups = collections.Counter(), collections.Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = [t.translate(FOLD) for t in TERM.findall(text or "")]
        count.update((lang, source, t) for t in found)
        docs.update((lang, t) for t in set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (g, t), n in docs.items() if g == lang and n >= min_docs]
        mine = sorted(s for g, s in groups if g == lang)
        table = {s: {t: count[lang, s, t] for t in kept} for s in mine}
        table[None] = {t: sum(table[s][t] for s in mine) for t in kept}
        share = {}
        for s, counts in table.items():
            total = sum(counts.values()) + 5 * len(kept)
            share[s] = {t: 1 + 1_000_000_000 * (c + 5) // total for t, c in counts.items()}
        for s in mine:
            pairs = [(-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode(), o) for o in mine if o != s]
            out += [(lang, s, "pair", o, -v, k + 1) for k, (v, _, o) in enumerate(sorted(pairs))]
            terms = [(share[None][t] - share[s][t], t.encode(), t) for t in kept if table[s][t] and share[s][t] > share[None][t]]
            out += [(lang, s, "term", t, -v, k + 1) for k, (v, _, t) in enumerate(sorted(terms)[:top])]
    return sorted(out)


@pytest.mark.parametrize("min_docs, top", [(30, 50), (3, 4), (1, 1)])
def test_audit(spark, min_docs, top):
    rng = random.Random(7)
    words = ["Aa", "aa", "é", "Éa", "z1z", "b-c", "ñ", "zoo", "ZOO", "ß", "日本", "x", "\x80"] + [f"w{chr(97 + k)}q" for k in range(26)]
    rows = []
    for k in range(500):
        source = "hot" if k % 3 == 0 else f"s{k % 7}"
        some = words[:20] if source == "hot" else words[k % 5:]
        rows.append((" ".join(rng.choice(some) for _ in range(rng.randrange(0, 25))), rng.choice(["en", "en", "fr", None]), source))
    rows += [(None, "en", "s1"), ("", "en", None), (None, "xx", "only"), ("... 123", "en", "empty"), ("é " * 60_000, "fr", "s1"),
             ("tie tie", "yy", "a"), ("tie tie", "yy", "b")] * 2 + [("same text", "zz", "a")] * 40 + [("same other", "zz", "b")] * 40
    full = [(k % 3 or None, *r, "clash", 4, 5) for k, r in enumerate(rows)]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, term string, count long, v long")
    got = dv.divergence(df.repartition(7), min_docs, top).collect()
    assert sorted(map(tuple, got)) == audit(rows, min_docs, top)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    out = dv.divergence(df)
    assert out.collect() == [] and out.columns == ["lang", "source", "part", "item", "value", "rank"]


def test_skyband_keeps_what_few_dominate():
    rng = np.random.default_rng(9)
    n, k = 400, 5
    count, spread = rng.integers(1, 30, n), rng.integers(1, 40, n)
    terms = [f"{chr(int(c))}{i}" for i, c in enumerate(rng.integers(97, 400, n))]
    want = {i for i in range(n) if sum(count[j] >= count[i] and spread[j] <= spread[i] and terms[j].encode() < terms[i].encode()
                                       for j in range(n)) < k}
    assert set(dv.skyband(count, spread, terms, k)) == want and len(want) < n
    # Skybands of parts, merged, are the skyband of all.
    parts = np.concatenate([np.arange(p, n, 3)[dv.skyband(count[p::3], spread[p::3], terms[p::3], k)] for p in range(3)])
    assert set(parts[dv.skyband(count[parts], spread[parts], [terms[i] for i in parts], k)]) == want
