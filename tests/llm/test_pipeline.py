"""run() against five plain-Python stages, and its stages against what the operators decide one by one."""

import collections
import itertools
import math
import re
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from campaign_spark.llm import near_dup, packing, quality


def test_stages(spark, tmp_path):
    text = lambda k: " ".join(f"w{k}x{j % 97}y{j}" for j in range(40 + k))
    rows = [(k, text(k), "en", f"s{k % 2}", 0) for k in range(20)] + [(50, text(3), "en", "s1", 0), (51, "too short", "en", "s0", 0)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(folder + "/documents.parquet")
    docs = spark.read.parquet(folder + "/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "minhash_near_dedup", "suffix_array_dedup", "mixing_sources", "best_fit_packing"]
    kept = {r.document.doc_id for r in quality.judge(docs).filter("kept").collect()}
    assert kept == set(range(20)) | {50}
    lone = {r.doc_id for r in near_dup.near_groups(docs).filter("kept").collect()} & kept
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} == lone == set(range(20))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == corpus_pipeline.COLUMNS, name


WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"


def split(text):
    return WORD.findall(text or "")


def good(text):
    """The quality rules, as their names say."""
    text, words = text or "", split(text)
    n = len(words)
    seen = collections.Counter(tuple(words[k:k + 5]) for k in range(n - 4))
    repeated = {k + i for k in range(n - 4) if seen[tuple(words[k:k + 5])] > 1 for i in range(5)}
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    chars = sum(map(len, words))
    return not (n < 10 or 100 * len(repeated) > 20 * n or sum(c in "#*$%&|<>" for c in text) > 0.25 * n
                or text.count("!!") > 0.5 * n or chars < 2 * n or chars > 20 * n
                or 100 * (len(lines) - len(set(lines))) > 50 * len(text.split("\n")))


def lone(rows):
    """Rows whose id is the smallest that links of 75 % of their five-word shingles reach."""
    sets = collections.defaultdict(list)
    for r in rows:
        w = [x.lower() for x in split(r[1])]  # the fixture has no capitals beyond A-Z
        sets[r[0]].append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    comp = {i: i for i in sets if i is not None}
    pairs = [(a, b) for a, b in itertools.combinations(comp, 2)
             if any(x & y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    while any(comp[a] != comp[b] for a, b in pairs):
        for a, b in pairs:
            comp[a] = comp[b] = min(comp[a], comp[b])
    return [r for r in rows if r[0] is None or comp[r[0]] == r[0]]


def without_repeats(rows):
    bodies = [(r[1] or "").encode() for r in rows]
    count = collections.Counter(b[k:k + 200] for b in bodies for k in range(len(b) - 199))
    out = []
    for r, b in zip(rows, bodies):
        gone = {k + i for k in range(len(b) - 199) if count[b[k:k + 200]] > 1 for i in range(200)}
        out.append((r[0], bytes(x for k, x in enumerate(b) if k not in gone).decode("utf-8", "ignore"), r[2], r[3]))
    return out


def times_read(rows, entropy=0.95, limit=2.0):
    """How often each source is read; every source of the fixture is one block, so a part of an epoch is a whole one."""
    tokens = collections.Counter()
    for r in rows:
        tokens[r[3]] += len(split(r[1]))
    total, n = sum(tokens.values()), len(tokens)

    def reaches(a):
        w = [(t / total) ** a for t in tokens.values()]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w) >= entropy * math.log(n)

    def epochs(a):
        return {s: (max(tokens.values()) / t) ** (1 - a) for s, t in tokens.items()}

    a = max(k / 100_000 for k in range(100_001) if reaches(k / 100_000))
    while max(epochs(a).values()) > limit:
        a += 1e-5
    return {s: math.ceil(e - 1e-3) for s, e in epochs(a).items()}


def pieces_of(rows, capacity=4096):
    coder = Tokenizer.from_file(packing.public_tokenizer())
    for r in rows:
        ids = coder.encode(r[1], add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), capacity):
            part = ids[at:at + capacity]
            yield r[0], at // capacity, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())


def test_run_against_plain_python(spark, tmp_path):
    """Five plain-Python stages give the same pieces; their places are gapless and the sequences few."""
    rng = np.random.default_rng(21)

    def words(n):
        return " ".join(f"{rng.choice(list('abcdefgh'))}{rng.integers(0, 4_000)}" for _ in range(n))

    shared, accents = words(60), "é" * 60 + " ".join(f"à{k}ö" for k in range(40))
    rows = [(k, words(int(rng.integers(12, 150))), "en", "big") for k in range(40)]
    rows += [(100 + k, words(90), "en", "mid") for k in range(12)] + [(200 + k, words(70), None, None) for k in range(5)]
    rows += [(300 + k, words(40) + " " + shared + "\n" + words(40), "en", "big") for k in range(5)]
    rows += [(310 + k, words(20) + " " + "Ʃéxª"[k] + accents + " " + words(30), "fr", "mid") for k in range(4)]
    rows += [(400 + k, rows[k][1], "en", "mid") for k in range(4)] + [(410 + k, rows[41 + k][1] + " end", "en", "big") for k in range(3)]
    rows += [(500, words(9), "en", "big"), (501, None, "en", "big"), (502, "", "en", "mid"), (503, "a b c d e f g " * 30, "en", "mid"),
             (504, "# $ % & | " + words(9), "en", "mid"), (505, "wow!! " * 3 + "so!! good!! it!! is!! and!! that!! was!! nice", "en", "mid"),
             (506, "\n".join(["one line of it"] * 8 + [words(300)]), "en", "mid"), (507, "x" * 400 + " " + words(12), "en", "mid"),
             (508, words(6_000), "en", "big"), (None, words(50), "en", "mid"), (3, rows[3][1], "en", "big")]
    frame = spark.createDataFrame([(*r, len(r[1] or ""), "extra") for r in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long, row string")
    frame.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")

    left = without_repeats(lone([r for r in rows if good(r[1])]))
    assert {r[0] for r in left}.isdisjoint({500, 501, 502, 503, 504, 505, 507, 400, 401, 410, 411}) and 508 in {r[0] for r in left}
    assert any(len(r[1].encode()) < len(dict((x[0], x[1]) for x in rows)[r[0]].encode()) for r in left)
    often = times_read(left)
    assert len(set(often.values())) > 1
    want = collections.Counter(p for r in left for p in list(pieces_of([r])) * often[r[3]])

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    room = collections.defaultdict(list)
    for r in got:
        room[r.sequence_id].append((r.offset, r.length))
    for places in room.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(room) <= -(-sum(r.length for r in got) // 4096) + 1


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
