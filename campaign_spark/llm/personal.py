"""Personal data by candidates and gradient boosted trees.

The base patterns (email, ip, card, phone) give spans that always stay. Beside
them high-recall generators propose overlapping spans of each kind: every
sequence of digit groups of a fitting total (cards, phones), four dotted groups
in plain or spelled form (addresses of hosts), and emails in plain or spelled
form with every number of domain labels. Boosted trees per kind judge a
candidate by its format and context. They learn from the base: a candidate that
is a base span counts as personal, one that fails its kind's check, cuts through
a base span or touches a letter or digit does not; the others (say a phone
number that a longer, failing match has swallowed) are not learned from but
decided. The check itself and the base patterns are no features.

On documents held out from learning the probability is calibrated, and each
kind's threshold is the least at which candidates accepted there are personal
with ``PRECISION``, and no less than ``LIKELY``; a kind with too few examples adds nothing. Of candidates
over the threshold that pass their check and touch no base span, the likeliest
are taken first, then longer ones; what overlaps one already taken is left.

One pass reads the texts and keeps spans and candidates only. Trees, calibration
and thresholds come from all labelled candidates: their features are put into
bins at the quantiles of all, equal rows of bins are counted, and every level of
every round adds up gradients by node and bin over all of them, in tasks. The
driver gets these sums, and held-out candidates counted by steps of the margin.
Sums are of whole numbers, so that results don't depend on the order of rows.
Every candidate of every text is judged.

Defined cases: null and empty texts have no spans; a null doc_id stays null;
every row gives a row, repeated ones the same; an empty table gives no rows;
other columns, whatever their names, are left out. Patterns are applied so that
their time grows in proportion to the text, also on long runs without a match.
Host addresses of version 6 are not proposed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .common import byte_texts, cut, discard, table

KINDS = ("email", "ip", "card", "phone")
HELD_OUT = 4  # every fourth document, by a hash, calibrates and sets thresholds
PRECISION = 0.95
LIKELY = 0.5  # a candidate is never added below this probability
MIN_EXAMPLES = 20  # of each class, learned from, and personal ones held out
STEPS = 1_024  # of a unit of margin, in which held-out candidates are counted for calibration and thresholds

_LOCAL_REVERSED = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can only begin where a run of digits does; nothing that was taken is given back.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DIGITS = re.compile(r"[0-9]+")
_RUN = re.compile(r"[0-9](?:[0-9\x20()./-]*[0-9])?")
_SPELLED_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\x20?[\[({](?:\.|dot)[\])}]\x20?|\x20dot\x20)[0-9]{1,3}){3}(?![0-9])")
_AT = re.compile(r"\x20?[\[({](?:at|AT|@)[\])}]\x20?|\x20@\x20?|@\x20|\x20(?:at|AT)\x20|@")
_DOT = r"(?:\.|\x20?[\[({](?:dot|DOT|\.)[\])}]\x20?|\x20(?:dot|DOT)\x20)"
_EMAIL_HINTS = ("@", "at]", "at)", "at}", "AT]", "AT)", "AT}", " dot ", " DOT ", "dot]", "dot)", "DOT]", "DOT)")  # any form has one
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_NEXT_LABEL = re.compile(_DOT + r"([A-Za-z0-9-]+)")
_SPACED_DOT = re.compile(r"\x20(?:dot|DOT)\x20|[\[({](?:dot|DOT|\.)[\])}]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
# Fixed words that announce a kind, in the languages of the corpora known so far.
CUES = {
    "email": ("mail", "e-mail", "email", "contact", "kontakt", "correo", "courriel", "write", "address"),
    "ip": ("ip", "host", "server", "address", "adresse", "serveur", "servidor", "login"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "mastercard", "payment"),
    "phone": ("phone", "tel", "telefon", "call", "mobile", "fax", "teléfono", "téléphone", "whatsapp"),
}
N_FEATURES = 24
GROUPS = 8  # groups of digits that a card or phone number is written in, at most
_FLUSH = 100_000  # candidates in one batch of results


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v if v < 5 else 2 * v - 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in that order; leftmost and not overlapping within a kind."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        # The pattern's first match with this @ begins at the run before it, cut at the last match.
        local = _LOCAL_REVERSED.match(text[done:at][::-1])
        domain = _DOMAIN.match(text, at + 1) if local else None
        done = at + 1
        if domain:
            out.append((at - local.end(), 0, domain.end()))
            done = domain.end()
        at = text.find("@", done)
    if _DIGITS.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out)


def _email_candidates(text: str) -> Iterator[tuple[int, int, int, bool]]:
    for m in _AT.finditer(text):
        sign = m.group()
        lo = m.start()
        while lo > 0 and m.start() - lo < 64 and _LOCAL_REVERSED.fullmatch(text[lo - 1]):  # 64: the longest local part
            lo -= 1
        label = _LABEL.match(text, m.end()) if lo < m.start() else None
        if not label:
            continue
        spelled_at = sign.strip() in ("at", "AT")
        plain, end = text[lo:m.start()] + "@" + label.group(), label.end()
        while True:
            more = _NEXT_LABEL.match(text, end)
            if not more or (spelled_at and not _SPACED_DOT.search(text[end:more.start(1)])):
                break
            plain, end = f"{plain}.{more.group(1)}", more.end()
            yield lo, 0, end, bool(_EMAIL.fullmatch(plain))


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, passes its kind's check) of every proposed span; they may overlap."""
    out = set(_email_candidates(text)) if any(h in text for h in _EMAIL_HINTS) else set()
    if not _DIGITS.search(text):
        return sorted(out)
    for m in _SPELLED_IP.finditer(text):
        octets = _DIGITS.findall(m.group())
        out.add((m.start(), 1, m.end(), all(map(_octet, octets))))
        out.update((m.start() + a, 1, m.end() - b, False) for a, b in ((1, 0), (0, 1)) if len(octets[-b]) > 1)  # a digit short
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 10:
            continue
        groups = [(g.start(), g.end()) for g in _DIGITS.finditer(text, run.start(), run.end())]
        for i, (begin, end) in enumerate(groups):
            total, digits = 0, ""
            for j in range(i, len(groups)):
                b, e = groups[j]
                total += e - b
                if total > 19 or b - end > 3 or j - i >= GROUPS:
                    break
                digits, end = digits + text[b:e], e
                if total >= 14:
                    out.add((begin, 2, end, luhn(digits)))
                    out.update([(begin + 1, 2, end, False), (begin, 2, end - 1, False)])  # a digit short
                if 10 <= total <= 15:
                    out.add((begin, 3, end, True))
                    first = begin
                    while first > 0 and begin - first < 2 and text[first - 1] in "+(":
                        first -= 1
                    if first < begin:
                        out.add((first, 3, end, True))
    return sorted(out)


def _class(text: str, at: int) -> int:
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


def features(text: str, start: int, kind: int, end: int) -> bytes:
    """24 float32: format and context of a span; neither the kind's check nor the base patterns are among them."""
    s = text[start:end]
    groups = [len(g) for g in re.findall(r"[^\W_]+", s)] or [0]
    before, after = text[max(0, start - 40):start], text[end:end + 40]
    words = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", before.lower())[-4:]
    left, right = before.rstrip(), after.lstrip()
    return np.array([
        len(s), len(groups), max(groups), min(groups), groups[0], groups[-1],
        sum(c.isdigit() for c in s), sum(c.isalpha() for c in s), s.count(" "), s.count("."), s.count("-"),
        s.count("(") + s.count(")"), s.count("(") - s.count(")"), s.count("/"), s.count("@"), s[0] == "+", s[0] == "(",
        _class(text, start - 1), _class(text, end), _class(left, len(left) - 1), _class(right, 0) if right else 0,
        before[-1:] in "+.@-/" and before != "", after[:1] in ".-@/:" and after != "",
        any(w.startswith(cue) for w in words for cue in CUES[KINDS[kind]]),
    ], np.float32).tobytes()


def _vectors(x: pa.Array | list[bytes]) -> np.ndarray:
    rows = x if isinstance(x, list) else x.to_pylist()
    return np.frombuffer(b"".join(rows), np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans and candidates of each text; label 1 personal, 0 not, null to be decided; open: may be added."""

    def lists(sizes: list[int], columns: list[pa.Array], names: tuple[str, ...]) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.StructArray.from_arrays(columns, names))

    def batch(ids: list, base_sizes: list, base: list, sizes: list, rows: list) -> pa.RecordBatch:
        columns = [[r[j] for r in rows] for j in range(6)]
        types = (pa.int8(), pa.int64(), pa.int64(), pa.bool_(), pa.int8(), pa.binary())
        spans = [pa.array([s[j] for s in base], t) for j, t in ((1, pa.int8()), (0, pa.int64()), (2, pa.int64()))]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), lists(base_sizes, spans, ("kind", "start", "stop")),
             lists(sizes, [pa.array(c, t) for c, t in zip(columns, types)], ("kind", "start", "stop", "open", "label", "x"))],
            names=["doc_id", "base", "found"])

    for b in batches:
        ids, base_sizes, bases, sizes, rows = [], [], [], [], []
        for doc_id, body in zip(b.column(0).to_pylist(), b.column(1)):
            text = body.as_buffer().to_pybytes().decode("utf-8")
            base = base_spans(text)
            known = set(base)
            before, at = len(rows), 0
            for start, kind, end, passes in candidates(text):
                while at < len(base) and base[at][2] <= start:  # ended for this candidate and all later ones
                    at += 1
                overlaps, j = False, at
                while j < len(base) and base[j][0] < end and not overlaps:
                    overlaps, j = base[j][2] > start, j + 1
                touches = _class(text, start - 1) in (2, 3) or _class(text, end) in (2, 3)
                label = 1 if (start, kind, end) in known else 0 if overlaps or touches or not passes else None
                rows.append((kind, start, end, label is None, label, features(text, start, kind, end)))
            ids.append(doc_id)
            base_sizes.append(len(base))
            bases += base
            sizes.append(len(rows) - before)
            if len(rows) > _FLUSH:
                yield batch(ids, base_sizes, bases, sizes, rows)
                ids, base_sizes, bases, sizes, rows = [], [], [], [], []
        if ids:
            yield batch(ids, base_sizes, bases, sizes, rows)


FOUND = ("doc_id long, base array<struct<kind: tinyint, start: long, stop: long>>, found array<struct<kind: tinyint, "
         "start: long, stop: long, open: boolean, label: tinyint, x: binary>>")
SPANS = "array<struct<kind: string, start: long, stop: long, score: double>>"


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(kind, held out, label, features) of the candidates with a label, from rows (held, found)."""
    for b in batches:
        found = b.column(1)
        held = np.repeat(b.column(0).to_numpy(zero_copy_only=False), found.value_lengths().to_numpy(zero_copy_only=False))
        flat = found.flatten()
        use = np.flatnonzero(flat.field("label").is_valid().to_numpy(zero_copy_only=False))
        for at in range(0, len(use), _FLUSH):
            some = pa.array(use[at:at + _FLUSH])
            kind, label, x = (flat.field(c).take(some) for c in ("kind", "label", "x"))
            yield kind.to_numpy(), held[some.to_numpy()], label.to_numpy(), _vectors(x)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each value of each feature occurs among the candidates to learn from."""
    for kind, held, _, x in _labelled(batches):
        rows = []
        for k in np.unique(kind[~held]):
            for j, column in enumerate(x[~held & (kind == k)].T):
                rows += [(k, j, v, n) for v, n in zip(*np.unique(column, return_counts=True))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int8(), pa.int8(), pa.float64(), pa.int64()))],
                                             names=["kind", "feature", "value", "n"])


def _binned(edges: dict[int, list[np.ndarray]]):
    """Candidates as the bins of their features, equal ones counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, held, label, x in _labelled(batches):
            for k in edges:
                mine = kind == k
                if mine.any():
                    rows = np.column_stack([held[mine], label[mine], boosting.to_bins(x[mine], edges[k])]).astype(np.uint8)
                    rows, n = np.unique(rows, axis=0, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(n), k, np.int8)), pa.array(rows[:, 0] > 0), pa.array(rows[:, 1].astype(np.int8)),
                         pa.array([r.tobytes() for r in rows[:, 2:]], pa.binary()), pa.array(n)], names=["kind", "held", "label", "b", "n"])

    return run


def _margins(models: dict[int, tuple[boosting.Boosted, list[boosting.Tree]]]):
    """Margins of rows (kind, label, b, n), rounded down to whole ``STEPS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            step = np.zeros(b.num_rows, np.int64)
            for k, at, binned, _, _ in boosting.table_rows(b, N_FEATURES):
                step[at] = np.floor((models[k][0].base + boosting.added(binned, models[k][1])) * STEPS)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(step), b.column(3)], names=["kind", "label", "step", "n"])

    return run


def learn(found: DataFrame) -> dict[int, tuple[boosting.Boosted, float]]:
    """kind -> (trees, threshold), from all candidates with a label."""
    held = (F.pmod(F.xxhash64(F.lit("held"), "doc_id"), F.lit(HELD_OUT)) == 0).alias("held")
    each = found.select(held, "found")
    edges: dict[int, list[np.ndarray]] = {}
    for r in boosting.quantiles(each.mapInArrow(_values, "kind tinyint, feature tinyint, value double, n long")).collect():
        edges.setdefault(r["kind"], [np.zeros(0)] * N_FEATURES)
        edges[r["kind"]][r["feature"]] = np.append(edges[r["kind"]][r["feature"]], r["value"])
    edges = {k: [np.sort(e) for e in edges[k]] for k in sorted(edges)}
    binned = cut(each.mapInArrow(_binned(edges), "kind tinyint, held boolean, label tinyint, b binary, n long")
                 .groupBy("kind", "held", "label", "b").agg(F.sum("n").alias("n")), "personal-binned")
    size = {(r["kind"], r["held"], r["label"]): r["n"] for r in binned.groupBy("kind", "held", "label").agg(F.sum("n").alias("n")).collect()}
    number = lambda k, held, label: size.get((k, held, label), 0)
    bases = {k: boosting.prior(number(k, False, 1), number(k, False, 0) + number(k, False, 1)) for k in edges
             if min(number(k, False, 0), number(k, False, 1), number(k, True, 1)) >= MIN_EXAMPLES}
    if not bases:
        discard(binned)
        return {}
    rows = binned.filter(F.col("kind").isin(list(bases)))
    grown = boosting.fit_table(rows.filter("not held").select("kind", "label", "b", "n"), bases, edges)
    steps = (rows.filter("held").select("kind", "label", "b", "n").mapInArrow(_margins(grown), "kind tinyint, label tinyint, step long, n long")
             .groupBy("kind", "step").agg(F.sum(F.col("n") * F.col("label")).alias("personal"), F.sum("n").alias("n"))
             .orderBy("kind", F.desc("step")).collect())
    discard(binned)
    models = {}
    for k, (trees, _) in grown.items():
        step, personal, n = np.array([(r["step"], r["personal"], r["n"]) for r in steps if r["kind"] == k], float).T
        middle = (step + 0.5) / STEPS
        trees.calibrate_margins(np.tile(middle, 2), np.repeat([1.0, 0.0], len(n)), np.concatenate([personal, n - personal]))
        good = np.flatnonzero(np.cumsum(personal) >= PRECISION * np.cumsum(n))
        if len(good):
            models[k] = (trees, max(float(trees.scaled(step[good[-1]:good[-1] + 1] / STEPS)[0]), LIKELY))
    return models


def _choose(models: dict[int, tuple[boosting.Boosted, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])
        for b in batches:
            found = b.column(2)
            doc = np.repeat(np.arange(b.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
            flat = found.flatten()
            use = np.flatnonzero(flat.field("open").to_numpy(zero_copy_only=False))
            flat, doc = flat.take(pa.array(use)), doc[use]
            kind, start, stop = (flat.field(c).to_numpy() for c in ("kind", "start", "stop"))
            score, least = np.zeros(len(doc)), np.full(len(doc), np.inf)
            for k, (trees, threshold) in models.items():
                mine = np.flatnonzero(kind == k)
                if len(mine):
                    score[mine], least[mine] = trees.probability(_vectors(flat.field("x").take(pa.array(mine)))), threshold
            chosen: dict[int, list[dict]] = {}
            taken: dict[int, set[int]] = {}
            for j in np.lexsort((kind, start, start - stop, -score, doc)):
                places = range(int(start[j]), int(stop[j]))
                if score[j] >= least[j] and taken.setdefault(doc[j], set()).isdisjoint(places):
                    taken[doc[j]].update(places)
                    chosen.setdefault(doc[j], []).append(
                        {"kind": KINDS[kind[j]], "start": places.start, "stop": places.stop, "score": float(score[j])})
            base = [[{"kind": KINDS[s["kind"]], "start": s["start"], "stop": s["stop"], "score": None} for s in spans]
                    for spans in b.column(1).to_pylist()]
            order = lambda s: (s["start"], KINDS.index(s["kind"]))
            spans = [sorted(x + chosen.get(k, []), key=order) for k, x in enumerate(base)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(span)), pa.array(spans, pa.list_(span))],
                                             names=["doc_id", "base", "spans"])

    return run


def personal_spans(docs: DataFrame) -> DataFrame:
    """doc_id, base, spans: arrays of (kind, start, stop, score) in code points, by start and kind.

    ``spans`` holds the base spans (score null) and those that the trees add.
    """
    found = cut(byte_texts(docs).mapInArrow(_find, FOUND), "personal-found")
    return found.mapInArrow(_choose(learn(found)), f"doc_id long, base {SPANS}, spans {SPANS}")


def redact(text: str, spans: list) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind']}]"]
        at = max(at, s["stop"])
    return "".join(out) + text[at:]


def spelled(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in KINDS]
    return personal_spans(table(spark, sf_dir, "documents")).select(
        "doc_id", *counts, F.sha2(spelled("base").cast("binary"), 256).alias("base_sha256"), spelled("spans").alias("spans"))
