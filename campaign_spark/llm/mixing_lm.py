"""Language-model scores by online logistic context mixing.

Texts are coded bit by bit. Four predictors look up, by hash, how often each bit
followed its context - the last one, two or three bytes, or all bytes of the word
so far - in the training texts. Their logits are combined by weights that two
gates select (how often the longest contexts were seen; the bit's and the byte's
place); an adaptive table refines the mixed probability. Every text starts from
weights learned on the training words, each word left out of its own counts, and
updates weights and table of its own after every bit that is read. White space
between words is coded by a small table of transitions. ``score`` is the log10
probability of all bits, and depends on no other text scored with it.

1. ``chunks``: tasks pack whole texts into chunks of about ``CHUNK`` bytes.
2. ``vocabulary``: each chunk sends its distinct words, with their counts in
   training texts, to buckets by hash; a bucket adds them up. However common a
   word is, a chunk sends it once.
3. The counts of hashed contexts (fixed size) are summed over the buckets, and the
   weights that texts start from are learned in each bucket and averaged.
4. Texts are dealt by length into parts of about ``PART`` bytes, and each part reads
   its texts side by side: those that stand together end at about the same time.
5. Buckets reply counts and parts reply scores to the chunks.

The contexts that are counted start anew with each word. Words are told apart by 64-bit hashes. Defined cases: a null or empty text has the
end token alone; a null doc_id stays null and counts as training; repeated rows
give repeated rows; with no training text all counts are 0; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, mix, table

CHUNK = 8_000_000
CHUNKS_A_BUCKET = 8
READ = -1  # stands for a bucket where a part replies scores
END = 0xE4D0F7E87A11B0E5  # stands for the end token among the word hashes
SIZES = (16, 18, 20, 22)  # log2 of the slots of each predictor
LONG = 1 << 20  # slots of a table above which only those that occur are summed
PIECE = 4_096  # slots summed together
GATE_A, GATE_B, BINS = 35, 32, 24
RATE = 0.01
BATCH = 20_000  # words coded together
ONLINE, ADAPT = 0.002, 0.02  # rates of a text's own weights and refining table
TEXTS = 2_048  # texts read side by side
WINDOW = 1 << 19  # bytes of them whose contexts are looked up together
PART = 32_000_000  # bytes of texts of about the same length that a task reads
CLASSES = 8  # lengths told apart from one power of two to the next
MET = 20  # log2 of the places in which equal contexts meet
_U = np.uint64
_SHIFT = np.array([[64 - s] for s in SIZES], _U)
_BITS = np.ascontiguousarray(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).T.astype(float))
_START, _STOP = 7, 8  # states of the white-space table besides 0 (word) and 1-6 (its bytes)
_SPACE = np.zeros(256, np.int64)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = range(1, 7)


def spaces(body: bytes) -> np.ndarray:
    """Counts of the 9 x 9 transitions between words, white-space bytes, start and end."""
    c = np.empty(len(body) + 2, np.int64)
    c[0], c[-1] = _START, _STOP
    c[1:-1] = _SPACE[np.frombuffer(body, np.uint8)]
    a, b = c[:-1], c[1:]
    change = (a != 0) | (b != 0)
    return np.bincount(a[change] * 9 + b[change], minlength=81)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    ids, held, bodies, size, number = [], [], [], 0, 0

    def out() -> pa.RecordBatch:
        nonlocal ids, held, bodies, size, number
        key = TaskContext.get().partitionId() * 2 ** 32 + number
        row = [[key], [ids], [held], [[len(x) for x in bodies]], [pack.compress(b"".join(bodies))]]
        ids, held, bodies, size, number = [], [], [], 0, number + 1
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)],
                                          names=["chunk", "doc_ids", "held", "sizes", "blob"])

    for b in batches:
        for doc, test, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            ids.append(doc)
            held.append(test)
            bodies.append(body.as_buffer().to_pybytes().lower())
            size += len(bodies[-1]) + 100
            if size >= CHUNK:
                yield out()
    if ids:
        yield out()


class _Numbers(dict):
    """word -> its number in a chunk, in order of first use."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _indexed(blob: bytes, sizes: list[int]):
    """A chunk's texts, the numbers of their words, its distinct words (and the end) in the order of their
    hashes, and each number's place in that order; the end's place is the last one given."""
    data = zstandard.ZstdDecompressor().decompress(blob, max_output_size=max(1, sum(sizes)))
    numbers, bodies, texts, at = _Numbers(), [], [], 0
    for n in sizes:
        bodies.append(data[at:at + n])
        at += n
        words = bodies[-1].split()
        texts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    words = [*numbers, b""]
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in numbers] + [END], _U)
    order = np.argsort(h)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return bodies, texts, [words[i] for i in order], h[order], place


def _slices(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                bodies, texts, words, h, place = _indexed(row["blob"], row["sizes"])
                count, moves = np.zeros(len(words), np.int64), np.zeros(81, np.int64)
                train = [t for t, test in zip(texts, row["held"]) if not test]
                if train:
                    count[place] = np.bincount(np.concatenate(train), minlength=len(words))
                    count[place[-1]] = len(train)
                for body, test in zip(bodies, row["held"]):
                    if not test:
                        moves += spaces(body)
                to = (h >> _U(32)).astype(np.int64) * buckets >> 32
                edge = np.searchsorted(to, np.arange(buckets + 1))
                out = [(k, row["chunk"], b" ".join(words[edge[k]:edge[k + 1]]), count[edge[k]:edge[k + 1]].tobytes(),
                        moves.tobytes() if not k else None) for k in range(buckets)]
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                 names=["bucket", "chunk", "words", "counts", "moves"])

    return run


def _vocabulary(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: its distinct words (by hash) with counts, and where each chunk's words are among them."""
    pdf = pdf.sort_values("chunk")
    lists = [w.split(b" ") if len(c) else [] for w, c in zip(pdf["words"], pdf["counts"])]
    flat = [w for x in lists for w in x]
    h = np.fromiter((xxhash.xxh3_64_intdigest(w) if w else END for w in flat), _U, len(flat))
    uniq, first, at = np.unique(h, return_index=True, return_inverse=True)
    n = np.concatenate([np.frombuffer(c, np.int64) for c in pdf["counts"]])
    count = np.zeros(len(uniq), np.int64)
    np.add.at(count, at, n)
    ends = np.cumsum([len(x) for x in lists])[:-1]
    moves = sum((np.frombuffer(m, np.int64) for m in pdf["moves"] if m is not None), np.zeros(81, np.int64))
    return pd.DataFrame({
        "bucket": [pdf["bucket"].iloc[0]], "words": [b" ".join(flat[i] for i in first)], "counts": [count.tobytes()],
        "chunks": [pdf["chunk"].tolist()], "places": [[x.astype(np.int32).tobytes() for x in np.split(at, ends)]],
        "n": [int(count.sum())], "v": [int((count > 0).sum())], "moves": [moves.tolist()]})


class Coder:
    """The bits of a batch of words, with the slots of their contexts."""

    def __init__(self, words: list[bytes]):
        data = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)  # each word ends with a blank
        size = np.array([len(w) + 1 for w in words])
        start = np.cumsum(size) - size
        self.word = np.repeat(np.arange(len(words)), size)
        self.place = np.arange(len(data)) - start[self.word]
        self.byte = data
        back = [np.where(self.place >= k, np.concatenate([np.zeros(k, np.int64), data])[:len(data)], 0) for k in (1, 2, 3)]
        self.contexts = [back[0].astype(_U), (back[0] + (back[1] << 8) + 1).astype(_U),
                         (back[0] + (back[1] << 8) + (back[2] << 16) + 2).astype(_U), self._prefix(size, start)]

    def _prefix(self, size: np.ndarray, start: np.ndarray) -> np.ndarray:
        out = np.full(len(self.byte), 0x9E37, _U)
        rows, h = np.arange(len(size)), np.full(len(size), 0x9E37, _U)
        for k in range(int(size.max()) - 1 if len(size) else 0):
            live = size[rows] > k + 1
            rows, h = rows[live], h[live]
            h = (h ^ self.byte[start[rows] + k].astype(_U)) * _U(0x100000001B3) + _U(k)
            out[start[rows] + k + 1] = h
        return out

    def bits(self) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """(bit's place, bits, slots of each predictor) for the eight bits of every byte."""
        for k in range(8):
            node = ((1 << k) | (self.byte >> (8 - k))).astype(_U)
            slots = []
            for i, (c, size) in enumerate(zip(self.contexts, SIZES)):
                if i == 0:
                    slots.append((c * _U(256) + node).astype(np.int64))
                else:
                    x = (c * _U(0x9E3779B97F4A7C15) + node) * _U(0xD6E8FEB86659FD93)
                    x = (x ^ (x >> _U(31))) * _U(0xBF58476D1CE4E5B9)
                    slots.append((x >> _U(64 - size)).astype(np.int64))
            yield k, (self.byte >> (7 - k)) & 1, slots


def _split(words: bytes) -> list[bytes]:
    return words.split(b" ") if words else [b""]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the batches, one at a time: each holds a bucket of words."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def _used(row: dict) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Batches of a bucket's words that are not empty and that training documents have, with their counts."""
    words, counts = _split(row["words"]), np.frombuffer(row["counts"], np.int64)
    use = np.flatnonzero((counts > 0) & np.fromiter(map(bool, words), bool, len(words)))
    for at in range(0, len(use), BATCH):
        some = use[at:at + BATCH]
        yield [words[i] for i in some], counts[some].astype(float)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (of zeros, of ones) in the slots of all predictors over this task's words."""
    total = [np.zeros((2, 1 << s)) for s in SIZES]
    for row in _rows(batches):
        for words, counts in _used(row):
            coder = Coder(words)
            weight = counts[coder.word]
            for _, bit, slots in coder.bits():
                for t, s in zip(total, slots):
                    # In a long table only the slots that occur: no temporary as long as the table.
                    met, at = np.unique(s, return_inverse=True) if t.shape[1] > LONG else (slice(None), s)
                    least = 0 if t.shape[1] > LONG else t.shape[1]
                    t[1][met] += np.bincount(at, weights=weight * bit, minlength=least)
                    t[0][met] += np.bincount(at, weights=weight * (1 - bit), minlength=least)
    first = 0
    for t in total:
        flat = t.reshape(-1, PIECE)
        used = np.flatnonzero(flat.any(1))
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array((used + first).astype(np.int32)), pa.array([flat[i].astype(np.float32).tobytes() for i in used], pa.binary())],
                names=["piece", "sums"])
        first += len(flat)


def _add_pieces(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(PIECE)
    for x in pdf["sums"]:
        total += np.frombuffer(x, np.float32)
    return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "sums": [total.astype(np.float32).tobytes()]})


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


class Mixer:
    """Gated weights and the refining table over the predictors' counts."""

    def __init__(self, tables: list[np.ndarray], a=None, b=None, refine=None):
        self.tables = tables
        self.a = np.full((GATE_A, len(SIZES)), 0.15) if a is None else a
        self.b = np.full((GATE_B, len(SIZES)), 0.15) if b is None else b
        self.past = (np.zeros_like(self.a), np.zeros_like(self.b))
        centre = _squash((np.arange(BINS) - BINS / 2 + 0.5))
        self.refine = np.stack([np.tile(1 - centre, (GATE_B, 1)), np.tile(centre, (GATE_B, 1))]) * 2 if refine is None else refine

    def inputs(self, coder: Coder, k: int, bit: np.ndarray, slots: list[np.ndarray], leave_out: bool):
        xs, seen = [], []
        for t, s in zip(self.tables, slots):
            zero, one = t[0][s].astype(float), t[1][s].astype(float)
            if leave_out:
                zero, one = np.maximum(zero - (1 - bit), 0), np.maximum(one - bit, 0)
            n = zero + one
            xs.append(np.log((one + 0.02) / (zero + 0.02)))
            seen.append(n)
        level = lambda n: (n > 0).astype(np.int64) + (n > 1) + (n > 3) + (n > 20)
        return np.stack(xs, 1), (level(seen[3]) + (seen[3] > 200) + (seen[3] > 5_000)) * 5 + level(seen[2]), k * 4 + np.minimum(coder.place, 3)

    def mixed(self, x: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", x, self.a[ga] + self.b[gb])

    def _bin(self, z: np.ndarray) -> np.ndarray:
        return np.clip((z + BINS / 2).astype(np.int64), 0, BINS - 1)

    def learn(self, coder: Coder, weight: np.ndarray) -> None:
        for k, bit, slots in coder.bits():
            x, ga, gb = self.inputs(coder, k, bit, slots, True)
            for at in range(0, len(bit), 4_096):
                z = slice(at, at + 4_096)
                mixed = self.mixed(x[z], ga[z], gb[z])
                error = (bit[z] - _squash(mixed)) * (weight[z] / weight[z].sum())
                for gate, table_, past in ((ga[z], self.a, self.past[0]), (gb[z], self.b, self.past[1])):
                    # Steps shrink with a weight's own past gradients, so that rare gates learn as fast.
                    for i in range(x.shape[1]):
                        slope = np.bincount(gate, weights=error * x[z, i], minlength=len(table_))
                        past[:, i] += slope * slope
                        table_[:, i] += RATE * slope / np.sqrt(past[:, i] + 1e-12)
                cell = gb[z] * BINS + self._bin(mixed)
                for v in (0, 1):
                    self.refine[v] += np.bincount(cell, weights=weight[z] * (bit[z] == v), minlength=GATE_B * BINS).reshape(GATE_B, BINS)


class Reader:
    """Reads texts bit by bit; each has weights and refining table of its own, which every bit updates once it is coded.

    Logits and gates of a bit depend on its word alone, so they are looked up once for each beginning of a word in a
    window of texts. The bits of a byte share no weights of the second gate and no cells of the refining table: those
    are fetched and updated a byte at a time, which is the same as bit by bit.
    """

    def __init__(self, mixer: Mixer):
        self.a = mixer.a.astype(np.float32)
        # By place in the word, then by bit.
        self.b = mixer.b.astype(np.float32).reshape(8, 4, len(SIZES)).transpose(1, 0, 2).reshape(4, -1)
        self.refine = (mixer.refine[1] / mixer.refine.sum(0)).reshape(8, 4, BINS).transpose(1, 0, 2).ravel()
        # One number for each slot, so that it is looked up once: real the logit, imaginary how often it was seen, by steps.
        self.slots = np.zeros(sum(1 << s for s in SIZES), np.complex64)
        self.first = np.cumsum([0] + [1 << s for s in SIZES])[:-1, None]
        steps = (), (), (0, 1, 3, 20), (0, 1, 3, 20, 200, 5_000)
        for t, first, some in zip(mixer.tables, self.first[:, 0], steps):
            self.slots.real[first:first + t.shape[1]] = np.log((t[1] + 0.02) / (t[0] + 0.02))
            for n in some:
                self.slots.imag[first:first + t.shape[1]] += t.sum(0) > n
        self.met = np.empty(1 << MET, np.int32)

    def log10(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text, whose words all end with a blank."""
        out = np.zeros(len(texts))
        order = np.argsort([-len(t) for t in texts], kind="stable")
        for at in range(0, len(order), TEXTS):
            some = order[at:at + TEXTS]
            out[some] = self._read([texts[i] for i in some])
        return out

    def _at(self, contexts: np.ndarray, node: np.ndarray) -> np.ndarray:
        x = contexts * _U(0x9E3779B97F4A7C15)
        x += node
        x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(31)
        x *= _U(0xBF58476D1CE4E5B9)
        x >>= _SHIFT
        x[0] = contexts[0] * _U(256) + node
        return x.view(np.int64) + self.first

    def _distinct(self, prefix: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which bytes to look up (their contexts differ), and for each byte its number among those."""
        key = (prefix ^ near * _U(0x9E3779B97F4A7C15)) * _U(0xD6E8FEB86659FD93) >> _U(64 - MET)
        own = np.arange(len(key), dtype=np.int32)
        self.met[key] = own  # any one of those that meet; the others are compared with it
        which = self.met.take(key.view(np.int64))
        which = np.where((prefix.take(which) == prefix) & (near.take(which) == near), which, own)
        first = np.flatnonzero(which == own)
        number = np.empty(len(key), np.int32)
        number[first] = np.arange(len(first), dtype=np.int32)
        return first, number.take(which)

    def _look_up(self, prefix: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits (byte, bit and predictor) and first gates (byte, bit) of bytes after their contexts."""
        x, gate = np.empty((len(prefix), 8, len(SIZES)), np.float32), np.empty((len(prefix), 8), np.int8)
        for at in range(0, len(prefix), 16_384):
            z = slice(at, at + 16_384)
            c, byte = near[z] >> _U(8), (near[z] & _U(255)).view(np.int64)
            contexts = np.stack([c & _U(0xFF), (c & _U(0xFFFF)) + _U(1), c + _U(2), prefix[z]])
            for k in range(8):
                met = self.slots.take(self._at(contexts, ((1 << k) | (byte >> (8 - k))).view(_U)))
                x[z, k] = met.real.T
                gate[z, k] = met.imag[3] * 5 + met.imag[2]
        return x.reshape(len(prefix), -1).view(np.complex128), gate

    def _read(self, texts: list[bytes]) -> np.ndarray:
        """Texts by falling length: the first ``live`` of them have a byte at the place that is read."""
        size = np.array([len(t) for t in texts])
        data, start = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size
        n, out, longest = len(texts), np.zeros(len(texts)), int(size.max(initial=0))
        # The four weights of a gate are moved as one number of 16 bytes.
        first, second = np.tile(self.a, (n, 1)).view(np.complex128).ravel(), np.tile(self.b, (n, 1)).view(np.complex128)
        refine = np.tile(self.refine, n)
        state = np.zeros(n, _U), np.full(n, 0x9E37, _U), np.zeros(n, np.int64)
        own, at = np.arange(n), 0
        while at < longest:
            live = int(np.searchsorted(-size, -at))
            steps = min(max(1, WINDOW // live), longest - at)
            lives = np.searchsorted(-size, -np.arange(at, at + steps))
            edge = np.concatenate([[0], np.cumsum(lives)])
            bytes_, near, prefix, place = (np.empty(edge[-1], t) for t in (np.uint8, _U, _U, np.int64))
            for i in range(steps):
                self._contexts(data[start[:lives[i]] + (at + i)], *(x[:lives[i]] for x in state),
                               *(x[edge[i]:edge[i + 1]] for x in (bytes_, near, prefix, place)))
            which, number = self._distinct(prefix, near)
            x, gate = self._look_up(prefix[which], near[which])
            del near, prefix
            for i in range(steps):
                z = slice(edge[i], edge[i + 1])
                out[:lives[i]] += self._byte(bytes_[z], own[:lives[i]], place[z], x.take(number[z], 0), gate.take(number[z], 0),
                                             first, second, refine)
            at += steps
        return out

    @staticmethod
    def _contexts(byte, back, prefix, place, bytes_, near, prefix_, place_) -> None:
        """Notes a byte's contexts (the last three bytes before it and the byte itself as one number) and moves on."""
        bytes_[:], prefix_[:] = byte, prefix
        value = byte.astype(_U)
        np.minimum(place, 3, out=place_)
        np.add(back << _U(8), value, out=near)
        go = byte != 0x20
        prefix ^= value
        prefix *= _U(0x100000001B3)
        prefix += place.view(_U)
        prefix[~go] = 0x9E37
        np.multiply(near & _U(0xFFFFFF), go, out=back)
        place += 1
        place *= go

    @staticmethod
    def _byte(byte, own, place, x, gate, first, second, refine) -> np.ndarray:
        """log10 probability of a byte of each text; its eight bits update the text's weights and table."""
        n, bit = len(byte), _BITS.take(byte, 1)
        ga, gb = gate.T + own * GATE_A, own * 4 + place
        x, wb = np.ascontiguousarray(x.T).view(np.float32), np.ascontiguousarray(second.take(gb, 0).T)
        wb_ = wb.view(np.float32)  # of each bit the weights of all texts, as in x
        z, p, error = np.empty((8, n)), np.empty((8, n)), np.empty((n, len(SIZES)), np.float32)
        flat = error.ravel()
        for k in range(8):
            some, at = x[k], ga[k]
            wa = first.take(at)
            t = wa.view(np.float32) + wb_[k]
            t *= some
            np.add(t[0::4] + t[1::4], t[2::4] + t[3::4], out=z[k])
            # The logistic function.
            q = np.tanh(z[k] * 0.5, out=p[k])
            q *= 0.5
            q += 0.5
            e = bit[k] - q
            e *= ONLINE
            error.T[:] = e.astype(np.float32)
            some *= flat
            wa.view(np.float32)[:] += some
            wb_[k] += some
            first[at] = wa
        second[gb] = wb.T
        z += BINS / 2
        np.maximum(z, 0, out=z)
        np.minimum(z, BINS - 1, out=z)
        cell = z.astype(np.int64)
        cell += gb * (8 * BINS) + np.arange(0, 8 * BINS, BINS)[:, None]
        one = refine.take(cell)
        p *= 3
        p += one
        p *= 0.25
        np.subtract(bit, one, out=z)
        z *= ADAPT
        one += z
        refine[cell] = one
        p += bit
        p -= 1
        np.abs(p, out=p)
        np.maximum(p, 1e-7, out=p)
        np.minimum(p, 1 - 1e-7, out=p)
        return np.log10(p.prod(0))


def _learn(tables: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, words_seen = Mixer(_unpacked(tables)), 0
        prior = mixer.refine.copy()
        for row in _rows(batches):
            for words, counts in _used(row):
                coder = Coder(words)
                mixer.learn(coder, counts[coder.word])
                words_seen += len(words)
        if words_seen:
            flat = np.concatenate([mixer.a.ravel() * words_seen, mixer.b.ravel() * words_seen,
                                   (mixer.refine - prior).ravel(), [words_seen]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], names=["i", "x"])

    return run


def _replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's words' counts, from the bucket that has added them up."""
    for row in _rows(batches):
        counts = np.frombuffer(row["counts"], np.int64)
        for chunk, places in zip(row["chunks"], row["places"]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([row["bucket"]], pa.int32()),
                 pa.array([counts[np.frombuffer(places, np.int32)].tobytes()], pa.binary())], names=["chunk", "bucket", "counts"])


def dealt(sizes: dict[int, int]) -> tuple[dict[int, tuple[int, int]], int]:
    """Where the texts of each class of lengths begin, the longest first, with their bytes; and the bytes of all."""
    starts, end = {}, 0
    for c in sorted(sizes, reverse=True):
        starts[c] = end, sizes[c]
        end += sizes[c]
    return starts, end


def _deal(starts: dict[int, tuple[int, int]]):
    """A chunk's texts by the part that reads them: a class of lengths is spread evenly over the bytes it takes up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for chunk, sizes, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                data = zstandard.ZstdDecompressor().decompress(packed.as_py(), max_output_size=max(1, sum(sizes)))
                n = np.array(sizes, np.int64)
                first, size = np.array([starts[c] for c in _length_class(n).tolist()], np.int64).T
                even = mix(np.arange(len(n), dtype=_U) + mix(np.array([chunk], _U))) >> _U(40)
                part = (first + size * (even.astype(float) / 2 ** 24)).astype(np.int64) // PART
                ends = np.cumsum(n)
                order = np.argsort(part, kind="stable")
                for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                    bodies = [b" ".join([*data[ends[i] - n[i]:ends[i]].split(), b""]) for i in some]
                    row = [[part[some[0]]], [chunk], [some], [[len(x) for x in bodies]], [pack.compress(b"".join(bodies))]]
                    kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)],
                                                     names=["part", "chunk", "places", "sizes", "blob"])

    return run


def _length_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(n + 1.0) * CLASSES).astype(np.int64)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of texts (and one more for each) by class of length."""
    for b in batches:
        n = b.column(0).flatten().to_numpy()
        kinds, at = np.unique(_length_class(n), return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int32)), pa.array(np.bincount(at, weights=n + 1).astype(np.int64))],
                                         names=["class", "size"])


def _read_texts(tables: bytes, start: tuple):
    """The log10 probabilities of the words of a part's texts, by chunk, with the texts' places there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, places, bodies = [], [], []
        for b in batches:
            for chunk, at, sizes, packed in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)), b.column(4)):
                data = zstandard.ZstdDecompressor().decompress(packed.as_buffer(), max_output_size=max(1, sum(sizes)))
                ends = np.cumsum(sizes).tolist()
                bodies += [memoryview(data)[e - n:e] for e, n in zip(ends, sizes)]
                chunks.append(chunk)
                places.append(np.array(at, np.int64))
        if not bodies:
            return
        values = Reader(Mixer(_unpacked(tables), *start)).log10(bodies)
        for chunk, at, some in zip(chunks, places, np.split(values, np.cumsum([len(x) for x in places])[:-1])):
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([READ], pa.int32()), pa.array([at.tobytes() + some.tobytes()], pa.binary())],
                names=["chunk", "bucket", "counts"])

    return run


def _unpacked(tables: bytes) -> list[np.ndarray]:
    """Counts (of zeros, of ones) in the slots of each predictor."""
    at = np.cumsum([0] + [2 << s for s in SIZES])
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(tables, max_output_size=4 * int(at[-1])), np.float32)
    return [flat[at[i]:at[i + 1]].reshape(2, -1) for i in range(len(SIZES))]


def _documents(n: int, v: int, moves: np.ndarray):
    allowed = np.zeros((9, 9))
    allowed[:8, [0, 1, 2, 3, 4, 5, 6, 8]] = 1
    allowed[0, 0] = 0
    m = moves.reshape(9, 9) * allowed + 0.5 * allowed
    move = np.where(allowed > 0, np.log10(np.where(allowed > 0, m, 1) / np.maximum(m.sum(1, keepdims=True), 1e-9)), 0).ravel()
    whole = np.log10(float(n + v + 1))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in left.iterrows():
            right = right.sort_values("bucket")
            counts = np.concatenate([np.frombuffer(x, np.int64) for b, x in zip(right["bucket"], right["counts"]) if b != READ])
            values = np.full(len(row["sizes"]), np.nan)
            for x in right["counts"][right["bucket"] == READ]:
                values[np.frombuffer(x, np.int64, len(x) // 16)] = np.frombuffer(x, float, offset=len(x) // 2)
            bodies, texts, _, _, place = _indexed(row["blob"], row["sizes"])
            logs = np.log10(counts + 1.0) - whole
            for doc, held, body, t, value in zip(row["doc_ids"], row["held"], bodies, texts, values):
                at = np.append(place[t], place[-1])
                score = float(value + spaces(body) @ move)
                out.append((doc, bool(held), len(at), int((counts[at] > 0).sum()), n, float(logs[at].sum()), score,
                            -score * np.log2(10) / max(1, len(body))))
        return pd.DataFrame(out, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
                                          "bits_per_byte"]).astype({"doc_id": "Int64"})

    return run


_CHUNK = "chunk long, doc_ids array<long>, held array<boolean>, sizes array<long>, blob binary"
_RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
           "score double, bits_per_byte double")


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base and mixed log10 probabilities of the whole text."""
    spark = docs.sparkSession
    held = F.expr("coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2, false)")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"),
                        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    chunks = cut(texts.mapInArrow(_chunks, _CHUNK), "lm-chunks")
    buckets = max(4, -(-chunks.count() // CHUNKS_A_BUCKET))
    vocabulary = cut(
        chunks.mapInArrow(_slices(buckets), "bucket int, chunk long, words binary, counts binary, moves binary")
        .groupBy("bucket").applyInPandas(_vocabulary, "bucket int, words binary, counts binary, chunks array<long>, "
                                         "places array<binary>, n long, v long, moves array<long>"), "lm-vocabulary")
    sums = vocabulary.agg(F.sum("n"), F.sum("v"), *[F.sum(F.col("moves")[i]) for i in range(81)]).first()
    if sums[0] is None:
        return spark.createDataFrame([], _RESULT)
    words = vocabulary.select("words", "counts")
    # Counts of hashed contexts: of fixed size (45 MB as floats), whatever the corpus.
    pieces = words.mapInArrow(_tables, "piece int, sums binary").groupBy("piece").applyInPandas(_add_pieces, "piece int, sums binary")
    flat = np.zeros(sum(2 << s for s in SIZES), np.float32)
    for r in pieces.collect():
        flat[r["piece"] * PIECE:(r["piece"] + 1) * PIECE] = np.frombuffer(r["sums"], np.float32)
    tables = zstandard.ZstdCompressor(level=1).compress(flat)
    del flat
    learned = {r["i"]: r["x"] for r in words.mapInArrow(_learn(tables), "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()}
    start = Mixer([])
    if learned:
        x = np.array([learned[i] for i in range(len(learned))])
        na, nb = start.a.size, start.b.size
        start.a, start.b = (x[:na] / x[-1]).reshape(start.a.shape), (x[na:na + nb] / x[-1]).reshape(start.b.shape)
        start.refine = start.refine + x[na + nb:-1].reshape(start.refine.shape)
    replies = vocabulary.select("bucket", "counts", "chunks", "places").mapInArrow(_replies, "chunk long, bucket int, counts binary")
    # At most some hundred classes, whatever the corpus.
    lengths = (chunks.select("sizes").mapInArrow(_lengths, "class int, size long")
               .groupBy("class").agg(F.sum("size").alias("size")).collect())
    starts, end = dealt({r["class"]: r["size"] for r in lengths})
    read = (chunks.select("chunk", "sizes", "blob").mapInArrow(_deal(starts), "part int, chunk long, places array<long>, sizes array<long>, blob binary")
            .repartitionById(max(1, -(-end // PART)), "part")
            .mapInArrow(_read_texts(tables, (start.a, start.b, start.refine)), "chunk long, bucket int, counts binary"))
    moves = np.array([m or 0 for m in sums[2:]], float)
    return (chunks.groupBy("chunk").cogroup(replies.unionByName(read).groupBy("chunk"))
            .applyInPandas(_documents(int(sums[0]), int(sums[1]), moves), _RESULT))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
