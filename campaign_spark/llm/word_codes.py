"""Token ids of words, many times faster than one tokenizer call a word, and the same.

For a byte-level BPE vocabulary whose words end in a suffix, lower-cased and cut
by a known pattern, a word's pieces are coded by tiktoken's merge loop. There a
byte that no UTF-8 text holds stands for the suffix, and joining it to the last
byte comes before all merges. That loop joins neighbours whose bytes make a
token, the tokenizer those whose pair is in its list; a span that evolves into
a token does so alike wherever it stands, so the two agree on every token that
the tokenizer gives for the token's own text. Tokens for which it does not are
found once (``unreachable``) and left out of the loop.

Only words of code points below U+0250 go this way, where composing is the
identity and the classes of the pattern are the same everywhere; all other words,
and vocabularies of any other make, are coded by the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from functools import cache

import regex

# Fixed values of the vocabulary file that the short way is made for.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_LAST = "ɏ"
_END = b"\xff"
_MARKS = ",.!?;:"  # one of them after letters is a piece of its own in any case


@cache
def _byte_of() -> dict[str, int]:
    """The byte that each letter of the byte-level alphabet stands for: printable bytes for themselves, the
    others, in order, for the letters from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _fits(spec: dict) -> bool:
    before = spec.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers") or [{}]
    model = spec.get("model", {})
    return (model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("ignore_merges")
            and not model.get("dropout") and (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
            and [s.get("type") for s in steps] == ["Split", "ByteLevel"] and steps[0]["pattern"] == {"Regex": _PATTERN}
            and steps[0]["invert"] and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and all(a.get("special") for a in spec.get("added_tokens", [])))


def _as_bytes(token: str) -> bytes:
    letters = _byte_of()
    ends = token.endswith("</w>")
    return bytes(letters[c] for c in (token[:-4] if ends else token)) + (_END if ends else b"")


class Words:
    """word (UTF-8 bytes without white space) -> its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str, left_out: frozenset[bytes] = frozenset()) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.short = _fits(spec)
        self._pieces: dict[str, bytes] = {}
        added = [a["content"] for a in spec.get("added_tokens", [])]
        # Words that may hold a special token are left to the tokenizer; without any, none does.
        self._special = os.path.commonprefix(added).encode() if added else _END
        if not self.short:
            return
        import tiktoken

        # Ids serve as ranks: they rise with the merges, and those of a last byte come before them.
        known = {_as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        made = list(dict.fromkeys(_as_bytes("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in spec["model"]["merges"]))
        singles = [bytes([b]) for b in range(256)] + [bytes([b]) + _END for b in range(256)]
        rise = [known.get(t, -1) for t in made]
        self.short = all(t in known for t in singles) and rise == sorted(set(rise)) and max(known[t] for t in singles) < rise[0]
        if not self.short:
            return
        ranks = {t: i for t, i in known.items() if t not in left_out}
        self._code = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece
        self._cut = regex.compile(_PATTERN.replace(r"\s", r"\t-\r\x20\x85\xa0"), regex.V0)

    def piece(self, text: str) -> bytes:
        return array("I", self._code(text.encode() + _END)).tobytes()

    def codes(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each word, for any words."""
        out, slow, pieces, short, special = {}, [], self._pieces, self.short, self._special
        for word in words:
            text = word.decode("utf-8", "replace")
            if not short or special in word or not (word.isascii() or max(text) <= _LAST):
                slow.append((word, text))
                continue
            text = text.lower()
            if text.isalpha():
                found = (text,)
            elif text[:-1].isalpha() and text[-1] in _MARKS:
                found = (text[:-1], text[-1])
            else:
                found = self._cut.findall(text)
            code = b""
            for p in found:
                known = pieces.get(p)
                if known is None:
                    known = pieces[p] = self.piece(p)
                code += known
            out[word] = code
        if len(pieces) > 300_000:  # bounded memory; no effect on results
            pieces.clear()
        for k in range(0, len(slow), 20_000):
            part = slow[k:k + 20_000]
            coded = self.tokenizer.encode_batch_fast([t for _, t in part], add_special_tokens=False)
            out.update((w, array("I", c.ids).tobytes()) for (w, _), c in zip(part, coded))
        return out


@cache
def unreachable(path: str) -> frozenset[bytes]:
    """Tokens that the tokenizer's own merges do not make from the token's bytes alone.

    The merges of a token's bytes are replayed by pairs, in the order of the
    file; each token's last pair must be the one that the file's first merge to
    that token names.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not _fits(spec):
        return frozenset()
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    rank: dict[tuple[str, str], int] = {}
    for k, m in enumerate(merges):
        rank.setdefault(m, k)
    out = set()
    for k, (a, b) in enumerate(merges):
        token = a + b
        ends = token.endswith("</w>")
        parts = list(token[:-4] if ends else token)
        if ends:
            parts[-1] += "</w>"
        pair = None
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: rank.get(p, len(merges)))
            if best not in rank:
                break
            pair, i, joined = best, 0, []
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    joined.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            parts = joined
        if len(parts) > 1 or rank[pair] != k:
            out.add(_as_bytes(token))
    return frozenset(out)
