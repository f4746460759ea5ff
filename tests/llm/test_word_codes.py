"""The short way to a word's ids against the tokenizer itself."""

import random
from array import array

import pytest

from campaign_spark.llm.packing import public_tokenizer
from campaign_spark.llm.word_codes import Words, unreachable


@pytest.fixture(scope="module")
def coder():
    return Words(public_tokenizer(), unreachable(public_tokenizer()))


def same(coder, texts):
    words = [x.encode() for x in set(texts) if x and not set(x) & set(" \t\n\r\x0b\x0c")]
    want = coder.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
    got = coder.codes(words)
    return [w for w, c in zip(words, want) if got[w] != array("I", c.ids).tobytes()]


def test_every_code_point_of_the_short_way(coder):
    assert coder.short
    points = [chr(c) for c in range(1, 0x260)]
    assert same(coder, points + [f"a{c}b{c}" for c in points] + [f"{c}.{c}," for c in points] + [f"I{c}'s" for c in points]) == []


def test_random_words(coder):
    rng = random.Random(3)
    some = "abcdeilnorstu'ABS9,.!-éüß☃日́̈TWJ<|>ÿ\x85\xa0"
    words = ["".join(rng.choice(some) for _ in range(rng.randrange(1, 20))) for _ in range(40_000)]
    words += ["<|startoftext|>", "x<|endoftext|>y", "ΑΣ", "İstanbul", "don't", "we'll,", "THE!!", "a" * 5_000, "ﬁ", "T̈"]
    assert same(coder, words) == []


def test_every_token_of_the_vocabulary(coder):
    tokens = [t.replace("</w>", "") for t in coder.tokenizer.get_vocab()]
    assert same(coder, tokens) == []
    assert unreachable(public_tokenizer()) == frozenset()


def test_a_token_that_its_merges_do_not_make_is_found(tmp_path):
    import json

    with open(public_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    # "a b" comes before "b c", so the text abc never reaches the pair (a, bc).
    spec["model"]["merges"] = [["a", "b"], ["b", "c"], ["a", "bc"]]
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    assert unreachable(str(path)) == frozenset({b"abc"})
