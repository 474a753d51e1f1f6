import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from poolwright.llm import bpe
from tests.llm import hard

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(*bpe.load(PATH))


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(PATH)


def test_same_tokens_as_the_library(encoder, library):
    rng = random.Random(3)
    texts = ["", "  ", "a<|endoftext|>b <|startoftext|>", "ΑΣ ΣΑΣ İstanbul", "日本語 🙂🙂 we'll they've 'S 'd", "\x1c\x1d x\x85y 1234 ½² ᠎", "A" * 5000, "éa", "​ 　"]
    texts += ["".join(rng.choice("abcdefthinhe '1.,é") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 0x2FF), rng.randint(0x370, 0x3000), rng.randint(0x1F300, 0x1F6FF)])) for _ in range(30)) for _ in range(300)]
    for text, ref in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert encoder.ids(text) == ref.ids, text
        assert encoder.decode(ref.ids) == library.decode(ref.ids, skip_special_tokens=False)


def test_backtracking_is_the_merges(encoder):
    """Words of few letters against merging pair by pair."""
    rng = random.Random(4)
    merges = {(a, b): n for n, (a, b) in enumerate(bpe.load(PATH)[1])}
    for _ in range(500):
        word = "".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 25)))
        parts = [*word[:-1], word[-1] + bpe.END]
        while True:
            best = min(((merges[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in merges), default=None)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert encoder.decode(encoder.ids(word)).split(" ") == parts


def test_hard_rows(spark, library):
    got = bpe.round_trip(hard.table(spark), PATH).collect()
    wanted = []
    for r in hard.rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    full = bpe.encode(hard.table(spark), PATH).collect()
    assert [len(r.ids) // 4 for r in full] == [r.n_tokens for r in full]
    assert bpe.round_trip(hard.empty(spark), PATH).collect() == []
