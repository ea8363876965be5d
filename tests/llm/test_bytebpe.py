import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerproof.llm import bytebpe

BITS = [" ", "  ", "\n", "a", "word", "'s", "é", " ", "　", " ", "1", "<|endoftext|>", "!", "\t", "日本", "\x85", "\x1c", "\x00", "😀", "'ll", " x"]


@pytest.fixture(scope="module")
def vocabulary():
    return bytebpe.read_vocabulary("/opt/tokenizers/byte_bpe_50k.json")


@pytest.mark.parametrize("plain", [True, False])
def test_ids_equal_the_library(vocabulary, rows, plain, monkeypatch):
    monkeypatch.setattr(bytebpe, "RUN", 5000)
    rng = random.Random(3)
    texts = ["".join(rng.choices(BITS, k=rng.randint(0, 14))) for _ in range(4000)]
    texts += [r[1] or "" for r in rows] + [" " * 100_000, "a" * 30_000, " a" * 9000 + "  "]
    encoder = bytebpe.ByteEncoder(vocabulary, plain)
    ids, ends = encoder.encode(pa.array(texts).slice(7))
    whole = encoder.library.encode_batch_fast(texts[7:], add_special_tokens=False)
    for i, wanted in enumerate(whole):
        assert ids[ends[i] : ends[i + 1]].tolist() == wanted.ids, texts[7 + i][:80]
    assert b"".join(encoder.token_bytes[i] for i in ids[: ends[50]]).decode() == "".join(texts[7:57])


def test_nothing(vocabulary):
    encoder = bytebpe.ByteEncoder(vocabulary, True)
    for texts in ([], ["", ""]):
        ids, ends = encoder.encode(pa.array(texts, pa.string()))
        assert len(ids) == 0 and np.array_equal(ends, np.zeros(len(texts) + 1))


def test_no_chunk_begins_with_a_space(vocabulary):
    encoder = bytebpe.ByteEncoder(vocabulary, True)
    ids, ends = encoder.encode(pa.array(["ab", " ", "c"]))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [encoder.one(t).tolist() for t in ("ab", " ", "c")]
