import base64
import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import sentencepiece
import tokenizers

from ledgerproof.llm import alignment

TOKENS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def tokens_by_hand(text, a, b, bytes_a):
    """(id, start, end) of both sides, or nothing if one of them does not spell the text."""
    if not text:
        return [], []
    spaced, sides = (" " + text).encode(), []
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, bytes_a.get), (b.encode(text), of_b)):
        at, tokens = 0, []
        for i in ids:
            tokens.append((i, at, at + len(spell(i))))
            at = tokens[-1][2]
        if b"".join(spell(i) for i in ids) != spaced:
            return [], []
        sides.append(tokens)
    return sides


def align_by_hand(rows):
    a = tokenizers.Tokenizer.from_file(alignment.VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL)
    bytes_a = {int(n): base64.b64decode(t) for t, n in map(bytes.split, open(TOKENS, "rb"))}
    links, found = [], []
    for row in rows:
        of_a, of_b = tokens_by_hand(row[1], a, b, bytes_a)
        ends = sorted({e for *_, e in of_a} & {e for *_, e in of_b})
        groups, start = [], 0
        met = []
        for end in ends:
            inner = [[t for t in side if start <= t[1] < end] for side in (of_a, of_b)]
            met += [(x[0], y[0]) for x in inner[0] for y in inner[1] if x[1] < y[2] and y[1] < x[2]]
            groups.append("|".join(",".join(str(t[0]) for t in side) for side in inner))
            start = end
        links.append(met)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        found.append((row[0], len(of_a), len(of_b), len(groups), len(met), digest))
    count = Counter(pair for met in links for pair in met)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return [
        (*f[:5], sum(count[p] == most[p[1]] for p in met), sum(count[p] for p in met), f[5])
        for f, met in zip(found, links, strict=True)
    ]


@pytest.mark.parametrize("block,slice_", [(1 << 23, 1 << 20), (2000, 700)])
def test_alignment_by_brute_force(nasty, rows, monkeypatch, block, slice_):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "SLICE", slice_)
    got = alignment.align(nasty)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    wanted = align_by_hand(rows)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))
    assert any(w[2] == 0 and r[1] for w, r in zip(wanted, rows, strict=True))  # the literal mark
    assert max(w[4] for w in wanted) > 10_000


def test_special_strings_are_text(spark):
    rows = [(1, "<|endoftext|> <s> </s> <unk> <0x41>"), (2, " "), (3, "\n\n  x"), (None, "a")]
    got = alignment.align(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, align_by_hand(rows)))


def test_empty(empty):
    assert alignment.align(empty).count() == 0


PARTS = ["a", "zz", "the ", " ", "  ", "\t", "\n", "▁", " ▁", "é", "日本", "😀", "<s>", "<0x41>", "\x00", "\r\n", "　"]


def aligner():
    with open(alignment.MODEL, "rb") as file:
        return alignment.Aligner(alignment.read_vocabulary(alignment.VOCABULARY), file.read(), True)


def test_chunks_give_the_ids_of_whole_texts():
    rng, made = random.Random(3), aligner()
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(400)] + [" ", "   ", "a  ", " " * 900]
    plain = pa.array([t for t in texts if t and "▁" not in t])
    data, bounds = alignment.column_bytes(alignment.pc.binary_join_element_wise(" ", plain, ""))
    for memory, side, starts in (
        (made.memory_a, lambda t: made.a.one(" " + t).tolist(), alignment.chunk_starts),
        (made.memory_b, made.b.library.encode, alignment.word_starts),
    ):
        ids, at = alignment._joined(memory, data, bounds, starts(data, bounds))
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == list(map(side, plain.to_pylist()))


def test_a_task_encodes_equal_chunks_once(monkeypatch):
    made, met = aligner(), []
    for memory in (made.memory_a, made.memory_b):
        monkeypatch.setattr(memory, "encode", lambda w, f=memory.encode: met.extend(w.to_pylist()) or f(w))
    for _ in range(3):
        figures, *_ = made.align(pa.array([("one two three " * 40).strip()] * 5))
    assert sorted(met) == sorted([b" one", b" two", b" three"] * 2)
    assert (figures["n_groups"] == figures["n_groups"][0]).all() and figures["n_groups"][0] >= 120
    before = made.align(pa.array(["one four"]))
    monkeypatch.setattr("ledgerproof.llm.bytebpe.REMEMBERED", 0)
    after = made.align(pa.array(["one four"]))
    assert before[1] == after[1] and len(made.memory_a.known) == 2


def test_a_model_with_pieces_over_words_encodes_whole_texts():
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(alignment.MODEL, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    assert alignment.separable(model.SerializeToString())
    model.pieces[-1].piece = "of▁the"
    assert not alignment.separable(model.SerializeToString())
