import hashlib
import string
from collections import defaultdict

import pytest

from ledgerproof.llm import radix

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.mark.parametrize("first", [1, 3, 64])
def test_copies_by_brute_force(nasty, rows, first):
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(LOWER)].append(row[0])
    wanted = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        wanted += [(i, keep, len(ids), i == keep, digest) for i in ids]
    got = [tuple(r) for r in radix.copies(nasty, first_digit=first).drop("row").collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(wanted, key=key)


def test_one_row_of_each_group_stays(nasty, rows):
    kept = radix.without_copies(nasty)
    assert kept.columns == nasty.columns
    texts = [(r.text or "").translate(LOWER) for r in kept.collect()]
    assert sorted(texts) == sorted({(r[1] or "").translate(LOWER) for r in rows})


def test_empty(empty):
    assert radix.copies(empty).count() == 0
    assert radix.without_copies(empty).columns == empty.columns
