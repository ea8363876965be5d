import re
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerproof.llm import divergence
from ledgerproof.llm.queries import ORACLES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DIGESTS = {
    "own": F.xxhash64,
    "few": lambda t: F.pmod(F.xxhash64(t), F.lit(23)).cast("long"),
    "one": lambda t: F.lit(0).cast("long"),
}


def audit_by_hand(rows, least, top):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for text, lang, source in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        count[lang, source].update(terms)
    kept = {lang: [t for t, n in c.items() if n >= least] for lang, c in seen.items()}
    shares = {}
    for lang, source in {d[:2] for d in docs}:
        n = count[lang, source]
        whole = sum(n[t] for t in kept[lang]) + len(kept[lang])
        shares[lang, source] = {t: 1 + 10**9 * (n[t] + 1) // whole for t in kept[lang]}
    of_lang = {}
    for lang in kept:
        n = sum((c for (own, _), c in count.items() if own == lang), Counter())
        whole = sum(n[t] for t in kept[lang]) + len(kept[lang])
        of_lang[lang] = {t: 1 + 10**9 * (n[t] + 1) // whole for t in kept[lang]}
    out = []
    f = lambda p, q: (p - q) ** 2 // q
    for (lang, source), p in shares.items():
        pairs = [(o, sum(f(p[t], q[t]) for t in kept[lang])) for (own, o), q in shares.items() if own == lang and o != source]
        q = of_lang[lang]
        terms = [(t, f(p[t], q[t])) for t in kept[lang] if count[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, *x, i + 1) for i, x in enumerate(found[:most])]
    return out


@pytest.fixture(scope="module")
def plain(rows):
    """Text, language and source; both ends of the names' order and terms of every kind."""
    more = [("Straße straße STRASSE ǅ don't x_y 日本 日本語", "de", s) for s in ("a", "B", "é", "", None)]
    return [(r[1], r[2], r[3]) for r in rows] + more + [("nothing kept here", "xx", "a"), (None, "xx", "b")]


@pytest.mark.parametrize("digest", DIGESTS)
@pytest.mark.parametrize("least,top", [(3, 200), (2, 5), (10**9, 5)])
def test_audit_by_brute_force(spark, plain, digest, least, top, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE", 3000)
    monkeypatch.setattr(divergence, "PAIRS", 50)
    docs = spark.createDataFrame(plain, "text string, lang string, source string").repartition(3)
    got = divergence.audit(docs, least=least, top=top, digest=DIGESTS[digest])
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(audit_by_hand(plain, least, top))


def test_clashing_columns_and_sql(nasty, rows):
    got = sorted(map(tuple, divergence.audit(nasty).collect()))
    con = duckdb.connect()
    names = ["doc_id", "text", "lang", "source"]
    con.register("documents", pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)}))
    wanted = con.execute(ORACLES["op12_source_divergence"]).fetchall()
    assert got == sorted(wanted)


def test_terms_of_a_column():
    texts = ["Ab c", "", "d", "e", "é-É x9y", " ", "\x00[a]"]
    words, doc = divergence.terms(pa.array(["zz", *texts]).slice(1))
    assert list(zip(words.to_pylist(), doc.tolist(), strict=True)) == [
        (t.translate(LOWER), i) for i, text in enumerate(texts) for t in TERM.findall(text)
    ]


def test_empty(empty):
    assert divergence.audit(empty).count() == 0
