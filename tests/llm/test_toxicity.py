import itertools

from pyspark.sql import functions as F

from ledgerproof.llm import toxicity as tox
from ledgerproof.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
NONE = (0,) * len(tox.KINDS)


def kinds(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = tox.judge(docs, tox.fixed_grammar(spark)).orderBy("doc_id").collect()
    return [{tox.KINDS[i]: c for i, c in enumerate(r.counts) if c} for r in rows], [r.score for r in rows]


def test_clauses(spark):
    found, score = kinds(
        spark,
        [
            "What a moron.",
            "You are a moron!",
            "You are not a moron.",
            "He said you are a moron; fine.",
            "I will kill you. Kill it",
            "Not now. Moron. moron\nmoron",
            "A MORON, they wrote",
            "never mind the very old moron",
            "nothing to see",
            "",
            None,
        ],
    )
    assert found == [
        {"insult": 1},
        {"aimed insult": 1},
        {"negated": 1},
        {"reported": 1},
        {"aimed threat": 1, "threat": 1},
        {"insult": 2},
        {"aimed insult": 1},
        {"insult": 1},
        {},
        {},
        {},
    ]
    assert score[8] == score[9] == score[10] < 0.5
    assert score[2] < 0.5 < score[0] < score[1] < score[4]


def clause_by_hand(symbols):
    """The kind of a clause from its whole symbol string, by the rules as stated."""
    marks = [s for s in symbols if s in (tox.INSULT, tox.THREAT)]
    if not marks:
        return None
    out = []
    for i, s in enumerate(symbols):
        if s in (tox.INSULT, tox.THREAT):
            if tox.NEGATION in symbols[max(0, i - tox.NEGATION_REACH) : i]:
                out.append(5)
            elif tox.REPORT in symbols[:i]:
                out.append(4)
            else:
                out.append({tox.THREAT: 0, tox.INSULT: 2}[s] + (tox.TARGET not in symbols))
    return min(out)


def test_transducers_by_brute_force():
    for symbols in itertools.product(range(6), repeat=5):
        seen = [(i, s) for i, s in enumerate(symbols) if s]
        assert tox.clause_kind(seen) == clause_by_hand(symbols)


def test_held_out_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op10_toxic_grammar"](spark, SF).where("held_out").join(labels, "doc_id")
    hits = got.where("predicted = 1 AND toxic = 1").count()
    assert hits >= 0.8 * got.where("toxic = 1").count()
    assert hits >= 0.95 * got.where("predicted = 1").count()


def test_defined_cases(spark, nasty, empty, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    few = spark.createDataFrame([(0, 1, 1), (7, 1, 0), (7, 0, 1), (14, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, few):
        grammar = tox.learn(nasty, labels)
        got = tox.judge(nasty, grammar)
        assert got.count() == len(rows)
        assert got.where("score < 0 OR score > 1 OR score IS NULL").isEmpty()
        assert tox.judge(empty, grammar).count() == 0
    assert tox.learn(empty, none).weights == tox.PRIOR


def test_learned_words_need_different_surroundings(spark):
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(40):
        rows.append((1, [words[i], "bad", words[i + 50], "copy", "copy2"]))  # bad: 40 surroundings
        rows += [(0, [words[i + 7], words[i + 90], words[i + 3]])] * 4
    rows = [(t, w if t == 0 else [*w[:3], "same", "copied", "same"]) for t, w in rows]
    sample = spark.createDataFrame(rows, "toxic int, words array<string>").select(
        "toxic", F.transform("words", lambda w: F.xxhash64(w)).alias("tokens")
    )
    bad = spark.range(1).select(F.xxhash64(F.lit("bad"))).first()[0]
    copied = spark.range(1).select(F.xxhash64(F.lit("copied"))).first()[0]
    learned = tox.learned_words(sample)
    assert bad in learned and copied not in learned
