import tiktoken

from ledgerproof.llm import tokencounts


def lengths_by_hand(rows):
    encoding = tiktoken.Encoding(
        "t", pat_str=tokencounts.PATTERN, mergeable_ranks=tokencounts.read_ranks(tokencounts.VOCABULARY), special_tokens={}
    )
    return [len(encoding.encode_ordinary(r[1] or "")) for r in rows]


def test_histogram_by_brute_force(nasty, rows):
    n = lengths_by_hand(rows)
    counted = tokencounts.lengths(nasty)
    assert sorted(r.n_tokens for r in counted.collect()) == sorted(n)
    table = tokencounts.histogram(counted)
    got = {r.n_tokens: r for r in table.collect()}
    assert set(got) == set(n) and max(n) > tokencounts.RUN
    for limit, r in got.items():
        assert r.docs == n.count(limit) and r.tokens == limit * r.docs
        assert r.docs_at_least == sum(x >= limit for x in n)
        assert r.tokens_at_least == sum(x for x in n if x >= limit)
        assert r.truncated_total == sum(min(x, limit) for x in n)
        assert abs(r.share - sum(x <= limit for x in n) / len(n)) < 1e-12
    for r in tokencounts.truncated_totals(table, [0, 3, 100, 10**9]).collect():
        assert r.tokens_left == sum(min(x, r.limit) for x in n)
        assert r.docs_longer == sum(x > r.limit for x in n)
    for r in tokencounts.quantiles(table, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == min(x for x in n if sum(y <= x for y in n) / len(n) >= r.q)


def test_empty(empty):
    table = tokencounts.histogram(tokencounts.lengths(empty))
    assert table.count() == 0
    assert [tuple(r) for r in tokencounts.truncated_totals(table, [8]).collect()] == [(8, 0, 0)]
    assert tokencounts.quantiles(table, [0.5]).count() == 0


def test_very_long_runs(spark):
    """Runs beyond what the pattern can take: equal to the parts that the pattern cuts them into."""
    long = tokencounts.LONG_RUN
    encoding = tiktoken.Encoding(
        "t", pat_str=tokencounts.PATTERN, mergeable_ranks=tokencounts.read_ranks(tokencounts.VOCABULARY), special_tokens={}
    )
    tails = ["", "x", "\n", "!", " x", "\n\nx", "\u3000", "\u3000y"]
    texts = [f"a{blank * n}{tail}" for blank in (" ", "\n", " \t", "\u2003") for n in (long - 1, long, long + 1) for tail in tails]
    texts += [t + " b" * 3 + " " * (2 * long) + t for t in texts[:30]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokencounts.lengths(docs).collect()}
    assert got == {i: len(encoding.encode_ordinary(t)) for i, t in enumerate(texts)}
    size = 5_000_000
    big = [" " * size, "a" * size, "!?" * (size // 2), "a" + " " * size + "b", " \n" * (size // 2) + "c"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(big)], "doc_id long, text string")
    found = {r.doc_id: r.n_tokens for r in tokencounts.lengths(docs).collect()}
    one = lambda s: len(encoding._encode_single_piece(s))
    assert found[0] == one(big[0]) and found[1] == one(big[1]) and found[2] == one(big[2])
    assert found[3] == 1 + one(" " * (size - 1)) + len(encoding.encode_ordinary(" b"))
    assert found[4] == one(" \n" * (size // 2 - 1) + " ") + len(encoding.encode_ordinary("\nc"))


def test_no_text_is_encoded_twice(nasty):
    plan = tokencounts.histogram(tokencounts.lengths(nasty))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
