"""One query per operator over the whole of its table, and the plain SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerproof.llm import (
    alignment,
    dartminhash,
    divergence,
    hyperlang,
    mixing,
    neighbours,
    packing,
    pieces,
    radix,
    secrets,
    tokencounts,
    toxicity,
    urlmodel,
)
from ledgerproof.llm.common import mod_hash, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("row")


@query
def op6_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix.copies(table(spark, sf_dir, "documents")).drop("row")


ORACLES["op6_radix_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""


@query
def op8_markov_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlmodel.judge(table(spark, sf_dir, "pages"))


@query
def op9_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = hyperlang.learn(docs, mod_hash("doc_id", 3) != 1)
    found = hyperlang.identify(docs, profiles)
    return found.select("doc_id", (mod_hash("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op10_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grammar = toxicity.learn(docs, labels.where(mod_hash("doc_id", 5) != 0))
    return toxicity.judge(docs, grammar).select(
        "doc_id",
        (mod_hash("doc_id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "counts",
    )


@query
def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    repository = F.concat_ws("/", "source", "lang")
    return secrets.report(secrets.scan(docs, F.col("source"), repository))


def _secret_sql() -> str:
    parts = []
    for i, (kind, pattern, group, least) in enumerate(secrets.KINDS):
        regex = "'" + pattern.replace("'", "''") + "'"
        parts.append(f"""
        SELECT rn, {i} AS kind, '{kind}' AS kind_name, gap_n + whole_n AS step, whole_n, v, owner, repo,
               sum(gap_n + whole_n) OVER (PARTITION BY rn ORDER BY place) AS stop
        FROM (SELECT rn, owner, repo, place, length(gaps[place]) AS gap_n, length(wholes[place]) AS whole_n,
                     vals[place] AS v
              FROM (SELECT *, unnest(range(1, len(wholes) + 1)) AS place
                    FROM (SELECT rn, owner, repo, regexp_extract_all(t, {regex}) AS wholes,
                                 regexp_extract_all(t, {regex}, {group}) AS vals,
                                 string_split_regex(t, {regex}) AS gaps FROM d)))
        QUALIFY length(v) >= {least}""")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t, source AS owner,
                      concat_ws('/', source, lang) AS repo FROM documents),
    found AS ({" UNION ALL ".join(parts)}),
    spread AS (SELECT v AS sv, count(DISTINCT coalesce('+' || owner, '-')) AS owners FROM found GROUP BY v),
    marked AS (SELECT *, owners <= {secrets.MAX_OWNERS}
                         AND len(list_distinct(string_split(v, ''))) >= {secrets.MIN_CHARACTERS} AS live
               FROM found JOIN spread ON v = sv),
    told AS (SELECT *, kind_name || ':' || (stop - whole_n)::BIGINT || ':' || stop::BIGINT AS span
             FROM marked WHERE kind < {len(secrets.BASE)} OR live),
    rows AS (SELECT rn, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
                    count(*) FILTER (kind = 2) AS n_hex,
                    string_agg(span, ',' ORDER BY stop - whole_n, kind) FILTER (kind < {len(secrets.BASE)}) AS base,
                    string_agg(span, ',' ORDER BY stop - whole_n, kind) AS spans,
                    count(*) FILTER (live) AS n_live,
                    count(*) FILTER (owners > {secrets.MAX_OWNERS}) AS n_shared FROM told GROUP BY rn)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared
    FROM d LEFT JOIN rows USING (rn)"""


ORACLES["op4_secret_ownership"] = _secret_sql()


@query
def op7_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.histogram(tokencounts.lengths(table(spark, sf_dir, "documents")))


@query
def op2_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.read_pieces())


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


ORACLES["op12_source_divergence"] = """
WITH d AS (SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                               'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
w AS (SELECT rn, lang, source, unnest(terms) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rn) >= 3),
l AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
             1 + (1000000000 * (k.n + 1)) // (l.total + l.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN l ON g.lang = l.lang
      LEFT JOIN t ON g.lang = t.lang AND g.source = t.source
      LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
         GROUP BY a.lang, a.source, b.source),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query
def op13_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))
