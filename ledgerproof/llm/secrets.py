"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Every text is searched for candidate values of the ``KINDS``. The candidates' SHA-256
hashes are counted over the whole corpus by distinct owners and repositories. A value that
only one owner has, with enough different characters, looks live; one that several owners
have is a copied example. Candidates of the kinds in ``BASE`` are always reported; keys of
well-known shapes are added to the report only where they look live.

Matches and the texts between them give the positions: the lengths of both, summed up over
a document's matches, in code points. The text itself is read once and never shuffled.

Cases: a null text is empty and has no span; documents without span are returned too; a
null owner or repository counts as one of its own; repeated rows are documents of their
own but add no owner; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerproof.llm.common import settle

# Kind, pattern, group of the value, least length of the value. Order counts.
KINDS = (
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("key", r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-|eyJ)[A-Za-z0-9_.-]{16,}", 0, 19),
)
BASE = ("assign", "access", "hex")
FOUND = (
    "array<struct<kind:int,place:int,gap:int,length:int,valid:boolean,value_hash:string,characters:int>>"
)
MAX_OWNERS = 1
MIN_CHARACTERS = 6


def _found(text: Column, number: int) -> Column:
    """All matches of a kind: number, place in the row, gap before, length, value's hash."""
    _, pattern, group, least = KINDS[number]
    regex = F.lit(pattern)
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, regex, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("value"),
        F.split(text, pattern, -1).alias("gap"),
    )

    def one(m: Column, i: Column) -> Column:
        value = m["value"]
        return F.struct(
            F.lit(number).alias("kind"),
            i.alias("place"),
            F.length(m["gap"]).alias("gap"),
            F.length(m["whole"]).alias("length"),
            (F.length(value) >= least).alias("valid"),
            F.sha2(value, 256).alias("value_hash"),
            F.size(F.array_distinct(F.split(value, ""))).alias("characters"),
        )

    matched = F.filter(F.transform(zipped, one), lambda s: s["length"].isNotNull())
    return F.when(F.regexp_like(text, regex), matched).otherwise(F.array().cast(FOUND))


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per document: row, doc_id, found (kind, start, end, owners, repositories, live).

    Spans are in code points, end exclusive, by start and then kind.
    """
    text = F.coalesce("text", F.lit(""))
    rows = settle(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            owner.alias("owner"),
            repository.alias("repository"),
            F.concat(*(_found(text, i) for i in range(len(KINDS)))).alias("found"),
        ),
        "secret-candidates",
    )
    upto = Window.partitionBy("row", "kind").orderBy("place")
    spans = (
        rows.select("row", "owner", "repository", F.inline("found"))
        .withColumn("end", F.sum(F.col("gap") + F.col("length")).over(upto))
        .withColumn("start", F.col("end") - F.col("length"))
        .where("valid")
    )
    by_owner = spans.groupBy("value_hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_owner.groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    spread = by_owner.groupBy("value_hash").agg(
        F.count("*").alias("owners"), F.sum("n").alias("repositories")
    )
    live = (F.col("owners") <= MAX_OWNERS) & (F.col("characters") >= MIN_CHARACTERS)
    per_row = (
        spans.join(spread, "value_hash")
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("start", "kind", "end", "owners", "repositories", live.alias("live")))
            ).alias("spans")
        )
    )
    none = F.array().cast(per_row.schema["spans"].dataType)
    return rows.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", F.coalesce("spans", none).alias("found")
    )


def report(scanned: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, all spans, and live and shared counts."""
    names = F.array(*(F.lit(k[0]) for k in KINDS))
    is_base = lambda s: s["kind"] < len(BASE)
    base = F.filter("found", is_base)
    told = F.filter("found", lambda s: is_base(s) | s["live"])

    def text(spans: Column) -> Column:
        one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        return F.concat_ws(",", F.transform(spans, one))

    count = lambda spans: F.size(spans).cast("long")

    def of_kind(number: int) -> Column:
        return F.filter("found", lambda s: s["kind"] == number)

    return scanned.select(
        "doc_id",
        *(count(of_kind(i)).alias(f"n_{kind}") for i, kind in enumerate(BASE)),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(told).alias("spans"),
        count(F.filter(told, lambda s: s["live"])).alias("n_live"),
        count(F.filter(told, lambda s: s["owners"] > MAX_OWNERS)).alias("n_shared"),
    )
