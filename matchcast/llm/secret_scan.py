"""Secret scan by corpus-wide ownership frequency, in DataFrame operations only.

Candidate spans are found by pattern; the hash of each value is counted over the distinct repositories and owners in which it
occurs anywhere. A value of many owners is a copied example; one of few is taken for a live credential. Spans of the base kinds
always stay. The method adds spans of kind ``live``: tokens of mixed characters outside base spans, whose value has few owners.

Repository and owner are columns of the caller's. A table with one column for both, like the query's, counts the same places twice; the
limit is then on that column alone.

Counts are pre-aggregated by (value, repository, owner) before any exchange by value, so a value that stands in a third of all rows
is a few rows by then; the join back is an ordinary equi-join, which Spark can split where it is skewed.

Defined cases: null text is empty; a null repository or owner counts as none of its own (a value seen in such rows only is live);
repeated rows each keep their result; texts of any length are scanned whole; offsets are code points, end exclusive; other columns
are ignored, and may be named as ours are; an empty table gives an empty table of the same schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matchcast.shared import BROADCAST_BYTES, cut

#: The base kinds and patterns, the least length of the value, and where the value stands.
BASE = (
    ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    ("access", r"(AKIA[A-Z0-9]+)", 20, 1),
    ("hex", r"([0-9a-f]+)", 24, 1),
)
#: Added by the method: long runs of letters and digits that hold an upper-case and a lower-case letter and a digit.
LIVE = ("live", r"((?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,})", 20, 1)
#: A value in more distinct repositories or owners than this is a copied example.
MOST_REPOSITORIES, MOST_OWNERS = 2, 2
KINDS = ("assign", "access", "hex", "live")
#: In the order of sorting: by start, then kind as listed.
FOUND = "array<struct<start:int,rank:int,end:int,value:string>>"
#: Cheap tests that hold wherever a base pattern has a match of full length.
GATES = (BASE[0][1], "AKIA[A-Z0-9]{16}", "[0-9a-f]{24}")


def spans(text: Column, kind: str, pattern: str, least: int, group: int) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, rank, value), those with short values dropped.

    Splitting by the pattern gives the text between the matches, and so, with the matches' own lengths, every offset."""
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), F.transform(whole, F.length).alias("size"), value.alias("value"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(FOUND).alias("found"))
    folded = F.aggregate(
        pieces,
        start,
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + F.coalesce(x["size"], F.lit(0))).alias("at"),
            F.when(
                F.length(x["value"]) >= least,
                F.concat(a["found"], F.array(F.struct((a["at"] + x["gap"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (a["at"] + x["gap"] + x["size"]).alias("end"), x["value"].alias("value")))),
            ).otherwise(a["found"]).alias("found"),
        ),
    )
    return folded["found"]


def named(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, KINDS)), rank + 1)


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", named(x["rank"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", repository: str = "source", owner: str = "source", key: str = "doc_id", keep: tuple[str, ...] = (), once: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, those that are copied examples, and ``found``.

    ``keep`` names columns that go along, which then come first. ``once`` names those of them that tell texts apart: copies of a text
    then count as one row, of the least repository and owner."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = F.flatten(F.array(*(F.when(F.rlike(body, F.lit(gate)), spans(body, *rule)).otherwise(F.array().cast(FOUND)) for rule, gate in zip(BASE, GATES, strict=True))))
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    rows = docs.select(*kept, F.col(key).cast("bigint").alias("doc_id"), F.col(repository).cast("string").alias("_repository"), F.col(owner).cast("string").alias("_owner"), base.alias("_base"), F.when(F.rlike(body, F.lit(LIVE[1])), spans(body, *LIVE)).alias("_live"))
    free = F.filter("_live", lambda x: F.rlike(x["value"], F.lit("[a-z]")) & F.rlike(x["value"], F.lit("[A-Z]")) & ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))
    rows = rows.withColumn("_live", F.coalesce(free, F.array().cast(FOUND)))
    found = F.transform(F.concat("_base", "_live"), lambda x: F.struct(x["start"], x["rank"], x["end"], F.sha2(x["value"], 256).alias("hash")))
    rows = cut(rows.select(*(c for c in rows.columns if c[0] == "_" and c.startswith("_keep_")), "doc_id", "_repository", "_owner", found.alias("_found")).withColumn("_row", F.monotonically_increasing_id()))

    texts = [f"_keep_{c}" for c in once]
    seen = rows.where(F.size("_found") > 0).select("_row", *texts, "_repository", "_owner", F.explode(F.array_distinct(F.transform("_found", lambda x: x["hash"]))).alias("_hash"))
    counted = seen.groupBy("_hash", *texts).agg(F.min("_repository").alias("_repository"), F.min("_owner").alias("_owner")) if once else seen
    places = counted.groupBy("_hash", "_repository", "_owner").agg(F.count("*").alias("_n"))
    copied = places.groupBy("_hash").agg(F.countDistinct("_repository").alias("_repositories"), F.countDistinct("_owner").alias("_owners"))
    copied = copied.where((F.col("_repositories") > MOST_REPOSITORIES) | (F.col("_owners") > MOST_OWNERS))
    examples = seen.join(copied, "_hash").groupBy("_row").agg(F.collect_set("_hash").alias("_copied"))

    none = F.array().cast("array<string>")
    out = rows.join(examples, "_row", "left").withColumn("_copied", F.coalesce("_copied", none))
    count = lambda k: F.size(F.filter("_found", lambda x: x["rank"] == k)).cast("bigint")
    base_spans = F.array_sort(F.filter("_found", lambda x: x["rank"] < 3))
    all_spans = F.array_sort(F.filter("_found", lambda x: (x["rank"] < 3) | ~F.array_contains(F.col("_copied"), x["hash"])))
    is_copied = F.size(F.filter("_found", lambda x: F.array_contains(F.col("_copied"), x["hash"]))).cast("bigint")
    return out.select(
        *(F.col(f"_keep_{c}").alias(c) for c in keep),
        *(() if key in keep else ("doc_id",)),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base_spans), 256).alias("base_sha256"),
        joined(all_spans).alias("spans"),
        (F.size(all_spans) - F.size(base_spans)).cast("bigint").alias("n_live"),
        is_copied.alias("n_copied"),
        F.transform(all_spans, lambda x: F.struct(x["start"], x["end"], named(x["rank"]).alias("kind"), F.array_contains(F.col("_copied"), x["hash"]).alias("copied"))).alias("found"),
    )


def redact(docs: DataFrame, text: str = "text", repository: str = "source", owner: str = "source", copied_base: bool = True) -> DataFrame:
    """The documents with every base span, and every span of kind ``live``, replaced by its kind in brackets; all columns stay, whatever
    their names.

    Base spans go even if their value is copied, as a real secret may stand in texts of many owners; without ``copied_base`` those that
    are copied examples stay. Owners count over distinct texts, so copies of a text do not make its values examples.

    Spans depend on the text alone, so they are joined back by 128 bits of its hash, once per distinct text that has any."""
    own = lambda c: F.col(f"`{c.replace('`', '``')}`")
    body = F.coalesce(own(text).cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*map(own, docs.columns)).alias("document"), own(text).cast("string").alias("text"), own(repository).cast("string").alias("repository"), own(owner).cast("string").alias("owner"), F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(7), body).alias("h2"))
    found = scan(keyed, "text", "repository", "owner", key="h1", keep=("h1", "h2"), once=("h1", "h2"))
    stays = lambda x: x["copied"] if not copied_base else x["copied"] & (x["kind"] == "live")
    spans_ = found.select("h1", "h2", F.filter("found", lambda x: ~stays(x)).alias("found")).where(F.size("found") > 0)
    spans_ = cut(spans_.groupBy("h1", "h2").agg(F.first("found").alias("found")))
    size = spans_.agg(F.sum(64 + 64 * F.size("found"))).first()[0] or 0
    left = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("text")),
        lambda a, x: F.when(
            x["start"] >= a["at"],
            F.struct(x["end"].alias("at"), F.concat(a["text"], F.substring(F.col("text"), a["at"] + 1, x["start"] - a["at"]), F.lit("["), x["kind"], F.lit("]")).alias("text")),
        ).otherwise(F.struct(F.greatest(a["at"], x["end"]).alias("at"), a["text"].alias("text"))),
        lambda a: F.concat(a["text"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))),
    )
    joined_ = keyed.join(F.broadcast(spans_) if size <= BROADCAST_BYTES else spans_, ["h1", "h2"], "left")
    kept = lambda c: F.col("document").getField(c)
    return joined_.select(*(F.when(F.col("found").isNotNull(), left).otherwise(kept(c)).alias(c) if c == text else kept(c).alias(c) for c in docs.columns))


def _sql_kind(rank: int, pattern: str, group: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"SELECT r, source, {rank} AS rank, string_split_regex(t, '{quoted}') AS pieces, regexp_extract_all(t, '{quoted}', 0) AS whole, regexp_extract_all(t, '{quoted}', {group}) AS val FROM d"


#: The same in SQL. Its engine knows no looking around, so the added kind is every run of its characters, filtered afterwards.
SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
k AS ({" UNION ALL ".join([*(_sql_kind(i, p, g) for i, (_, p, _, g) in enumerate(BASE)), _sql_kind(3, "[A-Za-z0-9+/_=-]+", 0)])}),
i AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM k),
s AS (
  SELECT r, source, rank, CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(whole[i]) AS n, val[i] AS v FROM i
  WHERE length(val[i]) >= CASE rank {" ".join(f"WHEN {i} THEN {least}" for i, (_, _, least, _) in enumerate((*BASE, LIVE)))} END
),
f AS (
  SELECT * FROM s WHERE rank < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')
    AND NOT EXISTS (SELECT 1 FROM s b WHERE b.r = s.r AND b.rank < 3 AND b.a < s.a + s.n AND b.a + b.n > s.a))
),
c AS (SELECT v, count(DISTINCT source) > {MOST_REPOSITORIES} AS copied FROM f GROUP BY v),
g AS (SELECT r, rank, a, copied, concat({list(KINDS)}[rank + 1], ':', a, ':', a + n) AS span FROM f JOIN c USING (v)),
j AS (
  SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex, string_agg(span, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
    string_agg(span, ',' ORDER BY a, rank) FILTER (rank < 3 OR NOT copied) AS spans, count(*) FILTER (rank = 3 AND NOT copied) AS n_live, count(*) FILTER (copied) AS n_copied
  FROM g GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN j USING (r)
"""
