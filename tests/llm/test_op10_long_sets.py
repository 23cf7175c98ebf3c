from pyspark.sql import functions as F

from matchcast.llm import sigtree_join


def test_sets_of_many_first_tokens_are_counted_where_they_are(spark, monkeypatch):
    """No join by set, whose rows would depend on whether some set has more than 1024 first tokens; links are all there."""
    seen = []

    def join(rows, groups, keys, by, **options):
        seen.append(keys)
        return split_join(rows, groups, keys, by, **options)

    split_join = sigtree_join.split_join
    monkeypatch.setattr(sigtree_join, "split_join", join)
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(12_000)), lambda i: F.concat(F.lit("w"), (i + 100_000 * (F.col("id") % 4)).cast("string"))))
    docs = spark.range(12).select(F.col("id").alias("doc_id"), F.concat(words, F.lit(" x"), F.col("id").cast("string")).alias("text"))
    got = {r.doc_id: (r.component_id, r.n_links) for r in sigtree_join.join(docs).collect()}
    assert got == {i: (i % 4, 2) for i in range(12)}
    assert seen and ["nid"] not in seen
