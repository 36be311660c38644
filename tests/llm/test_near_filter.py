"""Texts of candidates are filtered where they are; rounds of components have few parts."""

import numpy as np

from segmint.llm import graph, neardup


def test_filter_passes_every_id_and_few_others(spark, monkeypatch):
    for most in (neardup.FILTER_BITS, 1 << 12):
        monkeypatch.setattr(neardup, "FILTER_BITS", most)
        words = neardup._id_filter(spark.range(-500, 1500).select("id"))
        hashed = np.array([r[0] for r in spark.range(-500, 20000).selectExpr("xxhash64(id)").collect()], np.int64)
        passed = neardup._passing(words, hashed)
        assert passed[:2000].all()
        if most > 1 << 12:
            assert passed[2000:].mean() < 0.01
    assert not neardup._passing(neardup._id_filter(spark.range(0)), hashed).any()


def test_texts_of_candidates_are_not_shuffled(spark):
    docs = spark.createDataFrame([(i, f"text number {i} of some words here") for i in range(50)] + [(None, "no id")], "id long, text string")
    sets = neardup._sets(docs, spark.range(3, 6).select("id"))
    assert "Exchange" not in sets._jdf.queryExecution().executedPlan().toString()
    want = {neardup.set_digest(neardup.grams(f"text number {i} of some words here")) for i in (3, 4, 5)}
    assert want <= {bytes(r.digest) for r in sets.collect()}


def test_rounds_have_few_parts_with_many_shuffle_partitions(spark, monkeypatch):
    parts, real = [], graph.stage

    def staged(df, name):
        out = real(df, name)
        parts.append(len([f for f in out.inputFiles()]))
        return out

    monkeypatch.setattr(graph, "stage", staged)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "61")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = spark.range(3000).selectExpr("id AS a", "id - id % 7 AS b").where("a <> b")
        found = {r.node: r.root for r in graph.connected_components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {i: i - i % 7 for i in range(3000)} and max(parts[1:]) <= graph.LEAST_PARTS
