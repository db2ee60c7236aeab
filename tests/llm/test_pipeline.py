"""The corpus pipeline, stage by stage, against plain versions of each decision."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from commerce_engine.llm import queries, common, mixing, ordinal, packing, pseudonyms

from . import brute

FOLDER = "/root/testdata/sf0.01"


def test_stages_one_after_the_other(spark):
    docs = common.table(spark, FOLDER, "documents")
    labels = common.table(spark, FOLDER, "labels")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(common.written(stage(spark, tables[-1], FOLDER), "stage"))
    assert all(t.columns == docs.columns for t in tables[:-1])

    kept = {r["doc_id"] for r in ordinal.graded(docs, labels).where("kept").collect()}
    assert {r["doc_id"] for r in tables[1].collect()} == kept
    rated = {r["doc_id"]: (r["quality"], r["toxic"]) for r in labels.collect()}
    clean = [d for d, (q, t) in rated.items() if q == 1 and t == 0]
    assert sum(d in kept for d in clean) >= 0.98 * len(clean)
    assert sum(d in kept for d, (q, t) in rated.items() if t == 1) <= 0.2 * sum(t for _, t in rated.values())

    rows = tables[1].orderBy("doc_id").collect()
    groups = brute.similar([r["doc_id"] for r in rows], [r["text"] for r in rows], 5)
    assert {r["doc_id"] for r in tables[2].collect()} == {d for d, g in groups.items() if d == g}

    cipher = pseudonyms.Feistel(queries.pii_key(spark))
    want = {r["doc_id"]: pseudonyms.pseudonymise(cipher, r["text"])[0] for r in tables[2].collect()}
    assert {r["doc_id"]: r["text"] for r in tables[3].collect()} == want
    assert tables[3].where(F.col("n_chars") != F.length("text")).count() == 0

    order = [r["doc_id"] for r in mixing.schedule(tables[3]).orderBy("slot", "place").collect()]
    assert [r["doc_id"] for r in corpus_pipeline.mix(spark, tables[3], FOLDER).collect()] == order
    assert {r["doc_id"] for r in tables[4].collect()} == set(want)

    packed = tables[5].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    from commerce_engine.llm.tokens import WordIds

    ids = WordIds(public_tokenizers.path("word_bpe_49k.json"))
    assert {r["doc_id"]: r["n"] for r in packed} == {d: len(ids.encode(t.encode())) // 4 + 1 for d, t in want.items()}


def test_run_is_the_stages_and_handles_nulls(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, "a b c d e f g h", "en", "s", 15), (2, None, None, None, None), (None, "call 415-555-2671 now", "en", None, 21), (3, "", "en", "s", 0)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, 1), (False, 2), (False, 3), (True, 0)]


def test_the_mix_survives_packing(spark, tmp_path, monkeypatch):
    """Every group of sequences holds the target shares; other shares, or no mixing, give other sequences."""
    monkeypatch.setattr(packing, "GROUP_PIECES", 60)
    source = {i: "a" if i < 400 else "b" if i < 550 else "c" for i in range(600)}
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(8 + 40 * (i >= 550))), "en", s, 1) for i, s in source.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    def run():
        return sorted((r["sequence_id"], r["offset"], r["doc_id"], r["piece"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    first = run()
    assert len({d for _, _, d, _ in first}) == len(first) == 600
    shares = {r["source"]: r["share"] for r in mixing.default_shares(spark.read.parquet(str(tmp_path / "documents.parquet"))).collect()}
    for g in range(4):  # source c lasts for 50 / 0.179 slots
        held = Counter(source[d] for s, _, d, _ in first if s // 60 == g)
        assert sum(held.values()) == 60
        assert all(abs(held[s] - 60 * n / sum(shares.values())) < 2 for s, n in shares.items())
    assert run() == first
    with monkeypatch.context() as m:
        m.setattr(corpus_pipeline, "STAGES", [x for x in corpus_pipeline.STAGES if x[0] != "mixing"])
        assert run() != first
    monkeypatch.setattr(mixing, "default_shares", lambda docs: docs.select("source", F.lit(1).cast("bigint").alias("share")).distinct())
    assert run() != first


def test_packing_in_order_takes_contiguous_ranges(spark, tmp_path, monkeypatch):
    """Many files, several buckets of a file, long texts and rows without an id; a written table and a sorted frame alike."""
    monkeypatch.setattr(packing, "GROUP_PIECES", 25)
    monkeypatch.setattr(packing, "BUCKET_ROWS", 7)
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.expr("repeat(concat('word', id, ' '), if(id % 50 = 0, 90, 3))").alias("text"))
    ordered = rows.repartitionByRange(12, "id").sortWithinPartitions("id").select("doc_id", "text")
    ordered.write.parquet(str(tmp_path / "t"))
    for frame in (spark.read.parquet(str(tmp_path / "t")), ordered):
        got = packing.pack_documents(frame, public_tokenizers.path("word_bpe_49k.json"), 1, 64, in_order=True).collect()
        groups = Counter(r["sequence_id"] // 25 for r in got)
        assert sorted(groups) == list(range(len(groups))) and {n for g, n in groups.items() if g + 1 < len(groups)} == {25}
        ids = sorted((r["doc_id"], r["piece"], r["sequence_id"] // 25) for r in got if r["doc_id"] is not None)
        assert [g for _, _, g in ids] == sorted(g for _, _, g in ids) and {d for d, _, _ in ids} == {i for i in range(300) if i % 3}
        ends = Counter()
        for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
            assert ends[r["sequence_id"]] == r["offset"]
            ends[r["sequence_id"]] += r["length"]
        assert max(ends.values()) <= 64


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark, tmp_path):
    """(0, A), (1, A), (1, B), (3, B), (3, B): one A and one B stay."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(0, a), (1, a), (1, b), (3, b), (3, b), (None, a), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert sorted((str(r["doc_id"]), (r["text"] or "-")[0]) for r in left) == [("0", "a"), ("1", "b"), ("7", "-"), ("7", "-"), ("None", "a")]
    assert left[0].asDict().keys() == set(corpus_pipeline.COLUMNS)
