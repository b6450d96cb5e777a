from pyspark.sql import functions as F

from tessera.llm import mixture as m
from tessera.llm.queries import TOKENIZER



def sizes(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], "doc_id long, source string, n_tokens long, rate double").drop("rate")


def targets(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], "source string, target_share double, max_repeats long, n_tokens long")


def mixed(spark, docs, wanted, **options):
    counted = sizes(spark, docs)
    planned = m.rates(counted, targets(spark, wanted), **options)
    emitted = m.copies(counted, planned, seed=3)
    return emitted, {r["source"]: r for r in m.report(emitted, planned).collect()}


def test_shares_are_reached_within_the_caps(spark):
    docs = [(i, "big" if i % 10 else "small", 50 + i % 7) for i in range(6000)]
    emitted, report = mixed(spark, docs, [("big", 0.7, 1), ("small", 0.25, 3), ("absent", 0.05, 2)])
    assert abs(report["big"]["actual_share"] - 0.7 / 0.95) < 0.01 and abs(report["small"]["actual_share"] - 0.25 / 0.95) < 0.01
    assert report["absent"]["actual_share"] == 0 and report["absent"]["rate"] is None
    assert report["small"]["most_copies"] <= 3 and report["big"]["most_copies"] <= 1
    assert m.mixture(emitted).count() == emitted.agg(F.sum("n_copies")).first()[0]
    per_doc = {(r["doc_id"], r["copy_no"]) for r in m.mixture(emitted).collect()}
    assert len(per_doc) == m.mixture(emitted).count()
    again, _ = mixed(spark, docs[::-1], [("big", 0.7, 1), ("small", 0.25, 3), ("absent", 0.05, 2)])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in emitted.collect()}


def test_whole_and_fractional_copies(spark):
    docs = [(i, "a", 10) for i in range(100)] + [(1000 + i, "b", 10) for i in range(100)]
    emitted, report = mixed(spark, docs, [("a", 0.5, 2), ("b", 0.5, 5)])
    assert report["a"]["rate"] == report["b"]["rate"] == 2.0 and {r["n_copies"] for r in emitted.collect()} == {2}
    _, given = mixed(spark, docs, [("a", 0.5, 2), ("b", 0.5, 5)], total_tokens=8000)
    assert given["a"]["rate"] == 2.0 and given["b"]["rate"] == 4.0


def test_nulls_and_empty(spark):
    docs = [(1, None, 5), (2, "a", 0), (3, "other", 9)]
    emitted, report = mixed(spark, docs, [("a", 1.0, 2), (None, 0.5, 2), ("x", None, 1), ("y", 0.5, None)])
    assert emitted.count() == 0 and set(report) == {"a"} and report["a"]["actual_share"] == 0
    assert mixed(spark, [], [("a", 1.0, 2)])[0].count() == 0 and mixed(spark, docs, [])[0].count() == 0


def test_tokens_are_those_of_the_tokenizer(spark):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(TOKENIZER)
    encoder.encode_special_tokens = True
    long = "palavra " * 60_000
    texts = ["A prova de leitura.", "", None, "café ☃ " * 30, "<|endoftext|>", long, "x" * 1000]
    rows = spark.createDataFrame([(i, "s", t, "extra") for i, t in enumerate(texts)], "doc_id long, source string, text string, n_tokens string")
    got = {r["doc_id"]: r["n_tokens"] for r in m.token_counts(rows, TOKENIZER).collect()}
    assert got == {i: len(encoder.encode(t or "", add_special_tokens=False)) for i, t in enumerate(texts)}


def test_pieces_join_to_the_text():
    for text in ("", "ab cd", "a" * 50, "word " * 40, " " * 30 + "x"):
        parts = m.pieces(text, 7)
        assert "".join(parts) == text


def test_only_targeted_documents_are_measured(spark):
    docs = spark.createDataFrame([(1, "a", "café", 0), (2, "b", "xx", 0), (3, None, "y", 0), (4, "a", None, 0)], "doc_id long, source string, text string, max_repeats long")
    wanted = targets(spark, [("a", 1.0, 2), ("a", 0.5, 1), ("b", None, 1), (None, 0.5, 2)])
    assert {tuple(r) for r in m.token_counts(m.targeted(docs, wanted), m.BYTES).collect()} == {(1, "a", 5), (4, "a", 0)}
