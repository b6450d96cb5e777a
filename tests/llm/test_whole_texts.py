"""Registered queries on text do the whole job."""

from tests.test_whole_jobs import run


def test_short_documents_have_shares_too(spark, tmp_path):
    span = "".join(chr(0x100 + i) for i in range(100))
    rows = [(1, span + "ab"), (2, "x" + span), (3, "y" * 99), (4, "y" * 99), (5, ""), (6, None), (7, None), (8, "z" * 100)]
    got = {tuple(r) for r in run(spark, tmp_path, "p10_shares", documents=(rows, "doc_id long, text string")).collect()}
    assert got == {
        (1, 1, 102, 100, 0.980392), (2, 2, 101, 100, 0.990099), (3, 3, 99, 0, 0.0), (4, 3, 99, 0, 0.0),
        (5, 5, 0, 0, None), (6, 6, None, 0, None), (7, 7, None, 0, None), (8, 8, 100, 0, 0.0),
    }


def test_the_cleaned_corpus_keeps_its_text(spark, tmp_path):
    words = " ".join(f"w{i}" for i in range(20))
    documents = [(1, f"before {words} after", "pt", "s", None), (2, "something else", "pt", "s", "autre chose"), (3, None, None, "s", None)]
    got = run(
        spark, tmp_path, "p8_clean", documents=(documents, "doc_id long, text string, lang string, source string, target_text string"),
        eval_item=([(1, words, "pt", "x")], "item_id long, text string, lang string, suite string"),
    )
    assert got.columns == ["doc_id", "text", "lang", "source", "target_text"] and {tuple(r) for r in got.collect()} == set(documents[1:])
