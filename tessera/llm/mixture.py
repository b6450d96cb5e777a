"""Mixing sources to target shares of the total size in tokens.

Tokens are summed per source (combined before the shuffle); from the sums comes each source's
repetition rate. Every document is emitted floor(rate) times, and once more if the hash of its id and
the seed, read as a number in [0, 1), lies below the fraction of the rate. Documents are not moved.

The total is the largest at which no source needs more than its ``max_repeats``, so that all sources
that have documents come to their shares; a smaller or larger ``total_tokens`` may be given, at
which a source whose cap binds falls short. Shares of targets without documents are spread over the
others in proportion; sources without target are not used. The report gives target and actual share.

Defined cases
* a null source, target, share or cap is no target; of repeated targets of a source the first by
  share and cap counts; names are compared as they are;
* null and empty texts have 0 tokens and are emitted like others; a source of 0 tokens has no rate;
* copies of a document are numbered from 1; the outcome depends on id and seed alone, so that a task
  run again, or a table in another order, gives the same; the number in [0, 1) is read from the first
  52 bits of an MD5 digest of seed and id;
* documents of sources that no target names are left out before their text is tokenized;
* empty tables give an empty mixture; further columns of the inputs are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The tokenizer of UTF-8 bytes, one token each: no vocabulary file is read.
BYTES = "bytes"
#: Texts encoded at once, and characters of a text encoded at once (cut at white space).
TEXTS_AT_ONCE, CHARACTERS_AT_ONCE = 512, 200_000


def pieces(text: str, size: int) -> list[str]:
    """Parts of at most ``size`` characters, cut before white space, where no token crosses; a part
    without white space is cut as late as there is some."""
    out, at = [], 0
    while len(text) - at > size:
        cut = at + size
        while cut < len(text) and not (text[cut] == " " and text[cut - 1].isalnum()):
            cut += 1
        out.append(text[at:cut])
        at = cut
    out.append(text[at:])
    return out


def targeted(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """The documents of the sources that have a target (a row for each source on the other side)."""
    return documents.join(targets.where(_usable()).select("source").distinct(), "source", "left_semi")


def token_counts(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, source, n_tokens). ``tokenizer`` is ``BYTES`` or the path of a vocabulary file, which
    is read where the query starts and sent to the tasks (a few MB, fixed), so executors need no copy."""
    if tokenizer == BYTES:
        return documents.select("doc_id", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_tokens"))
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = documents.sparkSession.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        encoder = Tokenizer.from_str(vocabulary.value)
        encoder.encode_special_tokens = True
        for batch in batches:
            totals = []
            for at in range(0, len(batch), TEXTS_AT_ONCE):
                texts = [t or "" for t in batch["text"].iloc[at : at + TEXTS_AT_ONCE]]
                split = [pieces(t, CHARACTERS_AT_ONCE) for t in texts]
                encoded = iter(encoder.encode_batch([p for parts in split for p in parts], add_special_tokens=False))
                totals += [sum(len(next(encoded)) for _ in parts) for parts in split]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "n_tokens": totals})

    return documents.select("doc_id", "source", "text").mapInPandas(count, "doc_id long, source string, n_tokens long")


def _usable() -> F.Column:
    return F.col("source").isNotNull() & (F.col("target_share") > 0) & (F.col("max_repeats") > 0)


def rates(sizes: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """One row per target: tokens there are, share aimed at and repetition rate (null without any)."""
    wanted = targets.where(_usable()).groupBy("source").agg(
        F.min(F.struct("target_share", "max_repeats")).alias("t")
    ).select("source", "t.*")
    there = sizes.where(F.col("source").isNotNull()).groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_documents"))
    joined = wanted.join(there, "source", "left").select(
        "source", "target_share", "max_repeats", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("n_documents", F.lit(0)).alias("n_documents")
    )
    present = F.when(F.col("n_tokens") > 0, F.col("target_share"))
    largest = joined.agg(
        F.sum(present).alias("present"), F.min(F.when(F.col("n_tokens") > 0, F.col("n_tokens") * F.col("max_repeats") / F.col("target_share"))).alias("reach")
    ).first()  # two numbers
    spread = joined.withColumn("aim", present / F.lit(largest["present"]))
    total = F.lit(float(total_tokens) if total_tokens else (largest["reach"] or 0.0) * (largest["present"] or 0.0))
    rate = F.least(F.col("max_repeats").cast("double"), F.col("aim") * total / F.col("n_tokens"))
    return spread.select(
        "source", "target_share", "max_repeats", "n_documents", "n_tokens", "aim", F.when(F.col("n_tokens") > 0, rate).alias("rate")
    )


def copies(sizes: DataFrame, planned: DataFrame, seed: int = 0) -> DataFrame:
    """Each document of a planned source with the number of its copies (0 and more)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    uniform = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    whole = F.floor("rate")
    side = planned.where(F.col("rate").isNotNull()).select("source", "rate")  # a row for each row of the target table
    return sizes.join(side, "source").select(
        "doc_id", "source", "n_tokens", (whole + F.when(uniform < F.col("rate") - whole, 1).otherwise(0)).cast("long").alias("n_copies")
    )


def mixture(counted: DataFrame) -> DataFrame:
    """The emitted copies, one row each."""
    return counted.where("n_copies > 0").select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))).alias("copy_no"))


def report(counted: DataFrame, planned: DataFrame) -> DataFrame:
    """Per target: documents and tokens there are, rate, and tokens, largest repetition and share
    that came out."""
    out = counted.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("n_copies")).alias("mixed_tokens"), F.max("n_copies").alias("most_copies"))
    joined = planned.join(out, "source", "left")
    total = out.agg(F.sum("mixed_tokens")).first()[0]
    return joined.withColumn("all_tokens", F.lit(total)).select(
        "source", "target_share", "max_repeats", "n_documents", "n_tokens", F.col("aim").alias("aimed_share"), "rate",
        F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
    )
