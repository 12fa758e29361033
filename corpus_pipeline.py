"""From raw documents to packed sequences.

Each stage takes all that the one before it kept; ``run`` writes its result to shared storage and
reads it again, so a lost executor repeats at most one stage. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import line_dedup, minhash, mixing, packing, quality, tokens
from orderloom.llm.queries import SEQUENCE_TOKENS, vocabulary
from orderloom.session import materialise, remove, scratch_path, scratch_scope


def set_aside(docs: DataFrame, *used: str) -> DataFrame:
    """The columns a stage works with, all others in one, so that none clashes with what operators add."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*others, F.lit(0).alias(" ")).alias("others"))


def put_back(rows: DataFrame, columns: list[str], *used: str) -> DataFrame:
    """The columns of the stage's input in their order."""
    return rows.select(*(F.col(c) if c in used else F.col(f"others.`{c}`") for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the line field is trained on the labelled ones.

    Null, empty and wordless texts fail the rules and go. Long texts are judged whole. Each row is
    judged by its own text: repeated rows and rows that share an identifier, or have none, stay or go
    one by one. Half of the words in content lines is enough, a tie of two paths is content. Without
    labels all lines are content. An empty table gives an empty one.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = quality.judge(set_aside(docs, "text"), model).where("quality.kept")
    return put_back(judged, docs.columns, "text")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the lines of runs that stand in an earlier one; ``n_chars`` counted anew.

    A copy of which no word is left goes as a whole, a repeated row too; a row that lost nothing stays, with
    a null, empty or wordless text as well. Null identifiers are the earliest; among equal ones a row
    number decides, which a stored copy fixes. Long texts are taken whole; an empty table gives an
    empty one.
    """
    left = line_dedup.dedup_lines(set_aside(docs, "doc_id", "text"))
    left = left.where((F.col("n_removed") == 0) | F.regexp_like("text", F.lit(mixing.WORD)))
    left = left.withColumn("n_chars", F.length("text").cast("long"))
    return put_back(left, docs.columns, "doc_id", "text", "n_chars")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, by the sets of five-word shingles of their texts.

    That of the smallest identifier stays, the first of several rows with it. Texts count, not
    identifiers: of different texts under one identifier each is kept or dropped by its own set, and
    repeated rows are copies. Null, empty and wordless texts and null identifiers are linked with
    nothing and all stay. Ties are decided by row number, which a stored copy fixes. Texts are taken
    whole, however long; an empty table gives an empty one.
    """
    return put_back(minhash.keep_first(set_aside(docs, "doc_id", "text")), docs.columns, "doc_id", "text")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, up to three times.

    A null source is a source of its own. A text without words, null and empty ones too, has no size:
    it comes once for each whole time that its source is taken. Repeated rows are rounded one by one,
    long texts weigh by all their words, and reruns agree. An empty table gives an empty one.
    """
    mixed = mixing.mix(set_aside(docs, "source", "text"), mixing.word_count(F.col("text")))
    return put_back(mixing.repeated(mixed), docs.columns, "source", "text")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they lie in sequences of 2048 tokens.

    A null or empty text is one piece, its end token. Longer texts are cut, whatever their length.
    Repeated rows, and rows that share an identifier or have none, are pieces of their own. An empty
    table gives an empty one.
    """
    pieces = tokens.token_pieces(F.col("text"), vocabulary(), SEQUENCE_TOKENS)
    return packing.pack(docs.select("doc_id", F.inline(pieces)), "length", SEQUENCE_TOKENS)


STAGES = [
    ("quality", quality_rules),
    ("lines", line_dedup_stage),
    ("near", near_dedup),
    ("mix", source_mixing),
    ("pack", best_fit_packing),
]

# The trained field, the signatures and the rounding are beyond SQL; tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row per packed piece.

    A stage's own copies, and the result of the stage before, are removed once its result is written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, path)
        if before:
            remove(spark, before)
        before = path
    return docs
