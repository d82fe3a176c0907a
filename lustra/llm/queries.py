"""Registered queries of the training-data operators, with oracle SQL where SQL can say it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lustra.catalog.base import Query
from lustra.llm.bucket_refinement import repeat_digests
from lustra.llm.count_min_windows import remove_repeated_windows
from lustra.llm.html_blocks import extract_main_text
from lustra.llm.importance_selection import draw_like
from lustra.llm.importance_selection import oracle_sql as draw_sql
from lustra.llm.jaccard_regions import near_duplicates
from lustra.llm.licence_digests import known_digests, scan_licences
from lustra.llm.licence_digests import oracle_sql as licence_sql
from lustra.llm.nbest_pieces import Pieces, encode
from lustra.llm.qgram_decontamination import contaminated
from lustra.llm.redirect_filter import judge_urls
from lustra.llm.shipping import ship_package
from lustra.llm.spelling_composition import oracle_sql as spelling_sql
from lustra.llm.spelling_composition import spelling_groups, vocabulary
from lustra.llm.subword_quality import score, train
from lustra.llm.token_fertility import Vocabulary, token_quality
from lustra.llm.warc_revisits import deduplicate, read_archives, resolved, write_archives
from lustra.llm.warc_revisits import oracle_sql as revisit_sql
from lustra.sources.workspace import fresh_folder

#: Where the public tokeniser files are, on the driver and the executors alike.
TOKENIZERS = os.environ.get("LUSTRA_TOKENIZERS", "/opt/tokenizers")
VOCABULARIES = tuple(Vocabulary(f"{TOKENIZERS}/{f}") for f in ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"))
PIECES = Pieces(f"{TOKENIZERS}/piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, fertility measures and the verdict on every document."""
    ship_package(spark)
    return token_quality(table(spark, sf_dir, "documents"), VOCABULARIES)


def op2_bucket_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that an earlier document holds are removed."""
    ship_package(spark)
    return repeat_digests(table(spark, sf_dir, "documents"))


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    ship_package(spark)
    return extract_main_text(table(spark, sf_dir, "pages"))


def op4_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in documents: one row for each document and passage."""
    ship_package(spark)
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_found"), F.min("distance").alias("distance"), F.min("begin").alias("first_byte")
    )


def op5_count_min_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that an earlier document holds are removed."""
    ship_package(spark)
    cut = remove_repeated_windows(table(spark, sf_dir, "documents"), keep_text=False)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document: ids, score and digest, and whether each decodes to it.

    The best one's ids are given, and what each of the others has in place of stretches of them.
    """
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    return encode(docs, PIECES, n=4, with_ids=False, with_paths=True, with_edits=True).drop("paths")


def op7_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    ship_package(spark)
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    return judge_urls(table(spark, sf_dir, "pages"))


def op9_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that documents are, or that their lines name."""
    ship_package(spark)
    return scan_licences(table(spark, sf_dir, "documents"), known_digests(spark))


def op10_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents; a third of the labels is held out of training, no NULL doc_id ever is."""
    ship_package(spark)
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = train(documents, labels.filter(~held_out), "quality")
    scored = score(documents, model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )


def op11_importance_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents, drawn by how like the benchmark they are."""
    ship_package(spark)
    return draw_like(*(table(spark, sf_dir, name) for name in ("documents", "benchmark")))


def op12_spelling_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of all documents, typing slips put in, with the form each word is a variant of."""
    ship_package(spark)
    return spelling_groups(vocabulary(table(spark, sf_dir, "documents"), slip_every=199))


def op13_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, written anew with revisit records, read back and resolved."""
    captured, kept = (fresh_folder(spark, name) for name in ("captures", "archives"))
    write_archives(table(spark, sf_dir, "pages"), captured)
    deduplicate(spark, captured, kept)
    return resolved(read_archives(spark, kept))


QUERIES: dict[str, Query] = {
    "op1_token_fertility": Query(op1_token_fertility),
    "op2_bucket_refinement": Query(op2_bucket_refinement),
    "op3_html_blocks": Query(op3_html_blocks),
    "op4_qgram_decontamination": Query(op4_qgram_decontamination),
    "op5_count_min_windows": Query(op5_count_min_windows),
    "op6_nbest_pieces": Query(op6_nbest_pieces),
    "op7_jaccard_regions": Query(op7_jaccard_regions),
    "op8_redirect_filter": Query(op8_redirect_filter),
    "op9_licence_digests": Query(op9_licence_digests, licence_sql()),
    "op10_subword_quality": Query(op10_subword_quality),
    "op11_importance_selection": Query(op11_importance_selection, draw_sql()),
    "op12_spelling_composition": Query(op12_spelling_composition, spelling_sql()),
    "op13_warc_revisits": Query(op13_warc_revisits, revisit_sql()),
}
