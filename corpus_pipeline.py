"""The corpus pipeline: from raw documents to piece ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of ``documents``.
Between stages the rows are written to the shared folder and read again, so a lost executor costs tasks of one stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstream.llm import decontaminate, fertility, line_dedup, near_dup, piece_fst
from wardstream.llm.common import rows_and_files, table
from wardstream.session import materialise


def _filed(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``found``, what is left of ``docs``, in no more files than the texts of ``docs`` fill."""
    return found.coalesce(rows_and_files(docs, "text")[1])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their band of tokeniser fertility. Documents without words go."""
    return fertility.kept(docs).filter("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of repeated runs of lines. Documents of which nothing but white space is left go;
    ``n_chars`` follows the text."""
    found = line_dedup.without_repeats(docs)
    left = F.regexp_like("text", F.lit(r"[^\x09-\x0D\x20]"))
    return _filed(
        docs,
        found.filter((F.col("n_deleted") == 0) | left)
        .withColumn(
            "n_chars",
            F.when(F.col("n_deleted") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")),
        )
        .select(docs.columns),
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of the least id."""
    return _filed(docs, near_dup.one_of_each(docs))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten words in a row, or no short item, with the benchmark."""
    return _filed(docs, decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of each text. Searches are half as large as in the operator: the executors' heaps are full by now."""
    encoded = piece_fst.encode(docs, again="spelled_again", at_once=4 << 20)
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "spelled_again", "ids"
    )


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("clean_of_benchmark", clean_of_benchmark),
    ("pieces", pieces),
]

#: SQL knows neither the vocabularies nor weighted sampling; the tests replay the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
