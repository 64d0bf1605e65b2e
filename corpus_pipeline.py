"""Five stages that turn crawled documents into packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns they were given.  ``run`` writes each stage's result
to the shared folder and reads it again for the next one.

1. quality rules    documents that fail them go
2. line dedup       boilerplate lines go, but for their first occurrence
3. near-dedup       one document of each group of near-duplicates (0.8 or more) stays
4. personal data    values and the terms that reveal them are masked
5. packing          a row for each piece of a sequence

Defined cases: a null text stays null until packing, where it is the empty
text; the quality rules drop texts without ten words, so null and empty ones go
there; rows with a null id are kept by every stage that judges texts (they are
linked with nothing); rows alike in every column are treated alike, and
near-dedup keeps them all, as they share an id; other columns, whatever their
names, are passed through; an empty table gives empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabfold.llm import line_dedup, near_dup, packing, personal, quality
from tabfold.llm.common import stash, table

NEAR = 80         # percent of five-word shingles from which on documents are near-duplicates


def _with_text(cleaned: DataFrame, columns: list[str], clean: Column) -> DataFrame:
    """The columns of ``row`` with another text (a null text stays null where nothing was taken from it)."""
    def value(c: str) -> Column:
        old = F.col("row").getField(c)
        if c == "text":
            return F.when(old.isNull(), old).otherwise(clean)
        return F.when(old.isNull(), old).otherwise(F.length(clean).cast("long")) if c == "n_chars" else old
    return cleaned.select(*[value(c).alias(c) for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(line_dedup.without_boilerplate(docs), docs.columns, F.col("clean"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.one_of_each(docs, percent=NEAR)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_text(personal.sanitise(docs), docs.columns, F.col("clean"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near-dedup", near_dedup),
    ("personal data", personal_data),
    ("packing", pack),
]

#: The stages call zstandard, hash-based samples and a linear program: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
