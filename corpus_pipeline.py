"""The corpus pipeline: documents in, packed sequences out.

Every stage takes all rows its predecessor kept; all but the last return the columns of `documents`.
"""

from skywell.llm import decontaminate, langid, neardup, packing, secrets
from skywell.llm.common import fresh, table, written


def language(spark, docs, sf_dir):
    """Documents whose language can't be told go: null texts and texts without a letter."""
    model = langid.learn_language_model(docs.filter(~langid.held_out("doc_id", *langid.HELD)))
    judged = langid.identify_languages(docs, model, keep=tuple(docs.columns))
    return judged.filter(judged[fresh("lang_pred", docs.columns)] != langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each class of near-duplicates stays: that with the least id."""
    return neardup.deduplicated(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a benchmark item go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark, docs, sf_dir):
    """Secrets are replaced in the texts, in whatever layers they were found; all documents stay."""
    return secrets.redacted(docs)


def packed(spark, docs, sf_dir):
    """Pieces of token sequences that hold all documents."""
    return packing.pack(docs)


STAGES = [
    ("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("secrets", secret_scan), ("packing", packed),
]

#: The stages fit a model, align texts and tokenize, which SQL can't express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage over `documents`; every stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
