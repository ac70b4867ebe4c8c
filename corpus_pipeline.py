"""From raw documents to shuffled shards: five operators, one after the other.

Each stage reads what the one before it wrote and decides for whole rows.
"""

from almanack.llm.bag_minhash import keep_one
from almanack.llm.base import table
from almanack.llm.cotrain import good_only
from almanack.llm.decontaminate import clean
from almanack.llm.mix import mix
from almanack.llm.shard import shuffled
from almanack.sources.sinks import staged


def quality(spark, docs, sf_dir):
    """Documents that the co-trained classifier rejects go."""
    return good_only(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_one(docs)


def decontaminated(spark, docs, sf_dir):
    """Documents that hold a window of a benchmark item go."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark, docs, sf_dir):
    """Sources in their target shares; repeated documents are repeated rows."""
    return mix(docs)


def sharded(spark, docs, sf_dir):
    """All rows in random order over the shards."""
    return shuffled(docs)


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("sharding", sharded),
]

# the classifier, the hash order of the shuffle and the signatures have no SQL
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on the table ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = staged(docs, "stage")
    return docs
