"""The queries of this subpackage with their SQL."""

from almanack.llm import (  # noqa: F401
    bag_minhash, cotrain, ctw, decontaminate, hadamard, hard_negatives, html_extract, line_dedup, mix, shard, vp_trees,
    warc, whitening,
)
from almanack.llm.base import ORACLES, QUERIES  # noqa: F401
