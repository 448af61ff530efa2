"""Every query of this subpackage; importing the modules registers them."""

import corpus_pipeline

from . import credentials, decontaminate, langid, lm, mixing, quoting, sharding, simhash, tokenalign, tokenfiles, urlfilter, vafile, variants  # noqa: F401
from .registry import ORACLE, QUERIES, query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)

__all__ = ["ORACLE", "QUERIES"]
