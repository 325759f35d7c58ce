"""Broadsheet: rank large article collections against free-text queries on Spark.

The whole job is ``rank_documents(articles, queries)``; every step of it is also
a DataFrame operator of its own under ``broadsheet.operators``.
"""

from broadsheet.cluster import intermediates
from broadsheet.plans.ranking_job import rank_documents, rank_files

__all__ = ["intermediates", "rank_documents", "rank_files"]
