"""The DPH relevance model (Amati, divergence from randomness), as a column function."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the share of a document that consists of one term only.
F_MAX = 0.99999


def dph_score(tf: Column, corpus_tf: Column, length: Column, avg_length: Column,
              n_docs: Column) -> Column:
    """The relevance of a document for one term that occurs in it.

    Documents per occurrence is a whole-number division. For a term with more
    occurrences than there are documents it is 0, its logarithm has no value, and the
    term scores 0.
    """
    share = F.when(tf < length, tf / length).otherwise(F.lit(F_MAX))
    rarity = F.call_function("div", n_docs, corpus_tf)
    score = (1 - share) * (1 - share) / (tf + 1) * (
        tf * F.log2(tf * avg_length / length * rarity)
        + 0.5 * F.log2(2 * math.pi * tf * (1 - share))
    )
    return F.when(corpus_tf > n_docs, F.lit(0.0)).otherwise(score)
