"""Similarity ratio of two texts: 2 * matched characters / all characters,
counted over longest matching blocks. The only scalar Python function of the package;
it runs in Arrow batches, on candidate pairs that JVM-side filters let through."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def similarity_ratio(later: pd.Series, earlier: pd.Series) -> pd.Series:
    """Ratio of each pair; the order of the two texts matters.

    The matcher prepares the earlier text, so pairs that share it are taken together.
    """
    matcher, prepared = SequenceMatcher(None), None
    ratios = pd.Series(0.0, index=later.index)
    for at in earlier.sort_values().index:
        if earlier[at] != prepared:
            prepared = earlier[at]
            matcher.set_seq2(prepared)
        matcher.set_seq1(later[at])
        ratios[at] = matcher.ratio()
    return ratios
