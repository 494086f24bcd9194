"""Arrow-batched Python functions, for comparison with the built-in forms."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from weirflow.functions.fixed import RISK_4


@F.pandas_udf("string")
def risk_class(score: pd.Series) -> pd.Series:
    """Lower limits belong to the better class, as in the built-in scale."""
    limits = sorted(limit for limit, _ in RISK_4 if limit is not None)
    names = [name for _, name in RISK_4][::-1]
    return pd.cut(score, [-np.inf, *limits, np.inf], labels=names, right=False).astype("str")
