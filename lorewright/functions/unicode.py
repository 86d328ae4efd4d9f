"""Unicode composition, which has no built-in function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Canonical composition (NFC) of each text; null stays."""
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t), na_action="ignore")
