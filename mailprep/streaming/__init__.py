"""The cleaning step on streams.

Cleaning and the length filter look at one row at a time and keep no state, so the batch operators run on a
streaming table as they are; this only names that use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from mailprep import fixed as X
from mailprep.operators.schema import filter_short, with_body_text, with_clean_text


def clean_stream(mails: DataFrame, body: str = X.BODY, threshold: int = X.MIN_LENGTH_PREPARE) -> DataFrame:
    return filter_short(with_clean_text(with_body_text(mails, body), body), threshold=threshold)
