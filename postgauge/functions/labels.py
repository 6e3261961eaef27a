"""Label text to 0/1 and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postgauge.config import NEGATIVE_LABEL, POSITIVE_LABEL
from postgauge.functions.text import strip


def decode_label(label: Column) -> Column:
    """1 for yes/1, 0 for no/0 whatever the case and outer space; null otherwise."""
    value = F.lower(strip(label.cast("string")))
    return (
        F.when(value.isin(POSITIVE_LABEL, "1"), 1)
        .when(value.isin(NEGATIVE_LABEL, "0"), 0)
        .cast("int")
    )


def answer_label(label: Column) -> Column:
    """1 for yes, 0 for no, null for any other text."""
    value = F.lower(strip(label))
    return F.when(value == POSITIVE_LABEL, 1).when(value == NEGATIVE_LABEL, 0).cast("int")


def label_text(prediction: Column) -> Column:
    return F.when(prediction == 1, POSITIVE_LABEL).when(prediction == 0, NEGATIVE_LABEL)


def binary_flag(value: Column) -> Column:
    """A numeric flag as it is, yes/no as 1/0, anything else null."""
    text = value.cast("string")
    word = F.lower(strip(text))
    spoken = F.when(word == POSITIVE_LABEL, 1.0).when(word == NEGATIVE_LABEL, 0.0)
    return F.coalesce(text.try_cast("double"), spoken)
