"""Sample ids have the form ``<batch>-YYYY-MM-DD``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newstide.config import SAMPLE_ID_PATTERN


def date_key(ts: Column, as_of: Column | None = None) -> Column:
    """ISO date of an instant in the session zone (UTC); ``as_of`` stands in for null."""
    filled = ts if as_of is None else F.coalesce(ts, as_of)
    return F.date_format(filled, "yyyy-MM-dd")


def sample_id(date_text: Column, batch: Column | None = None) -> Column:
    number = F.lit(1) if batch is None else F.coalesce(F.nullif(batch, F.lit(0)), F.lit(1))
    return F.concat_ws("-", number.cast("string"), date_text)


def sample_batch(sample: Column) -> Column:
    """Leading integer, or null when the id has fewer than four parts."""
    parts = F.split(sample, "-")
    return F.when(F.size(parts) >= 4, F.get(parts, 0).try_cast("int"))


def sample_date(sample: Column) -> Column:
    """The date part, or null when it is no calendar date."""
    parts = F.split(sample, "-")
    text = F.concat_ws("-", F.get(parts, 1), F.get(parts, 2), F.get(parts, 3))
    return F.when(F.size(parts) >= 4, F.to_date(F.try_to_timestamp(text, F.lit("yyyy-M-d"))))


def is_well_formed(sample: Column) -> Column:
    return sample_batch(sample).isNotNull() & sample_date(sample).isNotNull()


def is_valid_sample(sample: Column) -> Column:
    """Strict form: year 2025 to 2099 and a real calendar date."""
    return F.coalesce(sample.rlike(SAMPLE_ID_PATTERN), F.lit(False)) & sample_date(sample).isNotNull()
