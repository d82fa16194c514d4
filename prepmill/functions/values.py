"""Single-value expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


MISSING = "NA"  # fixed value: how flight columns spell a missing number


def text_to_double(text: Column) -> Column:
    """Text as double; text that is no number becomes null instead of failing the job.

    A failed parse raises and catches an exception inside the JVM, ten times the cost of a good
    one, so the common marker for missing numbers is not parsed at all.
    """
    return F.when(text != MISSING, text.try_cast("double"))


def words_to_double(text: Column) -> Column:
    """The same for a column that mostly holds words.

    Words are told from numbers by their start: blanks, signs, points and digits sort before
    ``:``, and of the other texts only infinities and NaN are numbers. The test makes the
    generated code longer, which pays off only where most values fail.
    """
    word = F.upper(F.substring(text, 1, 3)).isin("INF", "NAN")
    return F.when((text < ":") | word, text.try_cast("double"))


def to_double(field: T.StructField) -> Column:
    """A column as double; what cannot be one becomes null."""
    column = F.col(f"`{field.name}`")
    is_text = isinstance(field.dataType, T.StringType)
    return text_to_double(column) if is_text else column.try_cast("double")


def strip_trailing_percent(name: str) -> Column:
    """Text without the ``%`` signs at its end."""
    return F.rtrim(F.col(name), F.lit("%"))


def percent_to_double(name: str) -> Column:
    """``'13.5%'`` as 13.5."""
    return text_to_double(strip_trailing_percent(name))


def before_dash(name: str) -> Column:
    """Text before the first ``-``, or the whole text if it has none."""
    return F.substring_index(F.col(name), "-", 1)


def keep_or_replace(name: str, old: str, new: str) -> Column:
    """``new`` where the column equals ``old``; every other value, null included, is kept."""
    return F.when(F.col(name) == old, F.lit(new)).otherwise(F.col(name))


def decode_two_way(name: str, zero: str, other: str) -> Column:
    """Text for a predicted index: ``zero`` for 0.0, else ``other``.

    Right only while ``zero`` is the most frequent label of the training data. Prefer
    ``operators.decode_prediction``, which takes the labels from the fitted indexer.
    """
    return F.when(F.col(name) == 0.0, F.lit(zero)).otherwise(F.lit(other))
