"""Names of markers, cells and columns, and the words that mean 'not set'."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Settings that count as absent.
UNSET = ["", "NULL", "null", "NA", "na", "none", "None", "NONE"]


def is_unset(value: object, zero: bool = False) -> bool:
    """Whether a setting counts as absent; ``zero`` also takes 0 for absent."""
    return value is None or str(value).strip() in UNSET or (zero and str(value).strip() == "0")


def marker_base(name: Column) -> Column:
    """A marker's name without the compartment behind it."""
    return F.regexp_replace(name, r"(?i)(_Cytoplasm|_Nucleus_).*$", "")


def marker_key(name: Column) -> Column:
    """A marker's name as a key: letters and digits only, upper case."""
    return F.upper(F.regexp_replace(name, r"[^A-Za-z0-9]", ""))


def cell_label(number: Column, width: int = 7) -> Column:
    """``C0000012``: a number padded to ``width``; longer ones stay whole."""
    text = number.cast("string")
    return F.concat(F.lit("C"), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))


def safe_name(name: Column) -> Column:
    """A name usable for a file."""
    return F.regexp_replace(name, r"[^A-Za-z0-9_.-]+", "_")


def column_case(name: str) -> str:
    """A column's name in lower case with single underscores."""
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name))).strip("_").lower()


def marked_label(cluster: Column, label: Column) -> Column:
    """``cluster-label``, null if either is."""
    return F.concat(cluster.cast("string"), F.lit("-"), label)
