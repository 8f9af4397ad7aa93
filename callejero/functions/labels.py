"""Labels of result files and months, and file paths found in log text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callejero import constants as K


def dataset_label(path: Column) -> Column:
    """Dataset a result file belongs to: first known fragment, else its folder, else its name."""
    low = F.lower(path)
    folder = F.regexp_extract(low, r"([^/]*)/[^/]*$", 1)
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"(.)\.[^.]*$", "$1")
    label = F.when(folder != "", folder).otherwise(stem)
    for fragment, dataset in reversed(K.DATASET_LABELS):
        label = F.when(low.contains(fragment), F.lit(dataset)).otherwise(label)
    return label


def month_name(month: Column) -> Column:
    """Spanish month name; 13 is the yearly mean, anything else ``Mes <value>``."""
    value = F.coalesce(month.cast("string"), F.lit("N/D"))
    entries = [F.lit(x) for pair in K.MONTH_LABELS.items() for x in pair]
    return F.coalesce(
        F.try_element_at(F.create_map(*entries), value), F.concat(F.lit("Mes "), value)
    )


def extract_csv_paths(text: Column) -> Column:
    """Array of the distinct CSV paths in a log text, in order of first mention."""
    found = F.regexp_extract_all(text, F.lit(K.CSV_PATH), F.lit(1))
    return F.array_distinct(
        F.transform(
            found,
            lambda p: F.replace(F.btrim(F.btrim(p, F.lit('"')), F.lit("'")), F.lit("file:///"),
                                F.lit("")),
        )
    )
