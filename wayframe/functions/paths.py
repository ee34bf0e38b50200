"""Parts of a sensor file's relative path."""

from pyspark.sql import Column, functions as F


def parent(path: Column) -> Column:
    """Everything before the last slash, empty when there is none."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def channel(path: Column) -> Column:
    """Sensor channel: the directory that holds the file."""
    return F.substring_index(parent(path), "/", -1)


def modality(channel_name: Column) -> Column:
    """``CAM_FRONT`` -> ``cam``."""
    return F.lower(F.substring_index(channel_name, "_", 1))
