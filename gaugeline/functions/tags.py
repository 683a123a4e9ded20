"""Node ids and tag names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.fixed import DEVICE_PATH


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_ ])", r"\\\1", text)


def tag_from_node_id(node_id: Column | str, device_path: str = DEVICE_PATH) -> Column:
    """The part of the node id below the device, in any namespace."""
    value, mark = _col(node_id), f";s={device_path}."
    below = F.substring(value, F.instr(value, mark) + len(mark), F.lit(2**31 - 1))
    return F.when(value.rlike(rf"^ns=\d+;s={_quoted(device_path)}\.."), below)


def tag_from_name(display_name: Column | str, device_path: str = DEVICE_PATH) -> Column:
    """The part of a full-path display name below the device."""
    name, above = _col(display_name), device_path + "."
    below = F.when(name.startswith(above), F.substring(name, len(above) + 1, 2**31 - 1))
    return F.when(below != "", below)


def last_segment(text: Column | str) -> Column:
    """What follows the last dot; NULL if nothing does."""
    last = F.substring_index(_col(text), ".", -1)
    return F.when(last != "", last)


def without_spaces(text: Column | str) -> Column:
    return F.translate(_col(text), " \t\n\r\f\v", "")


def folder_safe(text: Column | str) -> Column:
    """Every run of characters other than letters, digits and underscore becomes one underscore."""
    return F.regexp_replace(_col(text), r"[^A-Za-z0-9_]+", "_")


def clean_tag(text: Column | str) -> Column:
    """Spaces out first, so that ``Current_ A`` gives ``Current_A`` and not ``Current__A``."""
    return folder_safe(without_spaces(text))


def raw_tag(display_name: Column | str, node_id: Column | str, device_path: str = DEVICE_PATH) -> Column:
    """Tag by priority: path in the name, path in the id, last part of the name, last part of the id."""
    return F.coalesce(
        tag_from_name(display_name, device_path),
        tag_from_node_id(node_id, device_path),
        last_segment(display_name),
        last_segment(node_id),
    )


def namespace_index(node_id: Column | str) -> Column:
    """Namespace number of an ``ns=<i>;...`` id; an id without one is in namespace 0."""
    number = F.regexp_extract(_col(node_id), r"^ns=(\d+)", 1)
    return F.when(number != "", number.try_cast("bigint")).when(_col(node_id).isNotNull(), F.lit(0).cast("bigint"))


def make_node_id(namespace: Column | str, identifier: Column | str) -> Column:
    return F.concat(F.lit("ns="), _col(namespace).cast("string"), F.lit(";s="), _col(identifier))


def mentions_any(text: Column | str, keywords) -> Column:
    """Whether the text holds one of the keywords, ignoring case."""
    words = [word for word in keywords if word]
    if not words:
        return F.lit(False)
    return _col(text).rlike("(?i)" + "|".join(_quoted(word) for word in words))
