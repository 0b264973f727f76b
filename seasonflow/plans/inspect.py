"""Plan inspection through ``DataFrame.explain`` (used by tests and for reviews)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_section(df: DataFrame) -> str:
    """The operator tree of the formatted physical plan (before the node details)."""
    text = plan_text(df, "formatted")
    return text.split("\n\n\n")[0]


def count_nodes(df: DataFrame, node: str) -> int:
    """Occurrences of a physical operator name in the plan tree."""
    return len(re.findall(rf"\b{re.escape(node)}\b", physical_section(df)))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: (.*)", plan_text(df, "formatted"))


def uses_python(df: DataFrame) -> bool:
    """True when any Python evaluation node (UDF, Arrow UDF, mapInPandas) is planned."""
    text = plan_text(df, "formatted")
    return bool(re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas|MapInPandas", text))
