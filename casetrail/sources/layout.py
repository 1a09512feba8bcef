"""P1 column map and P2 typed projection."""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import try_date
from .schemas import spark_type


def typed_projection(df: DataFrame, columns: Iterable[tuple[str, str]]) -> DataFrame:
    """One output column per ``(name, type)``, in list order.

    ``date`` goes through the tolerant parser (NULL on a non-date), every other
    type through a strict cast (a bad value raises under ANSI mode, like the
    upstream ``cast``).
    """
    out = []
    for name, typ in columns:
        if typ == "date":
            out.append(try_date(name).alias(name))
        else:
            out.append(F.col(name).cast(spark_type(typ)).alias(name))
    return df.select(*out)


def column_map(df: DataFrame, mapping: Iterable[Mapping]) -> DataFrame:
    """Relayout by a list of ``{name, type: map|const|blank, source|value}``.

    ``map`` renames a source column (a missing source is an error), ``const``
    emits the literal, ``blank`` (and any unknown kind) emits ''.
    """
    cols = []
    have = set(df.columns)
    for spec in mapping:
        name, kind = spec["name"], spec.get("type")
        if kind == "map":
            src = spec["source"]
            if src not in have:
                raise KeyError(f"column map: source column {src!r} not in input")
            cols.append(F.col(f"`{src}`").cast("string").alias(name))
        elif kind == "const":
            cols.append(F.lit(spec.get("value")).cast("string").alias(name))
        else:
            cols.append(F.lit("").alias(name))
    return df.select(*cols)


def load_column_map(path: str) -> list[dict]:
    """Read a YAML column map (``column_map:`` list) if PyYAML is present."""
    try:
        import yaml  # type: ignore
    except ImportError as e:  # pragma: no cover - optional dependency
        raise RuntimeError("PyYAML is needed to read a column-map file") from e
    with open(path, encoding="utf-8-sig") as fh:
        return yaml.safe_load(fh)["column_map"]
