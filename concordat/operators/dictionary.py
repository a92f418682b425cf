"""Data dictionaries: column renames and code translation declared by each data owner."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.names import Names
from concordat.operators.joins import sized

# Columns of a dictionary.
FIELD, LABEL, CODE = "Champs", "Valeur", "Code"


def short_name(column: str) -> str:
    """A target column without its use-case prefix (everything up to the last underscore)."""
    return re.sub(".*_", "", column)


def column_renames(dictionary: DataFrame, source: str, names: Names = Names()) -> DataFrame:
    """``(Champs, Valeur)`` rows that say under which name a source holds a field."""
    return (
        dictionary.filter(F.col(LABEL).isNotNull() & F.col(CODE).isNull() & (F.col(names.source) == source))
        .groupBy(FIELD)
        .agg(F.min(LABEL).alias(LABEL))
    )


def coded_columns(dictionary: DataFrame) -> DataFrame:
    """Fields whose labels have codes."""
    return dictionary.filter(F.col(CODE).isNotNull() & F.col(LABEL).isNotNull()).select(FIELD).distinct()


def read_renames(
    dictionary: DataFrame, source: str, fields: Iterable[str], names: Names = Names()
) -> dict[str, str]:
    """Renames of the given fields, at most one per field, so safe to hold in the plan."""
    rows = column_renames(dictionary, source, names).filter(F.col(FIELD).isin(list(fields))).collect()
    return {r[FIELD]: r[LABEL] for r in rows}


def read_coded(dictionary: DataFrame, fields: Iterable[str]) -> list[str]:
    rows = coded_columns(dictionary).filter(F.col(FIELD).isin(list(fields))).collect()
    return sorted(r[FIELD] for r in rows)


def build_mapping(
    columns: Sequence[str],
    renames: Mapping[str, str] | None = None,
    remove_prefix: bool = True,
    remove_after_comma: bool = True,
) -> dict[str, str]:
    """Where to look up each target column: short name, then the owner's rename of it."""
    mapping = {}
    for column in columns:
        name = short_name(column) if remove_prefix else column
        name = re.sub(",.*", "", name) if remove_after_comma else name
        mapping[column] = (renames or {}).get(name, name)
    return mapping


def translate_codes(
    df: DataFrame, dictionary: DataFrame, columns: Iterable[str], match_field: bool = True
) -> DataFrame:
    """Replace the labels in ``columns`` by their codes; a label without a code becomes NULL.

    With ``match_field`` a label counts only for its own field and has one code. Without it every
    equal label of any field joins, as older runs did, and rows may multiply.
    """
    usable = dictionary.filter(F.col(LABEL).isNotNull() & F.col(CODE).isNotNull())
    wanted = set(columns)
    if not wanted:
        return df
    result, order = df, df.columns
    for i, column in enumerate(c for c in order if c in wanted):
        label, code = f"__label{i}", f"__code{i}"
        if match_field:
            codes = (
                usable.filter(F.col(FIELD) == short_name(column))
                .groupBy(F.col(LABEL).alias(label))
                .agg(F.min(CODE).alias(code))
            )
        else:
            codes = usable.select(F.col(LABEL).alias(label), F.col(CODE).alias(code))
        text = F.col(f"`{column}`").cast("string")
        result = result.join(sized(codes), text == F.col(label), "left")
        result = result.drop(column, label).withColumnRenamed(code, column)
    return result.select(*[f"`{c}`" for c in order])
