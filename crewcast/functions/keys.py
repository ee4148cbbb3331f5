"""Identifiers built from column values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def series_identifier(columns: Sequence[str]) -> Column:
    """Readable series name: the values in order, one blank between, ``None`` for a null."""
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns])


def row_fingerprint(columns: Sequence[str]) -> Column:
    """Key that depends on the values alone, so it is the same in every use and every retry."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)
