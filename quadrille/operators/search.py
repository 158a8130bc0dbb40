"""Searches by approximate name and by neighbourhood."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import approx
from ..functions.aabb import hit_literal
from ..sources.tables import written

NO_MATCH = 99999


def possible(path: Column, pattern: str, ins: int, delete: int, subst: int, most: int) -> Column:
    """False only for paths that cannot match: of the pieces of the pattern one must stand unchanged."""
    if min(ins, delete, subst) < 1:
        raise ValueError("an edit costs 1 at least")
    found = approx.pieces(pattern, most // min(ins, delete, subst))
    out = None
    for p in found:
        out = path.contains(p) if out is None else out | path.contains(p)
    return F.lit(True) if out is None else out


def name_cost(path: Column, pattern: str, ins: int = 10, delete: int = 10, subst: int = 10, most: int = 2) -> Column:
    """The least cost at which pattern (a POSIX basic expression) matches somewhere in path; null above `most`.

    If no edit is affordable that is a plain regular expression of the same tree and stays in the JVM; else paths that hold
    none of the pieces drop out there, and batches of the others go through the weighted automaton.
    """
    if min(ins, delete, subst) > most:
        return F.when(path.rlike(approx.java(pattern)), 0)

    @F.pandas_udf("int")
    def cost(paths: pd.Series) -> pd.Series:
        machine = approx.Matcher(pattern, ins, delete, subst, most)
        there = np.flatnonzero(paths.notna())
        found = np.full(len(paths), -1)
        for at in range(0, len(there), 4096):
            some = there[at : at + 4096]
            found[some] = machine.costs_of(paths.iloc[some].tolist())
        return pd.Series(pd.array(found, "Int32")).mask(found < 0)

    return cost(F.when(possible(path, pattern, ins, delete, subst, most), path))


def best_matches(tiles: DataFrame, pattern: str, path: str = "path", ins: int = 10, delete: int = 10, subst: int = 10, most: int = 2) -> DataFrame:
    """All rows at the least cost, with that cost; none if nothing matches. Rows are scored once."""
    costs = (ins, delete, subst, most)
    near = tiles if min(ins, delete, subst) > most else tiles.where(possible(F.col(path), pattern, *costs))
    scored = written(near.withColumn("cost", name_cost(F.col(path), pattern, *costs)).where("cost is not null"))
    least = scored.agg(F.min("cost").alias("cost"))
    return scored.join(F.broadcast(least), "cost", "left_semi")  # one row


def find_one(tiles: DataFrame, pattern: str, order: str = "id", **costs):
    """The last of the best matches; none at all raises."""
    row = best_matches(tiles, pattern, **costs).orderBy(F.col(order).desc()).head()
    if row is None:
        raise LookupError(f"no tile matches {pattern!r}")
    return row


def edit_distance(text: Column, word: str) -> Column:
    return F.levenshtein(text, F.lit(word))


def signs(ref: list[int], columns: list[str]) -> Column:
    """'[ - +   ]': where the reference lies behind (-), before (+) or level."""
    parts = [F.when(F.lit(r) > F.col(c), " -").when(F.lit(r) < F.col(c), " +").otherwise("  ") for r, c in zip(ref, columns)]
    return F.concat(F.lit("["), *parts, F.lit("]"))


def neighbours(tiles: DataFrame, ref, corners: bool = True) -> DataFrame:
    """Tiles that hit the reference row's box (itself among them); without corners only those whose origin differs on one axis at most."""
    out = tiles.where(hit_literal([ref[f"o{d}"] for d in range(3)], [ref[f"s{d}"] for d in range(3)]))
    if not corners:
        differ = sum(((F.col(f"o{d}") != ref[f"o{d}"]).cast("int") for d in range(3)), F.lit(0))
        out = out.where(differ <= 1)
    return out


def neighbours_by_name(tiles: DataFrame, pattern: str, corners: bool = True, **costs) -> DataFrame:
    """signs and path of the neighbours of the one best match; several or no matches raise."""
    found = best_matches(tiles, pattern, **costs).limit(2).collect()
    if len(found) != 1:
        raise LookupError(f"{pattern!r} has {'no match' if not found else 'several matches'}")
    ref = found[0]
    return neighbours(tiles, ref, corners).select(signs([ref[f"o{d}"] for d in range(3)], ["o0", "o1", "o2"]).alias("signs"), "path")
