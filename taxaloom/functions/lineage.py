"""Clade paths (``k__A|p__B|…``) and stratified feature ids (``CODE: NAME|STRATUM``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Rank names from the root down, and the prefix of each level name.
RANKS = ["KINGDOM", "PHYLUM", "CLASS", "ORDER", "FAMILY", "GENUS", "SPECIES", "SGB"]
PREFIXES = ["k__", "p__", "c__", "o__", "f__", "g__", "s__", "t__"]
UNKNOWN_TAXA = "GGB|SGB"
STRATUM_MARK = "|"
NAME_MARK = ": "
UNCLASSIFIED = "unclassified"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def levels(path: Column | str) -> Column:
    return F.split(_col(path), r"\|")


def last_level(path: Column | str) -> Column:
    return F.element_at(levels(path), -1)


def level_from_end(path: Column | str, n: int) -> Column:
    """The ``n``-th level counted from the end (1 = last); null when there are fewer."""
    return F.try_element_at(levels(path), F.lit(-n))


def _prefix(name: Column) -> Column:
    return F.substring(name, 1, 3)


def rank_by_prefix(name: Column | str) -> Column:
    """Rank of a level name by its prefix; null when the prefix is not known."""
    table = F.create_map(*[F.lit(x) for pair in zip(PREFIXES, RANKS) for x in pair])
    return F.try_element_at(table, _prefix(_col(name)))


def clean_name(name: Column | str) -> Column:
    """Level name without its rank prefix and with spaces; null when the prefix is not known."""
    name = _col(name)
    spaced = F.replace(F.replace(name, _prefix(name), F.lit("")), F.lit("_"), F.lit(" "))
    return F.when(_prefix(name).isin(PREFIXES), spaced)


def rank_by_depth(path: Column | str) -> Column:
    """Rank by the number of levels; more than eight levels is an error."""
    depth = F.size(levels(path))
    ranks = F.array(*[F.lit(r) for r in RANKS])
    return F.when(depth <= len(RANKS), F.get(ranks, depth - 1)).otherwise(
        F.raise_error(F.concat(F.lit("too many levels: "), _col(path))).cast("string")
    )


def level_columns(path: Column | str) -> list[Column]:
    """One column per rank; missing levels are null."""
    parts = levels(path)
    return [F.get(parts, F.lit(i)).alias(r) for i, r in enumerate(RANKS)]


def split_feature(feature: Column | str) -> Column:
    """``struct(code, name, stratum)`` of a feature id; a second stratum mark is an error."""
    parts = levels(feature)
    head = F.get(parts, F.lit(0))
    mark = F.instr(head, NAME_MARK)
    code = F.when(mark > 0, F.substring(head, F.lit(1), mark - 1)).otherwise(head)
    name = F.when(mark > 0, F.substring(head, mark + len(NAME_MARK), F.length(head)))
    checked = F.when(F.size(parts) <= 2, code).otherwise(
        F.raise_error(F.concat(F.lit("a feature name has too many parts: "), _col(feature))).cast("string")
    )
    return F.struct(checked.alias("code"), name.alias("name"), F.get(parts, F.lit(1)).alias("stratum"))


def join_feature(code: Column | str, name: Column | str, stratum: Column | str) -> Column:
    """Inverse of :func:`split_feature`; null parts are left out."""
    return F.concat_ws(STRATUM_MARK, F.concat_ws(NAME_MARK, _col(code), _col(name)), _col(stratum))


def taxon_label(stratum: Column | str) -> Column:
    """Readable taxon of a ``g__X.s__X_y`` stratum."""
    s = _col(stratum)

    def pretty(c: Column, prefix: str) -> Column:
        return F.replace(F.replace(c, F.lit(prefix), F.lit("")), F.lit("_"), F.lit(" "))

    species = pretty(F.get(F.split(s, r"\."), F.lit(1)), "s__")
    return F.when(s.contains("s__"), species).when(s.contains("g__"), pretty(s, "g__")).otherwise(s)


def genus_of(stratum: Column | str) -> Column:
    """The part of a stratum before its first dot."""
    return F.get(F.split(_col(stratum), r"\."), F.lit(0))


def is_stratified(term: Column | str) -> Column:
    return _col(term).contains(STRATUM_MARK)
