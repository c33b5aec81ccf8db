"""Small helpers that run on the driver."""

from __future__ import annotations

from collections.abc import Iterable


def quote_arguments(arguments: Iterable[str]) -> str:
    """Arguments in one line; those with a space stand in double quotes."""
    return " ".join(f'"{a}"' if " " in a else a for a in arguments)


def genome_index_sizes(length: int, chromosomes: int) -> tuple[int, int]:
    """Suffix-array prefix length and chromosome bin bits that suit a genome (the aligner's documented rule)."""
    from math import floor, log2

    return min(14, floor(log2(length) - 1)), min(18, floor(log2(max(length / chromosomes, 150))))
