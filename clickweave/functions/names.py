"""Column-name normalisation (B-01)."""

from __future__ import annotations


def to_snake_case(name: str) -> str:
    """strip, lower, drop parentheses, space/hyphen -> ``_``, then a single
    left-to-right pass that turns ``__`` into ``_`` (so ``____`` becomes ``__``)."""
    out = name.strip().lower()
    for old, new in (("(", ""), (")", ""), (" ", "_"), ("-", "_"), ("__", "_")):
        out = out.replace(old, new)
    return out
