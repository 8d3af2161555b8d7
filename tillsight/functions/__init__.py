"""Column expressions used by the operators."""

from .exprs import (
    clip,
    fixed,
    half_up,
    hash_key,
    hash_uniform,
    linear_bin,
    num,
    ratio_or_zero,
    scalar_of,
    slug,
    strip_prefix,
    title,
)

__all__ = [
    "clip", "fixed", "half_up", "hash_key", "hash_uniform", "linear_bin", "num",
    "ratio_or_zero", "scalar_of", "slug", "strip_prefix", "title",
]
