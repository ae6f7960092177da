from kindred.functions.hashing import band_count, hash_coefficients, universal_hash
from kindred.functions.scores import (
    clip,
    error_bin,
    jaccard_from_counts,
    pearson_from_sums,
    safe_ratio,
)

__all__ = [
    "band_count",
    "clip",
    "error_bin",
    "hash_coefficients",
    "jaccard_from_counts",
    "pearson_from_sums",
    "safe_ratio",
    "universal_hash",
]
