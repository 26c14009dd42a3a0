"""Argument validation shared by the operators.

The reference loops forever for k = 0 or z < 0 and prints nothing for H < 0;
here such arguments are rejected before any job runs.
"""

from __future__ import annotations


def check_k_z(k: int, z: int) -> None:
    if int(k) != k or k < 1:
        raise ValueError(f"k must be an integer >= 1, got {k!r}")
    if int(z) != z or z < 0:
        raise ValueError(f"z must be an integer >= 0, got {z!r}")


def check_alpha(alpha: float) -> None:
    if not alpha >= 0:
        raise ValueError(f"alpha must be >= 0, got {alpha!r}")


def check_parts(parts: int) -> None:
    if int(parts) != parts or parts < 1:
        raise ValueError(f"the number of parts L must be an integer >= 1, got {parts!r}")


def check_top(h: int) -> None:
    if int(h) != h or h < 1:
        raise ValueError(f"H must be an integer >= 1 for a top-H report, got {h!r}")


def check_salts(salts: int) -> None:
    if int(salts) != salts or salts < 1:
        raise ValueError(f"the number of salt buckets K must be >= 1, got {salts!r}")


def is_all_countries(country: str | None) -> bool:
    """``None`` or the word ``all`` in any case means: no country filter."""
    return country is None or country.lower() == "all"
