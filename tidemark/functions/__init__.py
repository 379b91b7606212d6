"""Scalar helpers: typed high-water marks and the predicates built from them."""

from .marks import Mark, after, any_not_null, batch_max, coerce, kind_of, literal, mark_type

__all__ = ["Mark", "after", "any_not_null", "batch_max", "coerce", "kind_of", "literal", "mark_type"]
