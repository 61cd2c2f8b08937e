"""Paths on any store."""

from __future__ import annotations


def join_path(*parts: str) -> str:
    """Path parts with one slash between them."""
    head, *tail = parts
    return "/".join([head.rstrip("/"), *[p.strip("/") for p in tail if p]])
