"""What a Python worker remembers between batches.

Workers live on from stage to stage. Each operator keeps some words it has met; when another
operator starts in the same worker, that memory is given back.
"""

from __future__ import annotations

import pyarrow as pa

_caches: list[dict] = []


def remembered(cache: dict) -> dict:
    """Registers a cache of this worker."""
    _caches.append(cache)
    return cache


def claim(*mine: dict) -> None:
    """Forgets all registered caches but these; called where a task begins."""
    others = [c for c in _caches if c and not any(c is m for m in mine)]
    for cache in others:
        cache.clear()
    if others:
        pa.default_memory_pool().release_unused()
