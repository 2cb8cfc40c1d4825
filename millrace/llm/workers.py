"""What a worker process builds of a file it is sent, kept for its next batches and tasks."""

from __future__ import annotations

import gc
from collections.abc import Callable
from typing import TypeVar

import pyarrow as pa

KEPT = 2  # files whose products stay, those used last

T = TypeVar("T")
_kept: dict[str, dict[type, object]] = {}


def built(kind: type[T], digest: str, make: Callable[[], T]) -> T:
    """The ``kind`` made of the file with this digest, once for each process.

    A worker lives on from job to job, and each job broadcasts the file anew, so neither the
    broadcast's value nor its address can be the key.
    """
    products = _kept[digest] = _kept.pop(digest, {})  # the last one used comes last
    while len(_kept) > KEPT:
        del _kept[next(iter(_kept))]
    if kind not in products:
        products[kind] = make()
    return products[kind]


def make_room() -> None:
    """Drop what steps before this one built here; steps that hold much of their own begin with it.

    An idle product stays in its worker else, beside the sets, points and texts of the next step.
    """
    if _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
