"""Sorted runs: front coding, and merging by a loser tree that knows common prefixes.

A run is a sorted sequence of byte strings, each written as the length of the prefix it
shares with the one before and the rest. The tree keeps for every loser the length of the
prefix that it shares with the string that beat it. Two strings with different such
lengths are in order without being read; with equal lengths they are compared behind
their common prefix only. So no known prefix is compared again, and the merged sequence
comes with its own prefix lengths.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


def shared_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes are known."""
    n = min(len(a), len(b))
    away = int.from_bytes(a[known:n]) ^ int.from_bytes(b[known:n])
    return n - (away.bit_length() + 7) // 8


def front_code(keys: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Shared prefix lengths and rests of a sorted sequence."""
    shared, rests, before = [], [], b""
    for key in keys:
        n = shared_prefix(before, key)
        shared.append(n)
        rests.append(key[n:])
        before = key
    return shared, rests


def front_decode(shared: Iterable[int], rests: Iterable[bytes]) -> Iterator[tuple[bytes, int]]:
    """(string, prefix shared with the one before) of a front-coded run."""
    key = b""
    for n, rest in zip(shared, rests):
        key = key[:n] + rest
        yield key, n


def front_code_rows(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Shared prefix lengths and joined rests of sorted rows of equal width."""
    width = rows.shape[1]
    shared = row_prefixes(rows).astype(np.uint8)
    return shared, rows[np.arange(width) >= shared[:, None]].tobytes()


def row_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row shares with the one before; 0 for the first."""
    shared = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        away = rows[1:] != rows[:-1]
        shared[1:] = np.where(away.any(axis=1), away.argmax(axis=1), rows.shape[1])
    return shared


def front_decode_rows(shared: bytes, rests: bytes, width: int) -> Iterator[tuple[bytes, int]]:
    """The run of `front_code_rows`, string by string."""
    key, at = b"", 0
    for n in shared:
        end = at + width - n
        key = key[:n] + rests[at:end]
        at = end
        yield key, n


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Merge sorted runs of (string, prefix shared with the one before in the run).

    Yields (run, string, prefix shared with the string yielded before). Equal strings come
    in the order of their runs.
    """
    size = 1
    while size < len(runs):
        size *= 2
    keys: list[bytes] = [b""] * size
    prefix = [-1] * size  # -1: the run has ended, and loses against everything
    for i, run in enumerate(runs):
        first = next(run, None)
        if first is not None:
            keys[i], prefix[i] = first[0], 0
    loser, known = [0] * size, [-1] * size

    def build(node: int) -> tuple[int, int]:
        if node >= size:
            return node - size, prefix[node - size]
        (a, pa), (b, pb) = build(2 * node), build(2 * node + 1)
        if pa < 0 or pb < 0:
            if pa < pb:
                a, pa, b, pb = b, pb, a, pa
            loser[node], known[node] = b, pb
            return a, pa
        if keys[b] < keys[a]:
            a, b = b, a
        loser[node], known[node] = b, shared_prefix(keys[a], keys[b])
        return a, 0

    best, same = build(1)
    while same >= 0:
        yield best, keys[best], same
        nxt = next(runs[best], None)
        if nxt is None:
            same = -1
        else:
            keys[best], same = nxt
        node = (best + size) >> 1
        while node:
            other = known[node]
            if same < other:
                loser[node], best = best, loser[node]
                known[node], same = same, other
            elif same == other and same >= 0:
                rival = loser[node]
                mine, its = keys[best], keys[rival]
                n = min(len(mine), len(its))
                away = int.from_bytes(mine[same:n]) ^ int.from_bytes(its[same:n])
                known[node] = n - ((away.bit_length() + 7) >> 3)
                if its < mine or (its == mine and rival < best):
                    loser[node], best = best, rival
            node >>= 1


def deal(order: np.ndarray, runs: int) -> np.ndarray:
    """Place of each merged item in its run, from the run numbers in merged order."""
    by_run = np.argsort(order, kind="stable")
    sizes = np.bincount(order, minlength=runs)
    place = np.empty(len(order), np.int64)
    place[by_run] = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return place
