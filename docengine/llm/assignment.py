"""One-to-one assignment of the largest total weight."""

from __future__ import annotations

import heapq
from collections.abc import Hashable


def best_assignment(edges: dict[Hashable, dict[Hashable, float]]) -> dict[Hashable, Hashable]:
    """Of ``edges`` (left, right, weight over 0) the pairs, each left and right used at most once, whose weights sum to most.

    Lefts are added one by one along the cheapest augmenting path; one may also stay alone at weight 0. Of equal totals the one found by the
    order of the keys.
    """
    most = max((w for e in edges.values() for w in e.values()), default=0.0)
    price: dict[Hashable, float] = {}
    owner: dict[Hashable, Hashable] = {}
    taken: dict[Hashable, Hashable] = {}
    alone = lambda left: ("alone", left)
    cost = lambda left: [*((r, most - w) for r, w in sorted(edges[left].items())), (alone(left), most)]
    slack: dict[Hashable, float] = {}
    for root in sorted(edges):
        slack[root] = min(c - price.get(r, 0.0) for r, c in cost(root))
        far: dict[Hashable, float] = {}
        via: dict[Hashable, Hashable] = {}
        done: dict[Hashable, float] = {}
        heap: list[tuple[float, str, Hashable]] = []
        left, at = root, 0.0
        while True:
            for r, c in cost(left):
                d = at + c - slack[left] - price.get(r, 0.0)
                if r not in done and d < far.get(r, float("inf")) - 1e-15:
                    far[r], via[r] = d, left
                    heapq.heappush(heap, (d, str(r), r))
            while True:
                at, _, right = heapq.heappop(heap)
                if right not in done and at <= far[right]:
                    break
            done[right] = at
            if right not in owner:
                break
            left = owner[right]
        reached = at
        slack[root] += reached
        for r, d in done.items():
            if r in owner:
                slack[owner[r]] += reached - d
            price[r] = price.get(r, 0.0) - (reached - d)
        while True:
            left = via[right]
            before = taken.get(left)
            owner[right], taken[left] = left, right
            if left == root:
                break
            right = before
    return {left: right for left, right in taken.items() if right != alone(left)}
