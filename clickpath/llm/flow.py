"""Minimum-cost flow on a small bipartite graph of shards (driver side, shards x shards numbers)."""

from __future__ import annotations


def min_cost_transport(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Flow[i][j] from old shard i to new shard j that ships all supply at the least cost.

    Successive shortest augmenting paths (Bellman-Ford labels) on the residual
    graph source -> old -> new -> sink.  Needs sum(capacity) >= sum(supply).
    """
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards cannot hold all bytes")
    olds, news = len(supply), len(capacity)
    flow = [[0] * news for _ in range(olds)]
    left, room = list(supply), list(capacity)
    while any(left):
        # label every node with the cheapest way to reach it from an old shard that still has bytes
        far = [0 if x else None for x in left]
        reach: list[int | None] = [None] * news
        came_old: list[int | None] = [None] * olds
        came_new = [0] * news
        changed = True
        while changed:
            changed = False
            for i in range(olds):
                if far[i] is None:
                    continue
                for j in range(news):
                    if reach[j] is None or far[i] + cost[i][j] < reach[j]:
                        reach[j], came_new[j], changed = far[i] + cost[i][j], i, True
            for j in range(news):
                if reach[j] is None:
                    continue
                for i in range(olds):
                    back = reach[j] - cost[i][j]
                    if flow[i][j] and (far[i] is None or back < far[i]):
                        far[i], came_old[i], changed = back, j, True
        end = min((j for j in range(news) if room[j]), key=lambda j: (reach[j], j))
        path, j = [], end
        while True:
            i = came_new[j]
            path.append((i, j, 1))
            if came_old[i] is None:
                break
            j = came_old[i]
            path.append((i, j, -1))
        start = path[-1][0]
        amount = min([left[start], room[end]] + [flow[i][j] for i, j, sign in path if sign < 0])
        for i, j, sign in path:
            flow[i][j] += sign * amount
        left[start] -= amount
        room[end] -= amount
    return flow
